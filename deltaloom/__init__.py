"""Change-data-capture apply engine on Spark DataFrames."""
