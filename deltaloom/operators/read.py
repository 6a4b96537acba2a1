"""Reads of a materialised table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def find_all(df: DataFrame) -> DataFrame:
    return df


def find_by_id(df: DataFrame, value, key: str = "id") -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def find_all_by_id(df: DataFrame, values: Iterable, key: str = "id") -> DataFrame:
    return df.filter(F.col(key).isin(list(values)))


def exists_by_id(df: DataFrame, value, key: str = "id") -> bool:
    return bool(find_by_id(df, value, key).limit(1).take(1))


def count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def find_sorted(df: DataFrame, *order) -> DataFrame:
    return df.orderBy(*order)


def find_page(df: DataFrame, page: int, size: int, *order) -> DataFrame:
    """Page `page`, from 0."""
    return df.orderBy(*order).offset(page * size).limit(size)


def find_by_example(df: DataFrame, **values) -> DataFrame:
    """Rows equal to the given values; None matches nothing, it is no criterion."""
    for c, v in values.items():
        if v is not None:
            df = df.filter(F.col(c) == F.lit(v))
    return df
