"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset and all runs in one process, a folder of our own. On a cluster it has to be set."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        there = tempfile.mkdtemp(prefix="deltaloom-")
        atexit.register(shutil.rmtree, there, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", there)
    return there.rstrip("/")
