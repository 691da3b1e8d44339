"""Where queries and the SQL that gives the same rows are registered."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir, f=f: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        ORACLES[f.__name__] = sql
        return f

    return register


def place(spark: SparkSession) -> str:
    """A folder that driver and executors share, for queries that write: spark.checkpoint.dir; where that is unset, in a session of one
    process, one of this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or tempfile.mkdtemp(prefix="spark-")).rstrip("/")
