"""Registry of queries: a name, a function (session, data folder) -> DataFrame, and its SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query. Without `sql` only its rows are checked there, its values in tests/."""

    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def longs(*columns: str):
    """Give counters and positions as BIGINT, the type they have on the SQL side."""

    def wrap(function):
        @functools.wraps(function)
        def cast(spark, folder):
            return function(spark, folder).withColumns({c: F.col(c).cast("bigint") for c in columns})

        return cast

    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on an input with fewer splits than cores, as one small file has.

    At scale a table has far more splits than cores, and this is the table itself.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def day(c: Column | str) -> Column:
    """Dates as text, so that both engines give the same value."""
    return F.date_format(c, "yyyy-MM-dd")


def instant(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
