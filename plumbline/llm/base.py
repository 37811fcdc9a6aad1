"""What the operators share: the registry of their queries, the word pattern, tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# What separates words, as a character class and as the characters themselves.
BLANK = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"


def query(name: str, sql: str | None = None):
    """Register a query of this package, with its SQL where SQL can express it."""

    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_list(text: Column) -> Column:
    """The words of a text, in order; none for a text of blanks only."""
    return F.filter(F.split(text, BLANK + "+"), lambda w: w != "")


def slices(batches, column: int, size: int = 2 << 20):
    """The rows of Arrow batches again, with about `size` bytes of text at a time: what a task makes of
    a slice is a multiple of its text, so this bounds the memory. A longer text is a slice of its own.
    Slices are copies: some string functions of Arrow read views with an offset wrongly."""
    for batch in batches:
        texts = batch.column(column)
        ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.take(pa.array(np.arange(start, stop)))
            start = stop


def shared_state(spark: SparkSession, model):
    """A function that gives `model` in a task. Its fields are sent once per executor; its class travels
    with the function, so the package need not be importable there."""
    state, kind = spark.sparkContext.broadcast(vars(model)), type(model)

    def get():
        found = object.__new__(kind)
        found.__dict__.update(state.value)
        return found

    return get


def carried(docs: DataFrame) -> DataFrame:
    """All columns as one struct `_row`, so that no name of theirs meets a name of an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def unpacked(docs: DataFrame, added: tuple[str, ...] = (), **replaced: Column) -> list[Column]:
    """The columns of `docs` out of `_row`, without those that are added, some with a new value."""
    return [replaced.get(c, F.col("_row")[c]).alias(c) for c in docs.columns if c not in added]


def partitions_for(df: DataFrame, column: str, target: int, least: int = 1) -> int:
    """How many parts of about `target` bytes the texts in `column` make. One aggregate."""
    size = df.agg(F.sum(F.octet_length(column) + F.lit(16))).first()[0] or 0
    return max(least, -(-int(size) // target))
