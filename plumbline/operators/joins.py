"""Joins that hold whatever share of the rows one key has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import BROADCAST_ROWS, is_small, pinned

TASK_ROWS = 1_000_000  # rows of one key that one task joins; a key with more is hot
KEYLESS_SALTS = 256  # parts of the rows without a key, which meet nothing


def join_sized(rows: DataFrame, other: DataFrame, key: str, spread: list[str], how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join on `key`: by broadcast when `other` was measured and is small, else skew-safe."""
    if is_small(other, limit):
        return rows.join(F.broadcast(other), key, how)
    return skew_safe_join(rows, other, key, spread, how)


def skew_safe_join(rows: DataFrame, other: DataFrame, key: str, spread: list[str], how: str = "inner") -> DataFrame:
    """Join by shuffle so that no key of `rows` fills one task.

    Keys with more than TASK_ROWS rows are counted with a partial aggregate and written once; they are
    at most one in TASK_ROWS of the rows. Such a key is dealt out by a hash of `spread` into as many
    salts as it has TASK_ROWS, so every part has about that many rows whatever its share, and the rows it
    meets are copied per salt; all other keys join as they are. Rows without a key meet nothing and are
    salted too.
    """
    hot = (
        rows.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_hot"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > TASK_ROWS)
        .select("_hot", F.ceil(F.col("_n") / TASK_ROWS).cast("int").alias("_salts"))
    )
    hot = pinned(hot, "hot-keys")
    hot = F.broadcast(hot) if is_small(hot) else hot
    salts = F.when(F.col(key).isNull(), F.lit(KEYLESS_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = rows.join(hot, F.col(key) == F.col("_hot"), "left")
    salted = salted.withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int")).drop("_hot", "_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copied = other.join(hot, F.col(key) == F.col("_hot"), "left").select(*other.columns, F.explode(copies).alias("_salt"))
    return salted.join(copied, [key, "_salt"], how).drop("_salt")
