"""Triggered sync of a change feed into a published table. Safe to run again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.search import PUBLISHED_COLUMNS
from plumbline.session import is_small, pinned
from plumbline.sources.tables import BUCKET, BUCKETS, exists, read, replace_rows, with_bucket

VERSION = "_version"
DELETED = "_deleted"


def publish_feed(feed: DataFrame, folder: str, version: int) -> None:
    """Add the changes of one run to the feed folder."""
    feed.withColumn(VERSION, F.lit(version).cast("bigint")).write.mode("append").parquet(folder)


def sync(spark: SparkSession, feed: str, target: str, checkpoint: str, key: str = "chunk_id", columns: tuple[str, ...] = PUBLISHED_COLUMNS, buckets: int = BUCKETS) -> None:
    """Take all changes not seen yet and bring the target to their state.

    A batch is reduced to the newest change per key with a partial aggregate, then only the buckets it
    touches are rewritten. Every row keeps the version it came with, a deleted one stays as a tombstone:
    a change that is older than what the target holds does nothing, whatever order batches come in, and
    a batch that is repeated after a failure gives the same table.
    """
    schema = spark.read.parquet(feed).schema
    published = [c for c in schema.names if c in columns and c != key]

    def apply(batch: DataFrame, batch_id: int) -> None:
        lasting = F.col("_change_type") != "delete"
        # a tombstone has no columns to carry
        kept = [F.when(lasting, F.col(c)).alias(c) for c in published]
        changes = batch.where(F.col("_change_type") != "update_preimage").select(key, VERSION, (~lasting).alias(DELETED), *kept)
        newest = pinned(with_bucket(_newest(changes, key), buckets, key), "changes")
        if exists(spark, target):
            touched = [r[0] for r in newest.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
            held = read(spark, target).where(F.col(BUCKET).isin(touched)).select(key, F.col(VERSION).alias("_held"))
            stale = newest.select(key, VERSION).join(held, key).where(~F.coalesce(F.col(VERSION) >= F.col("_held"), F.lit(False)) & F.col("_held").isNotNull())
            newest = _without(newest, pinned(stale.select(key).distinct(), "stale"), key)
        newest = newest.drop(BUCKET)
        replace_rows(target, newest.select(key, VERSION, DELETED, *published), buckets, key)

    query = (
        spark.readStream.schema(schema)
        .parquet(feed)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed; few keys are broadcast, so the rows stay where they are."""
    return rows.join(F.broadcast(keys) if is_small(keys) else keys, key, "left_anti")


def _newest(changes: DataFrame, key: str) -> DataFrame:
    """The newest change per key; of two changes in one version the row that stays wins: a feed holds an update as
    a pair. Keys alone are counted first: where few occur twice, only their rows are shuffled."""
    rest = [c for c in changes.columns if c != key]
    twice = changes.groupBy(F.col(key).alias("_twice")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    twice = pinned(twice.select("_twice"), "twice")
    several, once = changes, None
    if is_small(twice):
        same = F.col(key).eqNullSafe(F.col("_twice"))
        several = changes.join(F.broadcast(twice), same, "left_semi")
        once = changes.join(F.broadcast(twice), same, "left_anti")
    reduced = several.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(VERSION, ~F.col(DELETED))).alias("r")).select(key, "r.*")
    return reduced if once is None else reduced.unionByName(once)


def current(spark: SparkSession, target: str) -> DataFrame:
    """The published rows, without tombstones."""
    return read(spark, target).where(~F.col(DELETED)).drop(BUCKET, VERSION, DELETED)
