"""Incremental maintenance: what changed, the new state, and the row-level change feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import pinned

STATUS = ("new", "changed", "unchanged", "removed")


def classify(stored: DataFrame, incoming: DataFrame, key: str = "doc_id", digest: str = "content_hash", full_refresh: bool = False) -> DataFrame:
    """(key, stored hash, incoming hash, status) for every id on either side.

    A union and one partial aggregate do the work of a full outer join, which AQE could not
    split for a hot key. `full_refresh` treats every incoming row as changed.
    """
    none = F.lit(None).cast("string")
    before = stored.select(key, F.col(digest).alias("_old"), none.alias("_new"))
    now = incoming.select(key, none.alias("_old"), F.col(digest).alias("_new"))
    sides = before.unionByName(now).groupBy(key).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    same = F.lit(False) if full_refresh else F.col("_old") == F.col("_new")
    status = (
        F.when(F.col("_new").isNull(), "removed")
        .when(F.col("_old").isNull(), "new")
        .when(same, "unchanged")
        .otherwise("changed")
    )
    return sides.select(key, F.col("_old").alias("stored_hash"), F.col("_new").alias("incoming_hash"), status.alias("status"))


def to_write(diff: DataFrame, key: str = "doc_id") -> DataFrame:
    return diff.where(F.col("status").isin("new", "changed")).select(key)


def to_delete(diff: DataFrame, key: str = "doc_id") -> DataFrame:
    return diff.where(F.col("status").isin("changed", "removed")).select(key)


def rows_of(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of the listed ids. The ids are unique, so rows spread as the ids do."""
    return df.join(ids.select(key), key, "left_semi")


def apply_diff(stored: DataFrame, incoming: DataFrame, diff: DataFrame, key: str = "doc_id") -> DataFrame:
    """New state of a table: changed and removed rows out, new and changed rows in."""
    untouched = stored.join(to_delete(diff, key), key, "left_anti")
    return untouched.unionByName(rows_of(incoming, to_write(diff, key), key), allowMissingColumns=True)


def write_stats(diff: DataFrame, chunks: DataFrame, quarantined: DataFrame | None = None, errors: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """One row of counts describing an incremental run."""

    def n(df: DataFrame | None) -> Column:
        return F.lit(0).cast("bigint") if df is None else df.agg(F.count(F.lit(1))).scalar()

    status = F.col("status")
    counts = diff.agg(
        F.count_if(status != "removed").alias("documents_seen"),
        F.count_if(status.isin("new", "changed")).alias("documents_changed"),
        F.count_if(status == "removed").alias("documents_removed"),
        F.count_if(status == "unchanged").alias("documents_unchanged"),
    )
    written = rows_of(chunks.select(key), to_write(diff, key), key)
    return counts.withColumns(
        {"chunks_written": n(written), "quarantined": n(quarantined), "errors": n(errors)}
    )


def change_feed(before: DataFrame, after: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Rows to delete, insert and update (before and after image) between two snapshots.

    The snapshots are compared by digest, so only keys and digests are shuffled; the rows
    themselves are fetched for the keys that changed. Keys are unique per snapshot.
    """
    columns = [c for c in after.columns if c != key]

    def digests(df: DataFrame) -> DataFrame:
        return df.select(key, F.sha2(F.to_json(F.struct(*columns)), 256).alias("_digest"))

    diff = classify(digests(before), digests(after), key, "_digest").select(key, "status").where("status <> 'unchanged'")
    diff = pinned(diff, "feed-diff")

    def rows(df: DataFrame, names: dict[str, str]) -> DataFrame:
        kinds = F.coalesce(*[F.when(F.col("status") == s, F.lit(kind)) for s, kind in names.items()])
        hit = diff.where(F.col("status").isin(*names)).select(key, kinds.alias("_change_type"))
        return df.join(hit, key).select(key, "_change_type", *columns)

    gone = rows(before, {"removed": "delete", "changed": "update_preimage"})
    return gone.unionByName(rows(after, {"new": "insert", "changed": "update_postimage"}))


def replay(state: DataFrame, feed: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Apply a change feed to a snapshot."""
    gone = feed.where(F.col("_change_type").isin("delete", "update_preimage")).select(key)
    added = feed.where(F.col("_change_type").isin("insert", "update_postimage")).drop("_change_type")
    return state.join(gone, key, "left_anti").unionByName(added)
