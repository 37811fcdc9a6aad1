"""Typed tables on Parquet: layout, create, overwrite, append, bucketed replace."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from plumbline.operators.changes import apply_diff
from plumbline.operators.shape import conform
from plumbline.session import pinned

BUCKET = "bucket"
BUCKETS = 64

# Columns and types of the stored tables.
DDL = {
    "bronze_documents": (
        "doc_id STRING NOT NULL, source_path STRING, source_type STRING, title STRING, content_hash STRING, "
        "raw_text STRING, status STRING, effective_date DATE, review_date DATE, service STRING, "
        "audience STRING, source_url STRING, licence STRING, ingested_at TIMESTAMP"
    ),
    "silver_chunks": (
        "chunk_id STRING NOT NULL, doc_id STRING, chunk_index INT, title STRING, section_path STRING, "
        "text STRING, token_count INT, page INT, source_type STRING, status STRING, effective_date DATE, "
        "service STRING, audience STRING, source_url STRING, chunk_max_tokens INT, "
        "chunk_overlap_tokens INT, ingested_at TIMESTAMP"
    ),
    "ops_pii_quarantine": (
        "doc_id STRING, source_path STRING, content_hash STRING, findings STRING, detected_at TIMESTAMP"
    ),
}


@dataclass(frozen=True)
class Layout:
    """Where the tables of one environment live: `<base>/<env>/<layer>_<name>`."""

    base: str
    env: str = "dev"

    def path(self, table: str) -> str:
        return f"{self.base.rstrip('/')}/{self.env}/{table}"


def schema_of(table: str) -> T.StructType:
    return T._parse_datatype_string(DDL[table])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table with files. One that cannot be read is an error, not an empty table."""
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def read(spark: SparkSession, path: str, schema: T.StructType | None = None, merge: bool = False) -> DataFrame:
    """A stored table, empty when there is none and a schema is given.

    `merge` is for tables that gained columns over time: files written before read as NULL there.
    It opens every file's footer, so it is only for the histories.
    """
    if schema is not None and not exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.option("mergeSchema", merge)
    return reader.parquet(path)


def create(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty typed table if there is none."""
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)


def overwrite(df: DataFrame, path: str, staged: bool = False) -> None:
    """Replace data and schema. With `staged` the rows are written aside first, so that `df` may
    read the table it replaces; Spark refuses that otherwise."""
    if staged:
        df = pinned(df, "staged")
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows; new columns are allowed, older rows read as NULL there."""
    df.write.mode("append").parquet(path)


def with_bucket(df: DataFrame, buckets: int, key: str = "doc_id") -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))


def replace_changed(stored_path: str, incoming: DataFrame, diff: DataFrame, buckets: int = BUCKETS, key: str = "doc_id") -> None:
    """Apply a diff to a bucketed table, rewriting only the buckets it touches, in one commit.

    Rows of other buckets are neither read nor written: the buckets are directories and the
    list of touched ones, at most `buckets` numbers, prunes the scan. Give a large table more
    buckets, so that a small change touches a small part.
    """
    spark = incoming.sparkSession
    changed = with_bucket(diff.where(F.col("status") != "unchanged"), buckets, key)
    touched = [r[0] for r in changed.select(BUCKET).distinct().collect()]
    if not touched:
        return
    stored = (
        spark.read.parquet(stored_path).where(F.col(BUCKET).isin(touched))
        if exists(spark, stored_path)
        else with_bucket(incoming.limit(0), buckets, key)
    )
    _rewrite(stored_path, apply_diff(stored, with_bucket(incoming, buckets, key), diff, key), touched)


def replace_rows(stored_path: str, rows: DataFrame, buckets: int = BUCKETS, key: str = "doc_id") -> None:
    """Put rows, one per key, in the place of those with their keys: `replace_changed` where all rows are changed
    ones. The rows are the diff, so they are not met with one; stored rows alone are."""
    spark = rows.sparkSession
    rows = with_bucket(rows.where(F.col(key).isNotNull()), buckets, key)
    touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
    if not touched:
        return
    state = rows
    if exists(spark, stored_path):
        stored = spark.read.parquet(stored_path).where(F.col(BUCKET).isin(touched))
        state = stored.join(rows.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True)
    _rewrite(stored_path, state, touched)


def _rewrite(stored_path: str, state: DataFrame, touched: list[int]) -> None:
    spark = state.sparkSession
    folders = {b: f"{stored_path}/{BUCKET}={b}" for b in touched}
    before = {b: _files(spark, folder) for b, folder in folders.items()}
    # Dynamic overwrite stages the new files and swaps directories when the job commits, so the
    # job may read the files it replaces. The hint gives files of the advisory size: a large
    # bucket is split over tasks, small ones share a task.
    (
        state.hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(stored_path)
    )
    # A bucket left without rows got no new files: nothing replaced the old ones. Should this be
    # cut off, the next run finds the same documents removed and deletes them then.
    for b, folder in folders.items():
        if before[b] and _files(spark, folder) == before[b]:
            _delete(spark, folder)


def _hadoop(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _files(spark: SparkSession, folder: str) -> set[str]:
    path, fs = _hadoop(spark, folder)
    return {f.getPath().getName() for f in fs.listStatus(path)} if fs.exists(path) else set()


def _delete(spark: SparkSession, folder: str) -> None:
    path, fs = _hadoop(spark, folder)
    fs.delete(path, True)


def stored_digest(spark: SparkSession, path: str) -> str | None:
    """Digest of the source a table was loaded from; None when there is no table yet."""
    if not exists(spark, path):
        return None
    return spark.read.parquet(path).agg(F.max("source_sha256")).first()[0]


def log_run(layout: Layout, run: str, params: dict[str, object], metrics: DataFrame, rows: DataFrame) -> None:
    """Append one evaluation run: its metrics with the parameters, and its rows per question."""
    pairs = [F.lit(str(x)) for kv in sorted(params.items()) for x in kv]
    stamped = metrics.withColumns({"run": F.lit(run), "params": F.create_map(*pairs)})
    append(stamped, layout.path("ops_eval_runs"))
    append(rows.withColumn("run", F.lit(run)), layout.path("ops_eval_rows"))


def store_run(layout: Layout, documents: DataFrame, chunks: DataFrame, quarantine: DataFrame, diff: DataFrame, run_at, buckets: int = BUCKETS) -> None:
    """Write one ingest run: chunks and documents by bucket, quarantine once per content.

    The diff is written down first, as it reads the table that is about to change. Documents come
    last: their hashes say what is done, so a run that is cut off is simply applied again.
    """
    spark = documents.sparkSession
    diff = pinned(diff, "diff")
    stamp = F.lit(run_at).cast("timestamp")
    held = conform(quarantine.withColumn("detected_at", stamp), schema_of("ops_pii_quarantine"))
    known = read(spark, layout.path("ops_pii_quarantine"), schema_of("ops_pii_quarantine"))
    new = held.join(known.select("doc_id", "content_hash"), ["doc_id", "content_hash"], "left_anti")
    append(new.select(held.columns), layout.path("ops_pii_quarantine"))
    for table, rows in (("silver_chunks", chunks), ("bronze_documents", documents)):
        typed = conform(rows.withColumn("ingested_at", stamp), schema_of(table))
        replace_changed(layout.path(table), typed, diff, buckets)


__all__ = [
    "DDL", "Layout", "append", "conform", "create", "exists", "log_run", "overwrite", "read", "replace_changed",
    "replace_rows", "schema_of", "store_run", "stored_digest", "with_bucket",
]
