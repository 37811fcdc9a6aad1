"""Session helpers: a local session for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sizes up to which data may be held whole by every executor. Both are measured, not assumed.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 64 << 20


def local_session(cores: str | int = "*", memory: str = "12g", app: str = "plumbline") -> SparkSession:
    """A session for one machine. On a cluster use the session the cluster gives you."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def pinned(df: DataFrame, name: str, **options) -> DataFrame:
    """The rows of `df`, written once below the shared folder: what reads them repeats nothing,
    sees no later change of the sources, and survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True when `df` has at most `rows` rows and, written as JSON, at most `size` bytes.

    Reads no more than `rows` + 1 rows.
    """
    bytes_of = F.octet_length(F.to_json(F.struct(*df.columns)))
    n, total = df.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(bytes_of)).first()
    return n <= rows and (total or 0) <= size
