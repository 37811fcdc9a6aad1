"""A training corpus from raw documents: quality rules, near-duplicate removal, removal of repeated
paragraphs, mixing of sources, packing into sequences.

Every stage takes (session, documents, data folder) and works on all documents that the stage before
has kept; all but the last return the columns of documents. Each stage's result is written below the
shared folder and read again by the next, so a lost executor costs at most a stage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.llm import mixing, packing, paragraphs, quality_rules, simhash  # noqa: E402
from plumbline.llm.base import table  # noqa: E402
from plumbline.session import pinned  # noqa: E402

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(df: DataFrame) -> DataFrame:
    return df.select(*DOCUMENTS)


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the risk-controlled cutoffs accept. Null texts go."""
    return _columns(quality_rules.judge(docs, table(spark, sf_dir, "labels")).where("_kept"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints the document with the smallest id; of repeated rows one."""
    return _columns(simhash.one_of_each(docs))


def drop_repeated_paragraphs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the long paragraphs and passages that an earlier place has; n_chars follows the text."""
    return _columns(paragraphs.without_passages(docs).withColumn("n_chars", F.length("text").cast("bigint")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in the order of the mix; small sources start over."""
    return _columns(mixing.mixed(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and place."""
    return packing.pack(docs, packing.public_tokenizer())


STAGES = [
    ("quality_rules", keep_by_rules),
    ("simhash", keep_one_of_near_copies),
    ("substring_dedup", drop_repeated_paragraphs),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Hash votes, MinHash minima and token ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
