import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as c
from plumbline.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark):
    """Clean documents, junk, exact and near copies, passages shared by documents, hot source."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n))
    passage, rows = line(70), []
    for i in range(300):
        rows.append((i, line(rnd.randrange(60, 90)) + ("\n" + passage if i % 10 == 3 else ""), "hot" if i % 3 else f"s{i % 4}"))
    rows += [(1000 + i, rows[i][1], "hot") for i in range(20)]
    long = line(3000)
    rows += [(2000, long, "hot"), (2001, long.replace(" ", "\t", 3) + " " + word(), "hot")]
    rows += [(3000 + i, "junk " * 80, "hot") for i in range(5)] + [(3100, "too short", "hot"), (3101, None, None), (3102, "", "hot")]
    where = scratch_path(spark, "corpus")
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS).write.parquet(f"{where}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{where}/labels.parquet")
    return where, rows, passage


def test_stages_in_turn(spark, folder):
    where, rows, passage = folder
    docs = spark.read.parquet(f"{where}/documents.parquet")
    kept = {}
    for name, stage in c.STAGES:
        out = stage(spark, docs, where)
        if name != "packing":
            assert out.columns == list(c.DOCUMENTS)
        docs = c.pinned(out, "test")
        kept[name] = docs.collect()
    ids = lambda name: sorted(r.doc_id for r in kept[name])
    clean = list(range(300))
    assert ids("quality_rules") == clean + [1000 + i for i in range(20)] + [2000, 2001]
    assert ids("simhash") == [*clean, 2000]
    assert ids("substring_dedup") == [*clean, 2000]
    assert sum(passage in r.text for r in kept["substring_dedup"]) == 1
    assert all(r.n_chars == len(r.text) for r in kept["substring_dedup"])
    assert set(ids("mixing")) == {*clean, 2000}
    texts = {r.doc_id: r.text for r in kept["substring_dedup"]}
    assert all(r.text == texts[r.doc_id] for r in kept["mixing"])
    copies = Counter(ids("mixing"))
    pieces = Counter(r.doc_id for r in kept["packing"] if r.piece == 0)
    assert pieces == copies
    ends = Counter()
    for r in kept["packing"]:
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 1024


def test_run_and_empty(spark, folder):
    where, _, _ = folder
    out = c.run(spark, where)
    assert {"doc_id", "piece", "sequence_id"} <= set(out.columns) and out.select("doc_id").distinct().count() == 301
    docs = spark.read.parquet(f"{where}/documents.parquet")
    for _, stage in c.STAGES:
        assert stage(spark, docs.limit(0), where).count() == 0
    extra = docs.withColumn("_fp", F.lit(1)).withColumn("quality", F.lit("x")).withColumn("_mix", F.lit(2))
    for _, stage in c.STAGES[:4]:
        assert stage(spark, extra, where).columns == list(c.DOCUMENTS)
