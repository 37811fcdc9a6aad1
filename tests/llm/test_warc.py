import base64
import gzip
import hashlib
import random

from pyspark.sql import functions as F

from plumbline.llm import warc as w
from plumbline.session import scratch_path

PAGES = "page_id long, url string, html string"
b32 = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()


def pages(spark):
    rnd = random.Random(1)
    html = [None, "", "<p>é𝔘\r\n\r\nWARC/1.1\r\n</p>", "x" * 3_000_017, "y\r\n\r\n"] + ["<b>%d</b>" % rnd.randrange(40) for _ in range(120)]
    rows = [(i, None if i % 7 == 0 else f"http://e/{i}\n", h) for i, h in enumerate(html)]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, PAGES).withColumn("sha1", F.lit("clash")).repartition(4)


def test_round_trip(spark, monkeypatch):
    rows, df = pages(spark)
    monkeypatch.setattr(w, "SPLIT", 5000)
    where = scratch_path(spark, "warc")
    chunks = w.read_chunks(w.splits_of(w.write_archives(w.classify(df), where), 3000), where, chunk=65536).collect()
    payload = {i: (h or "").encode() for i, _, h in rows}
    first = {}
    for i in sorted(payload):
        first.setdefault(payload[i], i)
    by_page = {}
    for c in chunks:
        by_page.setdefault(c.page_id, []).append(c)
    assert set(by_page) == set(payload)
    for i, parts in by_page.items():
        parts.sort(key=lambda c: c.chunk)
        whole = payload[i]
        assert [c.last for c in parts] == [False] * (len(parts) - 1) + [True]
        assert parts[0].declared_bytes == len(whole) and parts[0].declared_digest == b32(whole)
        if first[whole] == i:
            assert (parts[0].record_type, parts[0].refers_to) == ("response", None)
            assert b"".join(c.payload for c in parts) == whole
            for c in parts:  # the digest is carried from chunk to chunk
                assert c.size <= 65536 and c.digest == b32(whole[: c.start + c.size])
        else:
            assert (parts[0].record_type, parts[0].refers_to, len(parts)) == ("revisit", first[whole], 1)
    archives = spark.read.format("binaryFile").load(where).select("content").collect()
    assert sum(gzip.decompress(bytes(a.content)).count(b"\r\nWARC-Type: ") for a in archives) == len(rows)


def test_query_and_edges(spark, monkeypatch):
    rows, df = pages(spark)
    odd = spark.createDataFrame([(None, None, "lonely"), (None, "u", "<b>1</b>"), (500, "u", "again"), (500, "u", "again"), (501, "u", "again")], PAGES)
    monkeypatch.setattr(w, "table", lambda *_: df.drop("sha1").unionByName(odd))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in w.op8_warc(spark, "").collect()]
    assert len(got) == len(rows) + 5
    assert [g[3:] for g in got if g[0] == 500] == [("response", None)] * 2
    assert (501, 5, b32(b"again"), "revisit", 500) in got
    assert sorted(g[3] for g in got if g[0] is None) == ["response", "revisit"]
    monkeypatch.setattr(w, "table", lambda *_: df.drop("sha1").limit(0))
    assert w.op8_warc(spark, "").count() == 0


def test_small_payloads_stay_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], PAGES)
    got = {r.page_id: r.refers_to for r in w.classify(df, revisit_bytes=3).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


def test_splits_are_read_by_many_tasks(spark):
    df = spark.range(160).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("page "), "id").alias("html")).repartition(4)
    where = scratch_path(spark, "warc")
    splits = w.splits_of(w.write_archives(w.classify(df), where), 500)
    rows = w.read_chunks(splits, where).withColumn("task", F.spark_partition_id())
    n, tasks, pages = splits.count(), rows.select("task").distinct().count(), rows.where("last").select("page_id").distinct().count()
    assert n >= 80 and tasks > n // 2 and pages == 160
