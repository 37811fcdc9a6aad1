import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from plumbline.llm import merkle as m

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def plain_pieces(line):
    out, piece = [], ""
    for w in re.findall(r"(?:[\u2E80-\uD7AF\uF900-\uFAFF]|[^\x20\x09-\x0D\u2E80-\uD7AF\uF900-\uFAFF]{1,64})[\x20\x09-\x0D]*|[\x20\x09-\x0D]+", line):
        piece += w
        if hashlib.md5(w.encode()).hexdigest()[0] in "0123":
            out, piece = [*out, piece], ""
    return [*out, piece] if piece else out


def plain_root(text):
    paragraph = lambda p: sha("".join(sha(x) for x in plain_pieces(p)))
    return sha("".join(sha("".join(paragraph(p) for p in s.split("\n"))) for s in text.split("\n\n")))


def dice(a, b):
    a, b = ({x for line in t.split("\n") for x in plain_pieces(line)} for t in (a, b))
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


@pytest.mark.parametrize("size", [8 << 20, 2000])  # one range of ids, and many
def test_query_matches_the_plain_way(spark, monkeypatch, size):
    rnd = random.Random(6)
    texts = [None, "", "a", "ab", "é𝔘x", "a\n\nb\nc", "\n\n\n", " \t", "x" * 5000, "word " * 20000]
    texts += ["".join(rnd.choice(["ab", "é", " ", " ", "\n", "\n\n"]) for _ in range(rnd.randrange(300))) for _ in range(80)]
    ids = rnd.sample(range(-(10**6), 10**6), len(texts) - 1) + [2**62]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in zip(ids, texts)], DOCS).withColumn("_key", F.lit(1)).repartition(4)
    monkeypatch.setattr(m, "RANGE_BYTES", size)
    monkeypatch.setattr(m, "table", lambda *_: df)
    rows = {r.doc_id: r for r in m.op4_merkle(spark, "").collect()}
    assert len(rows) == len(texts)
    ordered = sorted((i, t or "") for i, t in zip(ids, texts))
    for (i, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        half, r = len(t) // 2, rows[i]
        edited = t[: len(t) - half] + following[:half]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(edited))
        assert (r.fingerprint, r.edited_fingerprint) == (plain_root(t), plain_root(edited))
        assert abs(r.near_edited - dice(t, edited)) < 1e-12 and abs(r.near_next - dice(t, following)) < 1e-12
        if t == edited:
            assert (r.edit_section, r.edit_paragraph) == (None, None)
        else:
            a, b = [[s.split("\n") for s in x.split("\n\n")] for x in (t, edited)]
            s, p = r.edit_section, r.edit_paragraph
            assert a[:s] == b[:s] and (a[s] if s < len(a) else []) != (b[s] if s < len(b) else [])
            x, y = (a[s] if s < len(a) else []), (b[s] if s < len(b) else [])
            assert x[:p] == y[:p] and x[p : p + 1] != y[p : p + 1]


def test_edges(spark, monkeypatch):
    rows = [(None, "b", None, None, None), (3, "same", "en", "s", 1), (3, "same", "en", "s", 1), (9, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(m, "table", lambda *_: df)
    got = sorted((str(r.doc_id), r.n_chars, r.near_next) for r in m.op4_merkle(spark, "").collect())
    assert got == [("3", 4, 0.0), ("3", 4, 1.0), ("9", 0, 0.0), ("None", 1, 0.0)]
    monkeypatch.setattr(m, "table", lambda *_: df.limit(1))
    assert m.op4_merkle(spark, "").count() == 1
    monkeypatch.setattr(m, "table", lambda *_: df.limit(0))
    assert m.op4_merkle(spark, "").count() == 0


def test_an_edit_changes_only_the_pieces_it_touches(spark):
    latin = " ".join(f"word{i}" for i in range(400))
    han = "".join(chr(0x4E00 + i * 37 % 5000) for i in range(400))
    pairs = [(latin, latin.replace("word2 ", "word2 more ")), (han, han[:3] + "多" + han[3:]), (latin, latin[:-7]), ("", ""), ("", "a")]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", m.tree(F.col("a")).alias("x"), m.tree(F.col("b")).alias("y"))
    got = df.select(m.likeness(F.col("x.leaves"), F.col("y.leaves"))).collect()
    assert min(r[0] for r in got[:3]) > 0.95 and [r[0] for r in got[3:]] == [1.0, 0.0]


def test_the_sql_is_the_query(spark, monkeypatch, tmp_path):
    import duckdb

    rnd = random.Random(2)
    parts = ["ab", "é", "多", "한", " ", " ", "\t", "\n", "\n\n", "word", "𝔘", "x" * 70]
    docs = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(80)))) for i in range(200)] + [(900, None), (901, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS)
    df.coalesce(1).write.parquet(f"{tmp_path}/d")
    monkeypatch.setattr(m, "table", lambda *_: df)
    rows = m.op4_merkle(spark, "")
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    expected = db.execute(f"select {', '.join(rows.columns)} from ({m.SQL})").fetchall()
    assert sorted(map(tuple, rows.collect())) == sorted(expected)
