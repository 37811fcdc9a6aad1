import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import language as g

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


class Plain:
    """PPM with escape method C and without exclusions, byte by byte."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for t in texts:
            t = bytes([10]) * order + t
            for i in range(order, len(t)):
                for k in range(order + 1):
                    self.seen[t[i - k : i]][t[i]] += 1

    def bits(self, text):
        t, total = bytes([10]) * self.order + text, 0.0
        for i in range(self.order, len(t)):
            for k in range(self.order, -1, -1):
                c = self.seen.get(t[i - k : i])
                if c is None:
                    continue
                n, u = sum(c.values()), len(c)
                if t[i] in c:
                    total += -math.log2(c[t[i]] / (n + u))
                    break
                total += -math.log2(u / (n + u))
            else:
                total += 8
        return total


def counts(texts, order):
    word, _ = g.windows(pa.array(texts, pa.binary()), order)
    return [(k, *x) for k in range(order + 1) for x in zip(*np.unique(g.low_bytes(word, k + 1), return_counts=True))]


@pytest.mark.parametrize("order", [0, 2, 4])
def test_code_lengths_match_the_plain_way(order):
    rnd = random.Random(order)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 9)))
    train = {lang: [" ".join(word(a) for _ in range(50)).encode() for _ in range(6)] for lang, a in {"x": "abcdeé", "y": "cdefgü", "z": "qz"}.items()}
    rows = [(lang, k, gram, n) for lang, t in train.items() for k, gram, n in counts(t, order)]
    rnd.shuffle(rows)
    lang, at, gram, n = (np.array(c) for c in zip(*rows))
    model = g.Model(order, lang, at, gram.astype(np.uint64), n)
    texts = [b"", b"a", "abé cdü".encode(), bytes(range(256)), *(t for v in train.values() for t in v)]
    got = model.code_lengths(*g.windows(pa.array(texts, pa.binary()), order))
    plain = [Plain(train[x], order) for x in model.languages]
    assert np.allclose(got, [[p.bits(t) for p in plain] for t in texts])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = g.train(docs.where(~g.held_out(F.col("doc_id"))))
    out = g.identify(docs, model).where(g.held_out(F.col("doc_id")))
    right, n = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right >= 0.99


def test_query_and_edges(spark, monkeypatch):
    rows = [(i, ("the cat sat on the mat " if i % 2 else "le chat est sur le tapis ") * (1 + i % 5), "en" if i % 2 else "fr", "s", 0) for i in range(60)]
    rows += [(100, None, "en", "s", 0), (101, "", "en", "s", 0), (102, "123 !? \n", "fr", "s", 0), (103, "the mat", None, None, None), (None, "le tapis", None, None, None)]
    rows += [(105, "the cat " * 50000, None, None, None), (1, rows[1][1], "en", "s", 0)]
    df = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash")).withColumn("_row", F.lit(1))
    monkeypatch.setattr(g, "table", lambda *_: df)
    out = g.op1_language(spark, "").collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert [by_id[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by_id[100].score == 0
    assert [by_id[i].lang_pred for i in (103, None, 105, 1, 2)] == ["en", "fr", "en", "en", "fr"]
    assert all(0 <= r.score <= 1 for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    kept = g.identify(df, g.train(df))
    assert {"_row", "lang", "score"} <= set(kept.columns) and dict(kept.dtypes)["score"] == "double"
    assert g.train(df.limit(0)).languages.size == 0
    assert {r.lang_pred for r in g.identify(df, g.train(df.limit(0))).collect()} == {"und"}
    assert g.identify(df.limit(0), g.train(df)).count() == 0


def test_large_languages_are_sampled(spark):
    """A language of 2 * 10 ** 10 characters: the bound on the sample holds, and nothing overflows."""
    params = g.Ppm()
    rows = spark.range(2_000_000).select(g.is_drawn(F.lit(0), "id", F.lit(20_000_000_000), params).alias("drawn"))
    share = rows.agg(F.avg(F.col("drawn").cast("int"))).first()[0]
    assert 0.3 < share / (params.sample_chars / 2e10) < 3
    assert spark.range(100).where(g.is_drawn(F.lit(0), "id", F.lit(0), params)).count() == 100
