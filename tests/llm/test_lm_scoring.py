import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import lm_scoring as m

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tokens(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def plain(docs, k=4.0):
    fold = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    train = [tokens(t) for i, t in docs if not fold(i)]
    c = Counter(w for t in train for w in t)
    pair = Counter(p for t in train for p in zip(["^", *t], t))
    c_begin = Counter({"^": len(train)})
    n, v = sum(c.values()), len(c)
    out = {}
    for i, t in docs:
        t, base, score = tokens(t), 0.0, 0.0
        for a, w in zip(["^", *t], t):
            uni = (c[w] + 0.5) / (n + 0.5 * (v + 1))
            context = c_begin[a] if a == "^" else c[a]
            base += math.log10(uni)
            score += math.log10(pair[a, w] / (context + k) + k / (context + k) * uni)
        out[i] = (fold(i), len(t), sum(c[w] > 0 for w in t), n, base, score)
    return out


def test_scores_match_the_plain_way(spark, monkeypatch):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdé") for _ in range(rnd.randrange(1, 5))) for _ in range(300)]
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "Ab aB\x0bAB É é"), (5, "very long " * 30000), (6, "nowhere else to_be seen")]
    docs += [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(60)))) for i in range(10, 300)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS).repartition(5)
    monkeypatch.setattr(m, "table", lambda *_: df)
    for size in (8 << 20, 20000):  # one block, and many
        monkeypatch.setattr(m.Bigram, "__init__", lambda self, s=size: self.__dict__.update(prior=4.0, block_bytes=s))
        rows = {r.doc_id: r for r in m.op3_lm_scoring(spark, "").collect()}
        assert len(rows) == len(docs)
        for i, (held, n, known, total, base, score) in plain(docs).items():
            r = rows[i]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
            assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
            assert abs(r.score - score) <= n * 0.5 / m.STEPS + 1e-9  # what quantisation may cost


def test_squeeze():
    for x in ([], [0], [1, 2, 300], [2**64 - 1, 0], list(range(5000))):
        assert m.unsqueeze(m.squeeze(np.array(x, np.uint64))).tolist() == x


def test_edges(spark):
    df = spark.createDataFrame([(None, "a b", None, None, None), (7, "a b", "en", "s", 1), (7, "a b", "en", "s", 1)], DOCS)
    df = df.withColumn("score", F.lit("clash")).withColumn("block", F.lit(1)).withColumn("_row", F.lit(2))
    rows = m.score_texts(df, F.col("doc_id") == 7).collect()
    assert len(rows) == 3 and {r.train_tokens for r in rows} == {6} and {r.n_known for r in rows} == {3} and {r._row for r in rows} == {2}
    rows = m.score_texts(df, F.lit(False)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score, r.score) for r in rows} == {(0, 0, 0.0, 0.0)}
    assert m.score_texts(df.limit(0), F.lit(True)).count() == 0
