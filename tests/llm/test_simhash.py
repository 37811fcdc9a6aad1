import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from plumbline.llm import simhash as s

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", low) if x]
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_roots(prints):
    """Smallest id reachable over pairs at three or fewer bits."""
    root = {i: i for i, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, x) in enumerate(prints):
        for j, y in prints[:n]:
            if (x ^ y).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def test_fingerprints_and_components(spark):
    rnd = random.Random(2)
    word = lambda: rnd.choice(["A", "b", "Ée", "c", "dd", "é", "x\x85y", "Z9"])
    texts = [None, "", " \n", "a", "A b", "a\tb", "x y z", "X Y Z", "x\ny\vz w"]
    base = [word() for _ in range(300)]
    for _ in range(150):
        w = list(base)
        for _ in range(rnd.randrange(6)):
            w[rnd.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts += [" ".join(word() for _ in range(rnd.randrange(1, 40))) for _ in range(150)]
    texts.append("long words " * 60000)
    df = spark.createDataFrame([(i * 3, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS).withColumn("fp", F.lit("clash"))
    rows = s.near_duplicates(df).collect()
    assert len(rows) == len(texts)
    prints = [(i * 3, plain_fingerprint(t)) for i, t in enumerate(texts)]
    assert {r._id: r._fp & (2**64 - 1) for r in rows} == dict(prints)
    assert {r._id: r._root for r in rows} == plain_roots(prints)


def test_links_are_exact_for_every_plan_and_large_runs(spark):
    rnd = np.random.default_rng(4)
    seeds = rnd.integers(0, 2**64, 6, dtype=np.uint64)
    near = [seeds[i % 6] ^ np.uint64(sum(1 << int(b) for b in rnd.integers(0, 64, rnd.integers(0, 5)))) for i in range(900)]
    fps = np.unique(np.concatenate([np.array(near, np.uint64), rnd.integers(0, 2**64, 200, dtype=np.uint64)]))
    expected = plain_roots([(int(x), int(x)) for x in fps])
    for n in (10, 10**6, 10**9, 10**12):
        tables = s.plan_blocks(n, 3)
        every = {b for t in tables for b in t}
        assert sum(w for _, w in every) == 64
        a, b = [], []
        for t in tables:
            group = np.unique(s.key_of(fps, t), return_inverse=True)[1].astype(np.uint64)
            x, y = s.linked(fps, group, sorted(every - set(t)), 3)
            a.append(x)
            b.append(y)
        a, b = s.spanning(np.concatenate(a), np.concatenate(b))
        got = {int(x): int(x) for x in fps} | {int(x): int(y) for x, y in zip(a, b)}
        assert got == expected


def test_edges(spark):
    df = spark.createDataFrame([(None, "a b c d", None, None, None), (5, "a b c d", "en", "s", 1), (5, "a b c d", "en", "s", 1), (9, None, None, None, None)], DOCS)
    rows = sorted((str(r._id), str(r._root)) for r in s.near_duplicates(df).collect())
    assert rows == [("5", "5"), ("5", "5"), ("9", "9"), ("None", "5")]
    assert s.near_duplicates(df.limit(0)).count() == 0


def test_one_of_each(spark):
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(4, base), (2, base.replace("w7 ", "W7 ")), (2, base), (9, "other text"), (9, "other text"), (None, base), (None, "alone"), (5, None), (6, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).withColumn("_n", F.lit(1))
    out = s.one_of_each(df)
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), r.text is None or r.text[:5]) for r in out.collect()) == [("2", "w0 w1"), ("5", True), ("9", "other"), ("None", "alone")]
