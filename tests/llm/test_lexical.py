import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import lexical as lx
from plumbline.llm.words import word_slices

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def plain(docs, items, k=20):
    listed = [(i, plain_terms(t)) for i, t in docs]
    n_docs, n_all = sum(1 for _, ts in listed if ts), sum(len(ts) for _, ts in listed)
    df = Counter(t for _, ts in listed for t in set(ts))
    out = []
    for item, text in items:
        asked = plain_terms(text)
        found = []
        for i, ts in listed:
            tf = Counter(ts)
            m = 100 - 25 + (25 * len(ts) * n_docs) // n_all if n_all else 0
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in asked if tf[t])
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda f: f[:2] + (f[2] or 0,))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def got(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in lx.ranked(d, q, **kw).collect()), key=repr)


def some(seed, n_docs, n_items):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "éa", "9", "A-b"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choices(words, weights, k=n))
    docs = [(i, text(rnd.choice((0, 3, 20, 60)))) for i in range(n_docs)]
    docs += [(1000 + i, docs[5][1]) for i in range(80)] + [(7, docs[3][1]), (None, docs[4][1]), (3000, None), (3001, "!!")]
    return docs, [(i, text(rnd.randint(0, 12))) for i in range(n_items)] + [(90, None), (91, "absent"), (92, "w1 w1 W1")]


@pytest.mark.parametrize("seed,leaf,rows,items_each", [(1, 32, 4096, 1024), (2, 2, 64, 2)])
def test_against_brute_force(spark, monkeypatch, seed, leaf, rows, items_each):
    monkeypatch.setattr(lx, "BLOCK_ITEMS", items_each)
    docs, items = some(seed, 150, 5)
    assert got(spark, docs, items, k=7) == plain(docs, items, 7)
    # the same through trees of another shape, built here as their sizes travel with the code
    monkeypatch.setattr(lx, "LEAF", leaf)
    rnd = np.random.default_rng(seed)
    tf = rnd.poisson(0.4, (500, 40)).astype(np.int32)
    tf[100:200] = tf[100]
    m, ids = rnd.integers(75, 300, 500), rnd.permutation(500)
    tree = lx.Tree([np.flatnonzero(r) for r in tf], tf, m, ids)
    for _ in range(20):
        terms, weight = rnd.choice(40, 6, replace=False), rnd.integers(0, 9000, 6)
        best = lx.Best(10)
        tree.search(terms, weight, best)
        score = (weight * lx.saturation(tf[:, terms].astype(np.int64), m[:, None])).sum(axis=1)
        expected = sorted((-s, i) for s, i in zip(score.tolist(), ids.tolist()) if s > 0)[:10]
        assert [(-s, i) for s, i in zip(best.scores.tolist(), best.ids.tolist())] == expected


def test_nodes_cover_all_rows_and_bounds_hold():
    rnd = np.random.default_rng(5)
    tf = rnd.poisson(0.2, (700, 30)).astype(np.int32)
    tree = lx.Tree([np.flatnonzero(r) for r in tf], tf, np.full(700, 80), np.arange(700))
    leaves = sorted(tree.range[i] for i, c in enumerate(tree.children) if not c)
    assert leaves[0][0] == 0 and leaves[-1][1] == 700 and all(a[1] == b[0] for a, b in zip(leaves, leaves[1:]))
    for node, (lo, hi) in enumerate(tree.range):
        assert (tree.top[node] == tree.tf[lo:hi].max(axis=0)).all()


def test_slices_are_cut_between_words():
    text = "one Two, three-four " * 50 + "é" * 40
    assert [w.decode() for part in word_slices(text, 16) for w in part] == plain_terms(text)


def test_edges(spark):
    items = [(1, "a b"), (1, "a b"), (2, None)]
    assert got(spark, [], items) == []
    assert got(spark, [(1, None), (2, " ")], items) == []
    assert got(spark, [(1, "a")], []) == []
    docs = [(1, "a c"), (1, "a c"), (2, "c " * 3000), (3, "d")]
    assert got(spark, docs, items) == plain(docs, items)
    wide = spark.createDataFrame([(1, "a", "x", 3)], "doc_id long, text string, terms string, n int")
    asked = spark.createDataFrame([(1, "a", 2)], "item_id long, text string, rank int")
    assert lx.ranked(wide, asked).columns == ["item_id", "rank", "doc_id", "score"]
