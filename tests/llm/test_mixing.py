import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from plumbline.llm import mixing as m

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, sizes):
    rows, n = [], 0
    for s, k in sizes.items():
        for _ in range(k):
            rows.append((n, f"t{n}", "en", s, 2))
            n += 1
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("weights", [None, {"a": 5, "b": 1, "c": 0.01, "d": 3, None: 1}])
def test_every_prefix_stays_within_a_block(spark, monkeypatch, weights):
    monkeypatch.setattr(m, "RANGE_ROWS", 50)
    sizes = {"a": 700, "b": 90, "c": 3, "d": 40, None: 33}
    mix = m.Mix(weights, period=200, block_rows=4)
    asked = weights or {s: k**0.9 for s, k in sizes.items()}
    asked = {s: w / sum(asked.values()) for s, w in asked.items()}
    period = 200 if weights is None else 1001
    rows = m.schedule(docs(spark, sizes).withColumn("_key", F.lit("x")).withColumn("n", F.lit(1)), mix).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r._mix.slot, []).append(r)
        assert r._mix.release <= r._mix.slot < r._mix.deadline
    assert sorted(slots) == list(range(len(slots)))  # no slot is idle
    weight = {r.source: r._mix.weight for r in rows}
    assert abs(sum(weight.values()) - 1) < 1e-9
    placed = Counter()
    for t in range(len(slots)):
        assert len({(r.source, r._mix.block) for r in slots[t]}) == 1  # one block per slot
        placed[slots[t][0].source] += 1
        assert len(slots[t]) == 4 or t == len(slots) - 1  # and it is full, but for the last
        assert all(abs(placed[s] - (t + 1) * w) < 1 + (t + 1) // period for s, w in weight.items())
    seen = Counter(r.doc_id for r in rows)
    assert len(seen) == sum(sizes.values())  # nothing is lost
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, Counter())[r.doc_id] += 1
    for c in by_source.values():  # a source starts over only when it is through
        assert max(c.values()) - min(c.values()) <= 1
    if weights is None:  # the rarest sources have a block a period
        assert all(abs(weight[s] - asked[s]) <= 0.011 for s in sizes)
    else:
        assert all(abs(weight[s] - asked[s]) < 1e-12 for s in sizes)


def test_plain_schedule(spark):
    """The slots are those of a plain earliest-deadline-first loop, in exact fractions."""
    weights = {"a": 7, "b": 2, "c": 1, "d": 6}
    df = docs(spark, {s: 64 for s in weights})
    got = {r._mix.slot: (r.source, r._mix.block) for r in m.schedule(df, m.Mix(weights, block_rows=2)).collect()}
    share, placed = {s: Fraction(w, 16) for s, w in weights.items()}, Counter()
    for t in range(max(got) + 1):
        released = [s for s in sorted(weights) if placed[s] / share[s] // 1 <= t]
        best = min(released, key=lambda s: (math.ceil((placed[s] + 1) / share[s]), s))
        assert got[t] == (best, placed[best])
        placed[best] += 1


def test_asked_weights(spark):
    """Rows follow the weights asked for, a very small one and a source of one and a bit blocks, too."""
    rows = m.schedule(docs(spark, {"a": 33, "b": 3000}), m.Mix({"a": 0.5, "b": 0.5})).groupBy("source").count().collect()
    count = {r["source"]: r["count"] for r in rows}
    assert abs(count["a"] - count["b"]) <= 32
    rare = m.schedule(docs(spark, {"a": 2, "b": 5000}), m.Mix({"a": 0.0001, "b": 0.9999}, block_rows=1)).groupBy("source").count().collect()
    count = {r["source"]: r["count"] for r in rare}
    assert abs(count["a"] - 0.0001 * sum(count.values())) < 1


def test_mixed_keeps_columns_and_order(spark):
    df = docs(spark, {"a": 300, "b": 100})
    out = m.mixed(df, m.Mix({"a": 1, "b": 1}, block_rows=10))
    assert out.columns == df.columns
    firsts = [r.source for r in out.collect()][:400]
    assert abs(Counter(firsts)["a"] - 200) <= 10


def test_edges(spark):
    df = docs(spark, {"a": 5})
    assert m.schedule(df.limit(0)).count() == 0
    assert m.schedule(df, m.Mix({"zzz": 1})).count() == 0
    assert m.schedule(df, m.Mix({})).count() == 0
    twice = df.union(df).union(spark.createDataFrame([(None, None, None, "a", None)], DOCS))
    assert m.schedule(twice).count() == 11
    many = docs(spark, {f"s{i}": 1 + i % 3 for i in range(150)})
    assert m.schedule(many, m.Mix(period=10, block_rows=1)).select("doc_id").distinct().count() == many.count()
