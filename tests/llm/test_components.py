import random

import numpy as np
import pytest

from plumbline.llm import components as c
from plumbline.llm.components import components, spanning


def plain(pairs):
    root = {}
    for a, b in pairs:
        for x in (a, b):
            root.setdefault(x, x)
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= (root[a], root[b]) != (low, low)
            root[a] = root[b] = low
    return root


@pytest.mark.parametrize("kind,local", [("long", 10**6), ("long", 0), ("binary", 10**6), ("binary", 0)])
def test_components(spark, monkeypatch, kind, local):
    monkeypatch.setattr(c, "LOCAL_EDGES", local)
    rnd = random.Random(1)
    chain = list(range(1000, 1200))
    rnd.shuffle(chain)
    pairs = list(zip(chain, chain[1:])) + [(5, x) for x in range(6, 80)] + [(2, 2), (300, 301), (301, 300)]
    pairs += [(rnd.randrange(400, 700), rnd.randrange(400, 700)) for _ in range(200)]
    as_kind = (lambda x: x.to_bytes(4)) if kind == "binary" else (lambda x: x)
    df = spark.createDataFrame([(as_kind(x), as_kind(y)) for x, y in pairs], f"x {kind}, y {kind}")
    back = (lambda x: int.from_bytes(x)) if kind == "binary" else (lambda x: x)
    got = {back(r.node): back(r.root) for r in components(df, "x", "y").collect()}
    expected = plain(pairs)
    assert got == {k: v for k, v in expected.items() if k in got}
    assert {k for k, v in expected.items() if v != k} <= set(got)
    a, b = spanning(np.array([x for x, _ in pairs]), np.array([y for _, y in pairs]))
    assert dict(zip(a.tolist(), b.tolist())) == {k: v for k, v in expected.items() if v != k}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0
