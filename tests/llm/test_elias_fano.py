import mmap

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from plumbline.llm import elias_fano as e
from plumbline.llm.words import Words


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (1, 10**12), (50, 50), (300, 10), (1000, 10**6), (5000, 2**40)])
def test_sequence(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    s = e.Sequence(e.encode(values))
    assert np.array_equal(s.get(np.arange(n)), values)
    asked = np.concatenate([values, rng.integers(0, 2 * top, 300, dtype=np.uint64), np.array([0, top], np.uint64)])
    found = s.find(asked)
    assert np.array_equal(found >= 0, np.isin(asked, values))
    assert np.array_equal(values[found[found >= 0]], asked[found >= 0])
    if n > 100:
        bits = 8 * (len(s.low) + len(s.high))
        assert bits <= n * (3 + max(0, np.log2(top / n))) + 200


@pytest.mark.parametrize("pairs", [0, 1, 40, 4000])
def test_trie_in_a_memory_map(tmp_path, pairs):
    rng = np.random.default_rng(pairs)
    both = np.unique(np.stack([rng.zipf(1.3, pairs) % 500, rng.integers(0, 10**6, pairs)], axis=1), axis=0).reshape(-1, 2)
    context, successor = both[:, 0].astype(np.uint64), both[:, 1].astype(np.uint64)
    value = rng.integers(0, 65536, len(both))
    path = tmp_path / "trie"
    path.write_bytes(e.build(context, successor, value))
    with open(path, "rb") as f:
        trie = e.Trie(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    at = trie.find(context, successor)
    assert np.array_equal(at, np.arange(len(both))) and np.array_equal(trie.values[at], value)
    known = {tuple(x) for x in both.tolist()}
    asked = np.stack([rng.integers(0, 600, 3000), rng.integers(0, 10**6 + 50, 3000)], axis=1)
    asked[: len(both) // 2] = both[: len(both) // 2][:3000]
    got = trie.find(asked[:, 0].astype(np.uint64), asked[:, 1].astype(np.uint64)) >= 0
    assert got.tolist() == [tuple(x) in known for x in asked.tolist()]


def test_words():
    texts = [None, "", " \t\n\x0b\x0c\r", "The the\x0bTHE É\x1cé\x85x\xa0y", " a\n"]
    w = Words(pa.array(texts))
    hashed = lambda *x: [xxhash.xxh3_64_intdigest(y.encode()) for y in x]
    assert w.count.tolist() == [0, 0, 0, 4, 1]
    assert w.known[w.code].tolist() == hashed("the", "the", "the", "É\x1cé\x85x\xa0y", "a")
    known, code, begin = w.framed()
    assert known[code].tolist() == [1, 2, 1, 2, 1, 2, 1, *hashed("the", "the", "the", "É\x1cé\x85x\xa0y"), 2, 1, *hashed("a"), 2]
    assert begin.tolist() == [0, 2, 4, 6, 12]
