import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from plumbline.llm import spelling as sp

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_counts(rows, least_letters=7, least_count=2):
    out = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = "".join(c for i, c in enumerate(run) if i != h % len(run))
            if len(run) >= least_letters:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= least_count}


def plain_near(words):
    """Words that a wildcard in some place, or a letter less, makes equal."""
    by_hole, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by_hole[(i, w[:i] + w[i + 1 :])].add(w)
            if (less := w[:i] + w[i + 1 :]) in words:
                near[w].add(less)
                near[less].add(w)
    for group in by_hole.values():
        for w in group:
            near[w] |= group - {w}
    return near


def plain(rows, least_letters=7, least_count=2):
    n = plain_counts(rows, least_letters, least_count)
    near = plain_near(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def got(df, **kw):
    found = sp.variants(df, **kw).collect()
    rows = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found}
    assert len(rows) == len(found)
    return rows


def some_texts(seed, n, alphabet="abàß", length=(3, 6), words=400):
    """Few letters, so that most words have near words; frequencies far apart, so that forms chain."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choices(alphabet, k=rnd.randint(*length))) for _ in range(words)]
    weights = [rnd.choice((1, 1, 1, 12, 150)) for _ in vocabulary]
    return [(i, rnd.choice([" ", ", ", "\n", "1"]).join(rnd.choices(vocabulary, weights, k=rnd.randint(0, 80)))) for i in range(n)]


@pytest.mark.parametrize("group", [1024, 6])
def test_against_brute_force(spark, group):
    rows = some_texts(1, 150)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df, least_letters=3, group=group) == plain(rows, 3)


def test_chains_are_followed_to_the_last(spark):
    words = [("kettenwort", 60_000), ("kettenword", 4_000), ("ketenword", 300), ("ketenworde", 24), ("ketenwordee", 2), ("anderes", 7)]
    rows = [(i, f"{w} {w}") for w, n in words for i in range(n // 2)]
    found = got(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found == plain(rows)
    assert {r[0]: r[2] for r in found}["ketenwordee"] == "kettenwort"


def test_crowded_windows_are_halved_and_bounded(spark):
    """All words share all letters but two: whatever the group, every key ends up small."""
    letters = "abcdefghijklmnopqrstuvwxyzàáâ"
    words = [(f"stammwort{a}{b}", 2 + (a == b)) for a in letters for b in letters]
    df = spark.createDataFrame(words, "word string, n long")
    rows = sp.window_rows(df, group=50)
    keys = rows.groupBy("key", "hi", "lo").count().where("count > 50").collect()
    assert len(keys) < 9 and all(r.hi - r.lo == 1 for r in keys)  # only as longer words, with two letters free
    near = {r.word: r.n_near for r in sp.near_counts(rows).collect()}
    expected = plain_near({w for w, _ in words})
    assert near == {w: len(expected[w]) for w, _ in words}


def test_one_edit_and_distances():
    words = ["abcdefg", "abcdefgh", "xabcdefg", "abcxdefg", "abcdxfg", "gfedcba", "aabbccdd", "aabbccd", "abbccdd", "y" * 5000, "y" * 4999]
    letters, length = sp.letter_matrix(words)
    counts = sp.letter_counts(letters, length)
    d = sp.squared_distances(counts, counts)
    for i, x in enumerate(words):
        for j, y in enumerate(words):
            a, b = Counter(x), Counter(y)
            assert d[i, j] == sum((a[c] - b[c]) ** 2 for c in a | b)
    near = plain_near(set(words[:9]))
    for i in range(9):
        for j in range(9):
            if i != j and length[j] - length[i] in (0, 1):
                ok, _ = sp.one_edit(letters, length, np.array([i]), np.array([j]))
                assert ok[0] == (words[j] in near[words[i]]), (words[i], words[j])


def test_edges(spark):
    schema = "doc_id long, text string, word string, n int, id int"
    rows = [(1, "Spelling SPELLING spelling", "x", 1, 2), (1, "Spelling SPELLING spelling", "x", 1, 2), (None, "Straße " * 9, None, None, None), (2, None, None, None, None), (3, "", None, None, None)]
    assert got(spark.createDataFrame(rows, schema), least_letters=6) == plain([r[:2] for r in rows], 6)
    assert sp.variants(spark.createDataFrame([], schema)).count() == 0
    long = [(1, "z" * 30_000 + " " + "z" * 30_000), (2, "z" * 30_001 + " " + "z" * 30_001)]
    assert got(spark.createDataFrame(long, "doc_id long, text string")) == plain(long)


def test_ties_go_to_the_first_in_code_point_order(spark):
    rows = [(0, "aaaaaaaé " * 30 + "aaaaaaaz " * 30 + "aaaaaaaa " * 2)]
    found = {r[0]: r[1] for r in got(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert found["aaaaaaaa"] == "aaaaaaaz"


def test_query_on_all_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = sp.op13_spelling(spark, folder).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == plain(docs)
