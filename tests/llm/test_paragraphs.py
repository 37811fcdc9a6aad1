import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from plumbline.llm import paragraphs as p

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(t):
    return [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)) if x]


def shingles(t):
    w = words(t)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def plain(docs, least=50):
    """Every paragraph to the class of all that are connected by Jaccard 0.8 or more."""
    items = [(d, i, line) for d, t in docs for i, line in enumerate((t or "").split("\n")) if len(words(line)) >= least]
    sets = [shingles(x) for _, _, x in items]
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    members = {}
    for i, (d, k, _) in enumerate(items):
        members.setdefault(find(i), []).append((d, k))
    return {m: min(v) for v in members.values() if len(v) > 1 for m in v}


def corpus():
    rnd = random.Random(8)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(2, 9))) for _ in range(900)]
    line = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    shared = [line(rnd.randrange(50, 120)) for _ in range(12)]
    docs = [(1, None), (2, ""), (3, "\n\n"), (4, "short line\n" * 5), (5, "same " * 60 + "\n" + "same " * 60), (6, " ".join(line(40000)))]
    for d in range(10, 130):
        parts = []
        for _ in range(rnd.randrange(1, 4)):
            parts.append(" ".join(line(rnd.randrange(5, 90))))
            if rnd.random() < 0.6:
                w = list(rnd.choice(shared))
                for _ in range(rnd.choice([0, 0, 1, 2])):
                    w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
                parts.append("  ".join(x.upper() if rnd.random() < 0.1 and x.isascii() else x for x in w))
        docs.append((d, "\n".join(parts)))
    return docs


def test_classes_match_all_pairs(spark):
    docs = corpus()
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS).withColumn("node", F.lit(1)).repartition(5)
    rows = p.repeated_paragraphs(df).collect()
    got = {(r.doc_id, r.paragraph): (r.kept_doc_id, r.kept_paragraph) for r in rows}
    expected = plain(docs)
    assert len(rows) == len(got) and len(expected) > 100
    wrong = {k for k in expected if got.get(k) != expected[k]} | (set(got) - set(expected))
    assert len(wrong) <= 0.01 * len(expected)  # banding meets a pair at exactly 0.8 with probability 0.998
    text = dict(docs)
    for r in rows:
        assert r.removed == ((r.doc_id, r.paragraph) != (r.kept_doc_id, r.kept_paragraph))
        assert text[r.doc_id][r.start : r.start + r.length] == text[r.doc_id].split("\n")[r.paragraph]
    clean = {r.doc_id: r.text for r in p.without_repeats(df).collect()}
    gone = {}
    for r in rows:
        if r.removed:
            gone.setdefault(r.doc_id, set()).add(r.paragraph)
    for i, t in docs:
        assert clean[i] == (t if i not in gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]))


def test_a_large_group_of_near_copies_is_one_class(spark):
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    docs = []
    for d in range(1500):
        w = list(base)
        w[rnd.randrange(80)] = f"x{d}"
        docs.append((d, " ".join(w)))
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS)
    rows = p.repeated_paragraphs(df).collect()
    assert len(rows) == 1500 and {r.kept_doc_id for r in rows} == {0} and sum(r.removed for r in rows) == 1499


def test_large_buckets_lose_no_pair(spark):
    """Fillings of one form, unlike each other, with pairs of near copies among them: one bucket, parted or not."""
    rnd = random.Random(4)
    form = [f"form{i}" for i in range(60)]
    docs = []
    for d in range(240):
        own = [f"d{d}x{i}" for i in range(14)]
        docs.append((d, " ".join(form + own)))
        if d % 3 == 0:
            own[rnd.randrange(14)] = "else"
            docs.append((1000 + d, " ".join(form + own)))
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS).repartition(4)
    expected = plain(docs)
    assert len(expected) == 160
    for size in (3, 40, 10**6):  # tiles of blocks, keys of shingles, whole buckets
        banding = p.Banding(bands=8, rows=1, bucket_rows=size)
        got = {(r.doc_id, r.paragraph): (r.kept_doc_id, r.kept_paragraph) for r in p.repeated_paragraphs(df, banding).collect()}
        assert got == expected


def test_first_shingles_meet(spark):
    rnd = random.Random(9)
    sets = []
    for k in range(120):
        x = rnd.sample(range(60), rnd.randrange(1, 30))
        y = [v for v in x if rnd.random() > 0.07] + ([rnd.randrange(60)] if rnd.random() < 0.5 else [])
        sets += [(2 * k, sorted(set(x))), (2 * k + 1, sorted(set(y or x)))]
    df = spark.createDataFrame(sets, "node long, shingles array<long>")
    first = {}
    for r in p.first_shingles(df, 0.8).collect():
        first.setdefault(r.node, set()).add(r.shingle)
    pairs = [(i, j) for i, x in sets for j, y in sets if i < j and len(set(x) & set(y)) >= 0.8 * len(set(x) | set(y))]
    assert len(pairs) > 50 and all(first[i] & first[j] for i, j in pairs)
    for i, x in sets:
        assert len(first[i]) == len(x) - -(-4 * len(x) // 5) + 1


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, long, None, None, None), (7, long, "en", "s", 1), (7, long, "en", "s", 1), (8, long, "en", "s", 1)], DOCS)
    rows = {r.doc_id: r for r in p.repeated_paragraphs(df).collect()}
    assert {i: (r.kept_doc_id, r.removed) for i, r in rows.items()} == {None: (7, True), 7: (7, False), 8: (7, True)}
    assert sorted((str(r.doc_id), r.text == "") for r in p.without_repeats(df).collect()) == [("7", False), ("7", False), ("8", True), ("None", True)]
    assert p.repeated_paragraphs(df.limit(0)).count() == 0
    assert len(p.Paragraphs(pa.array([], pa.string()), 50).kept) == 0


def test_passages_in_long_lines_and_over_short_lines(spark):
    rnd = random.Random(6)
    own = lambda d, n: [f"d{d}é{rnd.randrange(10**9)}" for _ in range(n)]
    a, c, e = ([f"{k}{i}" for i in range(n)] for k, n in (("a", 60), ("c", 50), ("e", 49)))
    lines = lambda w: "\n".join(" ".join(w[i : i + 9]) for i in range(0, len(w), 9))
    docs = [(d, " ".join(own(d, 200) + a + own(d, 150))) for d in (1, 2)]
    docs += [(3, "\n".join([" ".join(own(3, 30)), lines(a).upper(), " ".join(own(3, 20))]))]
    docs += [(d, "\n".join([" ".join(own(d, 12)), lines(c), " ".join(own(d, 12))])) for d in (4, 5)]
    docs += [(d, " ".join(own(d, 80) + e + own(d, 80))) for d in (6, 7)]
    docs += [(8, " ".join(own(8, 70) + c + own(8, 40) + c))]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS)
    assert p.repeated_paragraphs(df).count() == 0
    rows = p.repeats(df).collect()
    text = dict(docs)
    got = sorted((r.doc_id, words(text[r.doc_id][r.start : r.start + r.length]), r.words, r.kept_doc_id) for r in rows)
    assert got == [(2, a, 60, 1), (3, a, 60, 1), (5, c, 50, 4), (8, c, 50, 4), (8, c, 50, 4)]
    assert {r.doc_id: r.paragraph for r in rows}[3] == 1 and all(r.removed for r in rows)
    clean = {r.doc_id: r.text for r in p.without_passages(df).collect()}
    for d, t in docs:
        drop = {2: set(a), 3: set(a), 5: set(c), 8: set(c)}.get(d, set())
        assert words(clean[d]) == [x for x in words(t) if x not in drop]
    assert all(clean[d] == text[d] for d in (1, 4, 6, 7))
    # one word over and over: the first holder stays
    same = spark.createDataFrame([(1, " ".join(["same"] * 130), "en", "s", 0)], DOCS)
    assert len(words(p.without_passages(same).first().text)) == 50


def test_every_repeated_run_is_found(spark):
    rnd = random.Random(12)
    pool = [f"p{i}" for i in range(400)]
    docs = []
    for d in range(60):
        w = []
        for _ in range(rnd.randrange(1, 5)):
            at, n = rnd.randrange(300), rnd.randrange(20, 90)
            w += pool[at : at + n] + [f"o{d}x{rnd.randrange(10**9)}" for _ in range(rnd.randrange(1, 30))]
        docs.append((d, "".join(x + ("\n" if rnd.random() < 0.05 else " ") for x in w)))
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS).repartition(4)
    none = p.repeated_paragraphs(df).where("false")
    got = set()
    for r in p.repeated_passages(df, none).collect():
        before = len(words(dict(docs)[r.doc_id][: r.start]))
        got.update((r.doc_id, before + k) for k in range(r.words))
    seen, expected = {}, set()
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - 49):
            e, j = seen.setdefault(tuple(w[i : i + 50]), (d, i))
            if e != d or i - j >= 50:
                expected.update((d, i + k) for k in range(50))
    assert len(expected) > 1000 and got == expected
