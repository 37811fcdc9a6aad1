import math
import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from plumbline.llm import quality_rules as q

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def model(text):
    """The counts, the plain way."""
    w, t = words(text), text or ""
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {j for starts in windows.values() if len(starts) > 1 for i in starts for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def texts():
    rnd = random.Random(3)
    yield from (None, "", " \t\n\x0b\x0c\r", "one", "a b c", "a b c a b c", "x " * 400, "\n\n a\n a\n a ", "ab cd é ü 𝔘")
    yield from ("a b\nc d\na b\na b", "|<>&%$*# #", "a b c d a b c", "long " * 30000)
    for _ in range(60):
        yield "".join(rnd.choice(["a", "b", "cd", "é", "#", " ", " ", "\n", "\t"]) for _ in range(rnd.randrange(200)))


def test_counts_match_the_plain_way(spark):
    cases = list(texts())
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(cases)], DOCS)
    rows = q.measure(df).select("doc_id", "_m.*").collect()
    assert len(rows) == len(cases)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == model(cases[r.doc_id]), cases[r.doc_id] and cases[r.doc_id][:80]


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10, 0.1), (0, 500, 0.004), (3, 1000, 0.01), (9, 1000, 0.01), (10, 1000, 0.01), (60, 20000, 0.004)]
    df = spark.createDataFrame(cases, "k long, n long, p double")
    for r in df.select("*", q.binomial_tail(F.col("k"), F.col("n"), F.col("p")).alias("t")).collect():
        exact = sum(math.comb(r.n, i) * r.p**i * (1 - r.p) ** (r.n - i) for i in range(r.k + 1))
        assert math.isclose(r.t, 1.0 if r.k >= r.n * r.p else exact, rel_tol=1e-9)


def test_binomial_tail_of_many_labels(spark):
    cases = [(1590, 400000, 0.004), (1450, 400000, 0.004), (7800, 2000000, 0.004)]
    df = spark.createDataFrame(cases, "k long, n long, p double")
    term = lambda n, i, p: math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
    for r in df.select("*", q.binomial_tail(F.col("k"), F.col("n"), F.col("p")).alias("t")).collect():
        assert math.isclose(r.t, math.fsum(term(r.n, i, r.p) for i in range(r.k + 1)), rel_tol=1e-6)


def test_query_equals_its_sql_where_cutoffs_are_chosen(spark, tmp_path, monkeypatch):
    """20,000 labelled texts a stratum; ratios on a cutoff, below and above it."""
    rnd = random.Random(8)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) for _ in range(4000)]
    docs, labels = [], []
    for i in range(40_000):
        w = rnd.choices(vocabulary, k=50)
        bad = i % 11 == 0
        for _ in range(rnd.choice((5, 12, 40)) if bad else rnd.choice((0,) * 200 + (1, 2))):
            w[rnd.randrange(50)] += "#"  # one in 50 words is the first cutoff itself
        docs.append((i, " ".join(w) if i % 997 else None, ("en", None)[i % 2], "s", 0))
        labels.append((i, int(not bad), 0))
    docs += [(50_000, "repeated " * 60, "en", "s", 0), (None, docs[1][1], "en", "s", 0)]  # the SQL is for ids that do not repeat
    for name, rows, schema in (("documents", docs, DOCS), ("labels", labels, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    expected = con.execute(q.SQL).fetchall()
    names = [d[0] for d in con.description]
    assert sum(1 for r in expected if r[names.index("failed_rules")]) > 3000
    got = [tuple(r[n] for n in names) for r in q.op6_quality_rules(spark, str(tmp_path)).collect()]
    assert Counter(got) == Counter(map(tuple, expected))


def corpus(spark, rows=4000):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8)))
    docs, labels = [], []
    for i in range(rows):
        good = i % 5 != 0
        w = [word() for _ in range(60)]
        text = " ".join(w) if good else " ".join(x + "$$$" for x in w)
        docs.append((i, text, ("en", "fr")[i % 2], "s", len(text)))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_junk_goes_and_good_texts_stay(spark):
    docs, labels = corpus(spark)
    blank = spark.createDataFrame([(5000, None, "en", "s", 0), (5001, " \n", "fr", "s", 0)], DOCS)
    kept = {r.doc_id: r._kept for r in q.judge(docs.unionByName(blank), labels).select("doc_id", "_kept").collect()}
    assert not kept[5000] and not kept[5001]
    assert all(kept[i] == (i % 5 != 0) for i in range(4000))


def test_few_labels_give_no_cutoff_and_many_rejections_are_not_risked(spark):
    docs, labels = corpus(spark, 200)
    assert q.choose_cutoffs(q.measured_rows(docs, q.RiskControl()), labels).count() == 0
    # all texts are called good: a cutoff that rejects the junk would reject a fifth of them
    docs, labels = corpus(spark)
    every = labels.withColumn("quality", F.lit(1))
    rejected = q.judge(docs, every).where("not _kept").count()
    assert rejected <= 0.02 * 4000


def test_edges(spark):
    docs, labels = corpus(spark, 40)
    odd = spark.createDataFrame([(None, "a b", None, None, None), (7, None, None, "s", 1), (7, None, None, "s", 1)], DOCS)
    extra = docs.unionByName(odd).withColumn("_n", F.lit(1)).withColumn("quality", F.lit("x")).withColumn("_id", F.lit(2))
    marks = labels.unionByName(spark.createDataFrame([(None, 1, 0), (3, None, 0), (99999, 1, 1)], labels.schema)).withColumn("text", F.lit("t"))
    out = q.judge(extra, marks)
    assert out.count() == 43 and {"_n", "quality", "_id"} <= set(out.columns)
    assert not out.where("text is null and _kept").count()
    assert q.judge(docs.limit(0), labels).count() == 0
    assert q.judge(docs, labels.limit(0)).where("_kept").count() == 32 + 8
    bare = q.verdicts(extra, marks)
    assert bare.count() == 43 and q.verdicts(docs.limit(0), labels).count() == 0
    both = out.select("doc_id", "_kept").exceptAll(bare.select("_id", "_kept"))
    assert both.count() == 0
