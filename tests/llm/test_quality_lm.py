import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from plumbline.llm import quality_lm as q
from plumbline.llm.words import BEGIN

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


class Plain:
    """Interpolated modified Kneser-Ney of order three over lists of tokens."""

    def __init__(self, texts):
        three = Counter()
        for t in texts:
            w = ["^", "^", *t, "$"]
            three.update(zip(w, w[1:], w[2:]))
        two = Counter((b, c) for _, b, c in three)
        one = Counter(c for _, c in two)
        self.levels = [self.level(x) for x in (three, two, Counter({(c,): n for c, n in one.items()}))]
        self.known = len(one)

    @staticmethod
    def level(grams):
        n1, n2, n3, n4 = (max(sum(1 for v in grams.values() if v == k), 1) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [min(max(k - (k + 1) * y * b / a, 0.1), k - 0.1) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        total, freed = defaultdict(float), defaultdict(float)
        for g, n in grams.items():
            total[g[:-1]] += n
            freed[g[:-1]] += d[min(n, 3) - 1]
        return grams, d, total, freed

    def p(self, gram):
        out, factor = 0.0, 1.0
        for grams, d, total, freed in self.levels:
            g = gram[-3 + self.levels.index((grams, d, total, freed)) :]
            if g[:-1] in total:
                n = grams.get(g, 0)
                out += factor * (n - d[min(n, 3) - 1] if n else 0) / total[g[:-1]]
                factor *= freed[g[:-1]] / total[g[:-1]]
        return out + factor / (self.known + 1)


def test_probabilities_match_the_plain_way(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    texts = [[rnd.choice(words[: rnd.choice([5, 30])]) for _ in range(rnd.randrange(40))] for _ in range(60)]
    df = spark.createDataFrame([(" ".join(t),) for t in texts], "text string")
    tables, unknown = q.probabilities(q.count_trigrams(df))
    model = q.Model([q._gather(*t) for t in tables], unknown)
    plain = Plain(texts)
    asked = [[rnd.choice([*words, "new", "other"]) for _ in range(12)] for _ in range(40)] + texts
    a, b, c, begin = q.trigrams(pa.array([" ".join(t) for t in asked]))
    got = np.add.reduceat(model.log10(a, b, c), begin)
    for t, x in zip(asked, got):
        w = ["^", "^", *t, "$"]
        assert math.isclose(x, sum(math.log10(plain.p(g)) for g in zip(w, w[1:], w[2:])), rel_tol=1e-4)
    # every context's probabilities add up to one: all known words, the end, and one unknown
    known = np.append(q.Words(pa.array([" ".join(words)])).known, [np.uint64(2), np.uint64(99)])
    for x, y in ((BEGIN, BEGIN), (known[0], known[1]), (np.uint64(99), known[3])):
        p = 10 ** model.log10(np.full(len(known), x), np.full(len(known), y), known)
        assert abs(p.sum() - 1) < 1e-4


def corpus(spark):
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        letters = "abcdef" if i % 2 else "ghijkl"
        words = [x + y for x in letters for y in letters]
        good = i % 8 != 0
        text = " ".join(rnd.choice(words) + ("" if good else "$$$") for _ in range(60))
        rows.append((i, text, ("en", "fr")[i % 2], "s", len(text)))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_junk_is_above_the_threshold(spark):
    docs, labels = corpus(spark)
    out = q.classify(docs, labels, q.KneserNey(sample_docs=150)).collect()
    assert len(out) == 400 and not any(r.kept for r in out if r.doc_id % 8 == 0)
    assert sum(r.kept for r in out if r.doc_id % 8) >= 0.95 * 350


def test_a_small_table_has_thresholds(spark):
    docs, labels = corpus(spark)
    out = q.classify(docs, labels).collect()
    assert all(r.threshold is not None for r in out) and not any(r.kept for r in out if r.doc_id % 8 == 0)
    assert sum(r.kept for r in out if r.doc_id % 8) >= 0.95 * 350


def test_edges(spark):
    docs, labels = corpus(spark)
    odd = spark.createDataFrame([(None, "ab cd", None, None, None), (900, None, "en", "s", 0), (901, "", "xx", "s", 0), (1, "ab " * 40000, "en", "s", 0)], DOCS)
    docs = docs.unionByName(odd).withColumn("perplexity", F.lit("clash")).withColumn("_row", F.lit(1)).withColumn("_id", F.lit(1))
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 0), (2, None, None), (5555, 1, None)], labels.schema))
    out = {r.doc_id: r for r in q.classify(docs, labels).collect() if r.doc_id is None or r.doc_id > 399}
    assert out[None].kept and out[None].n_tokens == 3 and not out[900].kept and not out[901].kept
    assert q.classify(docs.limit(0), labels).count() == 0
    none = q.classify(docs, labels.limit(0)).collect()
    assert len(none) == 404 and all(r.threshold is None and r.kept == (r.n_tokens > 1) for r in none)


def test_every_trusted_document_teaches_and_shards_answer_the_whole_model(spark):
    """5,000 trusted documents, each with a word of its own: with a sample of them most of these words stay unknown."""
    docs = spark.range(5000).selectExpr("id as doc_id", "concat('ab cd w', id, ' ef') as text", "'en' as lang")
    labels = docs.selectExpr("doc_id", "1 as quality", "0 as toxic")
    out = q.classify(docs, labels, q.KneserNey(block_bytes=20_000), keep=["doc_id", "text"])
    held = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(5)) == 0
    rows = out.withColumn("held", held).collect()
    plain = Plain([r.text.split() for r in rows if not r.held])
    assert len(rows) == 5000 and len({round(r.perplexity, 4) for r in rows if not r.held}) == 1
    for r in [r for r in rows if r.held][:5] + [r for r in rows if not r.held][:5]:
        w = ["^", "^", *r.text.split(), "$"]
        wanted = -sum(math.log10(plain.p(g)) for g in zip(w, w[1:], w[2:])) / 5
        assert math.isclose(math.log10(r.perplexity), wanted, rel_tol=1e-4)
