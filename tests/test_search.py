import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.functions import vectors
from plumbline.operators import search
from plumbline.operators.shape import merged_filter


@pytest.fixture(scope="module")
def vectors_frame(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 8)).round(3)
    base[100:200] = base[7]  # a third of all rows are copies of one
    corpus = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(base)], "id bigint, vector array<float>").repartition(4)
    queries = spark.createDataFrame([(q, [float(x) for x in v]) for q, v in enumerate(rng.normal(size=(5, 8)))], "query_id bigint, vector array<float>")
    return queries, corpus


def brute(queries, corpus, k):
    out = set()
    for q in queries.collect():
        a = np.asarray(q["vector"], dtype=np.float64)
        scored = []
        for c in corpus.collect():
            b = np.asarray(c["vector"], dtype=np.float64)
            scored.append((-round(float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), 6), c["id"]))
        out |= {(q["query_id"], i, rank) for rank, (_, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def picked(df):
    return {(r["query_id"], r["id"], r["rank"]) for r in df.collect()}


def test_exact_equals_brute_force(vectors_frame):
    queries, corpus = vectors_frame
    assert picked(search.exact_topk(queries, corpus, 12)) == brute(queries, corpus, 12)


def test_grid_equals_scan(vectors_frame, monkeypatch):
    queries, corpus = vectors_frame
    expected = picked(search.exact_topk(queries, corpus, 7))
    monkeypatch.setattr(search, "QUERY_BLOCK", 2)
    monkeypatch.setattr(search, "CORPUS_BLOCK", 50)
    assert picked(search.exact_topk(queries, corpus, 7)) == expected


def test_no_queries_no_rows(vectors_frame):
    queries, corpus = vectors_frame
    assert search.exact_topk(queries.limit(0), corpus, 3).count() == 0


def test_tiles_give_the_same_rows(vectors_frame, monkeypatch):
    queries, corpus = vectors_frame
    rows = corpus.toPandas()
    matrix, ids = search._matrix(pa.array(rows["vector"].tolist())), rows["id"].to_numpy()
    asked = search._unit_rows(np.array([r["vector"] for r in queries.orderBy("query_id").collect()], float))
    expected = brute(queries, corpus, 12)
    monkeypatch.setattr(search, "TILE_ROWS", 7)
    monkeypatch.setattr(search, "TILE_QUERIES", 2)
    for names in (ids, np.array([f"{i:05}" for i in ids])):
        best = search.Nearest(asked, 12)
        for start in range(0, len(ids), 90):
            best.add(pa.array(matrix[start : start + 90].tolist()), names[start : start + 90], lambda c: search._unit_rows(search._matrix(c)))
        query, found, _ = best.found()
        assert {(q, int(i), at % 12 + 1) for at, (q, i) in enumerate(zip(query, found))} == expected


def test_memory_of_a_scan_at_the_real_sizes():
    """4,096 questions against 30,000 rows: the scores of all pairs would take a gigabyte."""
    rng = np.random.default_rng(3)
    asked, rows = search._unit_rows(rng.normal(size=(search.QUERY_BLOCK, 16))), rng.normal(size=(30_000, 16))
    column, ids = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), 16).cast(pa.list_(pa.float64())), np.arange(30_000)
    tracemalloc.start()
    best = search.Nearest(asked, 10)
    best.add(column, ids, lambda c: search._unit_rows(search._matrix(c)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
    query, found, _ = best.found()
    sample = rng.choice(search.QUERY_BLOCK, 5)
    for q in sample:
        assert set(found[query == q]) == set(np.argsort(-(search._unit_rows(rows) @ asked[q]))[:10])


@pytest.fixture(scope="module")
def wide_frame(spark):
    """Vectors of 200 coordinates whose neighbours differ in the last ones only."""
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(3000, 200))
    rows[:, :64] = 1.0
    asked = rows[:8] + rng.normal(size=(8, 200)) * 0.9 * (np.arange(200) >= 64)
    corpus = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id bigint, vector array<float>").repartition(3)
    return spark.createDataFrame([(q, [float(x) for x in v]) for q, v in enumerate(asked)], "query_id bigint, vector array<float>"), corpus


def test_approximate_finds_the_neighbours(wide_frame, monkeypatch):
    queries, corpus = wide_frame
    exact = {(r["query_id"], r["id"]): r["score"] for r in search.exact_topk(queries, corpus, 10).collect()}
    found = search.approximate_topk(queries, corpus, 10)
    rows = found.collect()
    assert len({(r["query_id"], r["id"]) for r in rows}) == len(rows) == 80
    hit = [(r["query_id"], r["id"]) for r in rows if (r["query_id"], r["id"]) in exact]
    assert len(hit) >= 72  # recall of 0.9 with 4 % of the rows compared
    assert all(exact[(r["query_id"], r["id"])] == pytest.approx(r["score"], abs=2e-6) for r in rows if (r["query_id"], r["id"]) in exact)
    monkeypatch.setattr(search, "QUERY_BLOCK", 3)  # many queries: the grid
    assert picked(search.approximate_topk(queries, corpus, 10)) == picked(found)
    index = search.sketch_index(corpus)
    assert picked(search.approximate_topk(queries, corpus, 10, index=index)) == picked(found)


def test_approximate_with_all_rows_is_exact(vectors_frame):
    queries, corpus = vectors_frame
    assert picked(search.approximate_topk(queries, corpus, 300, candidates=300)) == picked(search.exact_topk(queries, corpus, 300))
    nothing = corpus.limit(0)
    assert search.approximate_topk(queries, nothing, 5).count() == 0 and search.approximate_topk(queries.limit(0), corpus, 5).count() == 0
    without = corpus.unionByName(corpus.limit(2).select("id", F.lit(None).cast("array<float>").alias("vector")))
    assert picked(search.approximate_topk(queries, without, 5)) == picked(search.approximate_topk(queries, corpus, 5))


def test_planes_cover_all_coordinates():
    sides = search.planes(256, 200)
    assert sides.shape == (256, 200) and set(np.unique(sides)) == {-1.0, 1.0}
    assert abs(sides.mean(axis=0)).max() < 0.3 and (search.planes(10, 64) == search.planes(256, 64)[:10]).all()
    x = np.r_[np.ones(64), np.zeros(136)]
    y = np.r_[np.ones(64), np.random.default_rng(1).normal(size=136)]
    assert ((sides @ (x + y) > 0) != (sides @ (x - y) > 0)).any()
    assert search.sketch_words(1 << 20) == 40 and search.candidates_for(500, 10) == 20 and search.candidates_for(10**9, 10) == 320


def bm25_model(query, texts):
    split = {i: t.lower().split() for i, t in texts.items()}
    n, mean = len(split), sum(map(len, split.values())) / len(split)
    out = {}
    for i, ts in split.items():
        total = 0
        for term in set(query.lower().split()):
            df = sum(term in x for x in split.values())
            tf = ts.count(term)
            if tf:
                total += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ts) / mean))
        if total:
            out[i] = round(total, 6)
    return out


def test_bm25_equals_the_formula(spark, monkeypatch):
    texts = {1: "the cat sat on the mat", 2: "the dog", 3: "cat cat cat", 4: "nothing of it", 5: ""}
    corpus = spark.createDataFrame(list(texts.items()), "id bigint, text string")
    queries = spark.createDataFrame([(1, "The CAT"), (2, "dog cat the the")], "query_id bigint, text string")
    index = search.keyword_index(corpus)
    def run():
        return {(r["query_id"], r["id"]): r["score"] for r in search.bm25_topk(queries, index, 10).collect()}
    expected = {(q, i): s for q, t in ((1, "The CAT"), (2, "dog cat the the")) for i, s in bm25_model(t, texts).items()}
    assert run() == pytest.approx(expected)
    monkeypatch.setattr(search, "QUERY_TERMS", 1)  # a block for each query
    assert run() == pytest.approx(expected)


def test_blocks_are_skipped_without_a_change(spark, monkeypatch):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(40)]
    texts = {i: " ".join(rng.choice(words, p=np.arange(40, 0, -1) / 820, size=rng.integers(0, 30))) for i in range(400)}
    texts |= {1000 + i: texts[3] for i in range(120)}
    queries = [(q, " ".join(rng.choice(words, size=5))) for q in range(6)] + [(7, ""), (8, "absent"), (9, None)]
    corpus = spark.createDataFrame([*texts.items(), (5000, None)], "id bigint, text string").repartition(3)
    asked = spark.createDataFrame(queries, "query_id bigint, text string")
    index = search.keyword_index(corpus)
    found = {}
    for r in search.bm25_topk(asked, index, 9).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    for q, text in queries[:6]:
        expected = sorted(((-s, i) for i, s in bm25_model(text, texts).items()))[:9]
        assert [(i, pytest.approx(-s, abs=2e-6)) for s, i in expected] == [(i, s) for _, i, s in sorted(found[q])]
    assert set(found) == set(range(6))
    blocks = index.collect()
    assert sum(len(b["ids"]) for b in blocks) == len(texts)
    for b in blocks:
        assert b["least"] == min(b["lengths"]) and sum(b["counts"]) == len(b["docs"]) == len(b["tfs"])
        at = 0
        for peak, n in zip(b["peaks"], b["counts"]):
            assert peak == max(b["tfs"][at : at + n])
            at += n


def test_a_block_below_the_bound_is_skipped(spark, monkeypatch):
    blocks = []
    for text, first in (("w w w w w", 0), ("w x x x x x", 10)):
        docs = spark.createDataFrame([(first + i, text) for i in range(3)], "id bigint, text string").coalesce(1)
        blocks.append(pa.RecordBatch.from_pylist([b.asDict() for b in search.keyword_index(docs).collect()]))
    calls = []
    real = search._Best.add
    monkeypatch.setattr(search._Best, "add", lambda self, *a: (calls.append(len(a[1])), real(self, *a)))

    class Held:
        value = (["w"], np.array([1.0]), [np.array([0])])

    run = search._block_search(Held, 3, 1.2, 0.75, 5.5, pa.int64())
    assert [r["id"] for b in run(blocks) for r in b.to_pylist()] == [0, 1, 2] and calls == [3]
    calls.clear()
    assert [r["id"] for b in run(blocks[::-1]) for r in b.to_pylist()] == [0, 1, 2] and calls == [3, 3]


def test_fusion_and_routing(spark, vectors_frame):
    queries, corpus = vectors_frame
    lists = [spark.createDataFrame(r, "query_id bigint, id bigint, rank int") for r in ([(1, 10, 1), (1, 11, 2)], [(1, 11, 1), (1, 12, 2)])]
    fused = search.fuse(lists, 10).orderBy("rank").collect()
    assert [r["id"] for r in fused] == [11, 10, 12] and fused[0]["score"] == round(1 / 62 + 1 / 61, 6)
    texts = F.when(F.col("query_id") < 2, "Where is Eastport?").otherwise("where is it?")
    corpus = corpus.withColumn("text", F.concat_ws(" ", F.lit("it is in eastport"), F.col("id")))
    queries = queries.withColumn("text", texts)
    auto = search.search(queries, corpus, 5, "AUTO")
    hybrid = search.search(queries.where("query_id < 2"), corpus, 5, "HYBRID")
    near = search.search(queries.where("query_id >= 2"), corpus, 5, "ANN")
    assert picked(auto.where("route = 'HYBRID'")) == picked(hybrid) and picked(auto.where("route = 'ANN'")) == picked(near)


def test_filter_comes_before_the_ranking(vectors_frame):
    queries, corpus = vectors_frame
    corpus = corpus.withColumn("status", F.when(F.col("id") % 2 == 0, "current").otherwise("superseded"))
    found = search.search(queries, corpus, 5, "EXACT", condition=merged_filter())
    assert picked(found) == brute(queries, corpus.where("status = 'current'"), 5)
    both = search.search(queries, corpus, 5, "EXACT", condition=merged_filter({"status": "superseded"}))
    assert all(r["id"] % 2 for r in both.collect())


def test_texts_are_encoded_once(spark):
    texts = spark.createDataFrame([(i, "copy" if i % 3 else f"text {i}") for i in range(90)], "id bigint, text string")
    cache = spark.createDataFrame([(spark.range(1).select(F.sha1(F.lit("text 0"))).first()[0], [1.0, 0.0])], "key string, vector array<float>")
    missing = search.missing_texts(texts, cache)
    assert sorted(r["text"] for r in missing.collect()) == sorted({"copy", *[f"text {i}" for i in range(3, 90, 3)]})
    new = search.encode_texts(missing, search.hashing_encoder(2), batch_size=7)
    attached = search.attach_vectors(texts, cache.unionByName(new))
    assert attached.count() == 90 and attached.where("id = 0").first()["vector"] == [1.0, 0.0]
    for r in new.collect():
        assert np.linalg.norm(r["vector"]) == pytest.approx(1, abs=1e-6) or not any(r["vector"])


def test_hashing_as_expressions_equals_the_encoder(spark):
    texts = ["one two two THREE", "", "!?", "a b c d e f g " * 40, "é ß 12"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "key string, text string")
    got = {r["key"]: r["vector"] for r in search.hashed_vectors(df, 16).collect()}
    for i, expected in enumerate(search.hashing_encoder(16)(texts)):
        assert got[str(i)] == pytest.approx(expected, abs=1e-6)


def test_hits_and_norms(spark):
    ranked = spark.createDataFrame([(1, "c1", 1, 0.5)], "query_id bigint, id string, rank int, score double")
    chunks = spark.createDataFrame([("c1", "d", None, "T > S", "7.0", "policy", "x")], "chunk_id string, doc_id string, title string, section_path string, page string, source_type string, text string")
    hit = search.hits(ranked, chunks).first()
    assert hit["page"] == 7 and hit["title"] == "" and hit["score"] == 0.5
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in df.select(vectors.l2_normalise(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_blocks_and_row_groups_are_small(spark):
    """Spark's reader holds a row group of wide rows at once: that must not be the whole partition."""
    import pyarrow.parquet as pq

    rnd = random.Random(2)
    texts = [(i, " ".join(f"t{rnd.randrange(50_000)}" for _ in range(400))) for i in range(3000)]
    index = search.keyword_index(spark.createDataFrame(texts, "id long, text string").coalesce(1))
    assert index.selectExpr("max(size(docs)) as n").first()["n"] <= search.BLOCK_TERMS <= 100_000
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    groups = [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert sum(groups) == index.count() >= 12 and len(groups) > len(files)


def test_signs_are_made_in_place():
    """A tile of sketches becomes one matrix of numbers, not two at a time."""
    sketches = pa.array([bytes([i % 256]) * 320 for i in range(search.TILE_ROWS)], pa.binary())
    tracemalloc.start()
    signs = search._signs(sketches)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert signs.shape == (search.TILE_ROWS, 2560) and set(np.unique(signs)) == {-1.0, 1.0}
    assert peak < 1.5 * signs.nbytes <= 1.5 * (32 << 20)
