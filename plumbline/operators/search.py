"""Search as batch jobs: exact and approximate vectors, keywords, and both together."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from plumbline.functions.text import has_exact_terms
from plumbline.functions.vectors import MIN_NORM, cosine, l2_normalise
from plumbline.operators.joins import join_sized, skew_safe_join
from plumbline.session import is_small, pinned

# Columns a search returns, columns published to the index.
HIT_COLUMNS = ("chunk_id", "doc_id", "title", "section_path", "page", "source_type", "text")
PUBLISHED_COLUMNS = (
    "chunk_id", "doc_id", "chunk_index", "title", "section_path", "text", "page", "source_type",
    "status", "service", "audience", "source_url", "token_count",
)

SCORE_DIGITS = 6  # scores compare, and tie, at this precision; ties go to the lower id
QUERY_BLOCK = 4096  # queries one task holds as a matrix
CORPUS_BLOCK = 16_384  # corpus rows one cell of the grid holds
TILE_QUERIES, TILE_ROWS = 512, 1024  # what is scored at once
BLOCK_DOCS, BLOCK_TERMS = 1024, 100_000  # documents of a block of postings, and their terms (one longer document is a block)
# Blocks are wide rows, and Spark's reader holds up to 4096 rows of a row group at once: row groups are small, and
# their size is looked at after every row, not after a hundred.
BLOCK_STORAGE = {"parquet.block.size": 4 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
BM25_K1, BM25_B = 1.2, 0.75
RRF_CONSTANT = 60
QUERY_TERMS = 100_000  # terms of the queries one task holds


def rank_rows(scored: DataFrame, k: int | None = None, query: str = "query_id", item: str = "id") -> DataFrame:
    """Rank per query. With k, Spark keeps k rows per query in every task before it shuffles."""
    order = Window.partitionBy(query).orderBy(F.desc("score"), F.asc(item))
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


# ------------------------------------------------------------------ the best rows, tile by tile


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), MIN_NORM)


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of arrays, all of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _one(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = _one(column)
    return column.to_numpy(zero_copy_only=False) if pa.types.is_integer(column.type) else np.asarray(column.to_pylist())


class Nearest:
    """The k best rows of each query so far, by score and then by id. Rows are scored tile by tile and
    a tile's best are picked before they are merged, so memory is one tile and 2k entries a query."""

    NONE = np.iinfo(np.int64).min  # the key of an empty place

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.keys = np.full((len(queries), k), self.NONE)  # scores as whole numbers of 10 ** -SCORE_DIGITS
        self.ids: np.ndarray | None = None

    def add(self, column: pa.Array, ids: np.ndarray, as_rows: Callable[[pa.Array], np.ndarray]) -> None:
        order = np.argsort(ids, kind="stable")
        if self.ids is None:
            self.ids = np.zeros(self.keys.shape, ids.dtype)
        for start in range(0, len(order), TILE_ROWS):
            tile = order[start : start + TILE_ROWS]
            rows, own, take = as_rows(column.take(pa.array(tile))).T, ids[tile], min(self.k, len(tile))
            for top in range(0, len(self.queries), TILE_QUERIES):
                part = slice(top, top + TILE_QUERIES)
                scores = np.nan_to_num(self.queries[part] @ rows, nan=-1e6, copy=False)
                # ids ascend along the columns: equal scores are told apart by their place
                key = np.rint(scores * 10**SCORE_DIGITS).astype(np.int64) * TILE_ROWS + (TILE_ROWS - 1 - np.arange(len(tile)))
                at = np.argpartition(key, len(tile) - take, axis=1)[:, len(tile) - take :]
                keys = np.concatenate([self.keys[part], np.take_along_axis(key, at, axis=1) // TILE_ROWS], axis=1)
                merged = np.concatenate([self.ids[part], own[at]], axis=1)
                best = np.lexsort((merged, -keys.clip(self.NONE + 1)), axis=-1)[:, : self.k]
                self.keys[part] = np.take_along_axis(keys, best, axis=1)
                if merged.dtype != self.ids.dtype:  # longer names
                    self.ids = self.ids.astype(merged.dtype)
                self.ids[part] = np.take_along_axis(merged, best, axis=1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score), by the place of the query."""
        if self.ids is None:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        query, place = np.nonzero(self.keys > self.NONE)
        return query, self.ids[query, place], self.keys[query, place] / 10**SCORE_DIGITS


def _hits(names: pa.Array, found: tuple, id_type: pa.DataType) -> list[pa.Array]:
    query, ids, scores = found
    return [_one(names.take(pa.array(query))), pa.array(ids.tolist(), id_type), pa.array(scores, pa.float64())]


def _nearest(queries: DataFrame, rows: DataFrame, k: int, as_queries: Callable, as_rows: Callable) -> DataFrame:
    """(query_id, id, score, rank): the k best rows (id, value) of each query (query_id, vector) by the product of
    what `as_queries` and `as_rows` make of them.

    Few queries (counted): every task holds them as a matrix and scans its part of the rows once, keeping
    k rows per query. Many: queries and rows are cut into a grid of bounded cells that meet by an equality
    join. Both give the same rows.
    """
    queries = queries.select("query_id", "vector")
    rows = rows.withColumnRenamed(next(c for c in rows.columns if c != "id"), "value")
    kind = rows.schema["id"].dataType
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {kind.simpleString()}, score double"
    id_type = to_arrow_type(kind)
    scan = _scan if is_small(queries, QUERY_BLOCK) else _grid
    return rank_rows(scan(queries, rows, k, as_queries, as_rows, schema, id_type), k)


def _scan(queries, rows, k, as_queries, as_rows, schema, id_type) -> DataFrame:
    held = queries.toArrow()
    matrix = as_queries(_matrix(_one(held.column("vector")))) if held.num_rows else None
    shared = rows.sparkSession.sparkContext.broadcast((held.column("query_id"), matrix))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        if not len(names):
            return
        best = Nearest(matrix, k)
        for batch in batches:
            if batch.num_rows:
                best.add(batch.column("value"), _ids(batch.column("id")), as_rows)
        yield pa.RecordBatch.from_arrays(_hits(names, best.found(), id_type), ["query_id", "id", "score"])

    return rows.mapInArrow(scan, schema)


def _grid(queries, rows, k, as_queries, as_rows, schema, id_type) -> DataFrame:
    n_q, n_c = queries.count(), rows.count()
    q_blocks, c_blocks = math.ceil(n_q / QUERY_BLOCK), max(1, math.ceil(n_c / CORPUS_BLOCK))

    def block(c: str, n: int) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.withColumn("qb", block("query_id", q_blocks)).withColumn("cb", every(c_blocks))
    right = rows.withColumn("cb", block("id", c_blocks)).withColumn("qb", every(q_blocks))

    def cell(q: pa.Table, c: pa.Table) -> pa.Table:
        best = Nearest(as_queries(_matrix(_one(q.column("vector")))), k)
        if q.num_rows and c.num_rows:
            best.add(_one(c.column("value")), _ids(c.column("id")), as_rows)
        return pa.Table.from_arrays(_hits(q.column("query_id"), best.found(), id_type), ["query_id", "id", "score"])

    return left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(cell, schema)


# ------------------------------------------------------------------ exact vectors


def exact_topk(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Cosine top k: queries (query_id, vector) against corpus (id, vector). Rows without a vector are no rows."""
    corpus = corpus.select("id", "vector").where(F.col("vector").isNotNull())
    return _nearest(queries, corpus, k, _unit_rows, lambda column: _unit_rows(_matrix(column)))


# ------------------------------------------------------------------ approximate vectors


def planes(n: int, dims: int) -> np.ndarray:
    """n random planes over all coordinates: signs by a rule, 128 coordinates to a digest."""
    out = np.empty((n, -(-dims // 128) * 128))
    for p in range(n):
        digits = "".join(md5(f"{p}:{i}".encode()).hexdigest() for i in range(out.shape[1] // 128))
        values = np.array([int(d, 16) for d in digits])
        out[p] = np.where(values[:, None] >> np.arange(4) & 1, 1.0, -1.0).ravel()
    return out[:, :dims]


def sketch_words(rows: int) -> int:
    """64-bit words of a sketch: two for each doubling of the corpus."""
    return max(2, 2 * math.ceil(math.log2(max(2, rows))))


def candidates_for(rows: int, k: int) -> int:
    """Rows a query is compared with exactly: 4 % of the corpus, between 2k and 32k (k the rows asked for)."""
    return max(2 * k, min(32 * k, rows // 25))


def sketch_index(corpus: DataFrame, words: int | None = None) -> DataFrame:
    """(id, sketch): for each vector on which side of 64 x words random planes it lies, as bits. By default the
    number of planes grows with the logarithm of the corpus. Built per row; store it to search often."""
    corpus = corpus.select("id", "vector").where(F.col("vector").isNotNull())
    words = words or sketch_words(corpus.count())

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = None
        for batch in batches:
            for start in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(start, TILE_ROWS)
                rows = _matrix(part.column("vector"))
                if sides is None:
                    sides = planes(64 * words, rows.shape[1]).T
                bits = np.packbits(rows @ sides > 0, axis=1)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([b.tobytes() for b in bits], pa.binary())], ["id", "sketch"])

    return corpus.mapInArrow(sketch, f"id {corpus.schema['id'].dataType.simpleString()}, sketch binary")


def _signs(column: pa.Array) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    sides = np.unpackbits(raw, axis=1).astype(np.float64)
    sides *= 2.0
    sides -= 1.0
    return sides


def approximate_topk(queries: DataFrame, corpus: DataFrame, k: int, index: DataFrame | None = None, candidates: int | None = None) -> DataFrame:
    """Cosine top k among the rows whose sketches look nearest.

    The sketches are scanned like an exact search: a query's distances to the planes
    times the sides of a row estimate the cosine. Only the best `candidates` rows of a query (by default
    `candidates_for`) are fetched by id and compared by their vectors. A stored `index` of the corpus spares
    making the sketches; else they are written once, so that the workers that make them are gone when others scan.
    """
    corpus = corpus.select("id", "vector").where(F.col("vector").isNotNull())
    n = corpus.count()
    index = pinned(sketch_index(corpus, sketch_words(n)), "sketches") if index is None else index

    def distances(vectors: np.ndarray) -> np.ndarray:
        sides = planes(8 * width, vectors.shape[1])
        return _unit_rows(vectors) @ sides.T / len(sides)

    width = (index.select(F.octet_length("sketch")).first() or [0])[0]
    if not width:
        return exact_topk(queries, corpus, k)  # no rows
    near = _nearest(queries, index, candidates or candidates_for(n, k), distances, _signs)
    survivors = pinned(near.select("query_id", "id"), "candidates")
    asked = survivors.join(queries.select("query_id", F.col("vector").alias("_qv")), "query_id")
    met = join_sized(corpus, asked, "id", spread=["id"])
    scored = met.select("query_id", "id", F.round(cosine(F.col("_qv"), F.col("vector")), SCORE_DIGITS).alias("score"))
    return rank_rows(scored, k)


# ------------------------------------------------------------------ keywords


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def keyword_index(corpus: DataFrame) -> DataFrame:
    """(id, text) -> blocks of postings, written once. A text that is null is no document.

    A row is a block of up to BLOCK_DOCS documents: their ids and lengths, the block's terms, in how many of
    its documents each occurs (`counts`) and its highest frequency in one (`peaks`), then the postings,
    term after term: places of documents and frequencies. `least` is the smallest length. Highest frequency
    and smallest length bound what a term can add to a score here, whatever the corpus is like. No shuffle.
    """
    words = corpus.where(F.col("text").isNotNull()).select("id", terms(F.col("text")).alias("terms"))
    kind = corpus.schema["id"].dataType
    names = ("ids", "lengths", "terms", "peaks", "counts", "docs", "tfs")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64))])
            start = 0
            while start < batch.num_rows:
                stop = int(np.searchsorted(ends, ends[start] + BLOCK_TERMS, side="right")) - 1
                stop = min(max(stop, start + 1), start + BLOCK_DOCS, batch.num_rows)
                length = np.diff(ends[start : stop + 1])
                held = batch.column("terms").slice(start, stop - start).flatten().dictionary_encode()
                pair, tf = np.unique(held.indices.to_numpy().astype(np.int64) * len(length) + np.repeat(np.arange(len(length)), length), return_counts=True)
                code, doc = np.divmod(pair, len(length))
                term, first = np.unique(code, return_index=True)
                values = {
                    "ids": batch.column("id").slice(start, stop - start), "lengths": length, "terms": held.dictionary.take(pa.array(term)),
                    "peaks": np.maximum.reduceat(tf, first) if len(first) else tf, "counts": np.diff(np.append(first, len(code))), "docs": doc, "tfs": tf,
                }
                lists = [v if isinstance(v, pa.Array) else pa.array(v, pa.int32()) for v in values.values()]
                rows = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in lists]
                yield pa.RecordBatch.from_arrays([pa.array([length.min()], pa.int32()), *rows], ["least", *names])
                start = stop

    numbers = ", ".join(f"{n} array<int>" for n in ("peaks", "counts", "docs", "tfs"))
    schema = f"least int, ids array<{kind.simpleString()}>, lengths array<int>, terms array<string>, {numbers}"
    return pinned(words.mapInArrow(pack, schema), "keyword-index", **BLOCK_STORAGE)


def _query_blocks(queries: DataFrame) -> Iterator[list[tuple]]:
    """(query_id, its distinct terms), block by block; the driver holds one block."""
    block, held = [], 0
    for row in queries.select("query_id", F.array_distinct(terms(F.col("text"))).alias("terms")).toLocalIterator():
        asked = row["terms"] or []
        if block and (len(block) >= QUERY_BLOCK or held + len(asked) > QUERY_TERMS):
            yield block
            block, held = [], 0
        block.append((row["query_id"], asked))
        held += len(asked)
    if block:
        yield block


class _Best:
    """The k best (score, id) of a query so far, equal scores by id."""

    def __init__(self, k: int):
        self.k, self.least = k, -math.inf
        self.scores, self.ids = np.empty(0), None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids = ids if self.ids is None else np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = self.scores[-1]


def bm25_topk(queries: DataFrame, index: DataFrame, k: int, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """BM25 of queries (query_id, text) over a keyword index.

    Queries are taken in blocks of bounded size. A task goes through its blocks of documents with all of
    them: a query whose bound in a block is below its k-th best score so far skips the block, else the
    postings of its terms are added up. Only k rows a query leave a task. A query without a term, or with
    terms that no document has, has no row.
    """
    spark, kind = index.sparkSession, index.schema["ids"].dataType.elementType
    query_type = queries.schema["query_id"].dataType.simpleString()
    id_type, out = to_arrow_type(kind), None
    total = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda n, x: n + x)
    n, length = index.agg(F.sum(F.size("ids")), F.sum(total)).first()
    for block in _query_blocks(queries):
        vocabulary = sorted({t for _, asked in block for t in asked})
        wanted = F.broadcast(spark.createDataFrame([(t,) for t in vocabulary], "term string"))
        postings = index.select(F.explode(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("n"))).alias("p")).select("p.*")
        df = dict(postings.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n")).collect())
        known = [t for t in vocabulary if t in df]
        place = {t: i for i, t in enumerate(known)}
        idf = np.array([math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) for t in known])
        asked = [np.array([place[t] for t in own if t in place], np.int64) for _, own in block]
        names = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(block)], f"_number int, query_id {query_type}")
        shared = spark.sparkContext.broadcast((known, idf, asked))
        search = _block_search(shared, k, k1, b, length / n if n else 0.0, id_type)
        found = index.mapInArrow(search, f"_number int, id {kind.simpleString()}, score double")
        found = rank_rows(found, k, "_number").join(F.broadcast(names), "_number").select("query_id", "id", "score", "rank")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], f"query_id {query_type}, id {kind.simpleString()}, score double, rank int") if out is None else out


def _block_search(shared, k: int, k1: float, b: float, mean: float, id_type: pa.DataType):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, idf, asked = shared.value
        names = pa.array(known, pa.string())
        best = [_Best(k) for _ in asked]
        for batch in batches:
            for row in range(batch.num_rows):
                part = lambda c: batch.column(c)[row].values  # noqa: E731, B023
                numbers = lambda c: part(c).to_numpy().astype(np.int64)  # noqa: E731, B023
                at = pc.index_in(part("terms"), value_set=names).fill_null(-1).to_numpy()
                own = np.flatnonzero(at >= 0)  # the block's terms that are asked for
                if not len(own):
                    continue
                count = numbers("counts")
                start = np.cumsum(count) - count
                here = np.full(len(known), -1)
                here[at[own]] = np.arange(len(own))
                peak = numbers("peaks")[own]
                norm = k1 * (1 - b + b * numbers("lengths") / mean)
                bound = idf[at[own]] * peak * (k1 + 1) / (peak + k1 * (1 - b + b * batch.column("least")[row].as_py() / mean))
                docs, tfs, ids = numbers("docs"), numbers("tfs"), _ids(part("ids"))
                shares: dict[int, tuple] = {}  # per term of the block, for the queries that ask for it
                for query, found in zip(asked, best):
                    local = here[query]
                    local = local[local >= 0]
                    # scores are rounded: the margin keeps a bound above what it bounds
                    if not len(local) or bound[local].sum() + 10**-SCORE_DIGITS < found.least:
                        continue
                    for j in local:
                        if j not in shares:
                            s, e = start[own[j]], start[own[j]] + count[own[j]]
                            doc, tf = docs[s:e], tfs[s:e]
                            shares[j] = doc, idf[at[own[j]]] * tf * (k1 + 1) / (tf + norm[doc])
                    doc, value = (np.concatenate(x) for x in zip(*[shares[j] for j in local]))
                    score = np.bincount(doc, value, len(ids))
                    hit = np.flatnonzero(score > 0)
                    score = np.round(score[hit], SCORE_DIGITS)
                    good = score >= found.least
                    if good.any():
                        found.add(score[good], ids[hit[good]])
        for number, found in enumerate(best):
            if found.ids is not None:
                columns = [pa.array(np.full(len(found.ids), number, np.int32)), pa.array(found.ids.tolist(), id_type), pa.array(found.scores)]
                yield pa.RecordBatch.from_arrays(columns, ["_number", "id", "score"])

    return search


# ------------------------------------------------------------------ both, and routing


def fuse(rankings: list[DataFrame], k: int, constant: int = RRF_CONSTANT) -> DataFrame:
    """Reciprocal rank fusion: 1 / (constant + rank), summed over the lists."""
    union = rankings[0].select("query_id", "id", "rank")
    for r in rankings[1:]:
        union = union.unionByName(r.select("query_id", "id", "rank"))
    summed = union.groupBy("query_id", "id").agg(
        F.round(F.sum(1 / (constant + F.col("rank"))), SCORE_DIGITS).alias("score")
    )
    return rank_rows(summed, k)


def depth_for(k: int) -> int:
    """How far down both lists are fused: four times as far as is asked, fifty at least."""
    return max(50, 4 * k)


def hybrid_topk(queries: DataFrame, corpus: DataFrame, k: int, depth: int | None = None, near: Callable = exact_topk) -> DataFrame:
    """The best of both lists, each `depth` long (by default `depth_for(k)`)."""
    depth = depth or depth_for(k)
    by_vector = near(queries, corpus, depth)
    by_words = bm25_topk(queries, keyword_index(corpus), depth)
    return fuse([by_vector, by_words], k)


def auto_topk(queries: DataFrame, corpus: DataFrame, k: int, depth: int | None = None) -> DataFrame:
    """Questions with exact terms go to both lists, the others (without a text too) to approximate vectors alone."""
    exact = F.coalesce(has_exact_terms(F.col("text")), F.lit(False))
    mixed = hybrid_topk(queries.where(exact), corpus, k, depth).withColumn("route", F.lit("HYBRID"))
    plain = approximate_topk(queries.where(~exact), corpus, k).withColumn("route", F.lit("ANN"))
    return mixed.unionByName(plain)


def search(queries: DataFrame, corpus: DataFrame, k: int, query_type: str = "AUTO", condition: Column | None = None) -> DataFrame:
    """One entry for all query types. The filter meets the corpus before anything is ranked."""
    if condition is not None:
        corpus = corpus.where(condition)
    if query_type == "ANN":
        return approximate_topk(queries, corpus, k)
    if query_type == "FULL_TEXT":
        return bm25_topk(queries, keyword_index(corpus), k)
    if query_type == "HYBRID":
        return hybrid_topk(queries, corpus, k)
    if query_type == "AUTO":
        return auto_topk(queries, corpus, k)
    if query_type == "EXACT":
        return exact_topk(queries, corpus, k)
    raise ValueError(f"unknown query type {query_type}")


def hits(ranked: DataFrame, chunks: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Ranked ids -> the rows a search returns; pages written as text become integers."""
    joined = ranked.join(chunks.withColumnRenamed(key, "id"), "id").withColumnRenamed("id", key)
    texts = {c: F.coalesce(c, F.lit("")) for c in ("title", "section_path", "source_type", "text")}
    return joined.withColumns(
        {**texts, "page": F.col("page").cast("string").try_cast("double").cast("int")}
    ).select("query_id", "rank", *HIT_COLUMNS, "score")


# ------------------------------------------------------------------ encoding


def hashing_encoder(dims: int = 64) -> Callable[[list[str]], list[list[float]]]:
    """Deterministic bag-of-words encoder: signed term hashes, L2-normalised. Needs no model."""

    def encode(texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), dims))
        for row, text in enumerate(texts):
            for term, n in Counter(re.findall(r"[^\W_]+", text.lower())).items():
                code = int.from_bytes(md5(term.encode()).digest()[:4])
                out[row, code % dims] += n if code >> 16 & 1 else -n
        return _unit_rows(out).tolist()

    return encode


def text_key(text: Column) -> Column:
    return F.sha1(text)


def missing_texts(texts: DataFrame, cache: DataFrame) -> DataFrame:
    """Each distinct text that is not cached yet, once. Keys are compared first: they alone are shuffled, and
    texts are fetched for the missing ones only. Copies meet in a partial aggregate."""
    keyed = texts.select(text_key(F.col("text")).alias("key"), "text").where(F.col("key").isNotNull())
    missing = pinned(keyed.select("key").distinct().join(cache.select("key"), "key", "left_anti"), "missing")
    fetched = join_sized(keyed, missing, "key", spread=["key"])
    return fetched.groupBy("key").agg(F.any_value("text").alias("text"))


def hashed_vectors(texts: DataFrame, dims: int = 64) -> DataFrame:
    """(key, text) -> (key, vector): what `hashing_encoder` gives, as expressions. Terms are hashed to a place
    and a sign and summed per text and place before they are shuffled."""
    code = F.conv(F.substring(F.md5("term"), 1, 8), 16, 10).cast("bigint")
    found = texts.select("key", F.explode_outer(terms(F.col("text"))).alias("term")).withColumn("_code", code)
    sign = F.when(F.shiftright("_code", 16).bitwiseAND(1) == 1, 1).otherwise(-1)
    sums = found.groupBy("key", (F.col("_code") % dims).alias("_at")).agg(F.sum(F.when(F.col("term").isNotNull(), sign)).alias("_x"))
    # a text gathers as many entries as there are places
    entries = F.collect_list(F.when(F.col("_at").isNotNull(), F.struct("_at", "_x")))
    whole = sums.groupBy("key").agg(F.map_from_entries(entries).alias("_sums"))
    raw = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.coalesce(F.try_element_at("_sums", i.cast("bigint")), F.lit(0)).cast("double"))
    return whole.select("key", raw.alias("_raw")).select("key", l2_normalise(F.col("_raw")).cast("array<float>").alias("vector"))


def encode_texts(missing: DataFrame, encode: Callable, batch_size: int = 64) -> DataFrame:
    """(key, text) -> (key, vector), in batches through the encoder. Append it to the cache."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch_size):
                part = frame.iloc[at : at + batch_size]
                yield pd.DataFrame({"key": part["key"].to_numpy(), "vector": encode(part["text"].tolist())})

    return missing.select("key", "text").mapInPandas(run, "key string, vector array<float>")


def attach_vectors(texts: DataFrame, cache: DataFrame) -> DataFrame:
    """Every text with its cached vector; a text that was copied a million times is no hot key."""
    keyed = texts.withColumn("key", text_key(F.col("text")))
    return skew_safe_join(keyed, cache.select("key", "vector"), "key", spread=["id"]).drop("key")
