"""Ranked lexical search over a prefix tree of documents.

Items (queries) are taken in blocks of bounded vocabulary. One pass over the texts reduces every document
to its vector of a block's terms (its other words only count for its length). A task takes some thousand
vectors at a time, with terms in order of falling document frequency, and sorts them: documents with a
common prefix of terms stand together, and the tree's paths are those prefixes, shared ones once. A node
holds, for its documents, the greatest frequency of every term and the smallest length norm m. A term's
share of a score grows with its frequency and falls with m, so these give a bound that no document below
the node exceeds. An item goes down the tree depth first, the best child first, and leaves out what is
bound below its k-th best score so far; what is left is scored exactly. A task hands on k rows an item.

Defined results: a null or blank text has no term and is not counted; a null item has no result. Each
row of the items is a query of its own, each row of the documents a document of its own; equal scores
rank by id, null ids last. Empty tables give an empty result. Other columns are not looked at. A very
long text is read in slices cut between words; memory follows its distinct terms.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.base import query, table
from plumbline.llm.words import word_slices
from plumbline.session import pinned

K = 20
BLOCK_ITEMS, BLOCK_TERMS = 1024, 4096  # items of a block, and its distinct terms (one longer item is a block)
TREE_ROWS, TREE_CELLS = 4096, 1 << 24  # documents of a tree, and documents times terms
LEAF = 32  # documents that are scored together
NO_ID = np.iinfo(np.int64).max  # a null id inside a task


@dataclass
class Block:
    """Items and the numbers of their terms."""

    ids: list
    counts: list[Counter]
    terms: dict[bytes, int]


def item_blocks(items: DataFrame, id: str, text: str):
    """The items, block by block; the driver holds one block."""
    block = Block([], [], {})
    for row in items.select(F.col(id).alias("id"), F.col(text).alias("text")).toLocalIterator():
        counts: Counter = Counter()
        for words in word_slices(row.text):
            counts.update(words)
        if not counts:
            continue
        if block.ids and (len(block.ids) >= BLOCK_ITEMS or len(block.terms.keys() | counts.keys()) > BLOCK_TERMS):
            yield block
            block = Block([], [], {})
        for term in counts:
            block.terms.setdefault(term, len(block.terms))
        block.ids.append(row.id)
        block.counts.append(counts)
    if block.ids:
        yield block


def vectors(docs: DataFrame, terms: dict[bytes, int], id: str, text: str) -> DataFrame:
    """(id, n, terms, tf): for every document with a term its number of terms, and those of `terms` with their
    frequencies. One pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def reduce(batches):
        numbers = shared.value
        for batch in batches:
            ids, ns, sizes, found, tfs = [], [], [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, counts = 0, Counter()
                for words in word_slices(t.as_py()):
                    n += len(words)
                    counts.update(words)
                if not n:
                    continue
                own = [(numbers[w], c) for w, c in counts.items() if w in numbers]
                ids.append(i)
                ns.append(n)
                sizes.append(len(own))
                found += [term for term, _ in own]
                tfs += [c for _, c in own]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), pa.int32())
            columns = [pa.array(ids, pa.int64()), pa.array(ns, pa.int64())]
            columns += [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (found, tfs)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "tf"])

    read = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    return read.mapInArrow(reduce, "id bigint, n bigint, terms array<int>, tf array<int>")


# ------------------------------------------------------------------ the tree


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Tree:
    """Documents as rows sorted by their terms, most frequent term first. A node is a range of rows with a
    common prefix; small neighbouring children of a node are one leaf."""

    def __init__(self, paths: list[np.ndarray], tf: np.ndarray, m: np.ndarray, ids: np.ndarray):
        order = sorted(range(len(paths)), key=lambda i: paths[i].astype(">u4").tobytes())
        self.tf, self.m, self.ids = tf[order], m[order], ids[order]
        paths = [paths[i] for i in order]
        self.range: list[tuple[int, int]] = [(0, len(paths))]
        self.children: list[list[int]] = [[]]
        todo = [0]
        while todo:
            node = todo.pop()
            for lo, hi, whole in self._parts(paths, *self.range[node]):
                self.children[node].append(len(self.range))
                self.range.append((lo, hi))
                self.children.append([])
                if whole:
                    todo.append(len(self.range) - 1)
        self.top = np.empty((len(self.range), tf.shape[1]), tf.dtype)
        self.least = np.empty(len(self.range), np.int64)
        for node in reversed(range(len(self.range))):  # children come after their parent
            if below := self.children[node]:
                self.top[node], self.least[node] = self.top[below].max(axis=0), self.least[below].min()
            else:
                lo, hi = self.range[node]
                self.top[node], self.least[node] = self.tf[lo:hi].max(axis=0), self.m[lo:hi].min()

    @staticmethod
    def _parts(paths: list[np.ndarray], lo: int, hi: int):
        """(start, end, whether it is cut further) of the children of a range; none if it is a leaf."""
        if hi - lo <= LEAF:
            return
        first, last = paths[lo], paths[hi - 1]  # sorted: what these two share all share
        short = min(len(first), len(last))
        differ = np.flatnonzero(first[:short] != last[:short])
        depth = int(differ[0]) if len(differ) else short
        if depth == len(last):
            return  # equal vectors
        following = np.array([p[depth] if len(p) > depth else -1 for p in paths[lo:hi]])
        starts = [0, *(np.flatnonzero(np.diff(following)) + 1).tolist(), hi - lo]
        held = lo
        for start, end in zip(starts, starts[1:]):
            if end - start > LEAF:
                if held < lo + start:
                    yield held, lo + start, False
                yield lo + start, lo + end, True
                held = lo + end
            elif lo + end - held > LEAF:
                yield held, lo + start, False
                held = lo + start
        if held < hi:
            yield held, hi, False

    def search(self, terms: np.ndarray, weight: np.ndarray, best: Best) -> None:
        """Put into `best` what belongs there of the documents of the tree."""
        bound = (weight * saturation(self.top[:, terms].astype(np.int64), self.least[:, None])).sum(axis=1)
        todo = [0]
        while todo:
            node = todo.pop()
            if bound[node] == 0 or bound[node] < best.least:
                continue
            if below := self.children[node]:
                todo += sorted(below, key=bound.__getitem__)
            else:
                lo, hi = self.range[node]
                tf = self.tf[lo:hi, terms].astype(np.int64)
                best.add((weight * saturation(tf, self.m[lo:hi, None])).sum(axis=1), self.ids[lo:hi])


class Best:
    """The k best (score, id) so far: the highest scores above 0, equal ones by id."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        if not good.any():
            return
        scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


def _trees(batches, n_terms: int, rank: np.ndarray, n_docs: int, n_all: int):
    """Trees of the vectors of a task, a bounded number of rows at a time."""
    rows = max(1, min(TREE_ROWS, TREE_CELLS // n_terms))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = pa.RecordBatch.from_arrays([c.slice(start, rows) for c in batch.columns], batch.schema.names)
            listed = part.column("terms")
            size = np.diff(listed.offsets.to_numpy())
            row = np.repeat(np.arange(len(size)), size)
            term = rank[listed.flatten().to_numpy()]
            tf = np.zeros((len(size), n_terms), np.int32)
            tf[row, term] = part.column("tf").flatten().to_numpy()
            paths = np.split(term[np.lexsort((term, row))], np.cumsum(size)[:-1])
            m = 100 - 25 + (25 * part.column("n").to_numpy() * n_docs) // n_all
            yield Tree(paths, tf, m, part.column("id").fill_null(NO_ID).to_numpy())


def _block_topk(docs: DataFrame, block: Block, k: int, id: str, text: str) -> DataFrame:
    """(_item, id, score): for each item of the block the k best of every task."""
    spark = docs.sparkSession
    rows = pinned(vectors(docs, block.terms, id, text), "vectors")
    n_docs, n_all = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(block.terms), np.int64)
    for term, n in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect():
        df[term] = n  # a row for each term of the block
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df]
    asked = []
    for counts in block.counts:
        own = [(rank[t], c * weight[t]) for term, c in counts.items() if df[t := block.terms[term]]]
        asked.append(tuple(np.array(x, np.int64) for x in zip(*own)) if own else None)
    shared = spark.sparkContext.broadcast((asked, rank))

    def search(batches):
        asked, rank = shared.value
        best = [Best(k) for _ in asked]
        for tree in _trees(batches, len(rank), rank, n_docs, n_all):
            for item, found in zip(asked, best):
                if item is not None:
                    tree.search(*item, found)
        for number, found in enumerate(best):
            if len(found.ids):
                ids = pa.array(found.ids, mask=found.ids == NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number, np.int32)), ids, pa.array(found.scores)], ["_number", "id", "score"])

    found = rows.where(F.size("terms") > 0).mapInArrow(search, "_number int, id bigint, score bigint")
    order = Window.partitionBy("_number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = K, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item. A pass over the texts for each block of items."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType
    out = None
    for block in item_blocks(items, item_id, item_text):
        names = spark.createDataFrame(list(enumerate(block.ids)), f"_number int, {item_id} {kind.simpleString()}")
        top = _block_topk(docs, block, k, id, text).join(F.broadcast(names), "_number")
        top = top.select(item_id, "rank", F.col("id").alias("doc_id"), "score")
        out = top if out is None else out.unionByName(top)
    return out or spark.createDataFrame([], f"{item_id} {kind.simpleString()}, rank int, doc_id bigint, score bigint")


TERMS_SQL = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


@query(
    "op12_ranked",
    f"""with docs as (select row_number() over () as r, doc_id, {TERMS_SQL.format('text')} as ts from documents),
      stat as (select count(*) filter (len(ts) > 0) as n_docs, sum(len(ts))::bigint as n_all from docs),
      asked as (select item_id, term, count(*) as c from (select item_id, unnest({TERMS_SQL.format('text')}) as term from benchmark) group by all),
      tfs as (select r, term, count(*) as tf from (select r, unnest(ts) as term from docs) where term in (select term from asked) group by all),
      weights as (select term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::bigint as w from (select term, count(*) as df from tfs group by term), stat),
      scored as (select item_id, r, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * len(ts) * n_docs) // n_all)))))::bigint as score
        from asked join tfs using (term) join weights using (term) join docs using (r), stat group by item_id, r)
      select item_id, rank::int as rank, doc_id, score from (
        select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored join docs using (r) where score > 0) where rank <= {K}""",
)
def op12_ranked(spark, folder):
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
