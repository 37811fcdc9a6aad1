"""Substring dedup: paragraphs by MinHash banding, exact Jaccard and components.

A paragraph is a line of at least `min_words` words; shorter ones (headings, licence lines, common
phrases) are left alone. Paragraphs with the same words, whatever their case and blanks, are one node.
Nodes meet in the buckets of `bands` bands of `rows` minima each: with 16 x 5 a pair of Jaccard
similarity 0.8 meets in at least one with probability 0.998, and more similar ones nearly always.

A bucket is not expanded into pairs. Each of its nodes is paired with a leader, the first in an order
that differs from bucket to bucket, and the pair is verified by the exact Jaccard similarity of the
sets of word shingles. Nodes that are unlike their leader, and not connected with it through other
buckets, are then compared with all of the bucket's other components, in the task that holds the bucket;
a bucket of very many nodes is parted by the nodes' rarest shingles, of which similar nodes share one, so no
pair is lost. Verified pairs make components; a component keeps its first paragraph (smallest document id, then position) and loses the
others.

Passages inside longer lines, or over several short ones, are found by their words, across line ends: every
run of `min_words` words that an earlier place has, too (smaller document id, then position), is removed,
and runs that overlap or touch are one span. Word runs of half that length, winnowed so that each passage of
`min_words` has one at the same place, tell which texts and places can share one; only there all runs of
`min_words` are compared, by 128 bits of their words. A run that overlaps its first holder stays, and so does
one inside a line that goes anyway. A passage with changed words is removed where `min_words` words in
succession are unchanged.

Rows that are shuffled by bucket are short (bucket and node, 24 bytes); shingle sets are made for nodes in
shared buckets only and join pairs, so a hot group is many rows of a join that can be split. Only the
second comparison brings sets together.

Defined results: null and empty texts have no paragraphs and stay as they are. A paragraph repeated in
one document is removed like one repeated elsewhere. Null ids come last when a paragraph is kept.
Identical rows (same id and text) count as one document and lose the same paragraphs. An empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.base import carried, query, slices, table, unpacked
from plumbline.llm.components import components
from plumbline.session import pinned

MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Banding:
    """min_words: the shortest paragraph looked at. shingle: words of a shingle. similarity: least Jaccard.
    bucket_rows: nodes of a bucket that a task compares at once; a larger one is parted first, with the same
    pairs."""

    min_words: int = 50
    shingle: int = 5
    similarity: float = 0.8
    bands: int = 16
    rows: int = 5
    seed: int = 1
    bucket_rows: int = 2000


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Paragraphs:
    """The long paragraphs of a column of texts: doc (row), number (line), start and length in code
    points, and the hashes of their words one after another."""

    def __init__(self, texts: pa.Array, min_words: int):
        lines = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), "\n")
        flat = lines.flatten()
        doc = pc.list_parent_indices(lines).to_numpy()
        size = pc.utf8_length(flat).to_numpy()
        first = np.concatenate([[0], np.cumsum(np.diff(lines.offsets.to_numpy()))])[:-1] if len(texts) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(size + 1)])
        start = ends[:-1] - ends[first[doc]] if len(doc) else ends[:-1]
        number = np.arange(len(doc)) - first[doc] if len(doc) else doc
        words = pc.ascii_split_whitespace(pc.ascii_lower(flat))
        tokens, parent = words.flatten(), pc.list_parent_indices(words).to_numpy()
        real = pc.not_equal(tokens, "").to_numpy(zero_copy_only=False)
        count = np.bincount(parent[real], minlength=len(doc))
        self.kept = np.flatnonzero(count >= min_words)
        self.doc, self.number, self.start, self.length = (x[self.kept] for x in (doc, number, start, size))
        self.count = count[self.kept]
        used = real & (count >= min_words)[parent]
        coded = tokens.filter(pa.array(used)).dictionary_encode()
        known = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
        self.words = known[coded.indices.to_numpy()] if len(known) else known
        self.begin = np.concatenate([[0], np.cumsum(self.count)])[:-1].astype(np.int64)

    def nodes(self) -> np.ndarray:
        """128 bits of the words of each paragraph."""
        raw = self.words.astype("<u8").tobytes()
        digest = [xxhash.xxh3_128_digest(raw[8 * b : 8 * (b + n)]) for b, n in zip(self.begin, self.count)]
        return np.frombuffer(b"".join(digest), "<u8").reshape(-1, 2)

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the word shingles, and where each paragraph's begin. A short paragraph has one."""
        n = len(self.words)
        padded = np.concatenate([self.words, np.zeros(width, np.uint64)])
        left = np.repeat(self.begin + self.count, self.count) - np.arange(n)  # words up to the paragraph's end
        h = np.zeros(n, np.uint64)
        for k in range(width):
            h = scramble(h + np.where(left > k, padded[k : k + n], np.uint64(0)) * MIX)
        sizes = np.maximum(self.count - width + 1, 1)
        whole = (left >= width) | (np.arange(n) == np.repeat(self.begin, self.count))
        return h[whole], np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)


def _binary(nodes: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(nodes, "<u8")
    return pa.Array.from_buffers(pa.binary(16), len(raw), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def _nodes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.cast(pa.binary(16)).buffers()[1], "<u8").reshape(-1, 2)[: len(column)]


FOUND = "doc_id bigint, text_hash bigint, paragraph bigint, start bigint, length bigint, words bigint, node binary, bands array<bigint>"


def signatures(docs: DataFrame, b: Banding, text: str = "text") -> DataFrame:
    """One row per long paragraph with its node and band keys. One pass over the texts, no shuffle."""
    rng = np.random.default_rng(b.seed)
    factors = rng.integers(0, 1 << 63, b.bands * b.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(batches):
        for batch in slices(batches, 2):
            p = Paragraphs(batch.column(2), b.min_words)
            if not len(p.kept):
                continue
            h, begin = p.shingles(b.shingle)
            keys = np.empty((len(begin), b.bands), np.uint64)
            for band in range(b.bands):
                key = np.full(len(begin), band + 1, np.uint64)
                for f in factors[band * b.rows : (band + 1) * b.rows]:
                    key = scramble(key * MIX + np.minimum.reduceat(scramble(h * f), begin))
                keys[:, band] = key
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(0, keys.size + 1, b.bands, dtype=np.int32)), pa.array(keys.reshape(-1).view(np.int64))
            )
            ids, hashes = batch.column(0).take(pa.array(p.doc)), batch.column(1).take(pa.array(p.doc))
            ints = [pa.array(x.astype(np.int64)) for x in (p.number, p.start, p.length, p.count)]
            yield pa.RecordBatch.from_arrays([ids, hashes, *ints, _binary(p.nodes()), bands], [c.split()[0] for c in FOUND.split(", ")])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text)
    return rows.mapInArrow(sign, FOUND)


def _runs(key: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key.astype(np.int64)


def _led(rows: DataFrame) -> DataFrame:
    """(key, leader, node) for the nodes of each key but its leader."""

    def lead(batches):
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        key, node = rows["key"].to_numpy().view(np.uint64), _nodes(rows["node"].chunk(0))
        order = np.lexsort((node[:, 1], scramble(node[:, 0] ^ key), key))
        key, node = key[order], node[order]
        first = _runs(key)
        at = np.repeat(first, np.diff(np.append(first, len(key))))
        rest = at < np.arange(len(key))
        if rest.any():
            columns = [pa.array(key[rest].view(np.int64)), _binary(node[at[rest]]), _binary(node[rest])]
            yield pa.RecordBatch.from_arrays(columns, ["key", "leader", "node"])

    return rows.repartition("key").mapInArrow(lead, "key bigint, leader binary, node binary")


def alike_among(part: list, is_open: list[bool], sets: list[np.ndarray], similarity: float):
    """(i, j) pairs that connect each open node with what is similar to it in other components."""
    size = np.array([len(x) for x in sets])
    # who has each shingle, so that a node looks only at those that share one with it
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)[np.argsort(code, kind="stable")]
    ends = np.cumsum(np.bincount(code, minlength=len(values)))
    begin = np.concatenate([[0], np.cumsum(size)])
    part = np.unique(np.array(part, object), return_inverse=True)[1]
    for i in np.flatnonzero(is_open):
        own = code[begin[i] : begin[i + 1]]
        first = np.where(own > 0, ends[own - 1], 0)
        n = ends[own] - first
        met = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
        common = np.bincount(owner[met], minlength=len(sets))
        alike = np.flatnonzero((common >= similarity * (size[i] + size - common)) & (part != part[i]))
        yield from ((i, j) for j in alike[np.unique(part[alike], return_index=True)[1]])


def _settled(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b) for what is similar to the open nodes under each key of (key, node, component, open, shingles)."""

    def settle(batches):
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        rows = rows.take(pc.sort_indices(rows, [("key", "ascending"), ("node", "ascending")]))
        key = rows["key"].to_numpy()
        first = _runs(key)
        node, part = rows["node"].to_pylist(), rows["component"].to_pylist()
        lists = rows["shingles"].combine_chunks()
        values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        opened = rows["open"].to_pylist()
        found = set()
        for lo, hi in zip(first, np.append(first[1:], len(key))):
            if any(opened[lo:hi]) and len(set(part[lo:hi])) > 1:
                sets = [values[ends[i] : ends[i + 1]] for i in range(lo, hi)]
                found.update((node[lo + i], node[lo + j]) for i, j in alike_among(part[lo:hi], opened[lo:hi], sets, similarity))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], ["a", "b"])

    return rows.select("key", "node", "component", "open", "shingles").repartition("key").mapInArrow(settle, "a binary, b binary")


def _shingle_sets(docs: DataFrame, places: DataFrame, b: Banding, text: str) -> DataFrame:
    """(node, shingles): the sorted distinct shingle hashes of the paragraph that stands for each node."""
    wanted = places.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("paragraph", "node")).alias("wanted"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64(text).alias("_hash"), text)
    joined = rows.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")))

    def sets(batches):
        for batch in slices(batches, 0):
            p = Paragraphs(batch.column(0), b.min_words)
            h, begin = p.shingles(b.shingle)
            end = np.append(begin[1:], len(h))
            at = {(d, n): i for i, (d, n) in enumerate(zip(p.doc.tolist(), p.number.tolist()))}
            nodes, values = [], []
            for d, wanted in enumerate(batch.column(1).to_pylist()):
                for w in wanted:
                    i = at[d, w["paragraph"]]
                    nodes.append(w["node"])
                    values.append(np.unique(h[begin[i] : end[i]]).view(np.int64))
            if nodes:
                offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))], ["node", "shingles"]
                )

    # repeated rows give a node's set more than once
    return joined.select(text, "wanted").mapInArrow(sets, "node binary, shingles array<bigint>").dropDuplicates(["node"])


def first_shingles(sets: DataFrame, similarity: float) -> DataFrame:
    """(node, shingle): of each set as many of the rarest shingles (equally rare ones by hash) as it has more
    than a similar set must share, and one. Two sets of at least that similarity have one of these in common."""
    each = sets.select("node", F.explode("shingles").alias("shingle"), F.size("shingles").alias("size"))
    counts = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    ordered = each.join(counts, "shingle").groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("rarest"))
    enough = F.col("size") - F.ceil(F.lit(similarity) * F.col("size") - F.lit(1e-6)) + 1
    return ordered.select("node", F.explode(F.slice("rarest", F.lit(1), enough.cast("int"))["shingle"]).alias("shingle"))


def _parted(rows: DataFrame, sets: DataFrame, b: Banding) -> DataFrame:
    """`rows` with those of buckets of more than `bucket_rows` under other keys, that lose no similar pair: one for
    each of the node's first shingles. Where a key still has more rows, its open nodes and all its nodes are dealt
    into blocks of about `bucket_rows`, and each block of open nodes has a key with each block of all."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    sized = rows.join(sizes, "key")
    small = sized.where(F.col("rows") <= b.bucket_rows).select(*rows.columns)
    large = pinned(sized.where(F.col("rows") > b.bucket_rows).select(*rows.columns), "large-buckets")
    if large.isEmpty():
        return small
    first = first_shingles(sets.join(large.select("node").distinct(), "node"), b.similarity)
    shared = large.join(first, "node").withColumn("key", F.xxhash64("key", "shingle")).select(*rows.columns)
    shared = pinned(shared, "shared-shingles")
    blocks = lambda n: F.ceil(n / b.bucket_rows).cast("int")
    groups = shared.groupBy("key").agg(
        blocks(F.count(F.lit(1))).alias("all"),
        blocks(F.count_if("open")).alias("opened"),
        (F.min("component") != F.max("component")).alias("mixed"),
    )
    dealt = pinned(shared.join(groups.where("mixed and opened > 0").drop("mixed"), "key"), "shared-by-open")
    block = lambda n: F.pmod(F.xxhash64("node", F.lit("block")), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = dealt.where("all > 1 and open").select("*", every("all").alias("j")).withColumn("i", block("opened"))
    asked = dealt.where("all > 1").select("*", every("opened").alias("i")).withColumn("j", block("all")).withColumn("open", F.lit(False))
    tiles = asking.unionByName(asked).withColumn("key", F.xxhash64("key", "i", "j"))
    return small.unionByName(dealt.where("all = 1").select(*rows.columns)).unionByName(tiles.select(*rows.columns))


def similar_nodes(docs: DataFrame, found: DataFrame, b: Banding, text: str) -> DataFrame:
    """(a, b): edges between nodes that connect the similar ones."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "paragraph"))
    nodes = pinned(found.groupBy("node").agg(first.alias("at"), F.first("bands").alias("bands")), "nodes")
    led = pinned(_led(nodes.select(F.explode("bands").alias("key"), "node")), "buckets")
    used = led.select("node").union(led.select("leader")).distinct()
    places = nodes.join(used, "node").select("node", "at.doc_id", "at.text_hash", "at.paragraph")
    sets = pinned(_shingle_sets(docs, places, b, text), "shingle-sets")

    both = led.select("leader", "node").distinct().join(sets, "node").withColumnRenamed("shingles", "_mine")
    both = both.join(sets.withColumnRenamed("node", "leader"), "leader")
    common = F.size(F.array_intersect("_mine", "shingles"))
    alike = common >= F.lit(b.similarity) * (F.size("_mine") + F.size("shingles") - common)
    checked = pinned(both.select("leader", "node", alike.alias("alike")), "pairs")
    verified = checked.where("alike").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    tree = pinned(components(verified, "a", "b"), "similar")
    # open: who is unlike the leader, and not connected with it through other buckets
    root_of = lambda c: tree.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    rows = led.join(checked, ["leader", "node"]).join(root_of("node"), "node", "left").join(root_of("leader"), "leader", "left")
    part, leads = F.coalesce("node_root", "node"), F.coalesce("leader_root", "leader")
    rows = pinned(rows.select("key", "node", part.alias("component"), "leader", leads.alias("leads"), (~F.col("alike") & (part != leads)).alias("open")), "bucket-rows")
    keys = rows.where("open").select("key").distinct()
    leaders = rows.select("key", F.col("leader").alias("node"), F.col("leads").alias("component"), F.lit(False).alias("open")).distinct()
    rows = rows.select("key", "node", "component", "open").unionByName(leaders).join(keys, "key", "left_semi")
    settled = _settled(_parted(rows, sets, b).join(sets, "node"), b.similarity)
    return tree.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(settled)


def repeated_paragraphs(docs: DataFrame, banding: Banding | None = None, text: str = "text") -> DataFrame:
    """The paragraphs of all components of two or more: doc_id, text_hash, paragraph, start, length, words,
    kept_doc_id, kept_paragraph, and removed (false for the one that stays)."""
    b = banding or Banding()
    found = pinned(signatures(docs, b, text), "paragraphs")
    tree = pinned(components(similar_nodes(docs, found, b, text), "a", "b"), "paragraph-components")
    rows = found.drop("bands").distinct().join(tree, "node", "left").withColumn("root", F.coalesce("root", "node")).drop("node")
    rows = pinned(rows, "paragraph-classes")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_hash"), F.col("paragraph"))
    classes = rows.groupBy("root").agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("members")).where("members > 1")
    return rows.join(classes, "root").select(
        *[c for c in rows.columns if c != "root"],
        F.col("kept.doc_id").alias("kept_doc_id"),
        F.col("kept.paragraph").alias("kept_paragraph"),
        (place != F.col("kept")).alias("removed"),
    )


class Stretches:
    """The words of a column of texts, all after another: doc (row), line, start and end in code points, hash,
    and first and count, where each text's words begin and how many it has."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        # a line break between texts, so that no word runs over
        data = np.frombuffer(b"\n".join(texts.to_pylist()) + b"\n", np.uint8)
        begin = np.cumsum(sizes + 1) - sizes - 1
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
        first, last = edge[::2], edge[1::2]
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        self.doc = np.searchsorted(begin, first, side="right") - 1
        at = begin[self.doc]
        self.start, self.end = chars[first] - chars[at], chars[last] - chars[at]
        self.line = breaks[first] - breaks[at]
        low = (data + np.where((data >= 65) & (data <= 90), 32, 0)).astype(np.uint64)
        self.hash = scramble(sums(scramble(low + np.uint64(1)), first, last, FACTORS[0]) + (last - first).astype(np.uint64) * MIX)
        self.count = np.bincount(self.doc, minlength=len(sizes))
        self.first = np.cumsum(self.count) - self.count

    def grams(self, width: int, factor: int) -> tuple[np.ndarray, np.ndarray]:
        """(at, hash) of the runs of `width` words that lie inside a text."""
        at = np.arange(max(len(self.hash) - width + 1, 0))
        at = at[self.doc[at] == self.doc[at + width - 1]]
        return at, scramble(sums(self.hash, at, at + width, factor))


FACTORS = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0x9FB21C651E98DF25)


def sums(values: np.ndarray, first: np.ndarray, last: np.ndarray, factor: int) -> np.ndarray:
    """The polynomial of values[first:last] in an odd factor, modulo 2^64, for many ranges at once."""
    powers = lambda f: np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(values), f, np.uint64)]))
    total = np.concatenate([[np.uint64(0)], np.cumsum(values * powers(factor)[:-1])])
    return (total[last] - total[first]) * powers(pow(factor, -1, 1 << 64))[first]


def _sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """The least (np.minimum) or greatest (np.maximum) of every `width` values in succession."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = least(x[:-step], x[step:])
        done += step
    return x


def seeds(s: Stretches, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(at, hash) of runs of half of `min_words`: the least of as many neighbours as begin in `min_words` words
    is one, so that equal passages of that length have an equal seed at the same place."""
    width = max(min_words // 2, 1)
    window = min_words - width + 1
    at, h = s.grams(width, FACTORS[1])
    if len(at) < window:
        return at[:0], h[:0]
    # windows that lie in one text: those over two texts count as its lowest value, so that they choose nothing
    lows = np.where(s.doc[at[: len(at) - window + 1]] == s.doc[at[window - 1 :]], _sliding(h, window, np.minimum), np.uint64(0))
    around = np.concatenate([np.zeros(window - 1, np.uint64), lows, np.zeros(window - 1, np.uint64)])
    chosen = _sliding(around, window, np.maximum) == h
    return at[chosen], h[chosen]


def _doc_key() -> Column:
    return F.xxhash64("doc_id", "text_hash")


PLACE = ("no_id", "doc_id", "text_hash", "word")
STEP = 20_000  # places of a row are told from its first one, in 16 bits
GRAMS = (
    "doc_id bigint, text_hash bigint, seed bigint, word bigint, line int, start int, end int, "
    "keys array<bigint>, lines array<smallint>, starts array<smallint>, ends array<smallint>"
)


def _lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def repeated_passages(docs: DataFrame, gone: DataFrame, banding: Banding | None = None, text: str = "text") -> DataFrame:
    """The spans of `min_words` words or more in succession that an earlier place has, with the columns of
    `repeated_paragraphs`; paragraph is the line a span begins in. `gone` has the removed paragraphs.

    Runs in succession with one seed travel as a row, to the task of the seed: a run's key is its seed and 64
    bits of all its words. There they are taken apart, and what an earlier place has is put together again
    before it travels to the task of its text."""
    b = banding or Banding()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text)

    def sown(batches):
        for batch in slices(batches, 1):
            s = Stretches(batch.column(1))
            at, h = seeds(s, b.min_words)
            doc = s.doc[at]
            order = np.lexsort((h, doc))  # a text names each of its seeds once
            h, doc = h[order], doc[order]
            first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])) if len(h) else order
            n = np.diff(np.append(first, len(h)))
            key = batch.column(0).to_numpy()[doc[first]]
            yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(key), pa.array(n, pa.int32())], ["seed", "doc_key", "n"])

    found = rows.select(_doc_key().alias("doc_key"), text).mapInArrow(sown, "seed bigint, doc_key bigint, n int")
    found = pinned(found, "seeds")
    shared = found.groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed")
    wanted = found.select("seed", "doc_key").join(shared, "seed").groupBy("doc_key").agg(F.collect_set("seed").alias("wanted"))
    lines = gone.groupBy(_doc_key().alias("doc_key")).agg(F.collect_set(F.struct("start", "length")).alias("gone"))
    joined = rows.withColumn("doc_key", _doc_key()).join(pinned(wanted.join(lines, "doc_key", "left"), "shared-seeds"), "doc_key")

    def runs(batches):
        for batch in slices(batches, 2):
            s = Stretches(batch.column(2))
            width = max(b.min_words // 2, 1)
            wanted, asked = batch.column(3), batch.column(4)
            values = wanted.flatten().to_numpy().view(np.uint64)
            key = lambda h, d: scramble(h + d.astype(np.uint64) * MIX)
            place, k1 = s.grams(b.min_words, FACTORS[2])
            if not len(place):
                continue
            # a run's own seed is the least of its parts: two equal runs have an equal one
            at, h = s.grams(width, FACTORS[1])
            own = _sliding(h, b.min_words - width + 1, np.minimum)[np.searchsorted(at, place)]
            use = np.isin(key(own, s.doc[place]), key(values, pc.list_parent_indices(wanted).to_numpy()))
            for d, lines in enumerate(asked.to_pylist()):
                lo, hi = np.searchsorted(s.doc[place], [d, d + 1])
                for x in lines or []:
                    inside = (s.start[place[lo:hi]] >= x["start"]) & (s.end[place[lo:hi] + b.min_words - 1] <= x["start"] + x["length"])
                    use[lo:hi] &= ~inside
            place, k1, own = place[use], k1[use], own[use]
            if not len(place):
                continue
            doc = s.doc[place]
            places = s.line[place], s.start[place], s.end[place + b.min_words - 1]
            new = np.concatenate([[True], (np.diff(place) != 1) | (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])])
            for x in places:
                new[1:] |= x[1:] // STEP != x[:-1] // STEP
            begin = np.flatnonzero(new)
            # at most `min_words` runs in a row: they overlap or touch, so those that go are one span
            new |= (np.arange(len(place)) - np.repeat(begin, np.diff(np.append(begin, len(place))))) % b.min_words == 0
            begin = np.flatnonzero(new)
            offsets, first = np.append(begin, len(place)), place[begin]
            ids = [batch.column(i).take(pa.array(s.doc[first])) for i in (0, 1)]
            ints = [pa.array(own[begin].view(np.int64)), pa.array(first - s.first[s.doc[first]])]
            ints += [pa.array(x[begin], pa.int32()) for x in places]
            lists = [_lists(offsets, k1.view(np.int64), pa.int64())]
            lists += [_lists(offsets, x - np.repeat(x[begin], np.diff(offsets)), pa.int16()) for x in places]
            yield pa.RecordBatch.from_arrays([*ids, *ints, *lists], [c.split()[0] for c in GRAMS.split(", ")])

    rows = joined.select("doc_id", "text_hash", text, "wanted", "gone").mapInArrow(runs, GRAMS)
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.sparkSession.sparkContext.defaultParallelism)
    apart = F.posexplode(F.arrays_zip("keys", "lines", "starts", "ends")).alias("nth", "run")
    grams = rows.repartition(parts, "seed").select("doc_id", "text_hash", "seed", F.col("word").alias("from"), "line", "start", "end", apart)
    grams = grams.select(
        "doc_id", "text_hash", "seed", "from", F.col("doc_id").isNull().alias("no_id"), (F.col("from") + F.col("nth")).alias("word"),
        F.col("run.keys").alias("key"), *[(F.col(c) + F.col(f"run.{c}s")).alias(c) for c in ("line", "start", "end")],
    )
    # equal runs pass in order of place, so a task holds one of them, however many there are
    in_order = Window.partitionBy("seed", "key").orderBy(*PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = grams.withColumn("first", F.first(F.struct(*PLACE, "line")).over(in_order))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    later = met.where(~same | (F.col("word") - F.col("first.word") >= b.min_words))
    span = [
        F.min(F.struct("word", "line", "start", F.struct("first.doc_id", "first.line").alias("first"))).alias("x"),
        F.max("end").alias("end"), F.max("word").alias("to"),
    ]
    later = later.groupBy("seed", "doc_id", "text_hash", "from").agg(*span)
    of_text = Window.partitionBy("doc_id", "text_hash").orderBy("x.word")
    new = (F.col("x.word") - F.lag("to").over(of_text) <= b.min_words).eqNullSafe(F.lit(True))
    later = later.withColumn("span", F.sum((~new).cast("int")).over(of_text))
    spans = later.groupBy("doc_id", "text_hash", "span").agg(F.min("x").alias("x"), F.max("end").alias("end"), F.max("to").alias("to"))
    return spans.select(
        "doc_id",
        "text_hash",
        F.col("x.line").alias("paragraph"),
        F.col("x.start").alias("start"),
        (F.col("end") - F.col("x.start")).alias("length"),
        (F.col("to") - F.col("x.word") + b.min_words).alias("words"),
        F.col("x.first.doc_id").alias("kept_doc_id"),
        F.col("x.first.line").alias("kept_paragraph"),
        F.lit(True).alias("removed"),
    )


def repeats(docs: DataFrame, banding: Banding | None = None, text: str = "text") -> DataFrame:
    """`repeated_paragraphs` and `repeated_passages`. A passage may stand in a paragraph that stays."""
    lines = pinned(repeated_paragraphs(docs, banding, text), "repeated-paragraphs")
    return lines.unionByName(repeated_passages(docs, lines.where("removed"), banding, text))


def _without(value: Column, cuts: Column) -> Column:
    """A text without the parts (start, end) of a sorted array. A last line that goes takes the break before it."""

    def cut(state: Column, c: Column) -> Column:
        piece = F.substring(value, state["at"] + 1, F.greatest(c["start"] - state["at"], F.lit(0)))
        return F.struct(F.greatest(state["at"], c["end"]).alias("at"), F.array_append(state["kept"], piece).alias("kept"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("kept"))
    rest = lambda s: F.concat(F.array_join(s["kept"], ""), F.substring(value, s["at"] + 1, F.length(value)))
    left = F.aggregate(cuts, start, cut, rest)
    last_line = F.exists(cuts, lambda c: c["end"] > F.length(value))
    return F.when(last_line & left.endswith("\n"), F.substring(left, F.lit(1), F.length(left) - 1)).otherwise(left)


def without_repeats(docs: DataFrame, banding: Banding | None = None, text: str = "text") -> DataFrame:
    """The documents less their removed paragraphs; a document that loses none is unchanged."""
    return _less(docs, repeated_paragraphs(docs, banding, text).where("removed").withColumn("more", F.lit(1)), text)


def without_passages(docs: DataFrame, banding: Banding | None = None, text: str = "text") -> DataFrame:
    """The documents less their removed paragraphs and passages; a document that loses none is unchanged. A
    paragraph goes with its line break, of a passage the blanks around it stay."""
    lines = pinned(repeated_paragraphs(docs, banding, text).where("removed"), "removed-paragraphs")
    passages = repeated_passages(docs, lines, banding, text).withColumn("more", F.lit(0))
    return _less(docs, lines.withColumn("more", F.lit(1)).unionByName(passages), text)


def _less(docs: DataFrame, cuts: DataFrame, text: str) -> DataFrame:
    """The documents less `length` and `more` characters from each `start`."""
    part = F.struct(F.col("start").cast("int").alias("start"), (F.col("start") + F.col("length") + F.col("more")).cast("int").alias("end"))
    gone = cuts.groupBy(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash")).agg(F.array_sort(F.collect_set(part)).alias("_gone"))
    rows = carried(docs).withColumn("_hash", F.xxhash64(f"_row.{text}"))
    joined = rows.join(gone, F.col("_row.doc_id").cast("bigint").eqNullSafe(F.col("_gone_id")) & (F.col("_hash") == F.col("_gone_hash")), "left")
    value = F.col("_row")[text]
    return joined.select(*unpacked(docs, **{text: F.when(F.col("_gone").isNull(), value).otherwise(_without(value, F.col("_gone")))}))


@query("op7_paragraphs")
def op7_paragraphs(spark, folder):
    return repeats(table(spark, folder, "documents")).drop("text_hash")
