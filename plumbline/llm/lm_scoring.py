"""Language-model scores from an n-gram trie that is spread over the cluster.

The model is a bigram model over words with Dirichlet smoothing: P(w | v) = c(v w) / (c(v) + k) +
k / (c(v) + k) * P(w), and P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)). A text is its words and one end; the
first word follows a begin mark. Counts cover every training text, whole.

Nothing of the model is held whole anywhere. Documents form blocks of about equal size by hash, words
and pairs of words belong to shards by hash, and blocks and shards exchange sorted arrays:

1. every block sends its distinct words with their counts to the words' shards, which add the counts up,
   number the words and send both back;
2. every block sends its distinct pairs, as word numbers, to the pairs' shards. A shard builds an
   Elias-Fano trie of its pairs, with the quantised first term of P(w | v) for each, looks every asked
   pair up in it, and sends the values back;
3. every block adds up its texts' scores.

A frequent word or pair is one entry per block, so no shard gets hot; the number of blocks and shards
follows the size of the texts. Word numbers and pairs are sorted, so they cross the network as deltas.

Defined results: a null text is the empty text, which is one end. Repeated rows teach as often as they
occur. Rows whose `train` is null do not teach. Without training rows every token has probability 1 in
the base score (N = V = 0) and in the model. An empty table gives an empty result.
"""

from __future__ import annotations

import mmap
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.base import partitions_for, query, slices, table
from plumbline.llm.elias_fano import Trie, build
from plumbline.llm.language import held_out
from plumbline.llm.paragraphs import MIX, scramble
from plumbline.llm.words import BEGIN, Words

STEPS = 4096  # quantisation: steps per factor of ten


@dataclass(frozen=True)
class Bigram:
    """prior: k, the weight of the unigram in counts. block_bytes: text of a block."""

    prior: float = 4.0
    block_bytes: int = 8 << 20


def squeeze(values: np.ndarray) -> bytes:
    """Integers below 2^64 as bytes: one plane per byte of the widest, compressed."""
    v = values.astype("<u8")
    planes = np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8).T[: max(1, (int(v.max(initial=0)).bit_length() + 7) // 8)])
    return len(v).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[8:]), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = planes.reshape(-1, n)
        out[:, : len(planes)] = planes.T
    return out.view("<u8").reshape(-1)


def rising(values: np.ndarray) -> np.ndarray:
    return np.diff(values.astype(np.int64), prepend=0)


def _by_shard(shard: np.ndarray) -> list[tuple[int, slice]]:
    """(shard, where it lies) for a sorted column of shards."""
    first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else shard
    return [(int(shard[a]), slice(int(a), int(b))) for a, b in zip(first, np.append(first[1:], len(shard)))]


def pair_order(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """What sorts pairs of word numbers; numbers below 2^32 make one key."""
    if max(first.max(initial=0), second.max(initial=0)) >> np.uint64(32):
        return np.lexsort((second, first))
    return np.argsort(first << np.uint64(32) | second)


class Block:
    """The texts of one block; everything that is sent is sorted, so the order of the rows does not matter."""

    def __init__(self, rows: pa.Table, shards: int):
        self.number = rows["block"][0].as_py()
        texts = rows["text"].combine_chunks()
        self.known, self.code, self.begin = Words(texts).framed()
        self.sizes = np.diff(np.append(self.begin, len(self.code)))
        self.train = np.repeat(rows["train"].to_numpy(zero_copy_only=False).astype(bool), self.sizes)
        self.shards = shards
        shard = scramble(self.known) % np.uint64(shards)
        self.order = np.lexsort((self.known, shard))
        self.parts = _by_shard(shard[self.order])

    def words(self):
        """(shard, words, counts in training texts)."""
        count = np.bincount(self.code[self.train], minlength=len(self.known))
        for shard, at in self.parts:
            own = self.order[at]
            yield shard, self.known[own], count[own]

    def learn(self, answers: pa.Table) -> None:
        """Take the numbers and counts of the words from their shards' answers."""
        by_shard = {r["shard"]: r for r in answers.to_pylist() if r["kind"] == 0}
        self.number_of, self.count = np.zeros(len(self.known), np.int64), np.zeros(len(self.known), np.int64)
        for shard, at in self.parts:
            own = self.order[at]
            self.number_of[own] = np.cumsum(unsqueeze(by_shard[shard]["a"]).astype(np.int64)) * self.shards + shard
            self.count[own] = unsqueeze(by_shard[shard]["b"])
        # pairs inside texts whose words were both learned
        inside = np.ones(len(self.code), bool)
        inside[self.begin] = False
        self.token = np.flatnonzero(inside)
        v, w = self.code[self.token - 1], self.code[self.token]
        asked = (self.count[v] > 0) & (self.count[w] > 0)
        local, self.pair = np.unique(v[asked] * len(self.known) + w[asked], return_inverse=True)
        self.asked = asked
        v, w = local // len(self.known), local % len(self.known)
        first, second = self.number_of[v].astype(np.uint64), self.number_of[w].astype(np.uint64)
        shard = scramble(first * MIX + second) % np.uint64(self.shards)
        order = pair_order(first, second)
        self.pair_order = order[np.argsort(shard[order].astype(np.uint16 if self.shards <= 1 << 16 else np.uint64), kind="stable")]
        self.pair_parts = _by_shard(shard[self.pair_order])
        self.pairs = first, second, self.count[v]

    def pair_rows(self):
        """(shard, first, second, count in training texts, count of the first word)."""
        n = np.bincount(self.pair[self.train[self.token[self.asked]]], minlength=len(self.pairs[0]))
        for shard, at in self.pair_parts:
            own = self.pair_order[at]
            yield shard, self.pairs[0][own], self.pairs[1][own], n[own], self.pairs[2][own]

    def score(self, answers: pa.Table, total: float, prior: float) -> dict[str, np.ndarray]:
        by_shard = {r["shard"]: r for r in answers.to_pylist() if r["kind"] == 1}
        value = np.zeros(len(self.pairs[0]), np.int64)
        for shard, at in self.pair_parts:
            value[self.pair_order[at]] = unsqueeze(by_shard[shard]["a"])
        v, w = self.code[self.token - 1], self.code[self.token]
        unigram = (self.count[w] + 0.5) / total
        context = self.count[v]
        p = np.where(context > 0, prior / (context + prior), 1.0) * unigram
        found = value[self.pair]
        p[self.asked] += np.where(found > 0, 10.0 ** -((found - 1) / STEPS), 0.0)
        first = np.cumsum(self.sizes - 1) - (self.sizes - 1)
        add = lambda x: np.add.reduceat(x, first) if len(first) else x
        return {
            "n_tokens": self.sizes - 1,
            "n_known": add((self.count[w] > 0).astype(np.int64)),
            "base_score": add(np.log10(unigram)),
            "score": add(np.log10(np.minimum(p, 1.0))),
        }


REQUEST = "shard bigint, block bigint, a binary, b binary, c binary, d binary"
ANSWER = "block bigint, kind int, shard bigint, a binary, b binary"


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    fields = [(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.table({n: pa.array(c, t) for c, (n, t) in zip(columns, fields)})


def answer_words(rows: pa.Table) -> pa.Table:
    """Add up the counts of a shard's words over all blocks, number the words, and answer each block."""
    asked = [(r["block"], unsqueeze(r["a"]).cumsum(dtype=np.uint64), unsqueeze(r["b"])) for r in rows.to_pylist()]
    words, place = np.unique(np.concatenate([w for _, w, _ in asked]), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate([n for _, _, n in asked]), minlength=len(words)).astype(np.int64)
    out, at, shard = [], 0, rows["shard"][0].as_py()
    for block, w, _ in asked:
        own = place[at : at + len(w)]
        at += len(w)
        out.append((block, 0, shard, squeeze(rising(own)), squeeze(total[own])))
    return _table(out, ANSWER)


def answer_pairs(prior: float):
    def answer(rows: pa.Table) -> pa.Table:
        """Build the trie of a shard's pairs and look up what each block asks."""
        asked = []
        for r in rows.to_pylist():
            first = np.cumsum(unsqueeze(r["a"]).astype(np.int64)).astype(np.uint64)
            asked.append((r["block"], first, unsqueeze(r["b"]), unsqueeze(r["c"]), unsqueeze(r["d"])))
        v, w, n, c = (np.concatenate([x[i] for x in asked]) for i in (1, 2, 3, 4))
        order = pair_order(v, w)
        v, w, n, c = v[order], w[order], n[order], c[order]
        new = np.concatenate([[True], (v[1:] != v[:-1]) | (w[1:] != w[:-1])]) if len(v) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        v, w, c = v[start], w[start], c[start]
        count = np.add.reduceat(n, start).astype(float) if len(v) else n.astype(float)
        place = np.empty(len(order), np.int64)  # which of the distinct pairs each asked one is
        place[order] = np.cumsum(new) - 1
        seen = count > 0
        value = 1 + np.minimum(np.rint(-np.log10(count[seen] / (c[seen] + prior)) * STEPS), 65534)
        image = build(v[seen], w[seen], value)
        with mmap.mmap(-1, len(image)) as memory:  # the levels are read in place from a map
            memory[:] = image
            trie = Trie(memory)
            at = trie.find(v, w)
            found = np.zeros(len(v), np.uint16)
            found[at >= 0] = trie.values[at[at >= 0]]
            del trie
        out, shard, end = [], rows["shard"][0].as_py(), 0
        for block, first, *_ in asked:
            end += len(first)
            out.append((block, 1, shard, squeeze(found[place[end - len(first) : end]]), b""))
        return _table(out, ANSWER)

    return answer


def totals(docs: DataFrame, text: str = "text", train: str = "train") -> tuple[int, int]:
    """(N, V): tokens of the training texts, ends included, and how many are distinct."""

    def count(batches):
        for batch in slices(batches, 0, 8 << 20):
            known, code, _ = Words(batch.column(0)).framed()
            n = np.bincount(code, minlength=len(known))
            own = (known != BEGIN) & (n > 0)
            yield pa.RecordBatch.from_arrays([pa.array(known[own].view(np.int64)), pa.array(n[own])], ["word", "n"])

    words = docs.where(F.col(train)).select(text).mapInArrow(count, "word bigint, n bigint")
    n, v = words.groupBy("word").agg(F.sum("n").alias("n")).agg(F.sum("n"), F.count(F.lit(1))).first()
    return n or 0, v


def score_texts(docs: DataFrame, train: Column, model: Bigram | None = None, text: str = "text") -> DataFrame:
    """Add n_tokens, n_known, train_tokens, base_score and score; columns of these names are replaced."""
    model = model or Bigram()
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    n, v = totals(docs.select(value.alias("text"), F.coalesce(train, F.lit(False)).alias("train")))
    total, prior = n + 0.5 * (v + 1), model.prior
    shards = partitions_for(docs, text, model.block_bytes)
    block = F.pmod(F.xxhash64("_row.doc_id", "text"), F.lit(shards))
    rows = docs.select(value.alias("text"), F.coalesce(train, F.lit(False)).alias("train"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("_row"))
    rows = rows.withColumn("block", block)
    result = T.StructType([rows.schema["_row"], rows.schema["text"]])
    for c, kind in (("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double")):
        result = result.add(c, kind)
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")

    def ask_words(rows: pa.Table) -> pa.Table:
        b = Block(rows, shards)
        return _table([(s, b.number, squeeze(np.diff(w, prepend=np.uint64(0))), squeeze(c), b"", b"") for s, w, c in b.words()], REQUEST)

    def ask_pairs(rows: pa.Table, answers: pa.Table) -> pa.Table:
        b = Block(rows, shards)
        b.learn(answers)
        out = [(s, b.number, squeeze(rising(f)), squeeze(g), squeeze(c), squeeze(k)) for s, f, g, c, k in b.pair_rows()]
        return _table(out, REQUEST)

    def add_up(rows: pa.Table, answers: pa.Table) -> pa.Table:
        b = Block(rows, shards)
        b.learn(answers)
        found = b.score(answers, total, prior)
        columns = {"_row": rows["_row"], "text": rows["text"]} | {c: pa.array(x) for c, x in found.items()}
        return pa.table(columns)

    words = rows.groupBy("block").applyInArrow(ask_words, REQUEST).groupBy("shard").applyInArrow(answer_words, ANSWER)
    pairs = rows.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(ask_pairs, REQUEST)
    pairs = pairs.groupBy("shard").applyInArrow(answer_pairs(prior), ANSWER)
    answers = words.unionByName(pairs).groupBy("block")
    scored = rows.groupBy("block").cogroup(answers).applyInArrow(add_up, result)
    kept = [F.col("text").alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns if c not in added]
    return scored.withColumn("train_tokens", F.lit(n).cast("bigint")).select(*kept, *added)


@query("op3_lm_scoring")
def op3_lm_scoring(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 1)
    scored = score_texts(docs.withColumn("held_out", out), ~out & F.col("doc_id").isNotNull())
    return scored.drop("text")
