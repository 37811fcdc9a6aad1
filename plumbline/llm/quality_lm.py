"""Quality by perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

Training: every labelled good document has a part. A fifth of them, by hash of the id, is held out for the
thresholds at every size; texts of all others, whole, teach the model. Counts, continuation counts, discounts
and the interpolated probabilities of all orders are tables sharded by n-gram, joined on contexts and suffixes.

Scoring: nothing of the model is held whole anywhere, as it grows with the corpus. Texts form blocks of about
equal size by hash, n-grams belong to shards by hash of their key. Every block sends its distinct n-grams of
three, two and one words to their shards as sorted arrays, a shard answers with the probability of the n-gram
and the weight of the context that it knows, and the block scores its texts by the part of the model that it
asked for. A frequent n-gram is one entry per block, so no shard gets hot. A token takes the probability of the
longest known n-gram, or the interpolation weights of the longer contexts times a shorter one's. A text's perplexity
is compared with a quantile of its language: the `quantile` of the perplexities of all trusted
documents of the language that are held out. Above it a document is not kept.

Defined results: a null text is the empty text; a text without words has one token, its end, and is not
kept. A null language is a language of its own. Where a language has no held-out document, no threshold is known and only texts without words are not kept. Labels with nulls, and labels of
unknown documents, are ignored; repeated rows count as often as they occur. Without trusted text every
token is equally unlikely. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.base import carried, partitions_for, query, slices, table
from plumbline.llm.lm_scoring import squeeze, unsqueeze
from plumbline.llm.paragraphs import MIX, scramble
from plumbline.llm.words import BEGIN, Words
from plumbline.operators.joins import join_sized
from plumbline.session import pinned


@dataclass(frozen=True)
class KneserNey:
    """sample_docs: trusted documents that teach, about, for a caller who wants a smaller model; None: all of them.
    quantile: of trusted perplexities, the threshold. held_out: one trusted document in so many is for the
    thresholds. block_bytes: text of a block."""

    sample_docs: int | None = None
    held_out: int = 5
    quantile: float = 0.98
    language: str = "lang"
    block_bytes: int = 8 << 20


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, c, begin): each token with the two before it, BEGIN where there are none."""
    known, code, begin = Words(texts).framed()
    word = known[code]
    sizes = np.diff(np.append(begin, len(code)))
    inside = np.ones(len(code), bool)
    inside[begin] = False
    at = np.flatnonzero(inside)
    b = word[at - 1]
    a = np.where(b == BEGIN, BEGIN, word[np.maximum(at - 2, 0)])
    return a, b, word[at], np.cumsum(sizes - 1) - (sizes - 1)


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return scramble(scramble(a) * MIX + b)


def count_trigrams(texts: DataFrame) -> DataFrame:
    """(a, b, c, n) over a table with a column text."""

    def count(batches):
        for batch in slices(batches, 0, 8 << 20):
            a, b, c, _ = trigrams(batch.column(0))
            key, first, n = np.unique(pair_key(pair_key(a, b), c), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[first].view(np.int64)) for x in (a, b, c)), pa.array(n)], ["a", "b", "c", "n"])

    return texts.select("text").mapInArrow(count, "a bigint, b bigint, c bigint, n bigint").groupBy("a", "b", "c").agg(F.sum("n").alias("n"))


def _discounts(grams: DataFrame) -> Column:
    """The discount of a count n in a table of counts, from how many n-grams occur one to four times."""
    few = grams.agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (max(x or 0, 1) for x in few)
    y = n1 / (n1 + 2 * n2)
    d1, d2, d3 = (min(max(k - (k + 1) * y * after / at, 0.1), k - 0.1) for k, at, after in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))
    return F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)


def _interpolate(grams: DataFrame, context: list[str], shorter: DataFrame, suffix: list[str]) -> tuple[DataFrame, DataFrame]:
    """(n-grams with p, contexts with weight): p = (n - D(n)) / total + weight * p of the suffix."""
    d = _discounts(grams)
    contexts = grams.groupBy(*context).agg(F.sum("n").alias("total"), F.sum(d).alias("freed"))
    contexts = contexts.select(*context, "total", (F.col("freed") / F.col("total")).alias("weight"))
    joined = grams.join(contexts, context).join(shorter.select(*suffix, F.col("p").alias("q")), suffix)
    p = (F.col("n") - d) / F.col("total") + F.col("weight") * F.col("q")
    return joined.select(*grams.columns, p.alias("p")), contexts.select(*context, "weight")


def probabilities(three: DataFrame) -> tuple[list[tuple[DataFrame, list[str], str]], float]:
    """The model's tables with their key columns and value, longest order first: n-grams and contexts of
    three, two and one words; and the probability of an unknown word. `three` is (a, b, c, n)."""
    three = pinned(three, "trigrams")
    two = pinned(three.groupBy("b", "c").agg(F.count(F.lit(1)).alias("n")), "bigrams")
    one = pinned(two.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "unigrams")
    d = _discounts(one)
    total, freed, words = one.agg(F.sum("n"), F.sum(d), F.count(F.lit(1))).first()
    unknown = (freed / total if total else 1.0) / (words + 1)
    p1 = one.withColumn("p", (F.col("n") - d) / F.lit(float(total or 1)) + F.lit(unknown))
    p2, w2 = _interpolate(two, ["b"], p1, ["c"])
    p2 = pinned(p2, "bigram-probabilities")
    p3, w3 = _interpolate(three, ["a", "b"], p2, ["b", "c"])
    tables = [(p3, ["a", "b", "c"], "p"), (w3, ["a", "b"], "weight"), (p2, ["b", "c"], "p"), (w2, ["b"], "weight"), (p1, ["c"], "p")]
    return tables, unknown


class Model:
    """The tables of `probabilities` as sorted keys with log10 values."""

    def __init__(self, arrays: list[tuple[np.ndarray, np.ndarray]], unknown: float):
        self.arrays, self.unknown = arrays, float(np.log10(unknown))

    def _value(self, which: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, values = self.arrays[which]
        if not len(keys):
            return np.zeros(len(key), bool), np.zeros(len(key))
        i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        found = keys[i] == key
        return found, np.where(found, values[i], 0.0)

    def log10(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log10 P(c | a b) of every token."""
        out = np.zeros(len(c))
        left = np.arange(len(c))
        ab, bc = pair_key(a, b), pair_key(b, c)
        for grams, contexts, gram, context in ((0, 1, pair_key(ab, c), ab), (2, 3, bc, b)):
            found, value = self._value(grams, gram[left])
            out[left] += value
            left = left[~found]
            out[left] += self._value(contexts, context[left])[1]
        found, value = self._value(4, c[left])
        out[left] += np.where(found, value, self.unknown)
        return out


def _folded(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(key of the n-gram, log10 of its value) of rows with the words of an n-gram and a value."""
    key, *rest = (batch.column(i).to_numpy().view(np.uint64) for i in range(batch.num_columns - 1))
    for k in rest:
        key = pair_key(key, k)
    return key, np.log10(batch.column(batch.num_columns - 1).to_numpy()).astype(np.float32)


def _gather(df: DataFrame, keys: list[str], value: str) -> tuple[np.ndarray, np.ndarray]:
    """A table of a model of a few texts, whole."""

    def fold(batches):
        for batch in batches:
            key, log = _folded(batch)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(log)], ["key", "value"])

    rows = df.select(*keys, value).mapInArrow(fold, "key bigint, value float").toArrow()
    key, log = rows["key"].to_numpy().view(np.uint64), rows["value"].to_numpy()
    order = np.argsort(key)
    return key[order], log[order]


GRAMS, CONTEXTS = ("g1", "g2", "g3"), ("w1", "w2")  # probabilities of n-grams, weights of contexts, by words
ENTRIES = "shard bigint, part string, keys binary, vals binary"
REQUEST = "shard bigint, block bigint, k1 binary, k2 binary, k3 binary"
ANSWER = "block bigint, shard bigint, g1 binary, g2 binary, g3 binary, w1 binary, w2 binary"
UNKNOWN = np.float32(np.nan)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.table({n: pa.array(c, kinds[t]) for c, (n, t) in zip(columns, fields)})


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted and each once; a plain sort takes a tenth of the time of np.unique."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def shard_ends(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's keys begin among sorted ones, and the end: a shard is a range of keys."""
    shard = ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    return np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))


def pack_keys(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return unsqueeze(data).cumsum(dtype=np.uint64)


def pack_values(values: np.ndarray) -> bytes:
    return squeeze(values.astype(np.float32).view(np.uint32))


def unpack_values(data: bytes) -> np.ndarray:
    return unsqueeze(data).astype(np.uint32).view(np.float32)


def sharded(tables: list[tuple[DataFrame, list[str], str]], shards: int, rows: int = 1 << 20) -> DataFrame:
    """The tables of `probabilities` as ENTRIES: sorted keys and values by shard, from about `rows` rows each."""

    def send(part: str):
        def packed(held):
            key, value = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(key)
            key, value = key[order], value[order]
            end = shard_ends(key, shards)
            own = [(s, slice(end[s], end[s + 1])) for s in range(shards) if end[s] < end[s + 1]]
            return _table([(s, part, pack_keys(key[at]), pack_values(value[at])) for s, at in own], ENTRIES).to_batches()

        def run(batches):
            held, n = [], 0
            for batch in batches:
                held.append(_folded(batch))
                n += batch.num_rows
                if n >= rows:
                    yield from packed(held)
                    held, n = [], 0
            if n:
                yield from packed(held)

        return run

    parts = []
    for df, keys, value in tables:
        part = (GRAMS if value == "p" else CONTEXTS)[len(keys) - 1]
        parts.append(df.select(*keys, value).mapInArrow(send(part), ENTRIES))
    return reduce(DataFrame.unionByName, parts)


def answer(asked: pa.Table, entries: pa.Table) -> pa.Table:
    """What a shard knows of the keys each block asks for."""
    known = {}
    for part in (*GRAMS, *CONTEXTS):
        own = [r for r in entries.to_pylist() if r["part"] == part]
        key = np.concatenate([np.zeros(0, np.uint64), *(unpack_keys(r["keys"]) for r in own)])
        value = np.concatenate([np.zeros(0, np.float32), *(unpack_values(r["vals"]) for r in own)])
        order = np.argsort(key)
        # one more entry, so that there is always a place to look at
        known[part] = np.append(key[order], np.uint64(0)), np.append(value[order], UNKNOWN)

    def found(part: str, key: np.ndarray) -> bytes:
        keys, values = known[part]
        at = np.searchsorted(keys[:-1], key)
        return pack_values(np.where(keys[at] == key, values[at], UNKNOWN))

    out = []
    for r in asked.to_pylist():
        key = {part: unpack_keys(r[f"k{part[1]}"]) for part in GRAMS}
        out.append((r["block"], r["shard"], *(found(part, key[f"g{part[1]}"]) for part in (*GRAMS, *CONTEXTS))))
    return _table(out, ANSWER)


class Block:
    """The texts of one block and the n-grams they ask for. What is sent is sorted and distinct, so the order of
    the rows does not matter."""

    def __init__(self, rows: pa.Table, shards: int):
        self.number, self.shards = rows["block"][0].as_py(), shards
        self.a, self.b, self.c, self.begin = trigrams(rows["text"].combine_chunks())
        ab, bc = pair_key(self.a, self.b), pair_key(self.b, self.c)
        self.keys = [distinct(x) for x in (np.concatenate([self.b, self.c]), np.concatenate([ab, bc]), pair_key(ab, self.c))]

    def asks(self) -> pa.Table:
        ends = [shard_ends(k, self.shards) for k in self.keys]
        own = [(s, [slice(e[s], e[s + 1]) for e in ends]) for s in range(self.shards) if any(e[s] < e[s + 1] for e in ends)]
        return _table([(s, self.number, *(pack_keys(k[at]) for k, at in zip(self.keys, places))) for s, places in own], REQUEST)

    def scores(self, answers: pa.Table, unknown: float) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, log10 of the probability) of every text."""
        rows = sorted(answers.to_pylist(), key=lambda r: r["shard"])

        def part(name: str) -> tuple[np.ndarray, np.ndarray]:
            values = np.concatenate([unpack_values(r[name]) for r in rows])
            found = ~np.isnan(values)
            return self.keys[int(name[1]) - 1][found], values[found]

        model = Model([part(name) for name in ("g3", "w2", "g2", "w1", "g1")], unknown)
        total = np.add.reduceat(model.log10(self.a, self.b, self.c), self.begin) if len(self.begin) else np.zeros(0)
        return np.diff(np.append(self.begin, len(self.c))), total


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the documents that are labelled good and not toxic."""
    return labels.where("doc_id is not null and quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").alias("_id")).distinct()


def train(docs: DataFrame, trusted: DataFrame, params: KneserNey) -> tuple[list[tuple[DataFrame, list[str], str]], float, Column]:
    """The tables of the model, the probability of an unknown word, and whether an id (column _id) is held out,
    given that it is trusted."""
    held = F.pmod(F.xxhash64("_id", F.lit("held out")), F.lit(params.held_out)) == 0
    drawn = ~held
    if params.sample_docs is not None:
        share = min(1.0, params.sample_docs / max(trusted.where(~held).count(), 1))
        drawn &= F.pmod(F.xxhash64("_id", F.lit("trusted")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    texts = join_sized(docs.select(F.col("doc_id").alias("_id"), "text"), pinned(trusted.where(drawn), "trusted"), "_id", ["text"])
    return *probabilities(count_trigrams(texts)), held


def perplexities(
    docs: DataFrame, tables: list[tuple[DataFrame, list[str], str]], unknown: float, params: KneserNey, keep: list[str], text: str = "text"
) -> DataFrame:
    """(_row, n_tokens, log10_prob): the columns to keep, and `_id` and `_lang`, of every document with the
    number of tokens and the probability of its text."""
    lang = F.coalesce(F.concat(F.lit("="), F.col("_row")[params.language].cast("string")), F.lit("null"))
    kept = F.struct(F.col("_row.doc_id").alias("_id"), lang.alias("_lang"), F.struct(*[F.col("_row")[c].alias(c) for c in keep]).alias("_row"))
    rows = carried(docs).select(kept.alias("_row"), F.coalesce(F.col("_row")[text], F.lit("")).alias("text"))
    shards = partitions_for(rows, "text", params.block_bytes)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("_row._id", "text"), F.lit(shards)))

    def ask(rows: pa.Table) -> pa.Table:
        return Block(rows, shards).asks()

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        n, total = Block(rows, shards).scores(answers, unknown)
        return pa.table({"_row": rows["_row"], "n_tokens": pa.array(n), "log10_prob": pa.array(total)})

    asked = rows.groupBy("block").applyInArrow(ask, REQUEST).groupBy("shard")
    answers = asked.cogroup(sharded(tables, shards).groupBy("shard")).applyInArrow(answer, ANSWER)
    result = T.StructType([rows.schema["_row"]]).add("n_tokens", "long").add("log10_prob", "double")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, result)


ADDED = ("n_tokens", "perplexity", "threshold", "kept")


def classify(docs: DataFrame, labels: DataFrame, params: KneserNey | None = None, keep: list[str] | None = None) -> DataFrame:
    """Add n_tokens, perplexity, threshold and kept to the columns to keep (all); columns of these names are
    replaced. What is kept is written once, as thresholds need all perplexities first."""
    params, keep = params or KneserNey(), [c for c in keep or docs.columns if c not in ADDED]
    trusted = pinned(trusted_ids(labels), "trusted-all")
    tables, unknown, held = train(docs, trusted, params)
    scored = perplexities(docs, tables, unknown, params, keep).select("_row.*", "n_tokens", "log10_prob")
    scored = scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_tokens")))
    scored = pinned(scored, "perplexities")
    judged_by = scored.select("_id", "_lang", "perplexity").join(trusted.where(held), "_id")
    limits = judged_by.groupBy("_lang").agg(F.percentile_approx("perplexity", params.quantile, 10000).alias("threshold"))
    out = join_sized(scored, pinned(limits, "perplexity-limits"), "_lang", ["_id"], "left")
    kept = (F.col("n_tokens") > 1) & (F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold")))
    return out.withColumn("kept", kept).select(*[F.col("_row")[c].alias(c) for c in keep], *ADDED)


@query("op2_quality_lm")
def op2_quality_lm(spark, folder):
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"), keep=["doc_id", "lang"])
