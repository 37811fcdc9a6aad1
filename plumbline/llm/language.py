"""Language identification by prediction by partial matching (PPM).

For every language a tree of byte contexts of 0 to `order` bytes counts which byte followed. A text's
code length in a language is the sum over its bytes: in the longest context, -log2(c / (n + u)) for a
byte seen c times there, n being the context's count and u its number of distinct bytes; a byte not seen
there costs an escape, -log2(u / (n + u)), and is coded in the context one byte shorter; a context never
seen costs nothing; below the empty context all 256 bytes are equal. Statistics are frozen, so a byte's
cost depends on its context only. The language with the shortest code wins.

The statistics come from a bounded sample of the labelled texts: pieces of `PIECE` characters, drawn by
hash, about `sample_chars` characters of each language. Its n-grams are counted on the executors and
collected as sorted arrays; their size follows languages x sample_chars, not the corpus. Texts are then
scored in one pass without a shuffle, whole, all languages at once.

Defined results: a null text, a text without a letter, and any text where no language was learned are
`und` with score 0. A null or unlabelled row teaches nothing. Equal code lengths go to the first name.
Repeated rows are scored alike. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.base import carried, query, shared_state, slices, table, unpacked
from plumbline.operators.joins import join_sized
from plumbline.session import pinned

PIECE = 4096  # characters of a piece of the sample
START = 10  # the byte that stands before a text


@dataclass(frozen=True)
class Ppm:
    """order: bytes of the longest context, at most 7. sample_chars: characters that teach a language, about."""

    order: int = 4
    sample_chars: int = 600_000


def windows(batch: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each with the `order` bytes before it in one word, and where each text begins
    (texts one after another)."""
    texts = [b"" if t is None else t for t in batch.cast(pa.binary()).to_pylist()]
    lead = bytes([START]) * order
    raw = np.frombuffer(b"".join(x for t in texts for x in (lead, t)), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    word = np.zeros(len(raw), np.uint64)
    for k in range(order, -1, -1):
        word <<= np.uint64(8)
        word[k:] |= raw[: len(raw) - k] if k else raw
    ends = np.cumsum(sizes + order)
    real = np.ones(len(raw), bool)
    for k in range(order):
        real[ends - sizes - 1 - k] = False
    return word[real], np.cumsum(sizes) - sizes


def low_bytes(word: np.ndarray, n: int) -> np.ndarray:
    return word & np.uint64((1 << (8 * n)) - 1)


class Model:
    """Per order the known n-grams (context and byte) with what they cost in every language, and the known
    contexts with what an escape costs. Built from rows (language, order, n-gram, count)."""

    def __init__(self, order: int, language: np.ndarray, at: np.ndarray, gram: np.ndarray, count: np.ndarray):
        self.order = order
        self.languages, number = np.unique(language.astype(str), return_inverse=True)
        self.grams, self.costs, self.contexts, self.escapes = [], [], [], []
        n_lang = len(self.languages)
        for k in range(order + 1):
            own = at == k
            g, c, lang = gram[own].astype(np.uint64), count[own].astype(float), number[own]
            known, place = np.unique(g, return_inverse=True)
            context, context_of = np.unique(g >> np.uint64(8), return_inverse=True)
            n, u = np.zeros((len(context), n_lang)), np.zeros((len(context), n_lang))
            np.add.at(n, (context_of, lang), c)
            np.add.at(u, (context_of, lang), 1)
            escape = np.where(u > 0, np.log2(np.maximum(n + u, 1)) - np.log2(np.maximum(u, 1)), 0.0)
            shorter = np.full((len(known), n_lang), 8.0)
            if k:
                shorter = self.costs[k - 1][np.searchsorted(self.grams[k - 1], low_bytes(known, k))]
            cost = escape[np.searchsorted(context, known >> np.uint64(8))] + shorter
            cost[place, lang] = np.log2((n + u)[context_of, lang]) - np.log2(c)
            self.grams.append(known)
            self.costs.append(cost)
            self.contexts.append(context)
            self.escapes.append(escape)

    def code_lengths(self, word: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        total = np.zeros((len(begin), len(self.languages)))
        text = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(word))))
        for k in range(self.order, -1, -1):
            if not len(word):
                return total
            seen = _find(self.grams[k], low_bytes(word, k + 1))
            _add(total, text[seen >= 0], self.costs[k], seen[seen >= 0])
            word, text = word[seen < 0], text[seen < 0]
            escaped = _find(self.contexts[k], low_bytes(word, k + 1) >> np.uint64(8))
            _add(total, text[escaped >= 0], self.escapes[k], escaped[escaped >= 0])
        np.add.at(total, text, 8.0)
        return total


def _find(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted value stands, -1 if it does not."""
    if not len(known):
        return np.full(len(wanted), -1)
    i = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[i] == wanted, i, -1)


def _add(total: np.ndarray, text: np.ndarray, values: np.ndarray, rows: np.ndarray) -> None:
    if len(text):
        first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        for lang in range(total.shape[1]):
            total[text[first], lang] += np.add.reduceat(values[:, lang][rows], first)


def is_drawn(piece: Column, doc_id: str, total: Column, params: Ppm) -> Column:
    """Whether a piece of a language of `total` characters teaches. A quotient, as the product of the totals of
    a large corpus and a hash leaves the range of a long."""
    slot = F.pmod(F.xxhash64(doc_id, piece), F.lit(1 << 30))
    return slot < F.lit(float(params.sample_chars) * (1 << 30)) / F.greatest(total, F.lit(1))


def sample(texts: DataFrame, params: Ppm) -> DataFrame:
    """(lang, piece): about sample_chars characters of each language, all of one that has less."""
    size = F.col("lang"), F.length("text").cast("bigint").alias("n")
    sizes = texts.select(*size).groupBy("lang").agg(F.sum("n").alias("total"))
    known = join_sized(texts, pinned(sizes, "language-sizes"), "lang", ["doc_id"])
    pieces = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int"))
    drawn = F.filter(pieces, lambda i: is_drawn(i, "doc_id", F.col("total"), params))
    cut = F.transform(drawn, lambda i: F.substring(F.col("text"), i * PIECE + 1, F.lit(PIECE)))
    return known.where(F.length("text") > 0).select("lang", F.explode(cut).alias("piece"))


def train(labelled: DataFrame, params: Ppm | None = None) -> Model:
    """Learn from (doc_id, text, lang) rows; those with a null text or lang are skipped."""
    params = params or Ppm()
    texts = labelled.where("text is not null and lang is not null").select("doc_id", F.lower("text").alias("text"), "lang")
    order = params.order

    def count(batches):
        for batch in slices(batches, 1):
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in set(langs.tolist()):
                word, _ = windows(batch.column(1).filter(pa.array(langs == lang)), order)
                for k in range(order + 1):
                    gram, n = np.unique(low_bytes(word, k + 1), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram)), pa.array(np.full(len(gram), k, np.int32)), pa.array(gram.view(np.int64)), pa.array(n)],
                        ["lang", "at", "gram", "n"],
                    )

    counted = sample(texts, params).mapInArrow(count, "lang string, at int, gram bigint, n bigint")
    rows = counted.groupBy("lang", "at", "gram").agg(F.sum("n").alias("n")).toArrow()
    columns = [rows[c].to_numpy() for c in ("lang", "at", "gram", "n")]
    return Model(order, columns[0], columns[1], columns[2].view(np.uint64), columns[3])


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred, score (the share of the best language if all were equally likely) and bits_per_byte;
    columns of these names are replaced."""
    shared = shared_state(docs.sparkSession, model)
    languages = len(model.languages)

    def score(batches):
        m = shared()
        names = np.append(m.languages.astype(object), "und")
        for batch in slices(batches, batch_text):
            texts = batch.column(batch_text)
            word, begin = windows(texts, m.order)
            size = np.diff(np.append(begin, len(word)))
            bits = m.code_lengths(word, begin)
            best = bits.argmin(axis=1)
            least = bits[np.arange(len(bits)), best]
            share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            letters = batch.column(batch_text + 1).to_numpy(zero_copy_only=False).astype(bool)
            pred = names[np.where(letters, best, languages)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(np.where(letters, share, 0.0)), pa.array(least / np.maximum(size, 1))],
                ["_kept", "lang_pred", "score", "bits_per_byte"],
            )

    batch_text = 1
    added = ("lang_pred", "score", "bits_per_byte")
    value = F.col("_row")[text]
    rows = carried(docs)
    if not languages:
        none = F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits_per_byte")
        return rows.select(*unpacked(docs, added), *none)
    letters = F.coalesce(F.rlike(value, F.lit(r"\p{L}")), F.lit(False))
    rows = rows.select("_row", F.lower(F.coalesce(value, F.lit(""))).alias("_text"), letters.alias("_letters"))
    kind = rows.schema["_row"].dataType.simpleString()
    out = rows.mapInArrow(score, f"_kept {kind}, lang_pred string, score double, bits_per_byte double")
    return out.withColumnRenamed("_kept", "_row").select(*unpacked(docs, added), *added)


def held_out(doc_id: Column, fold: int = 0) -> Column:
    """Whether a document stays out of training: crc32 of its id as text, modulo 5. Null ids do not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == fold, F.lit(False))


@query("op1_language")
def op1_language(spark, folder):
    docs = table(spark, folder, "documents")
    model = train(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    texts = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return identify(texts, model).drop("text")
