"""Spelling variants: words that differ by one inserted, deleted or replaced letter, grouped under the most
frequent one.

Near words agree on everything outside the place of the edit, so a window of places, with the letters
before and after it as key, brings them together: the halves of a word are two such windows. A window is
taken for the length of the shorter word, so a word has windows for its own length and for one less. Windows
whose key has too many words are halved, again and again, until their keys hold few words or the window
is one place; then the words of a key differ in at most two letters. So no group grows with the data, no
pair is lost, and a pair is counted only in the window of its first difference.

A task takes sorted runs of keys and cuts them into blocks of words. The matrix of letter counts times its
transpose gives the squared distances of all words of a block: 2 for a replaced letter, 1 for an
inserted one. Pairs at such a distance whose lengths fit are verified letter by letter. What leaves a
task is a row per word: how many near words it has there, and the most frequent one.

Defined results: a null text has no words, a null id counts as an empty one. Repeated rows count again.
Of near words with equal counts the first in code-point order is the form. An empty table gives an
empty result; other columns are not looked at. A very long text is read in slices cut between words;
a very long word is one row.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.base import query, table
from plumbline.operators.joins import join_sized, skew_safe_join
from plumbline.session import pinned

LETTERS = "A-Za-zÀ-ÿ"
DROPPED = 31  # a run whose hash this divides loses a letter
LEAST_LETTERS, LEAST_COUNT = 7, 2
COMMONER = 10  # times as frequent as a word its form is, at least
GROUP = 1024  # words of one key that are compared as they are
BLOCK = 512  # words of several keys in one matrix
HELD = 200_000  # words whose counts a task holds before it hands them on
PAIR_BYTES = 8 << 20  # letters of pairs that are verified at once


def word_counts(docs: DataFrame, text: str = "text", id: str = "doc_id", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the runs of letters of all texts, some with a letter dropped by hash. Counts are summed
    in the task first, then by word."""
    run = re.compile(f"[{LETTERS}]{{{least_letters},}}")  # a shorter run cannot give a word

    def count(batches):
        held: Counter = Counter()

        def handed():
            rows = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return rows

        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                if not (t := t.as_py()):
                    continue
                seed = zlib.crc32(f"{'' if i.as_py() is None else i.as_py()}:".encode())
                for found in run.finditer(t.encode("utf-8", "replace").lower().decode()):  # bytes: only A-Z change
                    word = found[0]
                    h = zlib.crc32(word.encode(), seed)
                    if h % DROPPED == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_letters:
                            continue
                    held[word] += 1
                if len(held) >= HELD:
                    yield handed()
        if held:
            yield handed()

    counted = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ------------------------------------------------------------------ windows


def _keyed(rows: DataFrame, windows: Column) -> DataFrame:
    """A row per window struct(size, lo, hi) of a word, with the hash of what the window leaves."""
    w = rows.select("word", "n", F.inline(windows))
    after = F.greatest(F.col("size") - F.col("hi"), F.lit(0))
    before_text = F.substring("word", F.lit(1), F.col("lo"))
    after_text = F.substring("word", F.length("word") - after + 1, after)
    return w.withColumn("key", F.xxhash64("size", "lo", "hi", before_text, after_text))


def _halves(size: Column, lo: Column, hi: Column) -> list[Column]:
    middle = F.floor((lo + hi) / 2).cast("int")
    return [F.struct(size.alias("size"), a.alias("lo"), b.alias("hi")) for a, b in ((lo, middle), (middle, hi))]


def window_rows(words: DataFrame, least_letters: int = LEAST_LETTERS, group: int = GROUP) -> DataFrame:
    """(word, n, size, lo, hi, key): the windows in which a word may meet near words. `size` is the length
    of the shorter word, the places lo to hi - 1 are where the words may differ first."""
    length = F.length("word")
    first = F.concat(*[
        F.when(size >= least_letters, F.array(*_halves(size, F.lit(0), size + 1))).otherwise(F.array())
        for size in (length, length - 1)
    ])
    rows = pinned(_keyed(words, first), "windows")
    done = None
    while True:
        crowded = rows.where("hi - lo > 1").groupBy("key").agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > group).select("key", F.lit(True).alias("_crowded"))
        crowded = pinned(crowded, "crowded")
        if crowded.isEmpty():
            return rows if done is None else done.unionByName(rows)
        # a window of one place may share its key with no wider one: the bounds are part of the key
        marked = join_sized(rows, crowded, "key", spread=["word"], how="left")
        few = marked.where(F.col("_crowded").isNull()).drop("_crowded")
        done = few if done is None else done.unionByName(few)
        halves = F.array(*_halves(F.col("size"), F.col("lo"), F.col("hi")))
        many = marked.where(F.col("_crowded")).select("word", "n", halves.alias("_halves"))
        rows = pinned(_keyed(many, F.col("_halves")), "windows")


# ------------------------------------------------------------------ blocks of words in a task


def letter_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of words as bytes, a row per word filled with zeros, and the lengths."""
    raw = [w.encode("latin-1") for w in words]
    length = np.array([len(r) for r in raw], np.int64)
    out = np.zeros((len(raw), int(length.max(initial=0)) + 1), np.uint8)
    for i, r in enumerate(raw):
        out[i, : len(r)] = np.frombuffer(r, np.uint8)
    return out, length


def letter_counts(letters: np.ndarray, length: np.ndarray) -> np.ndarray:
    """How often each letter that occurs stands in each word."""
    used, code = np.unique(letters, return_inverse=True)
    code = code.reshape(letters.shape)
    flat = (np.arange(len(letters))[:, None] * len(used) + code).ravel()
    counts = np.bincount(flat, minlength=len(letters) * len(used)).reshape(len(letters), len(used))
    return counts[:, used != 0].astype(np.float32 if length.max(initial=0) < 2048 else np.float64)  # exact either way


def squared_distances(some: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The squared distances of some rows of counts to all: one matrix product."""
    return (some * some).sum(axis=1)[:, None] + (counts * counts).sum(axis=1)[None, :] - 2 * (some @ counts.T)


def one_edit(letters: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether word a becomes word b, as long or one longer, by one edit, and the place where they first differ."""
    ok, first = np.zeros(len(a), bool), np.zeros(len(a), np.int64)
    step = max(1, PAIR_BYTES // letters.shape[1])
    for i in range(0, len(a), step):
        x, y = letters[a[i : i + step]], letters[b[i : i + step]]
        differ = x != y
        at = differ.argmax(axis=1)  # of different words there is one
        longer = length[b[i : i + step]] > length[a[i : i + step]]
        replaced = ~longer & (differ.sum(axis=1) == 1)
        # an inserted letter: from there on b is a, one place on
        shifted = (x[:, :-1] != y[:, 1:]) & (np.arange(x.shape[1] - 1) >= at[:, None])
        ok[i : i + step] = replaced | longer & ~shifted.any(axis=1)
        first[i : i + step] = at
    return ok, first


def near_in_block(words: list[str], group: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of near words of one block, by place. Words meet if their group and window are the same."""
    letters, length = letter_matrix(words)
    counts = letter_counts(letters, length)
    found = []
    for top in range(0, len(words), GROUP):
        distance = squared_distances(counts[top : top + GROUP], counts)
        a, b = np.nonzero((distance <= 2) & (group[top : top + GROUP, None] == group[None, :]))
        far, a = distance[a, b], a + top
        fits = (length[a] == size[a]) & (np.where(length[b] == size[a], 2, 1) == far) & ((length[b] > length[a]) | (a < b))
        fits &= (size[a] == size[b]) & (lo[a] == lo[b]) & (hi[a] == hi[b])
        a, b = a[fits], b[fits]
        ok, first = one_edit(letters, length, a, b)
        ok &= (first >= lo[a]) & (first < hi[a])
        found.append((a[ok], b[ok]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _blocks(key: np.ndarray, most: int):
    """Ranges of whole runs of equal keys, of up to `most` rows unless one run has more. Runs of one row
    have nothing to meet."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    ends = np.append(starts[1:], len(key))
    real = ends - starts > 1
    rows: list[np.ndarray] = []
    held = 0
    for s, e in zip(starts[real], ends[real]):
        if held and held + e - s > most:
            yield np.concatenate(rows)
            rows, held = [], 0
        rows.append(np.arange(s, e))
        held += e - s
    if held:
        yield np.concatenate(rows)


def near_counts(rows: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): for each word that has near words how many, and the most frequent of them."""

    def compare(batches):
        def compared(t: pa.Table):
            key, n = t["key"].to_numpy(), t["n"].to_numpy()
            size, lo, hi = (t[c].to_numpy() for c in ("size", "lo", "hi"))
            for at in _blocks(key, BLOCK):
                words = t["word"].take(pa.array(at)).to_pylist()
                a, b = near_in_block(words, key[at], size[at], lo[at], hi[at])
                if not len(a):
                    continue
                word, other = np.concatenate([a, b]), np.concatenate([b, a])
                texts = np.array(words, object)
                place = np.argsort(np.argsort(texts, kind="stable"), kind="stable")  # code-point order
                best = np.lexsort((place[other], -n[at][other], word))
                word, other = word[best], other[best]
                first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                count = np.diff(np.append(first, len(word)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts[word[first]], pa.string()), pa.array(count), pa.array(n[at][other[first]]), pa.array(texts[other[first]], pa.string())],
                    ["word", "n_near", "form_n", "form"],
                )

        held: list[pa.RecordBatch] = []  # the rows of the last key may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            key = batch.column("key").to_numpy()
            last = int(np.searchsorted(key, key[-1]))
            if last == 0 and len(held) > 1 and held[-2].column("key")[-1].as_py() == key[0]:
                continue
            yield from compared(pa.Table.from_batches([*held[:-1], batch.slice(0, last)]))
            held = [batch.slice(last)]
        if held:
            yield from compared(pa.Table.from_batches(held))

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(max(parts, rows.sparkSession.sparkContext.defaultParallelism), "key").sortWithinPartitions("key")
    found = dealt.mapInArrow(compare, "word string, n_near bigint, form_n bigint, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")
    )


# ------------------------------------------------------------------ forms and roots


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms are followed to the last. A form is far more frequent than its word,
    so chains are short and end; each round doubles the steps taken."""
    at = pinned(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = skew_safe_join(at, onward, "root", spread=["word"], how="left")
        moved = pinned(moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        at = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            return at


def variants(docs: DataFrame, text: str = "text", id: str = "doc_id", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, commoner: int = COMMONER, group: int = GROUP) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of the texts."""
    words = pinned(word_counts(docs, text, id, least_letters, least_count), "words")
    near = near_counts(window_rows(words, least_letters, group))
    common = F.col("form_n") >= commoner * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(common, F.col("form")).alias("form"), F.when(common, F.col("form_n")).alias("form_n"),
    )
    joined = pinned(joined, "forms")
    found = joined.join(roots(joined.where(F.col("form").isNotNull())), "word", "left")
    return found.withColumn("root", F.coalesce("root", "word"))


@query("op13_spelling")
def op13_spelling(spark, folder):
    return variants(table(spark, folder, "documents")).select("word", "form", "root", "n", "n_near", "form_n")
