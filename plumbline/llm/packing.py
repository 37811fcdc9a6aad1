"""Best-fit-decreasing packing of tokenised texts into sequences of a fixed capacity.

Best-fit decreasing sees only lengths, and a length is one of `capacity` values, so the whole packing
follows from how many pieces have each length. The pieces are tokenised and counted in parallel; the
histogram (at most `capacity` rows, whatever the size of the corpus) is packed once: open sequences
are kept as ranges by the room that is left, a segment tree over the rooms finds the tightest that
fits in logarithmic time, and a whole range of sequences is filled in one step. That gives the very
packing that best-fit decreasing makes piece by piece, as a few thousand runs "pieces number r to
r + n of length l go to sequences from s on at offset o". Every piece then finds its place by its
number among the pieces of its length: a count per task and length, summed up over the tasks.

Defined results: a null or empty text is its end token alone. Only texts above the capacity are cut;
all their pieces are full but the first, which takes the rest. Repeated rows and null ids are packed
like any others. An empty table gives an empty result. Literal special tokens in a text are treated as
the tokenizer treats them.
"""

from __future__ import annotations

import base64
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.base import query, table
from plumbline.session import pinned

END = 2
CAPACITY = 1024


@dataclass(frozen=True)
class Tokenizer:
    """Files of one byte-level BPE vocabulary: for `tokenizers`, and as ranks for `tiktoken`, which gives the
    same ids several times faster. Without ranks, and for texts that hold a special token, the former is used."""

    file: str
    ranks: str | None = None
    pattern: str | None = None

    def load(self):
        """A function from a text to its ids. Called once per task."""
        import tokenizers

        exact = tokenizers.Tokenizer.from_file(self.file)
        special = [t.content for t in exact.get_added_tokens_decoder().values()]
        slow = lambda text: exact.encode(text, add_special_tokens=False).ids
        if not self.ranks:
            return slow
        import tiktoken

        with open(self.ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda text: slow(text) if any(s in text for s in special) else fast.encode_ordinary(text)


def public_tokenizer() -> Tokenizer:
    import public_tokenizers as public

    return Tokenizer(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task string, number bigint"


def cut(docs: DataFrame, tokenizer: Tokenizer, capacity: int = CAPACITY, end: int = END, text: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document, a checksum of its ids, and its number among the
    pieces of its length that this task has made. One pass over the texts, no shuffle."""

    def pieces(batches):
        encode, made = tokenizer.load(), np.zeros(capacity + 1, np.int64)
        task = f"{TaskContext.get().partitionId()}"
        for batch in batches:
            out = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(value.as_py() or "")
                ids = np.fromiter((*ids, end), dtype="<u4", count=len(ids) + 1)
                first = (len(ids) - 1) % capacity + 1
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
                    out.append((doc, k, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes()), task, made[hi - lo]))
                    made[hi - lo] += 1
            if out:
                columns = list(zip(*out))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in PIECES.split(", ")]
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text).mapInArrow(pieces, PIECES)


class _Rooms:
    """Which rooms (1 to capacity) have open sequences: a segment tree of counts."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)

    def add(self, room: int, ranges: int) -> None:
        i = room + self.size
        while i:
            self.tree[i] += ranges
            i //= 2

    def tightest(self, room: int) -> int | None:
        """The smallest occupied room of at least `room`."""
        i = room + self.size
        if self.tree[i]:
            return room
        while i > 1:
            if i % 2 == 0 and self.tree[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return None
        while i < self.size:
            i = 2 * i if self.tree[2 * i] else 2 * i + 1
        return i - self.size


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first piece, pieces, first sequence, pieces per sequence, offset) of the best-fit-decreasing packing.

    Among equally tight sequences the one that got its room last comes first. A piece of the same length
    goes on into the sequence just filled while it fits, since that one is the tightest then.
    """
    rooms, open_ranges, runs = _Rooms(capacity), {}, []
    fresh = 0
    for length in sorted(histogram, reverse=True):
        left, done = histogram[length], 0
        while left:
            room = rooms.tightest(length)
            if room is None:
                each = capacity // length
                first, sequences, room = fresh, -(-left // each), capacity
                fresh += sequences
            else:
                first, sequences = open_ranges[room].pop()
                rooms.add(room, -1)
                each = room // length
            used = min(sequences, -(-left // each))
            placed = min(left, used * each)
            runs.append((length, done, placed, first, each, capacity - room))
            last = placed - (used - 1) * each  # the last sequence may take fewer
            for start, n, took in ((first, used - (last < each), each), (first + used - 1, int(last < each), last), (first + used, sequences - used, 0)):
                rest = room - took * length
                if n and rest:
                    open_ranges.setdefault(rest, []).append((start, n))
                    rooms.add(rest, 1)
            left, done = left - placed, done + placed
    return runs


def pack(docs: DataFrame, tokenizer: Tokenizer, capacity: int = CAPACITY, end: int = END, text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = pinned(cut(docs, tokenizer, capacity, end, text), "pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = pinned(per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    histogram = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(best_fit(histogram, capacity), dtype=np.int64).reshape(-1, 6)
    # pieces by (length, number) in one ascending key; numbers stay below 2^50
    shift = 50
    key = (runs[:, 0] << shift) + runs[:, 1]
    order = np.argsort(key)
    key, runs = key[order], runs[order]

    def places(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            length, number = rows["length"].to_numpy(), rows["number"].to_numpy()
            run = runs[np.searchsorted(key, (length << shift) + number, side="right") - 1]
            nth = number - run[:, 1]
            sequence = pa.array(run[:, 3] + nth // run[:, 4])
            offset = pa.array(run[:, 5] + nth % run[:, 4] * length)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, sequence, offset], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    numbered = pieces.join(per_task.drop("n"), ["task", "length"]).withColumn("number", F.col("number") + F.col("before"))
    return numbered.drop("task", "before").mapInArrow(
        places, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )


@query("op9_packing")
def op9_packing(spark, folder):
    return pack(table(spark, folder, "documents"), public_tokenizer())
