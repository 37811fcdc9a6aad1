"""Near duplicates by SimHash: fingerprints, pigeonhole blocks, verified links, components.

A text's fingerprint has a bit set where more than half of its shingle hashes have it. Fingerprints
link at `distance` or fewer differing bits. Only distinct fingerprints are compared, so copies cost
one row. The 64 bits are cut into distance + k blocks; two linked fingerprints agree in at least k of
them, so they meet in one of the tables keyed by k blocks. That loses no pair for any k; k follows the
number of fingerprints so that a key, of about 64k / (distance + k) bits, holds few of them.

In a table, fingerprints with one key stand together. Small runs are compared pair by pair, large ones
(a group of very many near copies shares most of its bits) are cut by the same principle on the bits
outside the key, again and again, which is exact at every size. A task hands on a spanning star per
component instead of all its pairs. The stars of all tables are joined to components.

Defined results: a null or blank text has no shingle and fingerprint zero, and is linked like any
other. Repeated rows get one row each, with the same component. A null id takes part in links and
gets a row, but is never the smallest id of a component unless it holds only nulls. An empty table
gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.base import carried, query, table, unpacked
from plumbline.llm.components import components, spanning
from plumbline.session import pinned

SEED = 42
RUN = 64  # fingerprints of one key that are compared pair by pair


def text_fingerprint(text: str | None, words: int) -> int:
    """The fingerprint of one text, unsigned."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and blanks only
    if not tokens:
        return 0
    if len(tokens) <= words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(tokens), SEED)]
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = [digest(join(s), SEED) for s in zip(*(tokens[i:] for i in range(words)))]
    n, ones = len(hashes), np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):  # a bounded number of bits at a time, however long the text
        part = np.array(hashes[i : i + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, into: str = "_fp") -> DataFrame:
    """Add the fingerprint of each text as a signed 64-bit column. No shuffle."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([text_fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn(into, of(F.col(text)))


def plan_blocks(n: int, distance: int) -> list[list[tuple[int, int]]]:
    """Tables as lists of (shift, width) blocks: the smallest k whose keys hold under 8 of n evenly spread values."""
    for k in range(1, 65 - distance):
        cuts = [round(64 * i / (distance + k)) for i in range(distance + k + 1)]
        blocks = [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]
        tables = [list(c) for c in combinations(blocks, k)]
        if n >> min(sum(w for _, w in t) for t in tables) < 8 or k >= 4:
            return tables
    raise ValueError("distance must be below 64")


def key_of(fp: np.ndarray, blocks: list[tuple[int, int]]) -> np.ndarray:
    key = np.zeros(len(fp), np.uint64)
    for shift, width in blocks:
        key = (key << np.uint64(width)) | ((fp >> np.uint64(shift)) & np.uint64((1 << width) - 1))
    return key


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return starts, np.diff(np.append(starts, len(key)))


def linked(fp: np.ndarray, group: np.ndarray, free: list[tuple[int, int]], distance: int) -> tuple[np.ndarray, np.ndarray]:
    """All links inside the groups, as stars. `free` are the bit ranges in which a group may differ."""
    order = np.argsort(group, kind="stable")
    fp, group = fp[order], group[order]
    starts, sizes = _runs(group)
    size_of = np.repeat(sizes, sizes)
    width = sum(w for _, w in free)
    small = (size_of <= RUN) | (width <= distance + 1)
    left, right = [], []
    f, g = fp[small], group[small]
    for step in range(1, int(sizes[(sizes <= RUN) | (width <= distance + 1)].max(initial=1))):
        same = g[step:] == g[:-step]
        if not same.any():
            break
        x, y = f[step:][same], f[:-step][same]
        near = np.bitwise_count(x ^ y) <= distance
        left.append(x[near])
        right.append(y[near])
    if not small.all():
        f, g = fp[~small], group[~small]
        names = np.unique(g, return_inverse=True)[1].astype(np.uint64)
        # cut the free bits into distance + 1 blocks; a linked pair agrees in at least one of them
        bits = [s + i for s, w in free for i in range(w)]
        cuts = [round(len(bits) * i / (distance + 1)) for i in range(distance + 2)]
        for lo, hi in zip(cuts, cuts[1:]):
            part = [(b, 1) for b in bits[lo:hi]]
            value = np.unique(key_of(f, part), return_inverse=True)[1].astype(np.uint64)
            a, b = linked(f, names << np.uint64(32) | value, [(b, 1) for b in bits[:lo] + bits[hi:]], distance)
            left.append(a)
            right.append(b)
    if not left:
        return fp[:0], fp[:0]
    return spanning(np.concatenate(left), np.concatenate(right))


def fingerprint_links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b): links that connect what all pairs within `distance` connect. `distinct` has column fp."""
    tables = plan_blocks(distinct.count(), distance)

    def keyed(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for number, blocks in enumerate(tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), number, np.int32)), pa.array(key_of(fp, blocks).view(np.int64)), batch.column(0)],
                    ["table", "key", "fp"],
                )

    def compared(batches):
        if not (held := list(batches)):  # 20 bytes for each of one partition's rows
            return
        rows = pa.Table.from_batches(held)
        number, key = rows["table"].to_numpy(), rows["key"].to_numpy()
        fp = rows["fp"].to_numpy().view(np.uint64)
        for t in np.unique(number):
            own = number == t
            group = np.unique(key[own], return_inverse=True)[1].astype(np.uint64)
            used = set(tables[t])
            every = {b for blocks in tables for b in blocks}
            a, b = linked(fp[own], group, sorted(every - used), distance)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    spread = distinct.mapInArrow(keyed, "table int, key bigint, fp bigint")
    parts = max(distinct.sparkSession.sparkContext.defaultParallelism, int(spread.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.repartition(parts, "table", "key").mapInArrow(compared, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, distance: int = 3, words: int = 3, text: str = "text") -> DataFrame:
    """(_id, _fp, _component, _root) per row: its id, fingerprint, a fingerprint that names its component, and
    the smallest id of the component."""
    prints = pinned(fingerprints(docs.select(F.col("doc_id").alias("_id"), text), text, words).select("_id", "_fp"), "simhash")
    least = pinned(prints.groupBy(F.col("_fp").alias("fp")).agg(F.min("_id").alias("least")), "simhash-distinct")
    tree = components(fingerprint_links(least.select("fp"), distance), "a", "b")
    joined = least.join(tree, least.fp == tree.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    roots = joined.groupBy("root").agg(F.min("least").alias("_root"))
    named = joined.join(roots, "root").select(F.col("fp").alias("_fp"), F.col("root").alias("_component"), "_root")
    return prints.join(named, "_fp").select("_id", "_fp", "_component", "_root")


def one_of_each(docs: DataFrame, distance: int = 3, words: int = 3, text: str = "text") -> DataFrame:
    """One row of each component: that with the smallest id (nulls last), then the smallest fingerprint."""
    place = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("_stays"), F.col("_fp").alias("_stays_fp"))
    groups = near_duplicates(docs, distance, words, text).groupBy("_component").agg(F.min(place).alias("first"))
    stays = pinned(groups.select("first._stays", "first._stays_fp"), "simhash-stays")
    marked = fingerprints(carried(docs), f"_row.{text}", words)
    on = F.col("_row.doc_id").eqNullSafe(F.col("_stays")) & (F.col("_fp") == F.col("_stays_fp"))
    one = marked.join(stays, on).dropDuplicates(["_stays", "_stays_fp"])
    return one.select(*unpacked(docs))


@query("op10_simhash")
def op10_simhash(spark, folder):
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select(
        F.col("_id").alias("doc_id"),
        F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
        F.col("_root").alias("component_id"),
    )
