"""Connected components of a graph given by its edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import pinned

LOCAL_EDGES = 1_000_000  # edges that one task joins


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): for every node of the edges (a, b) the smallest node that it is connected to.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest
    neighbour (or itself), then every node links its smaller neighbours to the smallest one. Both keep
    the components, and the trees get flat in a logarithmic number of rounds. A step shuffles edges by
    one node and needs only the minimum of a node's neighbours, so a node with very many neighbours is
    a partial aggregate and a join that can be split, never a group in memory. Each round is written to
    the shared folder, so a lost executor costs at most a round.

    Edges that were counted and are at most LOCAL_EDGES, a few dozen megabytes, need no rounds: one task
    joins them. Both ways give the same components.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = pinned(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if e.count() <= LOCAL_EDGES:
        return _joined_in_a_task(e)
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # larger neighbours go to the smallest one
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # smaller neighbours, and the node itself, go to the smallest one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = pinned(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        after = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("u")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("u").alias("node"), F.col("u").alias("root"))
    )


def _joined_in_a_task(e: DataFrame) -> DataFrame:
    kind = e.schema["u"].dataType.simpleString()

    def join(batches):
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held)
        nodes = pa.chunked_array([*rows["u"].chunks, *rows["v"].chunks]).combine_chunks().dictionary_encode()
        order = pc.sort_indices(nodes.dictionary).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        code = place[nodes.indices.to_numpy()]
        node, root = spanning(code[: len(rows)], code[len(rows) :])
        roots = np.unique(root)
        names = nodes.dictionary.take(pa.array(order))
        for at, to in ((node, root), (roots, roots)):
            yield pa.RecordBatch.from_arrays([names.take(pa.array(at)), names.take(pa.array(to))], ["node", "root"])

    return e.coalesce(1).mapInArrow(join, f"node {kind}, root {kind}")


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the edges (a, b): each node and the smallest node of its component.

    For the edges one task holds: hook the roots of both ends together and halve the paths.
    """
    if not len(a):
        return a, b
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        low, high = np.minimum(parent[x], parent[y]), np.maximum(parent[x], parent[y])
        if (low == high).all():
            break
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    own = parent != np.arange(len(nodes))
    return nodes[own], nodes[parent[own]]
