"""Connected components over an edge table (operators H2-H4 and the grouping step of deduplication)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strataframe.plans.runtime import discard, materialize


#: Edges, of 16 bytes each, that one task may hold.
SMALL_EDGES = 4 << 20


def _write(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written once, with their number and a checksum taken on the way."""
    seen = Observation()
    table = materialize(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), "cc")
    return table, (seen.get["n"], seen.get["sum"])


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node of each of ``n`` nodes' components under edges of ``a`` with ``b``, by hooking roots on smaller neighbours' roots and halving paths, on whole arrays."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node but the roots with its component."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    u, v = (np.concatenate([b.column(i).to_numpy() for b in parts]) for i in (0, 1))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = roots(len(nodes), at[: len(u)], at[len(u) :])
    other = root != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(nodes[root[other]])], names=["u", "v"])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a partition as stars of what they connect, ``SMALL_EDGES`` or so at a time: fewer edges, and the same components."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= SMALL_EDGES:
            yield from _settle(iter(held))
            held = []
    yield from _settle(iter(held))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its smallest node.

    Each partition first turns its own edges into stars, which settles groups that lie in one
    partition. Then alternates the large-star and small-star rewrites, each one hash shuffle of at
    most the current edges, until an iteration leaves the edge set unchanged
    (a logarithmic number of rounds in practice). Every round is written to the
    shared folder, so a lost executor costs one round. Once at most ``SMALL_EDGES`` are
    left, which their count at that write says, one task settles them. Self-loops make singleton
    components; null ends are ignored; an empty input gives an empty result.
    """
    e = edges.select(F.col(src).cast("bigint").alias("u"), F.col(dst).cast("bigint").alias("v")).dropna()
    loops = e.filter("u = v").select(F.col("u").alias("node")).distinct()
    cur, sig = _write(e.filter("u <> v").mapInArrow(_forest, "u bigint, v bigint").distinct())
    while sig[0] > SMALL_EDGES:
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large-star: link each larger neighbour of u to the smallest of u's neighbourhood
        large = _star(both, larger=True)
        # small-star: link u's smaller neighbours, and u, to the smallest of them
        small = _star(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), larger=False)
        nxt, now = _write(small.distinct())
        discard(cur)
        cur = nxt
        if now == sig:
            break
        sig = now
    else:
        cur = cur.coalesce(1).mapInArrow(_settle, "u bigint, v bigint")
    named = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = cur.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    found = named.unionByName(roots)
    lone = loops.join(found, "node", "left_anti").withColumn("component", F.col("node"))
    return found.unionByName(lone)


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """One star rewrite by a minimum per node joined back on it; both sides share one shuffle key, so no node's list is gathered."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    j = pairs.join(low, "u")
    if larger:
        return j.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    moved = j.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.filter("u <> m").select("u", F.col("m").alias("v")))
