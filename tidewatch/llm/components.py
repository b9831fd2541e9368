"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.frames import stored

#: links contracted inside one task
TASK_LINKS = 1_000_000
LINK = pa.schema([("u", pa.int64()), ("r", pa.int64())])


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of the links a - b, by repeated
    minimum over links and pointer jumping."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = code[:len(a)], code[len(a):]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        if (rx == ry).all():
            return nodes, nodes[root]
        low = np.minimum(rx, ry)
        np.minimum.at(root, rx, low)
        np.minimum.at(root, ry, low)
        while (root[root] != root).any():
            root = root[root]


def _contract(batches):
    """Links of a partition, in bounded portions, to (node, root) rows; a root
    has a row of its own."""
    held, size = [], 0

    def flush():
        u, r = roots(*np.concatenate(held, axis=1))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(r)], schema=LINK)

    for b in batches:
        held.append(np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]))
        size += b.num_rows
        if size >= TASK_LINKS:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def connected_components(links: DataFrame, store=stored) -> DataFrame:
    """(node, component) for every node of links (a, b): component is the
    smallest node reachable, the node itself included.

    Tasks contract the links of their partition to stars, without a shuffle.
    Stars are then dealt by node to as few tasks as TASK_LINKS allows and
    contracted again; while that takes several tasks, each node keeps its
    smallest root, and its other roots link with that one in a smaller graph
    of roots, which goes the same way.  A graph that does not shrink is solved
    by alternating star steps.  Links with themselves keep a lone node in the
    result.  Every round's graph is a table in the shared folder, made by
    ``store``.
    """
    cur = links.select(F.col("a").alias("u"), F.col("b").alias("r"))
    cur = store(cur.mapInArrow(_contract, "u long, r long"), "stars")
    size, steps = cur.count(), []
    while True:
        tasks = max(1, ceil(size / TASK_LINKS))
        cur = cur.repartition(tasks, "u").mapInArrow(_contract, "u long, r long")
        if tasks == 1:
            steps.append(store(cur, "roots"))
            break
        node = store(cur.groupBy("u").agg(F.min("r").alias("r"), F.collect_set("r").alias("all")), "roots")
        steps.append(node.select("u", "r"))
        other = node.select(F.explode("all").alias("u"), "r").where("u <> r").distinct()
        cur = store(other, "stars")
        left = cur.count()
        if not left:
            break
        if left > size / 2:
            steps.append(_stars(cur, store))
            break
        size = left
    out = steps[0]
    for more in steps[1:]:
        out = out.join(more.select(F.col("u").alias("r"), F.col("r").alias("top")), "r", "left") \
            .select("u", F.coalesce("top", "r").alias("r"))
    return out.select(F.col("u").alias("node"), F.col("r").alias("component"))


def _neighbour_min(both: DataFrame) -> DataFrame:
    """Each (u, v) with m, the smallest of u and its neighbours.  The minimum
    is pre-aggregated before the shuffle and joined back, so the links of a
    hub are never one group."""
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u")


def _stars(links: DataFrame, store) -> DataFrame:
    """(u, r): the smallest node reachable from each node but that node
    itself, by alternating large-star and small-star steps."""
    cur = links.select(F.greatest("u", "r").alias("u"), F.least("u", "r").alias("v")).where("u <> v").distinct()
    seen = None
    while True:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _neighbour_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _neighbour_min(large)
        cur = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(small.where("u <> m").select("u", F.col("m").alias("v"))).distinct()
        cur = store(cur, "star")
        mark = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return cur.select("u", F.col("v").alias("r"))
        seen = mark
