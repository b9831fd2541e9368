"""Approximate nearest neighbours by inner product: hierarchical k-means tree
with best-bin-first traversal.

A tree of k-means cells is fitted on at most SAMPLE vectors (chosen by hash)
and sent to the tasks; its size is bounded by the sample's.  Every vector is
assigned to a leaf.  Inner products become distances by one more coordinate,
``sqrt(longest^2 - length^2)``.  A query walks the tree through a priority
queue of cells by distance to their centres and visits the first leaves it
meets.  How many is calibrated: for CALIBRATION vectors that are not queries
the exact neighbours are found among all rows, and the visits are widened until
the mean share of neighbours inside the visited leaves reaches the target.  A
walk goes on until its leaves hold k vectors besides the query's own.

Leaves are searched exactly, in double precision, in cells of at most some
thousand vectors, so that a leaf full of copies is spread over tasks; queries
of a much visited leaf are split in the same way.
"""

from __future__ import annotations

import heapq
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.frames import stored
from tidewatch.llm.repeats import _arrow

SAMPLE = 32_768
BRANCH = 16
#: fewest sample vectors of a leaf; a leaf holds some LEAF_ROOT times the root
#: of the number of vectors, so that visits a query grow with the root too
LEAF_SAMPLE, LEAF_MIN, LEAF_ROOT = 16, 256, 4
CALIBRATION = 128
RECALL = 0.97
#: vectors, and queries, of a cell
CELL_MIN, CELL_MAX = 256, 4096


class Tree:
    """centre[i]: centre of node i; children[i]: its nodes, none for a leaf;
    leaf[i]: number of the leaf, or -1."""

    def __init__(self, points: np.ndarray, leaves: int, longest: float, seed: int = 0):
        self.longest, self.held = longest, None
        rng = np.random.default_rng(seed)
        x = self.lift(points)
        size = max(LEAF_SAMPLE, ceil(len(x) / max(leaves, 1)))
        self.centre, self.children, self.leaf = [x.mean(axis=0)], [[]], [-1]
        todo, self.leaves = [(0, x)], 0
        while todo:
            node, own = todo.pop()
            label = self._cluster(own, min(BRANCH, ceil(len(own) / size)), rng) if len(own) > size else np.zeros(len(own), int)
            kinds = np.unique(label)
            if len(kinds) < 2:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            for c in kinds:
                part = own[label == c]
                self.children[node].append(len(self.centre))
                todo.append((len(self.centre), part))
                self.centre.append(part.mean(axis=0))
                self.children.append([])
                self.leaf.append(-1)
        self.centre = np.array(self.centre)

    @staticmethod
    def _cluster(x: np.ndarray, k: int, rng) -> np.ndarray:
        centre = x[rng.choice(len(x), k, replace=False)]
        for _ in range(10):
            label = (((centre ** 2).sum(axis=1))[None] - 2 * x @ centre.T).argmin(axis=1)
            centre = np.array([x[label == c].mean(axis=0) if (label == c).any() else centre[c] for c in range(k)])
        return label

    def lift(self, x: np.ndarray) -> np.ndarray:
        short = np.sqrt(np.maximum(self.longest ** 2 - (x ** 2).sum(axis=1), 0))
        return np.concatenate([x, short[:, None]], axis=1)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest child at each level."""
        x = self.lift(x)
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf[node]
                continue
            c = self.centre[kids]
            near = ((c ** 2).sum(axis=1)[None] - 2 * x[rows] @ c.T).argmin(axis=1)
            todo += [(kid, rows[near == i]) for i, kid in enumerate(kids) if (near == i).any()]
        return out

    def visit(self, q: np.ndarray, most: int, least: int = 0) -> list[int]:
        """The first leaves of a best-bin-first walk: ``most`` of them, and on
        until they hold ``least`` vectors."""
        q = np.append(q, 0.0)
        queue, found, vectors = [(0.0, 0)], [], 0
        while queue and (len(found) < most or vectors < least):
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                found.append(self.leaf[node])
                vectors += int(self.held[self.leaf[node]]) if least else 0
                continue
            d = ((self.centre[kids] - q) ** 2).sum(axis=1)
            for x in zip(d.tolist(), kids):
                heapq.heappush(queue, x)
        return found


def _matrix(column) -> np.ndarray:
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks)
    return arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(arr), -1)


def best(ids: np.ndarray, x: np.ndarray, qid: int, q: np.ndarray, rough: np.ndarray, k: int):
    """The k best of x for q but those with the query's id: (ids, scores).
    rough: products that only choose; equal vectors get equal scores."""
    rough = np.where(ids == qid, -np.inf, rough)
    if len(rough) > k:
        bar = np.partition(rough, len(rough) - k)[len(rough) - k]
        some = np.flatnonzero(rough >= bar - 1e-9 * (1 + abs(bar)) if np.isfinite(bar) else np.isfinite(rough))
    else:
        some = np.flatnonzero(np.isfinite(rough))
    exact = (x[some] * q).sum(axis=1)
    order = np.lexsort((ids[some], -exact))[:k]
    return ids[some][order], exact[order]


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, v): rows with an id and a vector that is not null, not zero, and
    without null or non-finite components."""
    kind = vectors.schema[embedding].dataType.elementType.simpleString()
    v = F.col(embedding) if kind in ("float", "double") else F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(~odd & F.exists("v", lambda c: c != 0))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, recall: float = RECALL,
           vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id long, rank int, vec_id long, score double): the k nearest rows
    found for each query by largest inner product, ties by smaller vec_id.

    Vectors that are null, zero, or hold null or non-finite components take no
    part, on either side; nor do vectors of another dimension than the most
    frequent one, or rows without id.  Rows with the query's own vec_id are no
    candidates.  Repeated rows count separately as candidates and once as a
    query.  A query without candidates has no rows.
    """
    out_ddl = "query_id long, vec_id long, score double"
    out = _arrow(out_ddl)
    spark = vectors.sparkSession
    base = usable(vectors, vec_id, embedding)
    dims = base.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, rows = dims["d"], dims["n"]
    base = base.where(F.size("v") == dim)
    ask = usable(queries, vec_id, embedding).where(F.size("v") == dim).dropDuplicates(["id"])
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))
    longest = base.agg(F.max(length)).first()[0]

    share = min(1.0, SAMPLE / rows)
    cut = lambda salt, part: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1 << 30)) < int(part * (1 << 30))
    picked = _matrix(base.where(cut(1, share)).select("v").limit(2 * SAMPLE).toArrow().column("v")) if rows > SAMPLE \
        else _matrix(base.orderBy("id").select("v").toArrow().column("v"))
    leaf = max(LEAF_MIN, LEAF_ROOT * rows ** 0.5)
    tree = Tree(picked, min(ceil(rows / leaf), max(1, len(picked) // LEAF_SAMPLE)), longest)
    sent = spark.sparkContext.broadcast(tree)

    placed_ddl = f"leaf int, id long, v array<{'float' if 'float' in base.schema['v'].dataType.simpleString() else 'double'}>"
    placed_schema = _arrow(placed_ddl)

    def place(batches):
        for b in batches:
            if b.num_rows:
                leaf = sent.value.assign(_matrix(b.column("v")))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), b.column("id"), b.column("v")], schema=placed_schema)

    placed = stored(base.mapInArrow(place, placed_ddl), "placed")
    visits = _calibrate(placed, ask, tree, k, recall, rows)
    # a bounded number of leaves; sent with the tree
    tree.held = np.zeros(tree.leaves, np.int64)
    for r in placed.groupBy("leaf").count().collect():
        tree.held[r["leaf"]] = r["count"]
    sent = spark.sparkContext.broadcast(tree)
    # a query's own rows are no candidates, so its leaves hold k vectors besides
    own = placed.groupBy("id").agg(F.count(F.lit(1)).alias("own")).where("own > 1")
    ask = ask.join(own, "id", "left").select("id", "v", F.coalesce("own", F.lit(1)).alias("own"))

    def walk(batches):
        for b in batches:
            if not b.num_rows:
                continue
            seen = [sent.value.visit(q, visits, k + own) for q, own in zip(_matrix(b.column("v")), b.column("own").to_pylist())]
            at = pa.array(np.repeat(np.arange(len(seen)), [len(s) for s in seen]))
            leaf = pa.array(np.concatenate(seen).astype(np.int32))
            yield pa.RecordBatch.from_arrays([leaf, b.column("id").take(at), b.column("v").take(at)], schema=placed_schema)

    walks = ask.mapInArrow(walk, placed_ddl)
    cell = min(max(ceil(rows / 64), CELL_MIN), CELL_MAX)
    # cells of a leaf: parts of its vectors times parts of its queries, both
    # from counts (the queries' expected from all visits of a leaf)
    sizes = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("parts"))
    asked = walks.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / CELL_MAX).cast("int").alias("blocks"))
    cells = stored(sizes.join(asked, "leaf"), "cells")
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = placed.join(cells, "leaf").withColumn("part", mine("parts")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("leaf", "part", "block", "id", "v")
    right = walks.join(cells, "leaf").withColumn("block", mine("blocks")) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("leaf", "part", "block", "id", "v")

    def scan(key, table, asked):
        if not table.num_rows or not asked.num_rows:
            return out.empty_table()
        ids, x = table.column("id").to_numpy(), _matrix(table.column("v"))
        qid, q = asked.column("id").to_numpy(), _matrix(asked.column("v"))
        got = []
        for a in range(0, len(qid), 512):
            rough = q[a:a + 512] @ x.T
            got += [(qid[a + i], *best(ids, x, qid[a + i], q[a + i], r, k)) for i, r in enumerate(rough)]
        return pa.Table.from_arrays([pa.array(np.repeat([g[0] for g in got], [len(g[1]) for g in got]).astype(np.int64)),
                                     pa.array(np.concatenate([g[1] for g in got])),
                                     pa.array(np.concatenate([g[2] for g in got]))], schema=out)

    keys = ["leaf", "part", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(scan, out_ddl)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _calibrate(placed: DataFrame, ask: DataFrame, tree: Tree, k: int, recall: float, rows: int) -> int:
    """Leaves to visit: exact neighbours of CALIBRATION vectors, in one pass
    that keeps k rows a vector and task, against the order of their walks."""
    some = placed.join(ask.select("id"), "id", "left_anti").orderBy(F.xxhash64("id", F.lit(2)), "id").limit(CALIBRATION)
    got = some.select("id", "v").toArrow()
    if not got.num_rows:
        return tree.leaves
    qid, q = got.column("id").to_numpy(), _matrix(got.column("v"))
    ddl = "q int, id long, leaf int, score double"
    schema = _arrow(ddl)

    def near(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ids, leaf, x = b.column("id").to_numpy(), b.column("leaf").to_numpy(), _matrix(b.column("v"))
            rough = q @ x.T
            for i in range(len(qid)):
                r = np.where(ids == qid[i], -np.inf, rough[i])
                top = np.argsort(-r, kind="stable")[:k]
                top = top[np.isfinite(r[top])]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top), i, np.int32)), pa.array(ids[top]),
                                                  pa.array(leaf[top]), pa.array(r[top])], schema=schema)

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    true = placed.mapInArrow(near, ddl).withColumn("rank", rank).where(F.col("rank") <= k).select("q", "leaf").toArrow()
    of, leaf = true.column("q").to_numpy(), true.column("leaf").to_numpy()
    if not len(of):
        return tree.leaves
    place = np.zeros(len(of), np.int64)
    for i in np.unique(of):
        order = np.empty(tree.leaves, np.int64)
        order[tree.visit(q[i], tree.leaves)] = np.arange(tree.leaves)
        place[of == i] = order[leaf[of == i]]
    inside = np.cumsum(np.bincount(place, minlength=tree.leaves)) / len(place)
    return int(np.argmax(inside >= recall)) + 1
