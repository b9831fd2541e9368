"""A saved random forest as a table.

``read_nodes`` reads the node table that Spark ML saves; ``forest_probability``
finds the leaf of every tree for every row.  A row meets each block of trees
once (a broadcast of a few blocks, bounded by the model); inside a task the
block's splits are judged for many rows at once by bit operations.  A grouped
sum adds up the blocks' votes.  This needs no model object, so the scores can
be audited.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: trees of a block, rows judged at once, categories that a split may name
TREES, ROWS, CATEGORIES = 128, 512, 63

_STAGE = "stages/*_RandomForestClassifier_*"
_NODES = ("treeID INT, nodeData STRUCT<id: INT, impurityStats: ARRAY<DOUBLE>, gain: DOUBLE, leftChild: INT, rightChild: INT, "
          "split: STRUCT<featureIndex: INT, leftCategoriesOrThreshold: ARRAY<DOUBLE>, numCategories: INT>>")


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """One row a node of the forest in a saved pipeline: ``tree, node,
    feature`` (-1 at a leaf), ``threshold`` of a numeric split or ``left_set``
    (bit c set: category c goes left; the trainer's 32 bins bound c) of a
    categorical one, ``left, right, gain, rows`` (weighted training rows) and
    ``positive``, their share of class 1."""
    n = F.col("nodeData")
    split, stats = n["split"], n["impurityStats"]
    numeric = split["numCategories"] < 0
    rows = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    bits = F.aggregate(split["leftCategoriesOrThreshold"], F.lit(0).cast("bigint"),
                       lambda a, c: a + F.expr("1L") * F.pow(F.lit(2.0), c).cast("bigint"))
    return spark.read.schema(_NODES).parquet(f"{path}/{_STAGE}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), split["featureIndex"].alias("feature"),
        F.when(numeric, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(~numeric, bits).alias("left_set"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["gain"].alias("gain"),
        rows.alias("rows"), F.try_divide(F.get(stats, F.lit(1)), rows).alias("positive"))


def max_depth(spark: SparkSession, path: str) -> int:
    """Levels of splits that the saved forest may have."""
    said = spark.read.text(f"{path}/{_STAGE}/metadata").select(
        F.coalesce(F.get_json_object("value", "$.paramMap.maxDepth"), F.get_json_object("value", "$.defaultParamMap.maxDepth")))
    return int(said.first()[0])


class TreeBlock:
    """The votes of a block of trees on many rows at once.

    A tree's leaves are numbered from left to right, one bit each.  A split
    that sends a row right rules out the leaves under its left child, so the
    row's leaf is the first one that no split rules out.  What a feature's
    splits rule out depends only on the interval between their thresholds (or
    the category) that its value lies in: ``allowed`` has those words for each
    feature and interval, for all trees of the block side by side."""

    def __init__(self, nodes: list, features: int):
        trees: dict = {}
        for r in nodes:
            trees.setdefault(r["tree"], {})[r["node"]] = r
        self.trees = len(trees)
        spans, leaves = [], []                      # leaf numbers of each split: first, first under the right child
        for own in trees.values():
            found, splits, todo = [], [], [(0, False)]
            at: dict = {}
            while todo:                             # depth first, left child first
                node, seen = todo.pop()
                r = own[node]
                if r["feature"] < 0:
                    at[node] = len(found)
                    found.append(r["positive"])
                elif not seen:
                    todo += [(node, True), (r["right"], False), (r["left"], False)]
                else:
                    at[node] = at[r["left"]]
                    splits.append((r, at[node], at[r["right"]]))
            spans.append(splits)
            leaves.append(found)
        self.words = max(-(-len(f) // 64) for f in leaves)
        self.values = np.zeros((self.trees, 64 * self.words))
        self.empty = all(v is None for f in leaves for v in f)
        for t, f in enumerate(leaves):
            self.values[t, :len(f)] = [v or 0.0 for v in f]
        by = [[(t, *x) for t, splits in enumerate(spans) for x in splits if x[0]["feature"] == f] for f in range(features)]
        self.thresholds, self.allowed = [], []
        for splits in by:
            sets = any(r["left_set"] is not None for _, r, _, _ in splits)
            cuts = None if sets else np.unique([r["threshold"] for _, r, _, _ in splits])
            table = np.full((CATEGORIES + 1 if sets else len(cuts) + 1, self.trees, self.words), ~np.uint64(0))
            for t, r, first, right in splits:
                out = np.array([((1 << right) - (1 << first)) >> 64 * w & (1 << 64) - 1 for w in range(self.words)], np.uint64)
                if sets:
                    goes = [c for c in range(CATEGORIES + 1) if c == CATEGORIES or not r["left_set"] >> c & 1]
                else:
                    goes = slice(int(np.searchsorted(cuts, r["threshold"])) + 1, None)
                table[goes, t] &= ~out
            self.thresholds.append(cuts)
            self.allowed.append(table if splits else None)

    def arrays(self) -> tuple:
        return self.values, self.thresholds, self.allowed


def voter(rows: int = ROWS, categories: int = CATEGORIES):
    """votes(arrays of a block, columns): sum of the trees' shares of class 1
    for each row.  The function holds all it needs, so that tasks can run it
    where this package is not installed."""
    def votes(block: tuple, columns: list) -> np.ndarray:
        values, thresholds, allowed = block
        trees, words = len(values), values.shape[1] // 64
        place = []
        for x, cuts, table in zip(columns, thresholds, allowed):
            if table is None:
                place.append(None)
            elif cuts is None:
                whole = np.trunc(np.nan_to_num(x, nan=-1.0))
                place.append(np.where((whole >= 0) & (whole < categories), whole, categories).astype(np.int64))
            else:
                place.append(np.searchsorted(cuts, x))
        out = np.empty(len(columns[0]))
        every = np.arange(trees)
        for a in range(0, len(out), rows):
            b = slice(a, a + rows)
            bits = np.full((len(out[b]), trees, words), ~np.uint64(0))
            for p, table in zip(place, allowed):
                if table is not None:
                    bits &= table[p[b]]
            # the lowest bit left is a power of two, whose exponent is its number
            low = bits & (~bits + np.uint64(1))
            leaf = (low.astype(np.float64).view(np.int64) >> 52) - 1023
            first = leaf[:, :, 0]
            for w in range(1, words):
                first = np.where(first < 0, leaf[:, :, w] + 64 * w, first)
            out[b] = values[every, first].sum(axis=1)
        return out

    return votes


def forest_probability(rows: DataFrame, keys: list[str], features: list[str], nodes: DataFrame, depth: int,
                       out: str = "model_prob") -> DataFrame:
    """``keys`` and P(class 1) x 100 of every row.  ``keys`` must identify a
    row; a row that has a null feature gets NULL.  Rows that are partitioned by
    some of the keys are not shuffled.  ``depth``: levels of the forest, which
    the blocks know by themselves."""
    spark = rows.sparkSession
    # the model's own size: at most 2 ** (depth + 1) nodes a tree
    dealt = nodes.withColumn("_block", F.floor(F.col("tree") / TREES).cast("int")).orderBy("tree", "node").collect()
    own: dict = {}
    for r in dealt:
        own.setdefault(r["_block"], []).append(r)
    built = {i: TreeBlock(n, len(features)) for i, n in own.items()}
    sent, votes_of = spark.sparkContext.broadcast({i: b.arrays() for i, b in built.items()}), voter()

    @F.arrow_udf("double")
    def vote(block: pa.Array, *columns: pa.Array) -> pa.Array:
        number = block.to_numpy()
        x = [c.to_numpy(zero_copy_only=False) for c in columns]
        votes = np.empty(len(number))
        for i in np.unique(number):
            at = np.flatnonzero(number == i)
            votes[at] = votes_of(sent.value[i], x if len(at) == len(number) else [c[at] for c in x])
        return pa.array(votes)

    known = F.lit(not all(b.empty for b in built.values()))
    for c in features:
        known &= F.col(c).isNotNull()
    # every block of trees votes on every row
    blocks = spark.createDataFrame([(i, b.trees) for i, b in built.items()], "_block int, _trees int")
    long = rows.select(*keys, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)], known.alias("_known")) \
        .join(F.broadcast(blocks))
    x = [F.col(f"_x{i}") for i in range(len(features))]
    voted = long.withColumn("_sum", vote(F.col("_block"), *x))
    return voted.select(*keys, F.when(F.col("_known"), F.col("_sum")).alias("_vote"), "_trees").groupBy(*keys).agg(
        (F.sum("_vote") / F.sum("_trees") * F.lit(100.0)).alias(out))


def forest_importance(nodes: DataFrame, features: list[str]) -> DataFrame:
    """M5: (rank, feature, importance): gain x rows of a feature's splits,
    normalised in each tree and then over the forest."""
    gains = nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("g"))
    whole = gains.groupBy("tree").agg(F.sum("g").alias("t"))
    shares = gains.join(whole, "tree").where("t > 0").groupBy("feature").agg(F.sum(F.col("g") / F.col("t")).alias("s"))
    spark = nodes.sparkSession
    named = spark.createDataFrame(list(enumerate(features)), "feature int, name string").join(F.broadcast(shares), "feature", "left")
    total = shares.agg(F.sum("s").alias("total"))  # one row
    scored = named.join(F.broadcast(total)).select(
        F.col("name").alias("feature"), F.coalesce(F.col("s") / F.col("total"), F.lit(0.0)).alias("importance"))
    order = Window.orderBy(F.desc("importance"), "feature")  # one row a feature
    return scored.select(F.row_number().over(order).alias("rank"), "feature", "importance")
