"""Dimension attachment.

The reference loops over every district for one weather state.  Here each
scenario row carries its ``location`` and is equi-joined to the districts of
that location, so several cities can be scored in one job and no cross join
is planned.  The district side is broadcast only when its size in bytes is
bounded: known by construction, or counted up to the bound.  Above the bound
the join is a shuffle join in which only the keys measured to be hot are
salted, so one hot location cannot land in a single task and the dimension is
not copied for the others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialize

# Bytes of a dimension we are willing to ship to every task.
BROADCAST_MAX_BYTES = 32 << 20
# A key is hot when it holds more fact rows than this; each such portion of it
# goes to a salt of its own.
HOT_ROWS = 2_000_000


def scan_partitions(df: DataFrame) -> int | None:
    """Partition count of a plan that has no exchange (a scan and narrow
    operators), read without running a job; None when it would take one
    (an adaptive plan materialises its shuffle stages to report partitions)."""
    if df.isStreaming:
        return None
    qe = df._jdf.queryExecution()
    if "Exchange" in qe.executedPlan().toString():
        return None
    return qe.toRdd().getNumPartitions()


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (file sizes for scans)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Smallest output worth a task of its own when spreading a fan-out input.
FANOUT_TASK_BYTES = 4 << 20


def spread_for_fanout(facts: DataFrame, fanout: int = 15) -> DataFrame:
    """Give a fan-out join (every fact row -> ``fanout`` rows) enough tasks.

    Large inputs already arrive in many scan partitions and are left alone
    (no shuffle).  A small input that would expand inside a handful of tasks
    is spread round-robin over ``min(parallelism, estimated output / 4 MB)``
    partitions, so a one-row live scenario stays one task while a history
    file fills the cluster.  Round-robin repartitioning sorts rows first, so
    a retried task rebuilds the same partition."""
    n = scan_partitions(facts)
    if n is None:
        return facts
    dp = facts.sparkSession.sparkContext.defaultParallelism
    want = min(dp, max(1, estimated_bytes(facts) * fanout // FANOUT_TASK_BYTES))
    if n >= want:
        return facts
    return facts.repartition(int(want))


def row_bytes(df: DataFrame) -> int:
    """Catalyst's default width of a row of this schema."""
    return int(df._jdf.schema().defaultSize()) + 8


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether df has at most ``max_bytes``: counted, up to the bound only."""
    most = max(1, max_bytes // row_bytes(df))
    return df.limit(most + 1).count() <= most


def attach_dimension(facts: DataFrame, dim: DataFrame, on: str | list[str], *,
                     known_rows: int | None = None,
                     max_bytes: int = BROADCAST_MAX_BYTES, hot_rows: int = HOT_ROWS,
                     salt_key: str | None = None, spread: bool = False) -> DataFrame:
    """Inner equi-join of a fact table with a (usually small) dimension.
    ``spread``: the join multiplies rows (``spread_for_fanout``).
    ``known_rows``: rows of a dimension whose size is fixed by construction."""
    keys = [on] if isinstance(on, str) else list(on)
    if spread:
        facts = spread_for_fanout(facts)
    if known_rows * row_bytes(dim) <= max_bytes if known_rows is not None else fits_broadcast(dim, max_bytes):
        return facts.join(F.broadcast(dim), keys, "inner")
    # Large dimension: keys with many fact rows get as many salts as they hold
    # portions of ``hot_rows``; there are at most rows / hot_rows such keys, so
    # their list is small.  The salt is a hash of fact columns, never rand(),
    # so a retried task recomputes the same assignment after an executor loss.
    hot = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows) \
        .select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    source = F.col(salt_key) if salt_key else F.xxhash64(*[F.col(c) for c in facts.columns])
    salts = F.coalesce("_salts", F.lit(1))
    salted = facts.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(source), salts).cast("int")).drop("_salts")
    spread_dim = dim.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return salted.join(spread_dim, [*keys, "_salt"], "inner").drop("_salt")


def lookup_code(df: DataFrame, dim: DataFrame, name_col: str, *,
                dim_name: str = "district", dim_code: str = "district_code",
                out: str = "district_code", known_rows: int | None = None) -> DataFrame:
    """Name -> category code through a bounded dimension (left join keeps
    unknown names with a NULL code)."""
    codes = dim.select(F.col(dim_name).alias(name_col), F.col(dim_code).alias(out))
    if known_rows is None:      # a dimension of unknown origin may repeat names
        codes = codes.distinct()
    right = F.broadcast(codes) if known_rows is not None or fits_broadcast(codes) else codes
    return df.join(right, name_col, "left")


def row_agreement(left: DataFrame, right: DataFrame, group: str, key: str, keys: list[str],
                  only: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> DataFrame:
    """One row, ``scored`` and ``differing``: the rows of a full join of both
    sides on ``group`` and ``key``, and those in which the columns of left are
    not the same on both sides.

    Wide rows are not joined where both sides agree.  Each row becomes a hash
    of its columns, summed up for its group in the task that has the row, so
    that a group of a side is one narrow row in the shuffle.  Groups whose
    sums differ, or in which a key repeats or is none of ``keys`` (63 at most,
    a bit each), are joined row by row; ``only(groups)`` gives both sides' rows of
    these groups (column ``group``, null for a null one)."""
    def hashed(rows: DataFrame, sign: int) -> DataFrame:
        # a hash passes over nulls, so where they are is hashed as well
        nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in left.columns])
        place = F.coalesce(F.array_position(F.array(*map(F.lit, keys)), F.col(key)), F.lit(0))
        return rows.select(group, F.lit(sign).alias("_side"), place.cast("int").alias("_place"),
                           F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], nulls).alias("_hash"))

    side, low, high = F.col("_side"), F.col("_hash").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("_hash", 32)
    sums = hashed(left, 1).unionByName(hashed(right, -1)).groupBy(group).agg(
        F.sum(side).alias("n"), F.sum(side * low).alias("low"), F.sum(side * high).alias("high"),
        F.count_if(side > 0).alias("rows"), F.bit_or(F.expr("shiftleft(1L, _place)")).alias("keys"))
    same = (F.col("n") == 0) & (F.col("low") == 0) & (F.col("high") == 0) & F.col(group).isNotNull() \
        & (F.bit_count("keys") == F.col("rows")) & (F.col("keys") % 2 == 0)
    # one row for all groups that agree, and one for each other group
    found = sums.select(same.alias("same"), F.when(~same, F.col(group)).alias(group), "rows") \
        .groupBy("same", group).agg(F.sum("rows").alias("scored"))
    found = materialize(found)
    agreed = found.where("same").select("scored", F.lit(0).cast("bigint").alias("differing"))
    open_ = found.where("not same").select(group)
    if open_.head(1):
        a, b = only(open_)
        equal = F.lit(True)
        for c in left.columns:
            equal &= a[f"`{c}`"].eqNullSafe(b[f"`{c}`"])
        both = a.join(b, (a[group] == b[group]) & (a[key] == b[key]), "full")
        agreed = agreed.unionByName(both.agg(F.count(F.lit(1)).alias("scored"), F.count_if(~equal).alias("differing")))
    return agreed.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("scored", "differing")])
