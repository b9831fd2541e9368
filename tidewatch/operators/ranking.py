"""Sorts, ranks and top-k.

Per-scenario rankings use ``row_number`` over a window partitioned by the
scenario.  Callers that rank many scenarios should hash-partition the
scenario rows by ``scenario_id`` *before* the district join
(``colocate_scenarios``): the broadcast join keeps that partitioning, so the
window needs no second exchange of the 15x larger scored rows.  Top-k filters
on ``row_number`` are planned with a partial WindowGroupLimit that cuts each
group to k rows before any exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def colocate_scenarios(scenarios: DataFrame, key: str = "scenario_id", fanout: int = 15) -> DataFrame:
    """Hash-partition scenario rows once so later per-scenario windows and
    aggregates over the scored rows reuse this partitioning.

    The partition count is explicit, so adaptive execution does not coalesce
    the narrow scenario rows into a few tasks that would then carry the
    ``fanout`` times larger scored rows; it is sized from the estimated scored
    output (one partition per ~4 MB); for a plain scan never above the larger
    of its partitions, the cluster parallelism and the shuffle partitions (an
    input behind a shuffle has no such measure, and no cap)."""
    if scenarios.isStreaming:
        return scenarios
    from tidewatch.operators.joins import FANOUT_TASK_BYTES, estimated_bytes, scan_partitions
    spark = scenarios.sparkSession
    dp = spark.sparkContext.defaultParallelism
    want = max(1, estimated_bytes(scenarios) * fanout // FANOUT_TASK_BYTES)
    scanned = scan_partitions(scenarios)
    if scanned is not None:
        want = min(want, max(scanned, dp, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    if want > 1:  # whole waves of tasks: no straggler wave of a few partitions
        want = -(-want // dp) * dp
    return scenarios.repartition(int(want), key)


def rank_within(df: DataFrame, by, order: list[Column], name: str = "rank") -> DataFrame:
    """1-based rank number inside each group (ties broken by ``order``)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w))


def top_k(df: DataFrame, by, order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group, with their rank."""
    return rank_within(df, by, order, name).where(F.col(name) <= k)


def sorted_by(df: DataFrame, by, value: str, *, descending: bool, tie: str = "district",
              name: str = "rank") -> DataFrame:
    """O2/O3: position of each row in the per-group order of ``value``;
    equal values are ordered by ``tie`` (the reference leaves them open, N6)."""
    v = F.col(value).desc() if descending else F.col(value).asc()
    return rank_within(df, by, [v, F.col(tie).asc()], name)


def metric_series(risk: DataFrame, metrics: dict[str, str], by=("scenario_id",)) -> DataFrame:
    """O3: the ascending chart order of every metric, long format
    ``(scenario, series, position, district, value)``.  Window keys are
    integers (series index, alphabetical district code) so the sort stays on
    fixed-width prefixes; names are attached after ranking."""
    names = list(metrics)
    stacked = risk.select(
        *by, "district", "district_code",
        F.posexplode(F.array(*[F.col(c).cast("double") for c in metrics.values()]))
        .alias("series_no", "value"))
    ranked = rank_within(stacked, [*by, "series_no"],
                         [F.col("value").asc(), F.col("district_code").asc()], "position")
    series = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("series_no") + 1)
    return ranked.select(*by, "district", series.alias("series"), "value", "position")
