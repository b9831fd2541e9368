"""KPI aggregation and severity bands.

KPIs are one aggregate pass per scenario.  All 15 district rows of a
scenario leave the broadcast join in the same task, so the partial
aggregate already reduces them to one row before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.numeric import band, dbl
from tidewatch.operators.scoring import CRITICAL_PCT, WATCH_PCT

# ---- fixed values: band thresholds of the reference ------------------------
# metric -> (column, high, low, higher_is_worse)
METRIC_BANDS = {
    "probability": ("probability", 70.0, 40.0, True),
    "depth": ("depth_m", 1.0, 0.5, True),
    "people": ("people_affected", 5000, 1000, True),
    "lead_time": ("lead_time_h", 3, 6, False),
    "pct_area": ("pct_area_r1", 50.0, 25.0, True),
    "risk_score": ("risk_score", 70.0, 40.0, True),
}
KPI_PEOPLE_BANDS = (5000, 1000)
KPI_LEAD_BANDS = (3, 6)
# ---------------------------------------------------------------------------


def is_critical(p: Column) -> Column:
    """Probability above the critical threshold."""
    return p > dbl(CRITICAL_PCT)


def is_watch(p: Column) -> Column:
    """Probability in the watch band (40, 70]."""
    return (p > dbl(WATCH_PCT)) & (p <= dbl(CRITICAL_PCT))


def severity_bands(risk: DataFrame, keep=("scenario_id", "district")) -> DataFrame:
    """A band per displayed metric for every result row."""
    return risk.select(*keep, *[
        band(F.col(c), hi, lo, higher_is_worse=worse).alias(f"{name}_band")
        for name, (c, hi, lo, worse) in METRIC_BANDS.items()])


def kpi_cards(risk: DataFrame, by=("scenario_id",)) -> DataFrame:
    """A2-A5 + H25: critical / watch counts, total people, shortest lead time,
    and the card band of each, per scenario."""
    p = F.col("probability")
    agg = risk.groupBy(*by).agg(
        F.count(F.lit(1)).alias("districts"),
        F.count_if(is_critical(p)).alias("critical_count"),
        F.count_if(is_watch(p)).alias("watch_count"),
        F.sum("people_affected").alias("total_people"),
        F.min("lead_time_h").alias("min_lead_time_h"),
    )
    return agg.withColumns({
        "critical_band": F.when(F.col("critical_count") > 0, F.lit("danger")).otherwise(F.lit("safe")),
        "watch_band": F.when(F.col("watch_count") > 0, F.lit("warn")).otherwise(F.lit("safe")),
        "people_band": band(F.col("total_people"), *KPI_PEOPLE_BANDS),
        "lead_band": band(F.col("min_lead_time_h"), *KPI_LEAD_BANDS, higher_is_worse=False),
    })


def archive_summary(weather: DataFrame, order_col: str, value_cols) -> DataFrame:
    """A1 + O1 in one pass: record count and newest values (the reference
    scans its archive twice, once to count and once to sort)."""
    packed = F.struct(*[F.col(c) for c in value_cols])
    return weather.agg(F.count(F.lit(1)).alias("records"),
                       F.max_by(packed, F.col(order_col)).alias("_l")) \
        .select("records", *[F.col(f"_l.{c}").alias(c) for c in value_cols])


def dataset_profile(daily: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Days, rainy days, max rain, flood days and the date range."""
    src = labelled if labelled is not None else daily
    aggs = [F.count(F.lit(1)).alias("days"),
            F.count_if(F.col("rain_mm") > 0).alias("rainy_days"),
            F.max("rain_mm").alias("max_rain_mm"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date")]
    if labelled is not None:
        aggs.append(F.sum("flood").cast("bigint").alias("flood_days"))
    return src.agg(*aggs)
