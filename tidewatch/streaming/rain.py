"""Trailing rain and flood label on a stream.

The reference's live mode stands in a proxy for the 3-day rain total, because
it keeps no history.  Here the total is a watermarked sliding event-time
window per station: three days long, one day apart.  A window is emitted once,
when the watermark has passed its end, and its state goes then; rows later
than that are counted (``late_rows``) and left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import timeseries as TS

#: how much later than the newest observation a day's rain may arrive
LATENESS = "2 days"


def rolling_sum_stream(daily: DataFrame, value: str, out: str, *, days: int = TS.RAIN_WINDOW_DAYS,
                       by=("location",), date_col: str = "date", lateness: str = LATENESS, scale: int = 3) -> DataFrame:
    """W2 on a stream of daily rows: ``by``, date, value and the sum over the
    trailing ``days`` calendar days, for every day that has a row (as
    ``timeseries.rolling_sum_days``).  Append mode; the session's time zone
    must be UTC, in which windows are aligned.  Sums run in DECIMAL, so they
    do not depend on the order of arrival; several rows of a day add up."""
    at = F.col(date_col).cast("timestamp")
    dec = F.col(value).cast(f"decimal(30,{scale})")
    rows = daily.select(*by, at.alias("_at"), dec.alias("_v")).withWatermark("_at", lateness)
    wide = rows.groupBy(F.window("_at", f"{days} days", "1 day"), *by)
    last = F.col("window.end") - F.expr("INTERVAL 1 DAY")
    # the day's own rain is the part that a shorter window would hold
    own = F.when(F.col("_at") == last, F.col("_v"))
    return wide.agg(F.sum("_v").alias("_sum"), F.sum(own).alias("_own"), F.max(F.when(F.col("_at") == last, 1)).alias("_has")) \
        .where(F.col("_has") == 1) \
        .select(*by, last.cast("date").alias(date_col), F.col("_own").cast("double").alias(value),
                F.col("_sum").cast("double").alias(out))


def labelled_stream(daily: DataFrame, flood_dates: DataFrame, flood_dates_rows: int | None = None, *,
                    lateness: str = LATENESS) -> DataFrame:
    """W2 + J5 + H23 on a stream: closed days with 3-day rain and flood label
    (stream-static join with the confirmed dates)."""
    d = rolling_sum_stream(daily, "rain_mm", "rain_3day_mm", lateness=lateness)
    return TS.flood_label(TS.flag_dates(d, flood_dates, known_rows=flood_dates_rows))


def late_rows(query) -> int:
    """Groups (station, window) of rows that came after their window was
    closed, over the recent progress of a query."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
