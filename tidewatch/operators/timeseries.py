"""Daily history operators.

The trailing 3-day rain total is not a window over one location's history
(that would put a whole location into one task).  Each day instead sends its
rain to the day itself and the next two days, and a grouped sum adds them up:
partial aggregation, no single-task partition, exact RANGE semantics on
calendar days (missing days contribute nothing).

Date-based splits rank the *distinct dates* (a calendar-bounded set, one row
per day) and join the result back.  That small table is produced by a
shuffle stage, so adaptive execution knows its exact size when it plans the
join and turns it into a broadcast join from the measured size; no extra
counting job is run up front.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators import hydrology as H
from tidewatch.operators.joins import fits_broadcast

# ---- fixed values: labelling rule of the reference -------------------------
FLOOD_RAIN_3DAY_MM = 80.0
RAIN_WINDOW_DAYS = 3
TEST_FRACTION = 0.2
CV_FOLDS = 5
# ---------------------------------------------------------------------------



def rolling_sum_days(daily: DataFrame, value: str, out: str, *, days: int = RAIN_WINDOW_DAYS,
                     by=("location",), date_col: str = "date", scale: int = 3) -> DataFrame:
    """Sum of ``value`` over the trailing ``days`` calendar days (current
    day included) for every row of ``daily``.  Sums run in DECIMAL with
    ``scale`` decimals so the result does not depend on addition order."""
    others = [c for c in daily.columns if c not in (*by, date_col)]
    dec = f"decimal(30,{scale})"
    spread = daily.select(
        *by, date_col, F.col(value).cast(dec).alias("_v"),
        F.struct(*[F.col(c) for c in others]).alias("_row"),
        F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("_lag"))
    # Only the day's own copy carries its other columns through the shuffle.
    spread = spread.withColumns({
        "_target": F.date_add(F.col(date_col), F.col("_lag")),
        "_row": F.when(F.col("_lag") == 0, F.col("_row"))})
    agg = spread.groupBy(*by, "_target").agg(
        F.sum("_v").alias("_sum"),
        F.max_by(F.col("_row"), F.when(F.col("_lag") == 0, F.lit(1))).alias("_row"),
        F.max(F.when(F.col("_lag") == 0, F.lit(1))).alias("_self"))
    return agg.where(F.col("_self") == 1).select(
        *by, F.col("_target").alias(date_col),
        *[F.col(f"_row.{c}").alias(c) for c in others],
        F.col("_sum").cast("double").alias(out))


def flag_dates(daily: DataFrame, dates: DataFrame, out: str = "confirmed",
               date_col: str = "date", known_rows: int | None = None) -> DataFrame:
    """1 for days on a (small) list of dates, else 0 (left join)."""
    flags = dates.select(F.col(date_col)).distinct().withColumn("_hit", F.lit(1))
    right = F.broadcast(flags) if known_rows is not None or fits_broadcast(flags) else flags
    return daily.join(right, date_col, "left").withColumn(
        out, F.coalesce(F.col("_hit"), F.lit(0))).drop("_hit")


def flood_label(daily: DataFrame, rain3: str = "rain_3day_mm", confirmed: str = "confirmed",
                out: str = "flood") -> DataFrame:
    """Flood when the 3-day rain exceeds 80 mm or the day is confirmed."""
    return daily.withColumn(out, ((F.col(rain3) > F.lit(FLOOD_RAIN_3DAY_MM))
                                  | (F.col(confirmed) == 1)).cast("int"))


def labelled_days(daily: DataFrame, flood_dates: DataFrame, flood_dates_rows: int | None = None) -> DataFrame:
    """W2 + J5 + H23 + F8/F9: daily history with 3-day rain, month, season and label."""
    d = rolling_sum_days(daily, "rain_mm", "rain_3day_mm")
    d = flag_dates(d, flood_dates, known_rows=flood_dates_rows)
    d = flood_label(d)
    return d.withColumns({"month": F.month("date").cast("int"),
                          "wet_season": H.col(H.wet_season("month(date)"))})


def date_index(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Ordinal of every distinct date (1 = earliest) and the date count.

    Runs over the distinct dates only: one row per day, a set bounded by the
    calendar, not by the data volume."""
    dates = df.select(date_col).distinct()
    w = Window.orderBy(date_col)
    return dates.select(date_col, F.row_number().over(w).alias("date_no"),
                        F.count(F.lit(1)).over(Window.partitionBy()).alias("n_dates"))


def chronological_split(df: DataFrame, test_fraction: float = TEST_FRACTION,
                        date_col: str = "date") -> DataFrame:
    """The last ``ceil(fraction * dates)`` dates are the test set; all rows
    of a date stay together (N10)."""
    idx = date_index(df, date_col).withColumn(
        "role", F.when(F.col("date_no") > F.col("n_dates")
                       - F.ceil(F.col("n_dates") * F.lit(test_fraction)), F.lit("test"))
        .otherwise(F.lit("train")))
    return df.join(idx.select(date_col, "role"), date_col, "inner")


def date_tiles(df: DataFrame, tiles: int, date_col: str = "date") -> DataFrame:
    """``ntile(tiles)`` over the distinct dates (remainder dates go to the
    first tiles), as a small (date, tile) table."""
    w = Window.orderBy(date_col)
    return df.select(date_col).distinct().select(
        date_col, F.ntile(tiles).over(w).alias("tile"))


def time_series_folds(df: DataFrame, folds: int = CV_FOLDS, date_col: str = "date") -> DataFrame:
    """Expanding-window folds.  Dates are cut into ``folds + 1`` tiles;
    fold k trains on tiles 1..k and tests on tile k+1.  Every row is emitted
    once per fold it belongs to (no join of folds with rows)."""
    tiles = date_tiles(df, folds + 1, date_col)
    rows = df.join(tiles, date_col, "inner")
    t = F.col("tile")
    rows = rows.withColumn("fold", F.explode(F.sequence(F.greatest(t - 1, F.lit(1)), F.lit(folds))))
    return rows.withColumn("role", F.when(F.col("fold") == t - 1, F.lit("test"))
                           .otherwise(F.lit("train")))
