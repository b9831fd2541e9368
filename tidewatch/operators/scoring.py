"""Weather x district scoring.

``score(scenarios, districts, variant)`` returns one row per scenario and
district with every intermediate hydrology column, the probability, the
composite score and the labels.  ``batch_result`` / ``dashboard_result``
project it to the reference's published column sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.numeric import r1
from tidewatch.operators import hydrology as H
from tidewatch.operators.joins import attach_dimension

# ---- fixed values: status and priority labels of the reference ------------
STATUS_CRITICAL = "🔴 KRITIS"
STATUS_WATCH = "🟡 WASPADA"
STATUS_SAFE = "🟢 AMAN"
PRIORITY_HIGH = "🔴 PRIORITAS UTAMA"
PRIORITY_MEDIUM = "🟡 PRIORITAS SEDANG"
PRIORITY_LOW = "🟢 PRIORITAS RENDAH"
CRITICAL_PCT = 70.0
WATCH_PCT = 40.0
# composite score weights: probability, depth, % area, % people, urgency
SCORE_WEIGHTS = (0.35, 0.20, 0.15, 0.20, 0.10)
# ---------------------------------------------------------------------------


def _three_way(x: str, high: str, medium: str, low: str) -> str:
    return (f"CASE WHEN {x} > {H.d(CRITICAL_PCT)} THEN '{high}' "
            f"WHEN {x} > {H.d(WATCH_PCT)} THEN '{medium}' WHEN {x} IS NOT NULL THEN '{low}' END")


def status_sql(prob: str = "probability") -> str:
    """Status on the unrounded probability."""
    return _three_way(prob, STATUS_CRITICAL, STATUS_WATCH, STATUS_SAFE)


def priority_sql(score: str = "risk_score") -> str:
    """Evacuation priority on the rounded score."""
    return _three_way(score, PRIORITY_HIGH, PRIORITY_MEDIUM, PRIORITY_LOW)


def status_label(prob: str = "probability") -> Column:
    return F.expr(status_sql(prob))


def priority_label(score: str = "risk_score") -> Column:
    return F.expr(priority_sql(score))


def fill_live_proxies(scenarios: DataFrame) -> DataFrame:
    """H1/H2: in live mode the 3-day rain and sunshine are proxies of rain;
    a what-if scenario supplies them and keeps its own values."""
    return scenarios.withColumns({
        "rain_3day_mm": F.expr(f"coalesce(rain_3day_mm, {H.rain_3day_proxy()})"),
        "sunshine_h": F.expr(f"coalesce(sunshine_h, {H.sunshine_proxy()})"),
    })


def split_scorable(scenarios: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scenarios that can be scored, and the rejects with a ``reason``
    (no rain, no location); nothing is lost between the two."""
    reason = (F.when(F.col("rain_mm").isNull() | F.isnan("rain_mm"), "missing rain")
              .when(F.col("location").isNull(), "missing location"))
    marked = scenarios.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def split_dimension(districts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """District rows whose formulas are defined, and the rejects with a
    ``reason`` (a capacity, area or population that is missing or not positive)."""
    bad = [F.when(~F.coalesce(F.col(c) > 0, F.lit(False)), F.lit(c)) for c in ("drainage_m3s", "area_km2", "population")]
    marked = districts.withColumn("reason", F.concat_ws(", ", *bad))
    return marked.where("reason = ''").drop("reason"), marked.where("reason <> ''")


def score(scenarios: DataFrame, districts: DataFrame, variant: str | H.Variant = "batch", *,
          probability: str | None = None, district_rows: int | None = None,
          probability_fn=None) -> DataFrame:
    """Score every scenario against every district of its location.

    ``probability``: name of a column (0-100) supplied by a model; when None
    the index probability H14 is the provider.  ``probability_fn`` is a
    DataFrame -> DataFrame step (a fitted model, H15) that adds that column
    to the scored rows.  ``district_rows`` is the known size of the dimension
    (None: its size is checked before broadcasting).
    Scenarios without rain or location are left out (``split_scorable`` returns
    them); a district with an unusable divisor gets NULL where it is needed.
    """
    v = H.VARIANTS[variant] if isinstance(variant, str) else variant
    scenarios, _ = split_scorable(scenarios)
    rows = attach_dimension(scenarios, districts, "location", known_rows=district_rows,
                            salt_key="scenario_id", spread=True)
    rows = H.add_hydrology(rows, v)
    if v.seasonal_tide:
        rows = rows.withColumns({
            "wet_season": H.col(H.wet_season()),
            "rain_duration_h": H.col(H.rain_duration()),
        })
    if probability_fn is not None:
        rows = probability_fn(rows)
    prob = F.col(probability) if probability else F.col("index_prob")
    rows = rows.withColumn("probability", prob)
    return rows.withColumn("status", status_label())


def add_risk_score(scored: DataFrame) -> DataFrame:
    """Shares, normalised depth and urgency, composite score, priority."""
    d, clip = H.d, H.clip
    zero, hundred = d(0.0), d(100.0)
    df = scored.withColumns({
        "pct_area": F.expr(H.known(clip(f"flooded_km2 / area_km2 * {hundred}", zero, hundred), "flooded_km2", nonzero="area_km2")),
        "pct_people": F.expr(H.known(clip(f"people_affected / population * {hundred}", zero, hundred), "people_affected", nonzero="population")),
        "norm_depth": F.expr(H.known(clip(f"depth_m / {d(3.0)} * {hundred}", zero, hundred), "depth_m")),
        "norm_urgency": F.expr(H.known(clip(f"(12 - lead_time_h) / {d(11.0)} * {hundred}", zero, hundred), "lead_time_h")),
    })
    w_p, w_d, w_a, w_pp, w_u = (d(w) for w in SCORE_WEIGHTS)
    df = df.withColumn("risk_score", F.expr(H.rnd(
        f"{w_p} * probability + {w_d} * norm_depth + {w_a} * pct_area"
        f" + {w_pp} * pct_people + {w_u} * norm_urgency", 1)))
    return df.withColumns({"priority": priority_label(),
                           "pct_area_r1": F.expr(H.rnd("pct_area", 1))})


def batch_result(scored: DataFrame, keep=("scenario_id",)) -> DataFrame:
    """The batch job's six published columns (probability rounded to 1)."""
    return scored.select(
        *keep,
        F.col("district").alias("Kecamatan"),
        F.col("status").alias("Status"),
        r1(F.col("probability")).alias("Probabilitas"),
        F.col("depth_m").cast("double").alias("Tinggi_Genangan_m"),
        F.col("people_affected").alias("Penduduk_Terdampak"),
        F.col("lead_time_h").alias("Lead_Time_jam"),
    )


DASHBOARD_COLUMNS = ["Kecamatan", "Status", "Probabilitas (%)", "Tinggi Genangan (m)",
                     "Luas Terdampak (km2)", "% Luas Terdampak", "Penduduk Terdampak",
                     "Lead Time (jam)", "Flood Risk Score", "Prioritas Evakuasi"]


def dashboard_result(risk: DataFrame, keep=("scenario_id",)) -> DataFrame:
    """The dashboard's ten published columns."""
    return risk.select(
        *keep,
        F.col("district").alias("Kecamatan"),
        F.col("status").alias("Status"),
        F.col("probability").alias("Probabilitas (%)"),
        F.col("depth_m").alias("Tinggi Genangan (m)"),
        F.col("flooded_km2").alias("Luas Terdampak (km2)"),
        F.col("pct_area_r1").alias("% Luas Terdampak"),
        F.col("people_affected").alias("Penduduk Terdampak"),
        F.col("lead_time_h").alias("Lead Time (jam)"),
        F.col("risk_score").alias("Flood Risk Score"),
        F.col("priority").alias("Prioritas Evakuasi"),
    )
