"""End-to-end scoring plans.

Each plan is lazy: scan -> (latest | whole history) -> dimension join ->
Column formulas -> projection.  Nothing is collected between the steps, so
the same plan scores one weather state or years of history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import ingest, scoring
from tidewatch.sources.districts import districts


def batch_scores(spark: SparkSession, scenarios: DataFrame, dims: DataFrame | None = None,
                 district_rows: int | None = None) -> DataFrame:
    """E1 over any number of scenarios: batch formulas, six published columns."""
    dims, n = (districts(spark), len(_rows())) if dims is None else (dims, district_rows)
    return scoring.batch_result(scoring.score(scenarios, dims, "batch", district_rows=n))


def dashboard_scores(spark: SparkSession, scenarios: DataFrame, dims: DataFrame | None = None,
                     probability: str | None = None, district_rows: int | None = None,
                     keep=("scenario_id",)) -> DataFrame:
    """E3 over any number of scenarios: dashboard formulas and composite score."""
    return scoring.dashboard_result(
        dashboard_risk(spark, scenarios, dims, probability, district_rows), keep=keep)


def dashboard_risk(spark: SparkSession, scenarios: DataFrame, dims: DataFrame | None = None,
                   probability: str | None = None, district_rows: int | None = None,
                   probability_fn=None) -> DataFrame:
    dims, n = (districts(spark), len(_rows())) if dims is None else (dims, district_rows)
    sc = scoring.fill_live_proxies(scenarios)
    return scoring.add_risk_score(
        scoring.score(sc, dims, "dashboard", probability=probability, district_rows=n,
                      probability_fn=probability_fn))


def model_dashboard_risk(spark: SparkSession, scenarios: DataFrame, model,
                         dims: DataFrame | None = None, district_rows: int | None = None) -> DataFrame:
    """E3 with the classifier as the probability provider (H15, M2): the
    fitted pipeline scores every scenario x district row in one transform."""
    from tidewatch.plans import training as TR

    def apply(rows: DataFrame) -> DataFrame:
        return TR.model_probability(model, TR.dashboard_features(rows))

    return dashboard_risk(spark, scenarios, dims, probability="model_prob",
                          district_rows=district_rows, probability_fn=apply)


def latest_batch_job(spark: SparkSession, weather: DataFrame, order_col: str = "timestamp",
                     tie_col: str | None = None) -> DataFrame:
    """E1 exactly as the reference runs it: newest archived weather (or the
    default row) scored against every district, ordered by probability.  Events
    without rain are passed over (``ingest.rejected_null_rain`` returns them)."""
    usable, _ = ingest.rejected_null_rain(weather)
    w = ingest.latest_or_default(spark, usable, order_col, tie_col=tie_col)
    w = w.withColumns({"lokasi": F.lit("Surabaya"), "_id": F.lit(0).cast("bigint")})
    sc = ingest.to_scenarios(w, id_col="_id")
    # The reference reads its month from the clock only in the dashboard; the
    # batch variant ignores the month, so an unparsable "N/A" time is harmless.
    res = batch_scores(spark, sc)
    return res.drop("scenario_id").orderBy(F.desc("Probabilitas"), F.asc("Kecamatan"))


def _rows():
    from tidewatch.sources.districts import DISTRICT_ROWS
    return DISTRICT_ROWS


def live_dashboard(spark: SparkSession, weather: DataFrame, *, order_col: str = "timestamp",
                   month_col: str | None = None, model=None) -> dict[str, DataFrame]:
    """E3 as one bundle of lazy DataFrames: the newest weather event (missing
    fields defaulted) scored against every district, with the result table
    ordered by probability, the KPI cards, per-metric bands and chart series,
    the top-5 chart and the top-3 recommendation text."""
    from tidewatch.operators import kpi, ranking, report

    cols = [c for c in weather.columns]
    newest = ingest.with_defaults(ingest.latest(weather, order_col, columns=cols))
    sc = ingest.to_scenarios(newest.withColumn("_id", F.lit(0).cast("bigint")), id_col="_id",
                             month_col=month_col)
    risk = (model_dashboard_risk(spark, sc, model) if model is not None
            else dashboard_risk(spark, sc))
    result = scoring.dashboard_result(risk, keep=())
    return {
        "results": result.orderBy(F.desc("`Probabilitas (%)`"), F.asc("Kecamatan")),
        "kpis": kpi.kpi_cards(risk).drop("scenario_id"),
        "bands": kpi.severity_bands(risk, keep=("district",)),
        "series": ranking.metric_series(risk, {
            "probability": "probability", "depth": "depth_m", "people": "people_affected",
            "lead_time": "lead_time_h", "pct_area": "pct_area_r1", "risk_score": "risk_score"}),
        "top5": report.top5_priority(risk),
        "recommendations": report.top3_recommendations(risk),
    }
