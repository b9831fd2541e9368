"""Training data, model training and evaluation plans (SURVEY J4, P10, M1-M7,
W3, W4, A7-A11).

The training matrix is daily history x district attributes; the classifier is
Spark ML's random forest in a ``Pipeline`` (district label encoding, vector
assembly, forest), trained and scored as distributed jobs.
"""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import evaluation as EV
from tidewatch.operators import hydrology as H
from tidewatch.operators import timeseries as TS
from tidewatch.operators.joins import attach_dimension
from tidewatch.sources.districts import DISTRICT_COUNT, districts
from tidewatch.sources.versions import commit_version

# ---- fixed values: model feature order of the reference --------------------
FEATURES = ["curah_hujan_mm", "curah_hujan_3hari", "kelembaban_pct", "suhu_c",
            "kecepatan_angin", "durasi_hujan_jam", "bulan", "musim_hujan",
            "elevasi_m", "koef_limpasan", "frekuensi_historis", "kecamatan_enc"]
# ---------------------------------------------------------------------------

LABEL = "label"


def training_matrix(spark: SparkSession, daily: DataFrame | None = None,
                    flood_dates: DataFrame | None = None,
                    dims: DataFrame | None = None, *, flood_dates_rows: int | None = None,
                    district_rows: int | None = None, days: DataFrame | None = None) -> DataFrame:
    """J4 + P10: labelled days x districts with the 12 ordered features.
    ``kecamatan_enc`` is the dimension's alphabetical code (M1).  ``days``:
    already labelled daily history (e.g. a checkpointed table reused by
    several plans) instead of ``daily`` + ``flood_dates``."""
    if dims is None:
        dims, district_rows = districts(spark), DISTRICT_COUNT
    if days is None:
        days = TS.labelled_days(daily, flood_dates, flood_dates_rows)
    rows = attach_dimension(days, dims, "location", known_rows=district_rows)
    return rows.select(
        "date", "district",
        F.col("rain_mm").alias("curah_hujan_mm"),
        F.col("rain_3day_mm").alias("curah_hujan_3hari"),
        F.col("humidity_pct").alias("kelembaban_pct"),
        F.col("temp_c").alias("suhu_c"),
        F.col("wind_ms").alias("kecepatan_angin"),
        H.col(H.rain_duration()).alias("durasi_hujan_jam"),
        F.col("month").alias("bulan"),
        F.col("wet_season").alias("musim_hujan"),
        F.col("elevation_m").alias("elevasi_m"),
        F.col("runoff_coef").alias("koef_limpasan"),
        F.col("flood_freq").alias("frekuensi_historis"),
        F.col("district_code").alias("kecamatan_enc"),
        F.col("flood").alias(LABEL),
        # carried for the index-probability baseline
        "drainage_m3s", "area_km2", "population", "coast_km",
    )


def index_score(matrix: DataFrame) -> DataFrame:
    """Batch-formula index probability of each training row, as a [0, 1]
    score (the SQL-comparable probability provider, N11)."""
    rain, elev = "curah_hujan_mm", "elevasi_m"
    tide = H.tide_at(H.tide_base(H.BATCH), "coast_km")
    excess = H.drainage_excess(H.runoff("koef_limpasan", rain, "area_km2"), "drainage_m3s")
    p = H.index_probability(rain, H.river_stage(rain, elev), elev, excess, tide)
    return matrix.withColumn("score", H.col(f"({p}) / {H.d(100.0)}"))


def fold_metrics(matrix: DataFrame, folds: int = TS.CV_FOLDS,
                 threshold: float = EV.DECISION_THRESHOLD) -> DataFrame:
    """M4 with the index score: AUC, accuracy and F1 on each fold's test part."""
    scored = index_score(matrix).withColumnRenamed(LABEL, "y")
    test = TS.time_series_folds(scored.select("date", "y", "score"), folds) \
        .where(F.col("role") == "test")
    return EV.auc_and_decision(test, by=["fold"], threshold=threshold, groups_bound=folds) \
        .select("fold", "auc", "accuracy", "f1")


def cv_test_scores(folds: DataFrame, n_folds: int = TS.CV_FOLDS, parallel: int = TS.CV_FOLDS, **kw) -> DataFrame:
    """M4: (fold, y, score) of every fold's test rows under a forest fitted on
    that fold's training rows, with the final model's settings.  ``folds``:
    matrix rows with tile, fold and role, stored (each fit reads it);
    ``parallel``: folds fitted at once, each by jobs of its own."""

    def fold(k: int) -> DataFrame:
        own = folds.where(F.col("fold") == k)
        model = fit_forest(own.where(F.col("role") == "train").drop("tile", "fold", "role"), **kw)
        test = model_probability(model, own.where(F.col("role") == "test").drop("tile", "fold", "role"))
        return test.select(F.lit(k).alias("fold"), F.col(LABEL).alias("y"), (F.col("model_prob") / 100.0).alias("score"))

    # a fit is a chain of short jobs, one a tree level: chains of several folds
    # fill the cores that one leaves idle, and the tail of each job
    run = inheritable_thread_target(folds.sparkSession)(fold)
    with ThreadPool(min(n_folds, parallel)) as pool:
        return reduce(DataFrame.unionByName, pool.map(run, range(1, n_folds + 1)))


def forest_pipeline(num_trees: int = 100, max_depth: int = 8, seed: int = 42) -> Pipeline:
    """M1 + P10 + M3: label-encode the district, assemble the 12 features in
    order, fit a random forest (sqrt feature subsets, unscaled features)."""
    enc = StringIndexer(inputCol="district", outputCol="kecamatan_enc",
                        stringOrderType="alphabetAsc", handleInvalid="error")
    vec = VectorAssembler(inputCols=FEATURES, outputCol="features")
    rf = RandomForestClassifier(labelCol=LABEL, featuresCol="features", numTrees=num_trees,
                                maxDepth=max_depth, featureSubsetStrategy="sqrt", seed=seed)
    return Pipeline(stages=[enc, vec, rf])


def fit_forest(matrix: DataFrame, **kw) -> PipelineModel:
    train = matrix.drop("kecamatan_enc")
    return forest_pipeline(**kw).fit(train)


def model_probability(model: PipelineModel, rows: DataFrame, out: str = "model_prob") -> DataFrame:
    """P(flood) x 100 from a fitted pipeline, vectorised over all rows."""
    scored = model.transform(rows.drop("kecamatan_enc") if "kecamatan_enc" in rows.columns else rows)
    return scored.withColumn(out, vector_to_array("probability").getItem(1) * F.lit(100.0)) \
        .drop("features", "rawPrediction", "probability", "prediction")


def feature_importance(model: PipelineModel) -> list[tuple[str, float]]:
    """M5: (feature, importance) sorted by importance (12 values)."""
    rf = model.stages[-1]
    imp = rf.featureImportances.toArray().tolist()
    return sorted(zip(FEATURES, imp), key=lambda t: (-t[1], t[0]))


def save_model(model: PipelineModel, path: str) -> None:
    """M7: persist the pipeline (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def publish_model(spark: SparkSession, model: PipelineModel, path: str, keep: int = 4) -> int:
    """M7: save the pipeline as the next version of a model folder; readers
    (``versions.committed``) see it once it is whole."""
    return commit_version(spark, path, lambda to: save_model(model, to), keep=keep)


def live_features(spark: SparkSession, scenarios: DataFrame) -> DataFrame:
    """P10 for scoring: the 12 ordered features of every scenario and district."""
    from tidewatch.operators import scoring

    rows = scoring.score(scoring.fill_live_proxies(scenarios), districts(spark), "dashboard", district_rows=DISTRICT_COUNT)
    named = dashboard_features(rows).withColumn("kecamatan_enc", F.col("district_code"))
    return named.select("scenario_id", "district", *FEATURES)


def dashboard_features(risk_rows: DataFrame) -> DataFrame:
    """P10 on scored dashboard rows: the model's feature columns under their
    reference names (the district code is re-derived by the pipeline)."""
    return risk_rows.withColumns({
        "curah_hujan_mm": F.col("rain_mm"), "curah_hujan_3hari": F.col("rain_3day_mm"),
        "kelembaban_pct": F.col("humidity_pct"), "suhu_c": F.col("temp_c"),
        "kecepatan_angin": F.col("wind_ms"), "durasi_hujan_jam": F.col("rain_duration_h"),
        "bulan": F.col("month"), "musim_hujan": F.col("wet_season"),
        "elevasi_m": F.col("elevation_m"), "koef_limpasan": F.col("runoff_coef"),
        "frekuensi_historis": F.col("flood_freq")})
