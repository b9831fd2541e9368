"""Ingest normalisation.

Everything is DataFrame -> DataFrame and works unchanged on a static table
or on a streaming DataFrame (except ``latest``/``latest_or_default``, which
are batch operators on an archive).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.functions.numeric import dbl
from tidewatch.sources.districts import CITY

# ---- fixed values: defaults of the reference ------------------------------
# missing field -> default (dashboard reader)
FIELD_DEFAULTS = {"curah_hujan_mm": 0.0, "kelembaban_pct": 80, "suhu_c": 28.0,
                  "kecepatan_angin_ms": 3.0}
# no data at all -> default weather row (batch job)
NO_DATA_ROW = {"curah_hujan_mm": 15.0, "kelembaban_pct": 80, "suhu_c": 28.0,
               "kecepatan_angin_ms": 5.0, "timestamp": "N/A"}
KMH_PER_MS = 3.6
HTTP_OK = 200
# ---------------------------------------------------------------------------

WEATHER_FIELDS = ["curah_hujan_mm", "kelembaban_pct", "suhu_c", "kecepatan_angin_ms", "timestamp"]


def split_by_status(raw: DataFrame, status_col: str = "status") -> tuple[DataFrame, DataFrame]:
    """Successful responses and the reject set (kept, not dropped)."""
    ok = F.col(status_col) == HTTP_OK
    return raw.where(ok), raw.where(~ok | F.col(status_col).isNull())


def normalize_weather(raw: DataFrame, *, body_col: str = "body", status_col: str = "status",
                      location: str = CITY, keep=("event_id",)) -> DataFrame:
    """P1 + P2 + P4: parse the API body, keep status 200, lift ``current.*``
    to the flat event schema and convert wind from km/h to m/s."""
    ok, _ = split_by_status(raw, status_col)
    cur = F.from_json(F.col(body_col), S.RAW_WEATHER).getField("current")
    return ok.select(
        *keep,
        cur.getField("time").alias("timestamp"),
        cur.getField("temperature_2m").alias("suhu_c"),
        cur.getField("relative_humidity_2m").alias("kelembaban_pct"),
        cur.getField("precipitation").alias("curah_hujan_mm"),
        (cur.getField("wind_speed_10m") / dbl(KMH_PER_MS)).alias("kecepatan_angin_ms"),
        F.lit(location).alias("lokasi"),
    )


def with_defaults(weather: DataFrame) -> DataFrame:
    """Missing (or null) fields take the reader's defaults."""
    return weather.withColumns({
        name: F.coalesce(F.col(name), F.lit(v).cast(weather.schema[name].dataType))
        for name, v in FIELD_DEFAULTS.items()})


def rejected_null_rain(weather: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weather rows with rain, and those without, which cannot be scored."""
    has = F.col("curah_hujan_mm").isNotNull()
    return weather.where(has), weather.where(~has)


def latest(weather: DataFrame, order_col: str = "timestamp",
           columns=("curah_hujan_mm", "kelembaban_pct", "suhu_c", "kecepatan_angin_ms",
                    "timestamp"),
           tie_col: str | None = None) -> DataFrame:
    """O1 + P5: newest row by ``order_col`` (one row or none).

    Planned as TakeOrderedAndProject: every task keeps its own top row and only
    those reach the final merge, so no shuffle of the archive."""
    order = [F.col(order_col).desc()] + ([F.col(tie_col).desc()] if tie_col else [])
    return weather.orderBy(*order).limit(1).select(*columns)


def latest_per_key(df: DataFrame, key: str, order_col: str, value_cols) -> DataFrame:
    """O1 per location / S9 per topic: ``max_by`` aggregate.  Partial
    aggregation reduces each task to one row per key before the shuffle, so a
    key holding most of the rows is not a hot spot."""
    packed = F.struct(*[F.col(c) for c in value_cols])
    return (df.groupBy(key)
            .agg(F.max_by(packed, F.col(order_col)).alias("_latest"),
                 F.max(order_col).alias(order_col))
            .select(key, order_col, *[F.col(f"_latest.{c}").alias(c) for c in value_cols
                                      if c != order_col]))


def latest_or_default(spark: SparkSession, weather: DataFrame, order_col: str = "timestamp",
                      tie_col: str | None = None) -> DataFrame:
    """The newest weather row, or the reference's default row when the
    archive is empty.  One plan, no driver branch: the default carries a lower
    priority and a top-1 keeps the winner."""
    cols = WEATHER_FIELDS
    top = latest(weather, order_col, columns=cols, tie_col=tie_col).withColumn("_prio", F.lit(1))
    dtypes = dict(weather.select(*cols).dtypes)
    default = spark.range(1).select(
        *[F.lit(NO_DATA_ROW[c]).cast(dtypes[c]).alias(c) for c in cols], F.lit(0).alias("_prio"))
    return top.unionByName(default).orderBy(F.desc("_prio")).limit(1).drop("_prio")


def to_scenarios(weather: DataFrame, *, id_col: str = "event_id", month_col: str | None = None,
                 ts_col: str = "timestamp") -> DataFrame:
    """P8 (live mode): flat weather events -> scenario rows.  The month is the
    event's own (N5), taken from ``month_col`` or parsed from the event time."""
    month = (f"`{month_col}`" if month_col
             else f"""month(try_to_timestamp(`{ts_col}`, "yyyy-MM-dd'T'HH:mm"))""")
    return weather.selectExpr(
        f"`{id_col}` AS scenario_id",
        "lokasi AS location",
        f"`{ts_col}` AS observed_text",
        "curah_hujan_mm AS rain_mm",
        "kelembaban_pct AS humidity_pct",
        "suhu_c AS temp_c",
        "kecepatan_angin_ms AS wind_ms",
        f"CAST({month} AS INT) AS month",
        "CAST(NULL AS DOUBLE) AS rain_3day_mm",
        "CAST(NULL AS DOUBLE) AS sunshine_h",
    )


def what_if_scenarios(inputs: DataFrame, *, location: str = CITY) -> DataFrame:
    """P8 (manual mode): user-supplied scenarios with every input explicit:
    ``scenario_id, rain_mm, rain_3day_mm, humidity_pct, temp_c, wind_ms,
    sunshine_h, month``.  Any number of what-if rows is scored in one job."""
    return inputs.select(
        "scenario_id",
        F.lit(location).alias("location"),
        F.lit("Mode Simulasi Manual").alias("observed_text"),
        F.col("rain_mm").cast("double"), F.col("humidity_pct").cast("bigint"),
        F.col("temp_c").cast("double"), F.col("wind_ms").cast("double"),
        F.col("month").cast("int"),
        F.col("rain_3day_mm").cast("double"), F.col("sunshine_h").cast("double"),
    )


def report_events(items: DataFrame, *, source: str, keep=()) -> DataFrame:
    """Feed item -> flat report event (time, title, link, constant source)."""
    return items.select(
        *keep,
        F.date_format("polled_at", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("title").alias("judul"),
        F.col("link"),
        F.lit(source).alias("sumber"),
    )


def flatten_reports(docs: DataFrame, doc_col: str | None = None) -> DataFrame:
    """One row per report of a nested report document.

    ``docs`` either has the document's ``result`` column at top level (read
    with the document schema) or a struct column ``doc_col`` holding it."""
    root = F.col(doc_col).getField("result") if doc_col else F.col("result")
    keep = [c for c in docs.columns if c not in ("result", doc_col)]
    g = F.explode(root.getField("objects").getField("output").getField("geometries"))
    rows = docs.select(*keep, g.alias("g"))
    p = F.col("g.properties")
    return rows.select(
        *keep,
        p.getField("pkey").alias("pkey"),
        p.getField("created_at").alias("created_at"),
        p.getField("source").alias("source"),
        p.getField("status").alias("status"),
        p.getField("tags").getField("flood_depth").alias("flood_depth"),
        p.getField("tags").getField("kecamatan").alias("kecamatan"),
        p.getField("text").alias("text"),
        F.col("g.geometry.coordinates").getItem(0).alias("lon"),
        F.col("g.geometry.coordinates").getItem(1).alias("lat"),
    )
