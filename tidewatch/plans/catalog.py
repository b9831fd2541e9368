"""Registered queries over the driver's tables and their DuckDB oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs over whole tables;
``ORACLE[name]`` is the equivalent SQL over the pre-registered views.
Queries without an oracle entry get the driver's weaker rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas as S
from tidewatch.operators import drift
from tidewatch.operators import evaluation as EV
from tidewatch.operators import feed as FD
from tidewatch.operators import forest as FR
from tidewatch.operators import ingest, kpi, ranking, rejects, report
from tidewatch.operators import timeseries as TS
from tidewatch.operators import scoring as SCR
from tidewatch.operators.hydrology import BATCH, DASHBOARD
from tidewatch.operators.joins import lookup_code, row_agreement
from tidewatch.plans import scoring_plans as SP
from tidewatch.plans import sqlparts as Q
from tidewatch.plans import training as TR
from tidewatch.session import materialize, scratch_path
from tidewatch.sources import archive as AR
from tidewatch.sources import dated as DA
from tidewatch.sources import publish as PB
from tidewatch.sources import seen as SN
from tidewatch.sources import testbind as TB
from tidewatch.sources import versions as V
from tidewatch.sources.districts import DISTRICT_COUNT, DISTRICT_ROWS, districts
from tidewatch.streaming import ingest as ST
from tidewatch.streaming import latest as SL
from tidewatch.streaming import rain as SR
from tidewatch.streaming import reports as RP
from tidewatch.streaming.scoring import publish_latest_scores, publish_model_scores, read_model_scores, score_weather_stream

# (topic, key, value) records as read back from a JSON topic sink
_TOPIC_RECORD = T.StructType([T.StructField("topic", T.StringType()),
                              T.StructField("key", T.StringType()),
                              T.StructField("value", T.StringType())])

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def event_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.to_scenarios(TB.weather_events(spark, sf_dir), month_col="month")


def _dealt_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenarios dealt evenly before they are scored for every district: a
    scan's splits are as uneven as the files' row groups."""
    return ranking.colocate_scenarios(event_scenarios(spark, sf_dir))


# ---------------------------------------------------------------- scoring ---

@register("batch_scores", Q.batch_result(Q.scored(Q.SCENARIOS, BATCH)))
def batch_scores(spark, sf_dir):
    """J1, H5-H14, H16, P11 over every weather event."""
    return SP.batch_scores(spark, event_scenarios(spark, sf_dir))


@register("dashboard_scores",
          Q.dashboard_result(Q.risk(Q.scored(Q.live_proxies(Q.SCENARIOS), DASHBOARD))))
def dashboard_scores(spark, sf_dir):
    """H1-H13, H17-H22, P12 (index probability as the provider)."""
    return SP.dashboard_scores(spark, event_scenarios(spark, sf_dir))


# ----------------------------------------------------------------- ingest ---

_LATEST_COLS = 'curah_hujan_mm, kelembaban_pct, suhu_c, kecepatan_angin_ms, "timestamp"'


@register("latest_weather", f"""
SELECT {_LATEST_COLS} FROM ({Q.WEATHER}) w ORDER BY event_time DESC LIMIT 1""")
def latest_weather(spark, sf_dir):
    """O1, P5: newest weather event (by full event time)."""
    return ingest.latest(TB.weather_events(spark, sf_dir), "event_time")


@register("latest_per_location", f"""
SELECT lokasi, strftime(max(event_time), '%Y-%m-%d %H:%M:%S.%f') AS event_time,
       arg_max(curah_hujan_mm, event_time) AS curah_hujan_mm,
       arg_max(kelembaban_pct, event_time) AS kelembaban_pct,
       arg_max(suhu_c, event_time) AS suhu_c,
       arg_max(kecepatan_angin_ms, event_time) AS kecepatan_angin_ms,
       arg_max("timestamp", event_time) AS "timestamp"
FROM ({Q.WEATHER}) w GROUP BY lokasi""")
def latest_per_location(spark, sf_dir):
    """O1 per location: newest event of every location with ``max_by``
    (partial aggregation keeps one row per location per task)."""
    latest = ingest.latest_per_key(TB.weather_events(spark, sf_dir), "lokasi", "event_time",
                                   ["curah_hujan_mm", "kelembaban_pct", "suhu_c",
                                    "kecepatan_angin_ms", "timestamp"])
    return latest.withColumn("event_time",
                             F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@register("latest_or_default", f"""
SELECT {_LATEST_COLS} FROM (
  SELECT {_LATEST_COLS}, 1 AS prio FROM (SELECT * FROM ({Q.WEATHER}) w ORDER BY event_time DESC LIMIT 1)
  UNION ALL
  SELECT 15.0::DOUBLE, 80::BIGINT, 28.0::DOUBLE, 5.0::DOUBLE, 'N/A', 0
) ORDER BY prio DESC LIMIT 1""")
def latest_or_default(spark, sf_dir):
    """Newest event or the default row."""
    return ingest.latest_or_default(spark, TB.weather_events(spark, sf_dir), "event_time")


_RAW_FLAT = f"""
SELECT event_id, {Q.minute_text('ts')} AS "timestamp",
  CASE WHEN event_id % 7 <> 2 THEN 24 + (event_id % 121) / 10 END AS suhu_c,
  CASE WHEN event_id % 7 <> 1 THEN 55 + user_id % 46 END AS kelembaban_pct,
  CASE WHEN event_id % 7 <> 0 THEN value / 10 END AS curah_hujan_mm,
  CASE WHEN event_id % 7 <> 3 THEN ({Q.D(3.6)} + user_id % 100) / {Q.D(3.6)} END AS kecepatan_angin_ms,
  'Surabaya' AS lokasi
FROM events WHERE event_type <> 'error'"""


@register("normalize_weather", _RAW_FLAT)
def normalize_weather(spark, sf_dir):
    """Raw API JSON -> flat weather events (status 200 only)."""
    return ingest.normalize_weather(TB.raw_weather_responses(spark, sf_dir))


@register("weather_defaults", f"""
SELECT event_id, "timestamp", COALESCE(suhu_c, 28.0::DOUBLE) AS suhu_c,
  COALESCE(kelembaban_pct, 80::BIGINT) AS kelembaban_pct,
  COALESCE(curah_hujan_mm, 0.0::DOUBLE) AS curah_hujan_mm,
  COALESCE(kecepatan_angin_ms, 3.0::DOUBLE) AS kecepatan_angin_ms, lokasi
FROM ({_RAW_FLAT}) r""")
def weather_defaults(spark, sf_dir):
    """Missing fields take the reader's defaults."""
    return ingest.with_defaults(ingest.normalize_weather(TB.raw_weather_responses(spark, sf_dir)))


@register("weather_rejects", """
SELECT event_id, 500 AS status FROM events WHERE event_type = 'error'""")
def weather_rejects(spark, sf_dir):
    """The reject set of failed API responses (kept, not dropped)."""
    _, rejected = ingest.split_by_status(TB.raw_weather_responses(spark, sf_dir))
    return rejected.select("event_id", "status")


@register("tolerant_snapshot_read", f"""
SELECT event_id, "timestamp", suhu_c, kelembaban_pct, curah_hujan_mm, kecepatan_angin_ms, lokasi
FROM ({Q.WEATHER}) w JOIN (SELECT event_id, event_type FROM events) e USING (event_id)
WHERE event_type <> 'error'""")
def tolerant_snapshot_read(spark, sf_dir):
    """S3 + S5: weather snapshot lines read tolerantly: lines that are not
    valid JSON (here the error events, written with a stray brace) are "no
    data" and dropped, never a failure."""
    w = TB.events_to_weather(TB.table(spark, sf_dir, "events"), "event_type")
    body = F.to_json(F.struct("event_id", *S.WEATHER_EVENT.fieldNames()))
    lines = w.select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("{"), body)).otherwise(body).alias("value"))
    path = scratch_path(spark, "snapshots")
    lines.write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType())] + S.WEATHER_EVENT.fields)
    return AR.read_tolerant(spark, path, schema)


# ------------------------------------------------- what-if, KPIs, ranking ---


_RISK = Q.risk(Q.scored(Q.live_proxies(Q.SCENARIOS), DASHBOARD))
_BATCH = Q.batch_result(Q.scored(Q.SCENARIOS, BATCH))


def event_risk(spark, sf_dir, colocate: bool = False) -> DataFrame:
    sc = event_scenarios(spark, sf_dir)
    if colocate:
        sc = ranking.colocate_scenarios(sc)
    return SP.dashboard_risk(spark, sc)


@register("what_if_grid", Q.dashboard_result(Q.risk(Q.scored(Q.WHAT_IF, DASHBOARD))))
def what_if_grid(spark, sf_dir):
    """P8 manual mode: one what-if scenario per event, all inputs supplied."""
    sc = ingest.what_if_scenarios(TB.what_if_inputs(spark, sf_dir))
    return SP.dashboard_scores(spark, sc)


@register("what_if_rain_month", Q.dashboard_result(Q.risk(Q.scored(Q.RAIN_MONTH_GRID, DASHBOARD))))
def what_if_rain_month(spark, sf_dir):
    """P8 manual mode over a rain x month grid (the distinct pairs observed)."""
    sc = ingest.what_if_scenarios(TB.rain_month_grid(spark, sf_dir))
    return SP.dashboard_scores(spark, sc)


_BANDS_SQL = ", ".join(
    f"{Q.band(c, hi, lo, worse)} AS {name}_band"
    for name, (c, hi, lo, worse) in Q.BANDS.items())


@register("severity_bands", f"SELECT scenario_id, district, {_BANDS_SQL} FROM ({_RISK}) r")
def severity_bands(spark, sf_dir):
    """Per-metric severity band of every result row."""
    return kpi.severity_bands(event_risk(spark, sf_dir))


@register("kpi_cards", f"""
SELECT *, CASE WHEN critical_count > 0 THEN 'danger' ELSE 'safe' END AS critical_band,
          CASE WHEN watch_count > 0 THEN 'warn' ELSE 'safe' END AS watch_band,
          {Q.band('total_people', 5000, 1000)} AS people_band,
          {Q.band('min_lead_time_h', 3, 6, False)} AS lead_band
FROM (SELECT scenario_id, count(*) AS districts,
        count(*) FILTER (WHERE probability > 70.0::DOUBLE) AS critical_count,
        count(*) FILTER (WHERE probability > 40.0::DOUBLE AND probability <= 70.0::DOUBLE) AS watch_count,
        CAST(sum(people_affected) AS BIGINT) AS total_people,
        min(lead_time_h) AS min_lead_time_h
      FROM ({_RISK}) r GROUP BY scenario_id) k""")
def kpi_cards(spark, sf_dir):
    """KPI cards per scenario."""
    return kpi.kpi_cards(event_risk(spark, sf_dir))


@register("archive_summary", f"""
SELECT count(*) AS records, arg_max(curah_hujan_mm, event_time) AS curah_hujan_mm,
       arg_max(kelembaban_pct, event_time) AS kelembaban_pct, arg_max(suhu_c, event_time) AS suhu_c,
       arg_max(kecepatan_angin_ms, event_time) AS kecepatan_angin_ms,
       arg_max("timestamp", event_time) AS "timestamp"
FROM ({Q.WEATHER}) w""")
def archive_summary(spark, sf_dir):
    """A1 + O1 in one pass over the archive."""
    return kpi.archive_summary(TB.weather_events(spark, sf_dir), "event_time",
                               ["curah_hujan_mm", "kelembaban_pct", "suhu_c",
                                "kecepatan_angin_ms", "timestamp"])


@register("sorted_by_probability", f"""
SELECT scenario_id, "Kecamatan", "Probabilitas",
  CAST(row_number() OVER (PARTITION BY scenario_id ORDER BY "Probabilitas" DESC, "Kecamatan") AS INTEGER) AS rank
FROM ({_BATCH}) b""")
def sorted_by_probability(spark, sf_dir):
    """O2: batch result order (rounded probability descending, then name)."""
    sc = ranking.colocate_scenarios(event_scenarios(spark, sf_dir))
    res = SP.batch_scores(spark, sc).select("scenario_id", "Kecamatan", "Probabilitas")
    return ranking.rank_within(res, ["scenario_id"],
                               [F.col("Probabilitas").desc(), F.col("Kecamatan").asc()])


_SERIES = {"probability": "probability", "depth": "depth_m", "people": "people_affected",
           "lead_time": "lead_time_h", "pct_area": "pct_area_r1", "risk_score": "risk_score"}
_SERIES_SQL = " UNION ALL ".join(
    f"SELECT scenario_id, district, '{s}' AS series, CAST({c} AS DOUBLE) AS value FROM r"
    for s, c in _SERIES.items())


@register("metric_series", f"""
WITH r AS ({_RISK})
SELECT scenario_id, district, series, value,
  CAST(row_number() OVER (PARTITION BY scenario_id, series ORDER BY value, district) AS INTEGER) AS position
FROM ({_SERIES_SQL}) s""")
def metric_series(spark, sf_dir):
    """O3: ascending chart order of six metrics per scenario."""
    return ranking.metric_series(event_risk(spark, sf_dir, colocate=True), _SERIES)


_PRIO = "risk_score DESC, probability DESC, district"


@register("top5_priority", f"""
SELECT scenario_id, rank, 6 - rank AS chart_position, district, risk_score,
  printf('%s jiwa | %s%% wilayah | %d jam', {Q.thousands('people_affected')},
         {Q.fixed('pct_area_r1', 0)}, lead_time_h) AS note
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY scenario_id ORDER BY {_PRIO}) AS INTEGER) AS rank
      FROM ({_RISK}) r) t WHERE rank <= 5""")
def top5_priority(spark, sf_dir):
    """Top five by composite score with the bar annotation."""
    return report.top5_priority(event_risk(spark, sf_dir, colocate=True))


@register("top3_recommendations", f"""
SELECT scenario_id, string_agg(line, chr(10) || chr(10) ORDER BY rank) AS recommendation
FROM (SELECT scenario_id, rank,
        printf({Q.sq(Q.RECOMMENDATION)}, rank, district, {Q.fixed('risk_score', 1)},
               priority, {Q.fixed('depth_m', 2)}, {Q.fixed('pct_area_r1', 0)},
               {Q.thousands('people_affected')}, lead_time_h) AS line
      FROM (SELECT *, CAST(row_number() OVER (PARTITION BY scenario_id ORDER BY {_PRIO}) AS INTEGER) AS rank
            FROM ({_RISK}) r) t WHERE rank <= 3) l
GROUP BY scenario_id""")
def top3_recommendations(spark, sf_dir):
    """Numbered recommendation text per scenario."""
    return report.top3_recommendations(event_risk(spark, sf_dir, colocate=True))


@register("display_table", Q.DISPLAY.replace("{0}", Q.dashboard_result(_RISK)))
def display_table(spark, sf_dir):
    """the whole detail table rendered with display units, in order."""
    sc = ranking.colocate_scenarios(event_scenarios(spark, sf_dir))
    return report.display_table(SP.dashboard_scores(spark, sc))


# ------------------------------------------------ rejects, cities, features ---

_RAW_SCENARIOS = f"""
SELECT event_id AS scenario_id, lokasi AS location, "timestamp" AS observed_text, curah_hujan_mm AS rain_mm,
       kelembaban_pct AS humidity_pct, suhu_c AS temp_c, kecepatan_angin_ms AS wind_ms,
       CAST(substr("timestamp", 6, 2) AS INTEGER) AS month,
       CAST(NULL AS DOUBLE) AS rain_3day_mm, CAST(NULL AS DOUBLE) AS sunshine_h
FROM ({_RAW_FLAT}) r"""


def _raw_scenarios(spark, sf_dir) -> DataFrame:
    return ingest.to_scenarios(ingest.normalize_weather(TB.raw_weather_responses(spark, sf_dir)))


@register("scores_with_missing_rain",
          Q.batch_result(Q.scored(f"SELECT * FROM ({_RAW_SCENARIOS}) s WHERE rain_mm IS NOT NULL", BATCH)))
def scores_with_missing_rain(spark, sf_dir):
    """Normalised API responses, some without rain: those are not scored."""
    return SP.batch_scores(spark, _raw_scenarios(spark, sf_dir))


@register("score_rejects", f"""
SELECT scenario_id, observed_text, 'missing rain' AS reason FROM ({_RAW_SCENARIOS}) s WHERE rain_mm IS NULL""")
def score_rejects(spark, sf_dir):
    """The scenarios that scoring leaves out, with the reason."""
    _, rejects = SCR.split_scorable(_raw_scenarios(spark, sf_dir))
    return rejects.select("scenario_id", "observed_text", "reason")


@register("multi_city_scores", Q.batch_result(Q.scored(Q.CITY_SCENARIOS, BATCH, districts=Q.CITY_DISTRICTS)))
def multi_city_scores(spark, sf_dir):
    """J1 with the location from the data: an equi-join of weather and districts."""
    sc = ingest.to_scenarios(TB.city_weather(spark, sf_dir), month_col="month")
    return SP.batch_scores(spark, sc, TB.city_districts(spark), TB.CITY_COUNT * DISTRICT_COUNT)


def _features_sql(scenarios: str, mode: str) -> str:
    return f"""
SELECT '{mode}' AS mode, scenario_id, district, rain_mm AS curah_hujan_mm, rain_3day_mm AS curah_hujan_3hari,
  humidity_pct AS kelembaban_pct, temp_c AS suhu_c, wind_ms AS kecepatan_angin, rain_duration_h AS durasi_hujan_jam,
  month AS bulan, wet_season AS musim_hujan, elevation_m AS elevasi_m, runoff_coef AS koef_limpasan,
  flood_freq AS frekuensi_historis, district_code AS kecamatan_enc
FROM ({Q.scored(Q.live_proxies(scenarios), DASHBOARD)}) f"""


@register("live_features", f"{_features_sql(Q.SCENARIOS, 'live')} UNION ALL {_features_sql(Q.WHAT_IF, 'manual')}")
def live_features(spark, sf_dir):
    """P10, H1-H4: the model's 12 features of every live and what-if row."""
    live = TR.live_features(spark, event_scenarios(spark, sf_dir)).withColumn("mode", F.lit("live"))
    manual = TR.live_features(spark, ingest.what_if_scenarios(TB.what_if_inputs(spark, sf_dir)))
    return live.unionByName(manual.withColumn("mode", F.lit("manual")))


@register("latest_or_default_missing", """
SELECT 15.0::DOUBLE AS curah_hujan_mm, 80::BIGINT AS kelembaban_pct, 28.0::DOUBLE AS suhu_c,
       5.0::DOUBLE AS kecepatan_angin_ms, 'N/A' AS "timestamp" WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_id < 0)""")
def latest_or_default_missing(spark, sf_dir):
    """No event qualifies and the archive of a fresh deployment is absent:
    the default row."""
    absent = AR.read_weather_archive(spark, scratch_path(spark, "no-archive") + "/*.json")
    none = TB.weather_events(spark, sf_dir).where("event_id < 0").select(absent.columns)
    return ingest.latest_or_default(spark, none.unionByName(absent), "timestamp")


# ------------------------------------------------------- feed and topics ---


_FEED = f"""
SELECT page_id, CAST(floor(page_id / 10) AS BIGINT) AS poll_id, CAST(page_id % 10 AS INTEGER) AS position,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(floor(page_id / 10) AS BIGINT) * 300) AS polled_at,
  regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
  regexp_extract(url, '^https?://([^/?#]+)', 1) AS link
FROM pages"""
_REPORT_COLS = f"""strftime(polled_at, '%Y-%m-%dT%H:%M:%S') AS "timestamp", title AS judul, link,
  '{TB.REPORT_SOURCE}' AS sumber, md5(link) AS link_md5"""


def _report_events(df: DataFrame) -> DataFrame:
    return ingest.report_events(df, source=TB.REPORT_SOURCE, keep=("poll_id", "position")) \
        .withColumn("link_md5", F.md5("link"))


@register("feed_top5", f"""
SELECT poll_id, position, rank, title, link, md5(link) AS link_md5 FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY poll_id ORDER BY position) AS INTEGER) AS rank
  FROM ({_FEED}) f) t WHERE rank <= 5""")
def feed_top5(spark, sf_dir):
    """First five items of every poll."""
    top = FD.first_items_per_poll(TB.feed_items(spark, sf_dir))
    return FD.with_link_hash(top).select("poll_id", "position", "rank", "title", "link", "link_md5")


@register("feed_dedup", f"""
SELECT poll_id, position, {_REPORT_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY md5(link) ORDER BY poll_id, position) AS k
  FROM ({_FEED}) f) t WHERE k = 1""")
def feed_dedup(spark, sf_dir):
    """Every link once, at its first position in the feed."""
    return _report_events(FD.first_sighting(FD.with_link_hash(TB.feed_items(spark, sf_dir))))


@register("feed_new_only", f"""
SELECT poll_id, position, {_REPORT_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY md5(link) ORDER BY poll_id, position) AS k
  FROM (SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY poll_id ORDER BY position) AS r FROM ({_FEED}) f)
        WHERE r <= 5) c) t WHERE k = 1""")
def feed_new_only(spark, sf_dir):
    """O6 + J3 + A12: what the producer publishes over the whole feed history."""
    return _report_events(FD.new_reports(TB.feed_items(spark, sf_dir)))


_HALF = f"(SELECT (max(poll_id) + 1) // 2 FROM ({_FEED}) h)"


@register("feed_exclude_published", f"""
SELECT n.* FROM ({ORACLE['feed_new_only']}) n
WHERE n.link_md5 NOT IN (SELECT md5(link) FROM (
  SELECT *, row_number() OVER (PARTITION BY poll_id ORDER BY position) AS r FROM ({_FEED}) f) c
  WHERE r <= 5 AND poll_id < {_HALF})""")
def feed_exclude_published(spark, sf_dir):
    """New reports of the whole feed but those that a first run, over the
    first half of the polls, has already written to the archive."""
    items = TB.feed_items(spark, sf_dir)
    half = items.agg(F.expr("(max(poll_id) + 1) div 2").alias("half"))
    early = items.join(F.broadcast(half), F.col("poll_id") < F.col("half"), "left_semi")
    path = scratch_path(spark, "published")
    FD.new_reports(early).select("link_md5").write.parquet(path)
    archive = spark.read.schema("link_md5 string").parquet(path)
    return _report_events(FD.new_reports(items, archive))


def _event_records(spark, sf_dir) -> DataFrame:
    """Topic records bound from ``events`` (topic = prefix + event type)."""
    ev = TB.table(spark, sf_dir, "events")
    topic = F.concat(F.lit("tidewatch-"), F.col("event_type"))
    return ev.select("event_id", "ts", topic.alias("topic"),
                     F.col("event_id").cast("string").alias("key"),
                     F.to_json(F.struct("event_id", "user_id", "value", "props")).alias("value"))


@register("topic_route", """
SELECT event_id, 'tidewatch-' || event_type AS topic, event_type AS dataset,
       CAST(event_id AS VARCHAR) AS key
FROM events""")
def topic_route(spark, sf_dir):
    """Route every record to the dataset named by its topic."""
    return PB.with_dataset(_event_records(spark, sf_dir)).select("event_id", "topic", "dataset", "key")


@register("latest_per_topic", """
SELECT 'tidewatch-' || event_type AS topic, event_type AS dataset,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS event_time,
       CAST(arg_max(event_id, ts) AS VARCHAR) AS key
FROM events GROUP BY event_type""")
def latest_per_topic(spark, sf_dir):
    """Newest record of every topic (snapshot contents)."""
    latest = PB.latest_per_topic(_event_records(spark, sf_dir), "ts")
    return latest.select("topic", "dataset",
                         F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"), "key")


@register("report_flatten", f"""
SELECT doc_id, 'ID-' || doc_id || '-' || i AS pkey,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id), '%Y-%m-%dT%H:%M:%SZ') AS created_at,
  source, CASE WHEN lang = 'en' THEN 'confirmed' ELSE 'pending' END AS status,
  CAST(length(line) % 100 AS BIGINT) AS flood_depth,
  {Q.district_name_by_index('(doc_id + i) % 15 + 1')} AS kecamatan,
  line AS text,
  {Q.D(112.6)} + (doc_id % 100) / 1000 AS lon,
  {Q.D(-7.2)} - (i % 100) / 1000 AS lat
FROM (SELECT doc_id, source, lang, UNNEST(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) t""")
def report_flatten(spark, sf_dir):
    """Parse nested report documents and flatten every report."""
    docs = AR.parse_report_documents(TB.report_documents(spark, sf_dir), "json")
    return ingest.flatten_reports(docs.drop("json"), doc_col="doc")


@register("report_variant", ORACLE["report_flatten"])
def report_variant(spark, sf_dir):
    """Report documents as VARIANT, every field read by its path."""
    return drift.flatten(drift.reports(TB.report_documents(spark, sf_dir)))


@register("report_field_types", f"""
SELECT field, type, count(*) AS n
FROM ({ORACLE['report_flatten']}) r, (VALUES ('pkey', 'STRING'), ('created_at', 'STRING'), ('source', 'STRING'),
  ('status', 'STRING'), ('tags', 'OBJECT'), ('text', 'STRING'), ('tags.flood_depth', 'BIGINT'),
  ('tags.kecamatan', 'STRING')) f(field, type)
WHERE field <> 'source' OR source IS NOT NULL GROUP BY field, type""")
def report_field_types(spark, sf_dir):
    """The fields and types that reports hold, by exploded VARIANTs."""
    return drift.field_types(drift.reports(TB.report_documents(spark, sf_dir)))


_DOC_SQL = f"""
SELECT scenario_id, CAST(row_number() OVER (PARTITION BY scenario_id ORDER BY probability_r1 DESC, district) AS INTEGER) AS position,
  observed_text AS waktu, rain_mm AS curah_hujan, temp_c AS suhu, wind_ms AS angin,
  district AS "Kecamatan", status AS "Status", probability_r1 AS "Probabilitas",
  depth_m AS "Tinggi_Genangan_m", people_affected AS "Penduduk_Terdampak", lead_time_h AS "Lead_Time_jam"
FROM (SELECT *, {Q.rnd('probability', 1)} AS probability_r1 FROM ({Q.scored(Q.SCENARIOS, BATCH)}) s) t"""


@register("result_document", _DOC_SQL)
def result_document(spark, sf_dir):
    """Nested result document per scenario, written by the
    sink, read back and unnested."""
    scored = SCR.score(ranking.colocate_scenarios(event_scenarios(spark, sf_dir)),
                       districts(spark), "batch", district_rows=DISTRICT_COUNT)
    docs = report.result_documents(scored)
    path = scratch_path(spark, "documents")
    PB.write_documents(docs, path, key="scenario_id", compression="gzip")
    back = PB.read_documents(spark, path, keep="scenario_id long")
    rows = back.select("scenario_id", "cuaca_referensi", F.posexplode("prediksi_kecamatan").alias("i", "p"))
    return rows.select(
        "scenario_id", (F.col("i") + 1).cast("int").alias("position"),
        F.col("cuaca_referensi.waktu").alias("waktu"),
        F.col("cuaca_referensi.curah_hujan").alias("curah_hujan"),
        F.col("cuaca_referensi.suhu").alias("suhu"),
        F.col("cuaca_referensi.angin").alias("angin"),
        "p.Kecamatan", "p.Status", "p.Probabilitas", "p.Tinggi_Genangan_m",
        "p.Penduduk_Terdampak", "p.Lead_Time_jam")


@register("result_roundtrip", _BATCH)
def result_roundtrip(spark, sf_dir):
    """Batch results written as JSON lines (replace) and read back."""

    path = scratch_path(spark, "results")
    PB.write_results(SP.batch_scores(spark, _dealt_scenarios(spark, sf_dir)), path, compression="gzip")
    return PB.read_results(spark, path, keep="scenario_id long")


# -------------------------------------------- history, labels, training ---


def _day(c: str = "date"):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def _sday(c: str = "date") -> str:
    return f"strftime({c}, '%Y-%m-%d') AS {c}"


def labelled(spark, sf_dir) -> DataFrame:
    return TS.labelled_days(TB.daily_weather(spark, sf_dir), TB.confirmed_flood_dates(spark, sf_dir),
                            TB.FLOOD_DATE_COUNT)


def matrix(spark, sf_dir, reused: bool = True) -> DataFrame:
    """Training matrix.  When the plan reads it more than once (date index,
    folds, model fits) the small labelled daily history (one row per day) is
    checkpointed first, so the large tables are scanned once."""
    days = labelled(spark, sf_dir)
    return TR.training_matrix(spark, days=materialize(days) if reused else days)


@register("rain_3day", f"SELECT location, {_sday()}, rain_mm, rain_3day_mm FROM ({Q.RAIN3}) r")
def rain_3day(spark, sf_dir):
    """Trailing three-calendar-day rain total per location."""
    d = TS.rolling_sum_days(TB.daily_weather(spark, sf_dir), "rain_mm", "rain_3day_mm")
    return d.select("location", _day(), "rain_mm", "rain_3day_mm")


@register("flood_label", f"""
SELECT location, {_sday()}, rain_mm, rain_3day_mm, confirmed, flood, month, wet_season
FROM ({Q.LABELLED}) l""")
def flood_label(spark, sf_dir):
    """Daily flood label (3-day rain > 80 mm or confirmed)."""
    return labelled(spark, sf_dir).select("location", _day(), "rain_mm", "rain_3day_mm",
                                          "confirmed", "flood", "month", "wet_season")


@register("dataset_profile", f"""
SELECT count(*) AS days, count(*) FILTER (WHERE rain_mm > 0) AS rainy_days, max(rain_mm) AS max_rain_mm,
       strftime(min(date), '%Y-%m-%d') AS first_date, strftime(max(date), '%Y-%m-%d') AS last_date,
       CAST(sum(flood) AS BIGINT) AS flood_days
FROM ({Q.LABELLED}) l""")
def dataset_profile(spark, sf_dir):
    """Days, rainy days, max rain, flood days, date range."""
    p = kpi.dataset_profile(None, labelled(spark, sf_dir))
    return p.withColumns({"first_date": F.date_format("first_date", "yyyy-MM-dd"),
                          "last_date": F.date_format("last_date", "yyyy-MM-dd")})


_MATRIX_COLS = ["district", *TR.FEATURES, "label"]


@register("training_matrix", f"SELECT {_sday()}, {', '.join(_MATRIX_COLS)} FROM ({Q.MATRIX}) m")
def training_matrix(spark, sf_dir):
    """Labelled days x districts with the ordered features."""
    return matrix(spark, sf_dir, reused=False).select(_day(), *_MATRIX_COLS)


@register("time_split", f"""
SELECT {_sday()}, CASE WHEN row_number() OVER (ORDER BY date)
    > count(*) OVER () - CAST(ceil(count(*) OVER () * 0.2::DOUBLE) AS BIGINT) THEN 'test' ELSE 'train' END AS role
FROM (SELECT DISTINCT date FROM ({Q.DAILY}) d) x""")
def time_split(spark, sf_dir):
    """Chronological hold-out, last 20 % of the dates."""
    days = materialize(TB.daily_weather(spark, sf_dir).select("date"))
    return TS.chronological_split(days).select(_day(), "role")


@register("time_folds", f"""
SELECT {_sday()}, tile, CAST(fold AS INTEGER) AS fold,
       CASE WHEN fold = tile - 1 THEN 'test' ELSE 'train' END AS role
FROM ({Q.tiles(Q.DAILY, 6)}) t, range(1, 6) r(fold) WHERE fold >= tile - 1""")
def time_folds(spark, sf_dir):
    """Expanding five-fold time-series split on dates."""
    days = materialize(TB.daily_weather(spark, sf_dir).select("date"))
    return TS.time_series_folds(days).select(_day(), "tile", "fold", "role")


_CLS = """
SELECT l.doc_id, CAST(1 - quality AS INTEGER) AS y, (n_chars % 101) / 100 AS score
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def _ratio(a: str, b: str) -> str:
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0.0), 0.0)"


_CC = f"""
SELECT count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
       count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn
FROM (SELECT y, CAST(score >= {Q.D(Q.THRESHOLD)} AS INTEGER) AS pred FROM ({_CLS}) c) p"""


def _cls_row(label: int, hit: str, fpos: str, miss: str) -> str:
    p, r = _ratio(hit, f"{hit} + {fpos}"), _ratio(hit, f"{hit} + {miss}")
    return (f"SELECT {label} AS class, '{Q.CLASS_NAMES[label]}' AS name, {p} AS precision, {r} AS recall, "
            f"{_ratio(f'2.0::DOUBLE * ({p}) * ({r})', f'({p}) + ({r})')} AS f1, "
            f"{hit} + {miss} AS support, {hit} AS correct FROM cc")


_REPORT = f"WITH cc AS ({_CC}) {_cls_row(0, 'tn', 'fn', 'fp')} UNION ALL {_cls_row(1, 'tp', 'fp', 'fn')}"


@register("confusion_report", _REPORT)
def confusion_report(spark, sf_dir):
    """Per-class precision / recall / F1 / support at threshold 0.465."""
    return EV.class_report(EV.predict(TB.classifier_scores(spark, sf_dir)))


def _avg_rows() -> str:
    w = lambda m: f"({m}0 * s0 + {m}1 * s1) / CAST(total AS DOUBLE)"
    mc = lambda m: f"({m}0 + {m}1) / 2.0::DOUBLE"
    return f"""
WITH r AS ({_REPORT}),
a AS (SELECT CAST(sum(support) AS BIGINT) AS total, sum(correct) AS correct,
  {', '.join(f'sum(CASE WHEN class = {k} THEN {m} END) AS {m}{k}' for m in ('precision', 'recall', 'f1') for k in (0, 1))},
  {', '.join(f'sum(CASE WHEN class = {k} THEN support END) AS s{k}' for k in (0, 1))}
  FROM r)
SELECT 'accuracy' AS average, CAST(NULL AS DOUBLE) AS precision, CAST(NULL AS DOUBLE) AS recall,
       CAST(correct AS DOUBLE) / CAST(total AS DOUBLE) AS f1, total AS support FROM a
UNION ALL SELECT 'macro avg', {mc('precision')}, {mc('recall')}, {mc('f1')}, total FROM a
UNION ALL SELECT 'weighted avg', {w('precision')}, {w('recall')}, {w('f1')}, total FROM a"""


@register("report_averages", _avg_rows())
def report_averages(spark, sf_dir):
    """Accuracy, macro and weighted averages of the class report."""
    return EV.report_averages(EV.class_report(EV.predict(TB.classifier_scores(spark, sf_dir))))


@register("auc_rank_sum", Q.auc_sql(_CLS))
def auc_rank_sum(spark, sf_dir):
    """Exact ROC AUC (rank sum with mid-ranks)."""
    return EV.auc(TB.classifier_scores(spark, sf_dir))


_ROC = f"""
SELECT score AS threshold, "P" - pos_below AS tp, "N" - neg_below AS fp,
  {_ratio('"P" - pos_below', '"P"')} AS tpr, {_ratio('"N" - neg_below', '"N"')} AS fpr
FROM ({Q.score_counts_sql(_CLS)}) c"""


@register("roc_curve", _ROC)
def roc_curve(spark, sf_dir):
    """Cumulative true / false positives per threshold."""
    return EV.roc_curve(TB.classifier_scores(spark, sf_dir))


def _best_sql(roc: str) -> str:
    return f"""
SELECT threshold, fbeta, precision, recall FROM (
  SELECT *, {_ratio('(1.0::DOUBLE + 2.25::DOUBLE) * precision * recall', '2.25::DOUBLE * precision + recall')} AS fbeta
  FROM (SELECT *, {_ratio('tp', 'tp + fp')} AS precision, tpr AS recall FROM ({roc}) r) x) y
ORDER BY fbeta DESC, threshold ASC LIMIT 1"""


_FB = _best_sql(_ROC)


@register("best_fbeta", _FB)
def best_fbeta(spark, sf_dir):
    """Threshold maximising F-beta (beta = 1.5)."""
    return EV.best_threshold(EV.roc_curve(TB.classifier_scores(spark, sf_dir)))


_FOLD_TEST = f"""
SELECT m.*, label AS y, t.tile - 1 AS fold FROM ({Q.index_score(Q.MATRIX)}) m
JOIN ({Q.tiles(Q.DAILY, 6)}) t ON m.date = t.date WHERE t.tile >= 2"""

_FOLD_METRICS = f"""
WITH a AS ({Q.auc_sql(_FOLD_TEST, 'fold')}),
cc AS (SELECT fold, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
        count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn
       FROM (SELECT fold, y, CAST(score >= {Q.D(Q.THRESHOLD)} AS INTEGER) AS pred FROM ({_FOLD_TEST}) f) p
       GROUP BY fold),
m AS (SELECT fold, {_ratio('tp + tn', 'tp + fp + fn + tn')} AS accuracy,
        {_ratio('2.0::DOUBLE * (' + _ratio('tp', 'tp + fp') + ') * (' + _ratio('tp', 'tp + fn') + ')',
                '(' + _ratio('tp', 'tp + fp') + ') + (' + _ratio('tp', 'tp + fn') + ')')} AS f1 FROM cc)
SELECT CAST(a.fold AS INTEGER) AS fold, auc, accuracy, f1 FROM a JOIN m ON a.fold = m.fold"""


@register("fold_metrics", _FOLD_METRICS)
def fold_metrics(spark, sf_dir):
    """M4 (index score): AUC, accuracy and F1 on every fold's test dates."""
    return TR.fold_metrics(matrix(spark, sf_dir))


@register("fold_summary", f"""
SELECT count(*) AS folds,
  {', '.join(f"{Q.rnd(f'avg({c})', 4)} AS {c}_mean, {Q.rnd(f'stddev_pop({c})', 4)} AS {c}_std" for c in ('auc', 'accuracy', 'f1'))}
FROM ({_FOLD_METRICS}) f""")
def fold_summary(spark, sf_dir):
    """A10: fold mean and population standard deviation (4 places)."""
    return EV.mean_std(TR.fold_metrics(matrix(spark, sf_dir)), ["auc", "accuracy", "f1"])


@register("cv_threshold", _best_sql(_ROC.replace(Q.score_counts_sql(_CLS), Q.score_counts_sql(_FOLD_TEST))))
def cv_threshold(spark, sf_dir):
    """A11, M4 (index score): the F1.5 threshold over the pooled test folds."""
    scored = TR.index_score(matrix(spark, sf_dir)).withColumnRenamed(TR.LABEL, "y")
    test = TS.time_series_folds(scored.select("date", "y", "score")).where(F.col("role") == "test")
    return EV.best_threshold(EV.roc_curve(test))


@register("rf_support", f"""
WITH s AS (SELECT date, CASE WHEN row_number() OVER (ORDER BY date)
      > count(*) OVER () - CAST(ceil(count(*) OVER () * 0.2::DOUBLE) AS BIGINT) THEN 'test' ELSE 'train' END AS role
    FROM (SELECT DISTINCT date FROM ({Q.DAILY}) d) x)
SELECT role, label, count(*) AS support, count(DISTINCT m.date) AS dates
FROM ({Q.MATRIX}) m JOIN s ON m.date = s.date GROUP BY role, label""")
def rf_support(spark, sf_dir):
    """Rows and dates of each class in the forest's training and test parts."""
    split = TS.chronological_split(matrix(spark, sf_dir))
    return split.groupBy("role", F.col(TR.LABEL)).agg(F.count(F.lit(1)).alias("support"), F.countDistinct("date").alias("dates"))


# -------------------------------------------------------------- streaming ---


def _stream_of(spark, sf_dir, name):
    """A table as a file stream, whether it is one file or a folder of part files."""
    schema, path = TB.table(spark, sf_dir, name).schema, f"{sf_dir.rstrip('/')}/{name}.parquet"
    if V.is_folder(spark, path):
        return ST.files_stream(spark, path, schema)
    return ST.files_stream(spark, sf_dir, schema, glob=f"{name}.parquet")


def _event_records_stream(spark, sf_dir):
    ev = _stream_of(spark, sf_dir, "events")
    topic = F.concat(F.lit("tidewatch-"), F.col("event_type"))
    return ev.select("event_id", "ts", topic.alias("topic"),
                     F.col("event_id").cast("string").alias("key"),
                     F.to_json(F.struct("event_id", "user_id", "value", "props")).alias("value"))


@register("stream_archive", ORACLE["topic_route"])
def stream_archive(spark, sf_dir):
    """Streamed topic records archived once per
    dataset (file sink + checkpoint), read back."""
    out, ck = scratch_path(spark, "archive"), scratch_path(spark, "archive-ck")
    ST.run_to_end(ST.archive_records(_event_records_stream(spark, sf_dir), out, ck))
    return spark.read.parquet(out).select("event_id", "topic", "dataset", "key")


def _dated_archive(spark, sf_dir) -> tuple[str, T.StructType]:
    """The event records archived by dataset and day in several micro-batches,
    then compacted."""
    replay, out, ck = (scratch_path(spark, n) for n in ("dated-replay", "dated", "dated-ck"))
    records = _event_records(spark, sf_dir)
    TB.write_replay(records, replay, "key", 4)
    stream = ST.files_stream(spark, replay, records.schema, max_files_per_trigger=1)
    ST.run_to_end(DA.archive_stream(stream, out, ck))
    DA.compact(spark, out, records.schema)
    return out, records.schema


@register("dated_archive", """
SELECT event_id, 'tidewatch-' || event_type AS topic, event_type AS dataset,
       strftime(ts, '%Y-%m-%d') AS "day", CAST(event_id AS VARCHAR) AS key
FROM events""")
def dated_archive(spark, sf_dir):
    """A stream archived by dataset and day, compacted under a commit
    manifest, read back."""
    out, schema = _dated_archive(spark, sf_dir)
    return DA.read(spark, out, schema).select("event_id", "topic", "dataset", "day", "key")


@register("dated_archive_latest", """
SELECT event_type AS dataset, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS event_time,
       CAST(arg_max(event_id, ts) AS VARCHAR) AS key
FROM events GROUP BY event_type""")
def dated_archive_latest(spark, sf_dir):
    """O1: the newest record of every dataset, from the files of its newest day."""
    out, schema = _dated_archive(spark, sf_dir)
    names = sorted({DA._place(u)[0] for u in DA.manifest(spark, out)[1]["units"]})
    rows = [DA.latest(spark, out, schema, n) for n in names]
    every = reduce(DataFrame.unionByName, rows) if rows else DA.read(spark, out, schema)
    return every.select("dataset", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"), "key")


@register("report_snapshot", f"""
SELECT pkey, created_at, source, status, flood_depth, kecamatan, text, lon, lat
FROM ({ORACLE['report_flatten']}) r
WHERE doc_id IN (SELECT max(doc_id) FROM documents GROUP BY source)""")
def report_snapshot(spark, sf_dir):
    """The newest nested report document of every source, published as a file
    of multi-line JSON, read back by the tolerant snapshot reader and flattened."""
    path = scratch_path(spark, "report-snapshot")
    newest = TB.table(spark, sf_dir, "documents").groupBy("source").agg(F.max("doc_id").alias("doc_id"))
    docs = AR.parse_report_documents(TB.report_documents(spark, sf_dir).join(newest, "doc_id"), "json")
    PB.write_snapshots(docs.select(F.col("source").alias("dataset"), F.to_json("doc", {"pretty": "true"}).alias("value")), path)
    return ingest.flatten_reports(AR.read_report_snapshot(spark, path))


@register("stream_snapshot", ORACLE["latest_per_topic"])
def stream_snapshot(spark, sf_dir):
    """Newest record per topic kept by an idempotent foreachBatch sink."""
    out, ck = scratch_path(spark, "snapshot"), scratch_path(spark, "snapshot-ck")
    ST.run_to_end(ST.snapshot_latest(_event_records_stream(spark, sf_dir), out, ck, order_col="ts"))
    snap = ST.read_snapshot(spark, out)
    return snap.select("topic", "dataset",
                       F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"), "key")


@register("stream_dedup", """
SELECT DISTINCT md5(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS link_md5,
       regexp_extract(url, '^https?://([^/?#]+)', 1) AS link
FROM pages""")
def stream_dedup(spark, sf_dir):
    """Streamed feed items de-duplicated by link hash (state bounded
    by a watermark on the poll time), read back."""
    items = FD.with_link_hash(TB.pages_to_feed(_stream_of(spark, sf_dir, "pages")))
    # watermarks need TIMESTAMP (not TIMESTAMP_NTZ)
    items = items.withColumn("polled_ts", F.col("polled_at").cast("timestamp"))
    new = ST.dedup_keys(items, "link_md5", event_time="polled_ts", horizon=ST.DEDUP_HORIZON)
    out, ck = scratch_path(spark, "dedup"), scratch_path(spark, "dedup-ck")
    ST.run_to_end(ST.start(new.select("link_md5", "link", "poll_id", "position"),
                           sink="parquet", path=out, checkpoint=ck))
    return spark.read.parquet(out).select("link_md5", "link")


@register("stream_scores", ORACLE["batch_scores"])
def stream_scores(spark, sf_dir):
    """Every streamed weather event scored against all districts
    (stream-static broadcast join), read back."""
    weather = TB.events_to_weather(_stream_of(spark, sf_dir, "events"))
    scored = score_weather_stream(spark, weather, month_col="month",
                                  partitions=spark.sparkContext.defaultParallelism)
    out, ck = scratch_path(spark, "scores"), scratch_path(spark, "scores-ck")
    ST.run_to_end(ST.start(scored, sink="parquet", path=out, checkpoint=ck))
    return spark.read.parquet(out)


_NEWEST = Q.SCENARIOS.replace("FROM (" + Q.WEATHER + ") w",
                              "FROM (SELECT * FROM (" + Q.WEATHER + ") w0 ORDER BY event_time DESC LIMIT 1) w")


@register("stream_latest_scores", f"""
SELECT "Kecamatan", "Status", "Probabilitas", "Tinggi_Genangan_m", "Penduduk_Terdampak", "Lead_Time_jam"
FROM ({Q.batch_result(Q.scored(_NEWEST, BATCH))}) b""")
def stream_latest_scores(spark, sf_dir):
    """The published result table after the stream of all events:
    the newest event overall, scored."""
    weather = TB.events_to_weather(_stream_of(spark, sf_dir, "events"))
    out, ck = scratch_path(spark, "live"), scratch_path(spark, "live-ck")
    ST.run_to_end(publish_latest_scores(spark, weather, out, ck, order_col="event_time"))
    newest = ST._versions(spark, f"{out}/results")[-1]
    return PB.read_results(spark, f"{out}/results/v={newest}")


#: buckets of the table of seen links
SHUFFLE_BUCKETS = 16
#: parts that a replayed history arrives in, in order
_REPLAY_ARRIVALS = 8


@register("stream_rain_3day", f"""
SELECT location, {_sday()}, rain_mm, rain_3day_mm, confirmed, flood FROM ({Q.LABELLED}) l
WHERE date <= (SELECT max(date) FROM ({Q.DAILY}) d) - INTERVAL 3 DAY""")
def stream_rain_3day(spark, sf_dir):
    """W2, J5, H23 on a stream: the station's days arrive in date order, a few
    files a trigger; closed windows (here all but the last three days, as rain
    may be two days late) with their 3-day total and flood label."""
    feed, out, ck = (scratch_path(spark, x) for x in ("rain-feed", "rain", "rain-ck"))
    daily = TB.daily_weather(spark, sf_dir)
    TB.write_replay(daily, feed, "date", _REPLAY_ARRIVALS)
    stream = ST.files_stream(spark, feed, daily.schema, max_files_per_trigger=3)
    days = SR.labelled_stream(stream, TB.confirmed_flood_dates(spark, sf_dir), TB.FLOOD_DATE_COUNT)
    ST.run_to_end(ST.start(days, sink="parquet", path=out, checkpoint=ck))
    return spark.read.parquet(out).select("location", _day(), "rain_mm", "rain_3day_mm", "confirmed", "flood")


@register("stream_new_reports", ORACLE["feed_new_only"])
def stream_new_reports(spark, sf_dir):
    """E2, O6, T6, J3, P3 as one stream: replayed polls, first five items of
    each, links not seen before (keyed state that expires by age)."""
    feed, out, ck = (scratch_path(spark, x) for x in ("polls", "reports", "reports-ck"))
    TB.write_replay(RP.polls_of(TB.feed_items(spark, sf_dir)), feed, "poll_id", _REPLAY_ARRIVALS)
    polls = ST.files_stream(spark, feed, RP.POLL, max_files_per_trigger=3)
    new = RP.new_reports_stream(polls, max_age_s=400 * 86400)
    ST.run_to_end(RP.with_rocksdb(spark, lambda: ST.start(new, sink="parquet", path=out, checkpoint=ck)))
    rows = spark.read.schema(RP.OUT).parquet(out).withColumn("polled_at", F.col("polled_at").cast("timestamp_ntz"))
    return _report_events(rows.drop("link_md5"))


@register("stream_latest_state", ORACLE["latest_per_topic"])
def stream_latest_state(spark, sf_dir):
    """Newest record per topic in the state store, records arriving out of
    order in several batches, upserted into the published table."""
    feed, out, ck = (scratch_path(spark, x) for x in ("latest-feed", "latest", "latest-ck"))
    records = _event_records(spark, sf_dir)
    TB.write_replay(records, feed, "key", _REPLAY_ARRIVALS)
    stream = ST.files_stream(spark, feed, records.schema, max_files_per_trigger=3)
    ST.run_to_end(RP.with_rocksdb(spark, lambda: SL.publish_latest(stream, out, ck, order_col="ts")))
    return SL.read_latest(spark, out).select(
        "topic", "dataset", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"), "key")


@register("stream_reject_counts", """
SELECT count(*) AS n_read,
       count(*) FILTER (WHERE event_type <> 'error' AND event_id % 7 <> 0 AND value IS NOT NULL) AS n_ok,
       count(*) FILTER (WHERE event_type = 'error') AS n_status,
       count(*) FILTER (WHERE false) AS n_body,
       count(*) FILTER (WHERE event_type <> 'error' AND (event_id % 7 = 0 OR value IS NULL)) AS n_rain
FROM events""")
def stream_reject_counts(spark, sf_dir):
    """Streamed API responses stored by outcome and counted in the
    same pass, the counts kept with the batch id and added up."""
    feed, out, ck = (scratch_path(spark, x) for x in ("raw-feed", "judged", "judged-ck"))
    raw = TB.raw_weather_responses(spark, sf_dir)
    TB.write_replay(raw, feed, "event_id", _REPLAY_ARRIVALS)
    ST.run_to_end(rejects.store_stream(ST.files_stream(spark, feed, raw.schema, max_files_per_trigger=3), out, ck))
    return rejects.read_counts(spark, out).agg(*[F.sum(c).alias(c) for c in rejects.COUNTS])


@register("feed_exclude_bucketed", ORACLE["feed_exclude_published"])
def feed_exclude_bucketed(spark, sf_dir):
    """J3 against an archive of seen links that is bucketed by the link's hash:
    only the new items are shuffled."""
    items = TB.feed_items(spark, sf_dir)
    half = items.agg(F.expr("(max(poll_id) + 1) div 2").alias("half"))
    early = items.join(F.broadcast(half), F.col("poll_id") < F.col("half"), "left_semi")
    seen = SN.create(spark, scratch_path(spark, "seen"), buckets=SHUFFLE_BUCKETS)
    SN.add(FD.new_reports(early), seen)
    return _report_events(SN.unseen(FD.new_reports(items), seen))


# ----------------------------------------------------------- Spark ML model ---

_MODELS: dict = {}


def trained_forest(spark, sf_dir):
    return _forest(spark, sf_dir)[0]


def _forest(spark, sf_dir):
    """M3 + M7: fit the forest on the chronological training dates, publish the
    pipeline under the shared folder and load it back: (model, model folder).
    Queries of one session share the fit while the training rows stay the same."""
    split = materialize(TS.chronological_split(matrix(spark, sf_dir)))
    rows = split.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(split.columns)).cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, tuple(rows))
    if key not in _MODELS:
        model = TR.fit_forest(split.where(F.col("role") == "train").drop("role"))
        path = scratch_path(spark, "forest")
        version = TR.publish_model(spark, model, path)
        _MODELS[key] = TR.load_model(f"{path}/v={version}"), path
    return _MODELS[key]


@register("rf_scores")
def rf_scores(spark, sf_dir):
    """M2, M3, M6, M7: forest probability and decision on the test dates, at
    the threshold found by cross-validation."""
    split = TS.chronological_split(matrix(spark, sf_dir))
    test = split.where(F.col("role") == "test").drop("role")
    scored = TR.model_probability(trained_forest(spark, sf_dir), test)
    cut = rf_threshold(spark, sf_dir).select(F.col("threshold").alias("_cut"))  # one row
    out = scored.join(F.broadcast(cut)).withColumn("pred", (F.col("model_prob") / 100.0 >= F.col("_cut")).cast("int"))
    return out.select(_day(), "district", "label", "model_prob", "pred")


@register("rf_evaluation")
def rf_evaluation(spark, sf_dir):
    """M2 + A7 on the hold-out dates: class report of the forest decisions."""
    sc = rf_scores(spark, sf_dir).select(F.col("label").alias("y"), "pred")
    return EV.class_report(sc)


@register("rf_auc")
def rf_auc(spark, sf_dir):
    """A9 on the hold-out dates: AUC of the forest probabilities."""
    sc = rf_scores(spark, sf_dir).select(F.col("label").alias("y"),
                                         (F.col("model_prob") / 100.0).alias("score"))
    return EV.auc(sc)


@register("rf_importance")
def rf_importance(spark, sf_dir):
    """M5: feature importance ranking of the fitted forest (12 rows)."""
    imp = TR.feature_importance(trained_forest(spark, sf_dir))
    rows = [(i + 1, f, float(v)) for i, (f, v) in enumerate(imp)]
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("rank", T.IntegerType()), T.StructField("feature", T.StringType()),
        T.StructField("importance", T.DoubleType())]))


@register("model_dashboard_scores")
def model_dashboard_scores(spark, sf_dir):
    """H15 + E3: dashboard scoring of every weather event with the forest."""
    risk = SP.model_dashboard_risk(spark, _dealt_scenarios(spark, sf_dir), trained_forest(spark, sf_dir))
    return SCR.dashboard_result(risk)


@register("forest_table_scores")
def forest_table_scores(spark, sf_dir):
    """The saved forest read as a node table and walked for every
    scenario and district, without the model object."""
    path = V.current_path(spark, _forest(spark, sf_dir)[1])
    rows = TR.live_features(spark, _dealt_scenarios(spark, sf_dir))
    return FR.forest_probability(rows, ["scenario_id", "district"], TR.FEATURES, FR.read_nodes(spark, path), FR.max_depth(spark, path))


@register("forest_agreement", "SELECT count(*) * 15 AS scored, 0::BIGINT AS differing FROM events")
def forest_agreement(spark, sf_dir):
    """M2: rows that the node table and the model score differently (by more
    than 1e-10 of a percent), over all scenarios and districts."""
    keys = ["scenario_id", "district"]
    rows = TR.live_features(spark, _dealt_scenarios(spark, sf_dir))
    model = TR.model_probability(trained_forest(spark, sf_dir), rows).select(*keys, F.col("model_prob").alias("other"))
    both = forest_table_scores(spark, sf_dir).join(model, keys, "full")
    same = F.coalesce(F.abs(F.col("model_prob") - F.col("other")) <= F.lit(1e-10), F.lit(False))
    return both.agg(F.count(F.lit(1)).alias("scored"), F.count_if(~same).alias("differing"))


@register("forest_table_importance")
def forest_table_importance(spark, sf_dir):
    """M5 from the node table (12 rows)."""
    path = V.current_path(spark, _forest(spark, sf_dir)[1])
    return FR.forest_importance(FR.read_nodes(spark, path), TR.FEATURES)


def _stream_model_scores(spark, sf_dir) -> DataFrame:
    weather = TB.events_to_weather(_stream_of(spark, sf_dir, "events"))
    out, ck = scratch_path(spark, "model-scores"), scratch_path(spark, "model-scores-ck")
    ST.run_to_end(publish_model_scores(spark, weather, _forest(spark, sf_dir)[1], out, ck, month_col="month",
                                       partitions=spark.sparkContext.defaultParallelism))
    return read_model_scores(spark, out).drop("v", "model_version")


@register("stream_model_scores")
def stream_model_scores(spark, sf_dir):
    """Every streamed weather event scored with the classifier of a
    versioned model folder."""
    return _stream_model_scores(spark, sf_dir)


@register("stream_model_agreement", "SELECT count(*) * 15 AS scored, 0::BIGINT AS differing FROM events")
def stream_model_agreement(spark, sf_dir):
    """Rows of the stream's scores that the batch job lacks."""
    stream, model = _stream_model_scores(spark, sf_dir), trained_forest(spark, sf_dir)

    def only(ids):
        events = event_scenarios(spark, sf_dir)
        events, rows = (x.join(ids.withColumnRenamed("scenario_id", "_id"), F.col("scenario_id").eqNullSafe(F.col("_id")), "left_semi")
                        for x in (events, stream))
        return rows, SCR.dashboard_result(SP.model_dashboard_risk(spark, ranking.colocate_scenarios(events), model))

    return row_agreement(stream, model_dashboard_scores(spark, sf_dir), "scenario_id", "Kecamatan", [r[0] for r in DISTRICT_ROWS], only)


# ------------------------------------------------ archive scan and publish ---

_WEATHER_COLS = ["timestamp", "suhu_c", "kelembaban_pct", "curah_hujan_mm", "kecepatan_angin_ms", "lokasi"]


@register("archive_sql_latest", f"""
SELECT curah_hujan_mm, kelembaban_pct, suhu_c, kecepatan_angin_ms, "timestamp"
FROM ({Q.WEATHER}) w ORDER BY "timestamp" DESC, event_id DESC LIMIT 1""")
def archive_sql_latest(spark, sf_dir):
    """Weather events archived as JSON files, scanned back by
    glob with an explicit schema, registered as a view and queried with SQL
    (newest by the event's own time text, ties by event id)."""
    path = scratch_path(spark, "weather-archive")
    TB.weather_events(spark, sf_dir).select("event_id", *_WEATHER_COLS).write.json(path)
    schema = T.StructType([T.StructField("event_id", T.LongType())] + S.WEATHER_EVENT.fields)
    view = "cuaca_archive"
    AR.read_weather_archive(spark, f"{path}/*.json", view=view, schema=schema)
    return spark.sql(f"""
        SELECT curah_hujan_mm, kelembaban_pct, suhu_c, kecepatan_angin_ms, timestamp
        FROM {view} ORDER BY timestamp DESC, event_id DESC LIMIT 1""")


def _published(spark, records: DataFrame, value_schema) -> DataFrame:
    """Write topic records with the file sink and parse them back."""
    path = scratch_path(spark, "topic")
    PB.write_topic(records, fmt="json", path=path)
    back = spark.read.schema("topic string, key string, value string").json(path)
    return back.select("topic", "key", F.from_json("value", value_schema).alias("v")).select(
        "topic", "key", "v.*")


@register("publish_weather", f"""
SELECT 'tidewatch-cuaca' AS topic, 'SBY' AS key, "timestamp", suhu_c, kelembaban_pct, curah_hujan_mm,
       kecepatan_angin_ms, lokasi FROM ({Q.WEATHER}) w""")
def publish_weather(spark, sf_dir):
    """Every weather event published with the constant station key."""
    rec = PB.weather_records(TB.weather_events(spark, sf_dir), TB.WEATHER_TOPIC)
    return _published(spark, rec, S.WEATHER_EVENT)


@register("publish_reports", f"""
SELECT 'tidewatch-laporan' AS topic, link_md5 AS key, "timestamp", judul, link, sumber
FROM ({ORACLE['feed_new_only']}) n""")
def publish_reports(spark, sf_dir):
    """New reports published keyed by the MD5 of their link."""
    rec = PB.report_records(_report_events(FD.new_reports(TB.feed_items(spark, sf_dir))),
                            TB.REPORT_TOPIC)
    return _published(spark, rec, S.REPORT_EVENT)


@register("report_districts", f"""
SELECT f.doc_id, f.pkey, f.kecamatan, d.district_code
FROM ({ORACLE['report_flatten']}) f LEFT JOIN ({Q.DISTRICTS}) d ON f.kecamatan = d.district""")
def report_districts(spark, sf_dir):
    """District code of every flattened report (broadcast lookup)."""
    rep = report_flatten(spark, sf_dir).select("doc_id", "pkey", "kecamatan")
    return lookup_code(rep, districts(spark), "kecamatan", known_rows=DISTRICT_COUNT)


@register("rf_cv")
def rf_cv(spark, sf_dir):
    """M4 with the forest: five expanding time-series folds, one fit of the
    final model's settings per fold; AUC, accuracy and F1 per fold."""
    return EV.auc_and_decision(_cv_scores(spark, sf_dir), by=["fold"], groups_bound=TS.CV_FOLDS) \
        .select("fold", "auc", "accuracy", "f1")


def _cv_scores(spark, sf_dir) -> DataFrame:
    """Test scores of the five forests; fits shared as in ``trained_forest``."""
    folds = materialize(TS.time_series_folds(matrix(spark, sf_dir)))
    rows = folds.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(folds.columns)).cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, "cv", tuple(rows))
    if key not in _MODELS:
        _MODELS[key] = materialize(TR.cv_test_scores(folds))
    return _MODELS[key]


@register("rf_cv_summary")
def rf_cv_summary(spark, sf_dir):
    """A10, M4: mean and population standard deviation of the forest's folds."""
    return EV.mean_std(rf_cv(spark, sf_dir), ["auc", "accuracy", "f1"])


@register("rf_threshold")
def rf_threshold(spark, sf_dir):
    """The F1.5 threshold over the forest's pooled test folds, beside
    the reference's published value."""
    best = EV.best_threshold(EV.roc_curve(_cv_scores(spark, sf_dir)))
    return best.withColumn("published", F.lit(EV.DECISION_THRESHOLD))


@register("dashboard_latest", f"""
SELECT "Kecamatan", "Status", "Probabilitas (%)", "Tinggi Genangan (m)", "Luas Terdampak (km2)",
       "% Luas Terdampak", "Penduduk Terdampak", "Lead Time (jam)", "Flood Risk Score", "Prioritas Evakuasi"
FROM ({Q.dashboard_result(Q.risk(Q.scored(Q.live_proxies(Q.SCENARIOS.replace(
    'FROM (' + Q.WEATHER + ') w', 'FROM (SELECT * FROM (' + Q.WEATHER + ') w0 ORDER BY event_time DESC LIMIT 1) w')),
    DASHBOARD)))}) d""")
def dashboard_latest(spark, sf_dir):
    """E3 (live mode): newest weather event scored with the dashboard formulas."""
    return SP.live_dashboard(spark, TB.weather_events(spark, sf_dir), order_col="event_time",
                             month_col="month")["results"]


@register("stream_two_topics", f"""
SELECT 'tidewatch-cuaca' AS topic, 'cuaca' AS dataset, 'SBY' AS key, "timestamp" FROM ({Q.WEATHER}) w
UNION ALL
SELECT 'tidewatch-laporan' AS topic, 'laporan' AS dataset, link_md5 AS key, "timestamp"
FROM ({ORACLE['feed_new_only']}) n""")
def stream_two_topics(spark, sf_dir):
    """Weather and report records published as JSON to two
    topics (a file-backed broker here), consumed as one two-topic stream,
    routed by topic and archived per dataset, read back."""
    broker = scratch_path(spark, "broker")
    PB.write_topic(PB.weather_records(TB.weather_events(spark, sf_dir), TB.WEATHER_TOPIC),
                   fmt="json", path=broker)
    PB.write_topic(PB.report_records(_report_events(FD.new_reports(TB.feed_items(spark, sf_dir))),
                                     TB.REPORT_TOPIC), fmt="json", path=broker)
    stream = ST.files_stream(spark, broker, _TOPIC_RECORD, fmt="json")
    routed = stream.select("topic", "key", F.get_json_object("value", "$.timestamp").alias("timestamp"),
                           "value")
    out, ck = scratch_path(spark, "two-topics"), scratch_path(spark, "two-topics-ck")
    ST.run_to_end(ST.archive_records(routed, out, ck))
    return spark.read.parquet(out).select("topic", "dataset", "key", "timestamp")




_LATEST_SCEN = Q.SCENARIOS.replace(
    'FROM (' + Q.WEATHER + ') w',
    'FROM (SELECT * FROM (' + Q.WEATHER + ') w0 ORDER BY event_time DESC LIMIT 1) w')


@register("dashboard_latest_kpis", f"""
SELECT *, CASE WHEN critical_count > 0 THEN 'danger' ELSE 'safe' END AS critical_band,
          CASE WHEN watch_count > 0 THEN 'warn' ELSE 'safe' END AS watch_band,
          {Q.band('total_people', 5000, 1000)} AS people_band,
          {Q.band('min_lead_time_h', 3, 6, False)} AS lead_band
FROM (SELECT count(*) AS districts,
        count(*) FILTER (WHERE probability > 70.0::DOUBLE) AS critical_count,
        count(*) FILTER (WHERE probability > 40.0::DOUBLE AND probability <= 70.0::DOUBLE) AS watch_count,
        CAST(sum(people_affected) AS BIGINT) AS total_people,
        min(lead_time_h) AS min_lead_time_h
      FROM ({Q.risk(Q.scored(Q.live_proxies(_LATEST_SCEN), DASHBOARD))}) r) k""")
def dashboard_latest_kpis(spark, sf_dir):
    """E3 (live mode) KPI cards of the newest weather event."""
    return SP.live_dashboard(spark, TB.weather_events(spark, sf_dir), order_col="event_time",
                             month_col="month")["kpis"]
