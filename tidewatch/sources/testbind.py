"""Bindings from the driver's generic tables to this domain.

The test tables carry no weather, so each binding derives the domain rows
from them with plain column expressions; the SQL oracle uses the same
expressions.  Every binding reads whole tables: modulo arithmetic below only
derives attribute values, it never filters rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.numeric import dbl
from tidewatch.functions.text import minute_text
from tidewatch.sources.districts import CITY

# ---- fixed values: binding parameters ---------------------------------------
WEATHER_TOPIC = "tidewatch-cuaca"
REPORT_TOPIC = "tidewatch-laporan"
REPORT_SOURCE = "Tempo RSS"
FEED_EPOCH = "2024-01-01 00:00:00"
FEED_POLL_SECONDS = 300          # news poll cadence
FEED_ITEMS_PER_POLL = 10
FLOOD_DATE_COUNT = 30            # size of the confirmed flood-date list
CITY_COUNT = 4                   # cities of the several-city binding
# -----------------------------------------------------------------------------


# Schemas of the driver tables this package reads (explicit, so a read plans
# without a schema-discovery job over the file footers).
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def weather_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat weather events (reference event schema) plus ``event_id``,
    ``event_time`` and a ``month`` spread over the year."""
    return events_to_weather(table(spark, sf_dir, "events"))


def city_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather events of several cities: the location comes from the data."""
    ev = table(spark, sf_dir, "events")
    return events_to_weather(ev, "user_id").withColumn(
        "lokasi", F.concat(F.lit("Kota "), (F.col("user_id") % CITY_COUNT).cast("string"))).drop("user_id")


def city_districts(spark: SparkSession) -> DataFrame:
    """The district dimension once for each city of ``city_weather``."""
    from tidewatch.sources.districts import districts

    rows = districts(spark, "Kota 0")
    for i in range(1, CITY_COUNT):
        rows = rows.unionByName(districts(spark, f"Kota {i}"))
    return rows


def events_to_weather(ev: DataFrame, *keep: str) -> DataFrame:
    """The weather binding as a DataFrame transform (static or streaming);
    ``keep``: columns of the events carried along."""
    return ev.selectExpr(
        *keep,
        "event_id",
        "ts AS event_time",
        """date_format(ts, "yyyy-MM-dd'T'HH:mm") AS timestamp""",
        "24 + (event_id % 121) / 10 AS suhu_c",
        "55 + user_id % 46 AS kelembaban_pct",
        "value / 10 AS curah_hujan_mm",
        "(3.6D + user_id % 100) / 3.6D AS kecepatan_angin_ms",
        f"'{CITY}' AS lokasi",
        "CAST(1 + event_id % 12 AS INT) AS month",
    )


def raw_weather_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw API responses: ``event_id, event_time, status, body`` where body is
    the nested JSON document; some fields are absent, error events fail."""
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id") % 7
    current = F.struct(
        minute_text(F.col("ts")).alias("time"),
        F.when(k != 2, F.lit(24) + (F.col("event_id") % 121) / F.lit(10)).alias("temperature_2m"),
        F.when(k != 1, F.lit(55) + F.col("user_id") % 46).alias("relative_humidity_2m"),
        F.when(k != 0, F.col("value") / F.lit(10)).alias("precipitation"),
        F.when(k != 3, dbl(3.6) + F.col("user_id") % 100).alias("wind_speed_10m"),
    )
    return ev.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.to_json(F.struct(current.alias("current"))).alias("body"),
    )


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News-feed items: each page is an item of a poll of 10 (feed order =
    page id); the link is the page's host so that links repeat."""
    return pages_to_feed(table(spark, sf_dir, "pages"))


def pages_to_feed(pages: DataFrame) -> DataFrame:
    """The feed binding as a DataFrame transform (static or streaming)."""
    poll = F.floor(F.col("page_id") / FEED_ITEMS_PER_POLL).cast("bigint")
    return pages.select(
        "page_id",
        poll.alias("poll_id"),
        (F.col("page_id") % FEED_ITEMS_PER_POLL).cast("int").alias("position"),
        F.timestamp_add("SECOND", poll * FEED_POLL_SECONDS,
                        F.lit(FEED_EPOCH).cast("timestamp_ntz")).alias("polled_at"),
        F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("link"),
    )


def daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily station weather, one row per ship date of ``lineitem``.

    Values come from exact integer aggregates so both engines agree bit for
    bit: rain 0-39.9 mm with about one dry day in five, humidity 55-100,
    temperature 24-36 C, wind 1-29.9 m/s, sunshine 0-12 h."""
    li = table(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate")
    agg = li.groupBy(day.alias("date")).agg(
        F.sum("l_quantity").cast("bigint").alias("_q"),
        F.count(F.lit(1)).alias("_n"),
        F.sum("l_linenumber").cast("bigint").alias("_ln"),
        F.sum("l_partkey").cast("bigint").alias("_pk"),
        F.max("l_suppkey").alias("_sk"),
    )
    return agg.select(
        F.lit(CITY).alias("location"),
        "date",
        (F.greatest(F.col("_q") % 500 - F.lit(100), F.lit(0)) / F.lit(10)).alias("rain_mm"),
        (F.lit(55) + F.col("_n") % 46).alias("humidity_pct"),
        (F.lit(24) + (F.col("_ln") % 121) / F.lit(10)).alias("temp_c"),
        (F.lit(1) + (F.col("_pk") % 290) / F.lit(10)).alias("wind_ms"),
        ((F.col("_sk") % 121) / F.lit(10)).alias("sunshine_h"),
    )


def confirmed_flood_dates(spark: SparkSession, sf_dir: str, count: int = FLOOD_DATE_COUNT) -> DataFrame:
    """The confirmed flood-date list: the ``count`` order dates with the
    largest urgent-order value (ties by date), 30 as in the reference's list."""
    orders = table(spark, sf_dir, "orders")
    per_day = (orders.where(F.col("o_orderpriority") == "1-URGENT")
               .groupBy(F.to_date("o_orderdate").alias("date"))
               .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("urgent_value")))
    return (per_day.orderBy(F.desc("urgent_value"), F.asc("date"))
            .limit(count).select("date"))


def classifier_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled score table: ``y = 1 - quality`` (the minority class) with a
    score in [0, 1] derived from the document length."""
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return labels.join(docs, "doc_id", "inner").select(
        "doc_id",
        (F.lit(1) - F.col("quality")).cast("int").alias("y"),
        ((F.col("n_chars") % 101) / F.lit(100)).alias("score"),
    )


def what_if_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual what-if inputs, one per event, spanning the dashboard's input
    ranges (rain 0-200, 3-day rain 0-300, humidity 55-100, temperature
    24-36, wind 1-30, sunshine 0-12, any month)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("scenario_id"),
        (F.col("value").cast("bigint") % 201).cast("double").alias("rain_mm"),
        (F.lit(55) + F.col("event_id") % 46).alias("humidity_pct"),
        (F.lit(24) + (F.col("user_id") % 121) / F.lit(10)).alias("temp_c"),
        (F.lit(1) + (F.col("event_id") % 291) / F.lit(10)).alias("wind_ms"),
        (F.lit(1) + F.col("user_id") % 12).cast("int").alias("month"),
        ((F.col("user_id") * 7 + F.col("event_id")) % 301).cast("double").alias("rain_3day_mm"),
        ((F.col("event_id") % 121) / F.lit(10)).alias("sunshine_h"),
    )


REPORT_EPOCH = "2024-01-01 00:00:00"


def report_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested report documents (disaster-map shape) built from ``documents``:
    one document per text, one report per line of the whole text."""
    from tidewatch.sources.districts import DISTRICT_ROWS

    from tidewatch.operators.joins import spread_for_fanout

    # one report per line of every text: spread the texts before the fan-out
    docs = spread_for_fanout(table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", "source"), fanout=2)
    names = F.array(*[F.lit(r[0]) for r in DISTRICT_ROWS])
    created = F.date_format(F.timestamp_add("MINUTE", F.col("doc_id"),
                                            F.lit(REPORT_EPOCH).cast("timestamp_ntz")),
                            "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def geometry(line, i):
        n = i + 1
        return F.struct(
            F.struct(
                F.concat(F.lit("ID-"), F.col("doc_id").cast("string"), F.lit("-"),
                         n.cast("string")).alias("pkey"),
                created.alias("created_at"),
                F.col("source").alias("source"),
                F.when(F.col("lang") == "en", F.lit("confirmed")).otherwise(F.lit("pending"))
                .alias("status"),
                F.struct((F.length(line) % 100).cast("bigint").alias("flood_depth"),
                         F.element_at(names, ((F.col("doc_id") + n) % len(DISTRICT_ROWS) + 1)
                                      .cast("int")).alias("kecamatan")).alias("tags"),
                line.alias("text"),
            ).alias("properties"),
            F.struct(F.array(dbl(112.6) + (F.col("doc_id") % 100) / F.lit(1000),
                             dbl(-7.2) - (n % 100) / F.lit(1000)).alias("coordinates"))
            .alias("geometry"),
        )

    geoms = F.transform(F.split(F.col("text"), "\n"), geometry)
    doc = F.struct(F.struct(F.struct(F.struct(geoms.alias("geometries")).alias("output"))
                            .alias("objects")).alias("result"))
    return docs.select("doc_id", F.to_json(doc).alias("json"))


def rain_month_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What-if grid: every distinct (rain level, month) pair seen in the
    events (whole-mm rain 0-200, month spread over the year), one manual
    scenario per pair with the dashboard's default humidity, temperature,
    wind, a 3-day total of three such days and no sunshine."""
    ev = table(spark, sf_dir, "events")
    pairs = ev.select((F.col("value").cast("bigint") % 201).alias("rain"),
                      (F.lit(1) + F.col("user_id") % 12).cast("int").alias("month")).distinct()
    return pairs.select(
        (F.col("rain") * 100 + F.col("month")).alias("scenario_id"),
        F.col("rain").cast("double").alias("rain_mm"),
        F.lit(80).cast("bigint").alias("humidity_pct"),
        F.lit(28.0).alias("temp_c"),
        F.lit(3.0).alias("wind_ms"),
        "month",
        (F.col("rain") * 3).cast("double").alias("rain_3day_mm"),
        F.lit(0.0).alias("sunshine_h"),
    )


def write_replay(df: DataFrame, path: str, order_col: str, arrivals: int) -> None:
    """Write a history as so many arrivals in the order of a column, one after
    the other: a file stream takes files by their modification time, and the
    files of one write have no order."""
    parts = f"{path}-parts"
    df.repartitionByRange(arrivals, order_col).withColumn("_arrival", F.spark_partition_id()).write.partitionBy("_arrival").parquet(parts)
    stored = df.sparkSession.read.parquet(parts)
    for i in range(arrivals):
        stored.where(F.col("_arrival") == i).drop("_arrival").write.mode("append").parquet(path)
