"""Sinks.

Topic records are ``(topic, key, value)`` with a JSON value, which is the
shape Spark's Kafka sink expects.  The Kafka connector jar is not part of a
plain PySpark install, so ``write_topic`` takes the format as a parameter and
the tests use a file format with the same records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas as S
from tidewatch.functions.text import dataset_of_topic, link_hash
from tidewatch.sources.versions import commit_version, current_path

# ---- fixed values: message keys of the reference ---------------------------
WEATHER_KEY = "SBY"
# lines of a compressed file: some 10 MB of either
RESULTS_PER_FILE, DOCUMENTS_PER_FILE = 1_000_000, 100_000
# -----------------------------------------------------------------------------


def topic_records(df: DataFrame, topic: str | Column, key: Column, value_cols=None) -> DataFrame:
    """Rows -> (topic, key, JSON value)."""
    cols = value_cols or df.columns
    t = F.lit(topic) if isinstance(topic, str) else topic
    return df.select(t.alias("topic"), key.cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"))


def weather_records(weather: DataFrame, topic: str, key_col: str | None = None) -> DataFrame:
    """Weather events keyed by a constant station key, as the reference
    does; with ``key_col`` by that column, so that a topic's partitions share
    the load."""
    cols = [f.name for f in S.WEATHER_EVENT.fields]
    return topic_records(weather, topic, F.col(key_col) if key_col else F.lit(WEATHER_KEY), cols)


def report_records(reports: DataFrame, topic: str) -> DataFrame:
    """Report events keyed by the MD5 of their link."""
    cols = [f.name for f in S.REPORT_EVENT.fields]
    return topic_records(reports, topic, link_hash(F.col("link")), cols)


def write_topic(records: DataFrame, *, fmt: str = "kafka", options: dict | None = None,
                path: str | None = None) -> None:
    """Publish batch topic records (Kafka when its connector is installed)."""
    w = records.write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        w.save()
    else:
        w.mode("append").save(path)


def with_dataset(records: DataFrame, topic_col: str = "topic") -> DataFrame:
    """Route by topic -> dataset name (part after the first hyphen)."""
    return records.withColumn("dataset", dataset_of_topic(F.col(topic_col)))


def latest_per_topic(records: DataFrame, order_col: str) -> DataFrame:
    """Newest record of every topic.  ``max_by`` partial aggregation
    keeps one row per topic per task, so a topic holding most of the records
    is never gathered into one task."""
    return (with_dataset(records)
            .groupBy("topic", "dataset")
            .agg(F.max_by(F.struct("key", "value"), F.col(order_col)).alias("_l"),
                 F.max(order_col).alias(order_col))
            .select("topic", "dataset", order_col, "_l.key", "_l.value"))


def write_snapshots(latest: DataFrame, path: str) -> None:
    """S9 sink: replace the per-dataset snapshot (one JSON file per dataset)."""
    (latest.select("dataset", "value").repartition("dataset")
     .write.mode("overwrite").partitionBy("dataset").text(path))


def write_archive(records: DataFrame, path: str, fmt: str = "json") -> None:
    """S10 (batch form): append every record, one folder per dataset."""
    with_dataset(records).write.mode("append").partitionBy("dataset").format(fmt).save(path)


def _lines(df: DataFrame, compression: str | None, rows: int):
    """Writer of lines.  Compressed files cannot be split, so each holds a
    bounded number of lines and is read by a task of its own."""
    return df.write.options(compression=compression, maxRecordsPerFile=rows) if compression else df.write


def write_results(result: DataFrame, path: str, compression: str | None = None) -> None:
    """Replace the result table, JSON lines.  The new table is written
    beside the published one and becomes it by one commit; ``read_results``
    follows the commits.  ``compression``: a codec such as gzip for a table of
    many scenarios; the dashboard's own file stays plain."""
    commit_version(result.sparkSession, path, lambda to: _lines(result, compression, RESULTS_PER_FILE).json(to))


def read_results(spark: SparkSession, path: str, keep: str = "") -> DataFrame:
    """``keep``: DDL of key columns written before the result's own."""
    schema = T.StructType((T.StructType.fromDDL(keep).fields if keep else []) + S.BATCH_RESULT.fields)
    return spark.read.schema(schema).json(current_path(spark, path))


def write_documents(docs: DataFrame, path: str, doc_col: str = "document", key: str | None = None,
                    compression: str | None = None) -> None:
    """One JSON document per line (per scenario), replaced as in
    ``write_results`` (and compressed as there); with ``key`` that column becomes a first field of the
    document."""
    doc = F.struct(F.col(key), F.col(f"{doc_col}.*")) if key else F.col(doc_col)
    lines = docs.select(F.to_json(doc).alias("value"))
    commit_version(docs.sparkSession, path, lambda to: _lines(lines, compression, DOCUMENTS_PER_FILE).text(to))


def read_documents(spark: SparkSession, path: str, keep: str = "") -> DataFrame:
    """Documents read back with their schema (``keep``: DDL of the key)."""
    schema = T.StructType((T.StructType.fromDDL(keep).fields if keep else []) + S.RESULT_DOCUMENT.fields)
    return spark.read.schema(schema).json(current_path(spark, path))
