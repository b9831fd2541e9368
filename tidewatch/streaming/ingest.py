"""Structured Streaming ingest.

One streaming query replaces the reference's consumer loop: it subscribes to
both topics, archives every event exactly once (file sink + checkpoint),
keeps the newest record per topic (``foreachBatch``, idempotent per batch
id), de-duplicates keyed reports with bounded state, and scores each new
weather event against the broadcast district dimension.

The Kafka source needs the ``spark-sql-kafka`` package on the classpath; the
same transformations run on a file source (``files_stream``), which is what
the tests use with ``trigger(availableNow=True)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources import publish as PB

# ---- fixed values: cadences of the reference (seconds) ----------------------
WEATHER_POLL_S = 60
REPORT_POLL_S = 300
RESCORE_S = 20
# -----------------------------------------------------------------------------


def cadence_trigger(seconds: int) -> dict:
    """A processing-time trigger for a polling cadence."""
    return {"processingTime": f"{int(seconds)} seconds"}


# service triggers: weather every 60 s, reports every 300 s, rescoring every 20 s
WEATHER_TRIGGER = cadence_trigger(WEATHER_POLL_S)
REPORT_TRIGGER = cadence_trigger(REPORT_POLL_S)
RESCORE_TRIGGER = cadence_trigger(RESCORE_S)


def kafka_stream(spark: SparkSession, servers: str, topics: list[str],
                 starting: str = "latest") -> DataFrame:
    """S6 + T1: subscribe to several topics; (topic, key, value, offset, ts)."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting)
            .load()
            .selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
                        "partition", "offset", "timestamp"))


def files_stream(spark: SparkSession, directory: str, schema: T.StructType, *,
                 glob: str | None = None, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, recursive: bool = False) -> DataFrame:
    """A file-backed stream with an explicit schema (tests and replays)."""
    r = spark.readStream.schema(schema).format(fmt)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def parse_values(records: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """JSON value -> typed columns (topic metadata kept)."""
    keep = [c for c in records.columns if c != value_col]
    return records.select(*keep, F.from_json(F.col(value_col), schema).alias("_v")).select(*keep, "_v.*")


def start(df: DataFrame, *, sink: str, checkpoint: str, path: str | None = None,
          partition_by=(), mode: str = "append", trigger: dict | None = None,
          query_name: str | None = None):
    """T2 + T7: start a streaming query with a checkpoint (restart resumes at
    the committed offsets) and a trigger (``{"processingTime": "60 seconds"}``
    in service, ``{"availableNow": True}`` in batch replays)."""
    w = df.writeStream.format(sink).outputMode(mode).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start(path) if path else w.start()


def archive_records(records: DataFrame, path: str, checkpoint: str, *, fmt: str = "parquet",
                    trigger: dict | None = None):
    """S10 + T3 + T5: every record appended once, one folder per dataset."""
    return start(PB.with_dataset(records), sink=fmt, path=path, checkpoint=checkpoint,
                 partition_by=("dataset",), trigger=trigger)


def snapshot_latest(records: DataFrame, path: str, checkpoint: str, *, order_col: str,
                    trigger: dict | None = None, live_path: str | None = None):
    """S9 + T4: newest record per topic.

    Each micro-batch merges its own newest records with the previous snapshot
    version and writes version ``batch_id``.  A replayed batch rewrites the
    same version with the same content, so the sink is idempotent; readers
    take the highest version (``read_snapshot``).  All but the last two versions
    are removed on each trigger, so neither the folder nor its listing grows.  ``live_path``: also
    replace one plain JSON value per dataset there (``dataset=<name>/``), the
    newest-event files a dashboard reads."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cur = PB.latest_per_topic(batch, order_col)
        prev = _read_versions(spark, path, cur.schema, before=batch_id)
        if prev is not None:
            both = cur.unionByName(prev)
            cur = (both.groupBy("topic", "dataset")
                   .agg(F.max_by(F.struct("key", "value"), F.col(order_col)).alias("_l"),
                        F.max(order_col).alias(order_col))
                   .select("topic", "dataset", order_col, "_l.key", "_l.value"))
        cur.coalesce(1).write.mode("overwrite").parquet(f"{path}/v={batch_id}")
        prune_versions(spark, path)
        if live_path:
            PB.write_snapshots(spark.read.parquet(f"{path}/v={batch_id}"), live_path)

    return (records.writeStream.foreachBatch(merge)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _versions(spark: SparkSession, path: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name[2:]))
    return sorted(out)


def prune_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all complete versions but the newest ``keep``."""
    for v in _versions(spark, path)[:-keep]:
        remove_version(spark, path, v)


def remove_version(spark: SparkSession, path: str, version: int) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/v={version}")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _read_versions(spark: SparkSession, path: str, schema: T.StructType, before: int):
    vs = [v for v in _versions(spark, path) if v < before]
    return spark.read.schema(schema).parquet(f"{path}/v={vs[-1]}") if vs else None


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot version."""
    vs = _versions(spark, path)
    if not vs:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/v={vs[-1]}")


#: how long a link stays known to the de-duplicating stream
DEDUP_HORIZON = "7 days"


def dedup_keys(stream: DataFrame, key: str, *, event_time: str | None = None,
               horizon: str | None = None) -> DataFrame:
    """First row per key.  Without a horizon the key set lives as long as
    the query (the reference's in-memory set, but checkpointed); with an event
    time and horizon, state is bounded by the watermark."""
    if event_time and horizon:
        return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def run_to_end(query) -> None:
    """Block until an ``availableNow`` query has drained its input."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
