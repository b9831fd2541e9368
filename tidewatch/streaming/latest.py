"""Newest record per topic as engine state.

A streaming ``max_by`` keeps one row a topic in the state store; in update mode
each trigger hands on only the topics that it changed, and the sink puts these
over the published table.  The state lives in the checkpoint, so a restart goes
on from it without the published table, and a record that arrives late never
replaces a newer one.  Tasks reduce their records to one a topic before the
shuffle, so a topic with most of the records is no hot key.

Both the state and the table grow with the number of topics, not of records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources import publish as PB
from tidewatch.sources import versions as V


def latest_stream(records: DataFrame, order_col: str) -> DataFrame:
    """(topic, dataset, order_col, key, value): the newest record of each topic of
    a stream.  Records without topic or order are left out; of records with equal
    order the one with the greatest key, then value stays, whatever batch it is in."""
    known = PB.with_dataset(records).where(F.col("topic").isNotNull() & F.col(order_col).isNotNull())
    return (known.groupBy("topic", "dataset")
            .agg(F.max(F.struct(order_col, "key", "value")).alias("_l"))
            .select("topic", "dataset", *[F.col(f"_l.{c}").alias(c) for c in (order_col, "key", "value")]))


def upsert(batch: DataFrame, path: str, batch_id: int) -> None:
    """Put the changed topics over the published table, as version ``batch_id``
    and by one commit; a batch that is committed already, and older ones, change
    nothing."""
    spark = batch.sparkSession
    done = V.committed(spark, path)
    if done and batch_id <= done[-1]:
        return

    def write(folder: str) -> None:
        rows = batch
        if done:
            old = spark.read.schema(batch.schema).parquet(f"{path}/v={done[-1]}")
            rows = old.join(batch.select("topic").distinct(), "topic", "left_anti").select(batch.columns).unionByName(batch)
        rows.write.parquet(folder)

    V.commit_version(spark, path, write, version=batch_id)


def publish_latest(records: DataFrame, path: str, checkpoint: str, *, order_col: str, trigger: dict | None = None):
    """T4 + S9: keep the newest record per topic of a stream published at ``path``."""
    return (latest_stream(records, order_col).writeStream.outputMode("update")
            .foreachBatch(lambda batch, i: upsert(batch, path, i))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The published table."""
    return spark.read.parquet(V.current_path(spark, path))
