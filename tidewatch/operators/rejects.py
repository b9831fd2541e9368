"""API responses judged, stored and counted in one pass.

Every response gets an outcome: ``ok``, or the first reason that keeps it from
being scored.  The pass that stores the rows by outcome also counts them
(``DataFrame.observe``), so the counts need no scan of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas as S
from tidewatch.operators import ingest

#: ok; failed request; body that is no weather document; no rain in it
OUTCOMES = ("ok", "status", "body", "rain")
COUNTS = ["n_read", *(f"n_{o}" for o in OUTCOMES)]


def judge(raw: DataFrame, *, body_col: str = "body", status_col: str = "status", keep=("event_id",)) -> DataFrame:
    """All responses with ``outcome`` and their weather fields, null where the
    response has none (a missing status is a failed request)."""
    current = F.from_json(F.col(body_col), S.RAW_WEATHER).getField("current")
    ok = F.coalesce(F.col(status_col) == ingest.HTTP_OK, F.lit(False))
    outcome = F.when(~ok, "status").when(current.isNull(), "body") \
        .when(current.getField("precipitation").isNull(), "rain").otherwise("ok")
    # the weather fields of all responses, whatever their status
    every = raw.withColumns({"outcome": outcome, status_col: F.lit(ingest.HTTP_OK)})
    return ingest.normalize_weather(every, body_col=body_col, status_col=status_col, keep=(*keep, "outcome"))


def counts() -> list:
    """The metrics of a pass over judged rows."""
    return [F.count(F.lit(1)).alias("n_read")] + [F.count_if(F.col("outcome") == o).alias(f"n_{o}") for o in OUTCOMES]


def store(judged: DataFrame, folder: str) -> dict[str, int]:
    """Write judged rows, one folder an outcome, and return their counts."""
    seen = Observation()
    judged.observe(seen, *counts()).write.mode("overwrite").partitionBy("outcome").parquet(folder)
    return {c: int(seen.get.get(c) or 0) for c in COUNTS}


def counts_frame(spark: SparkSession, found: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([tuple(found[c] for c in COUNTS)], ", ".join(f"{c} long" for c in COUNTS))


def store_stream(raw: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None, **args):
    """Judge a stream of responses: ``path/rows/batch=<id>/outcome=<o>/`` and one
    row of counts in ``path/counts/batch=<id>/``.  A replayed batch writes both
    anew, with the same content; a batch counts once its counts are there."""
    def write(batch: DataFrame, batch_id: int) -> None:
        found = store(judge(batch, **args), f"{path}/rows/batch={batch_id}")
        counts_frame(batch.sparkSession, found).coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/batch={batch_id}")

    return (raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(batch, n_read, n_ok, n_status, n_body, n_rain): one row a batch."""
    return spark.read.schema(", ".join(f"{c} long" for c in [*COUNTS, "batch"])).parquet(f"{path}/counts")


def read_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """The judged rows of all counted batches; filters on outcome prune folders."""
    rows = spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return rows.join(read_counts(spark, path).select("batch"), "batch", "left_semi").drop("batch")
