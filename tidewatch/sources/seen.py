"""Links that were published already, as a bucketed table.

The table is bucketed and sorted by the link's hash, so an anti-join shuffles the
new items only, however long the archive has grown.  Appended batches add files to
the buckets; ``rewrite`` merges them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

KEY = "link_md5"


@dataclass(frozen=True)
class Seen:
    """A bucketed table: its name in the catalogue, folder and buckets."""

    table: str
    path: str
    buckets: int


def _write(links: DataFrame, seen: Seen, mode: str) -> None:
    links.select(KEY).where(f"{KEY} IS NOT NULL").write.format("parquet").mode(mode) \
        .option("path", seen.path).bucketBy(seen.buckets, KEY).sortBy(KEY).saveAsTable(seen.table)


def create(spark: SparkSession, path: str, buckets: int, table: str | None = None) -> Seen:
    """An empty table at a folder that executors share."""
    seen = Seen(table or f"seen_links_{uuid.uuid4().hex}", path, buckets)
    _write(spark.createDataFrame([], f"{KEY} string"), seen, "errorifexists")
    return seen


def add(links: DataFrame, seen: Seen) -> None:
    """Append links.  They are dealt by bucket first, so a batch adds one file to
    each of its buckets; links that are there already do no harm."""
    _write(links.select(KEY).distinct().repartition(seen.buckets, KEY), seen, "append")


def rewrite(seen: Seen, spark: SparkSession, path: str) -> Seen:
    """The same links without repeats, one file a bucket, as a new table: the old
    one stays as it is until the caller drops it."""
    new = create(spark, path, seen.buckets)
    add(spark.table(seen.table), new)
    return new


def unseen(items: DataFrame, seen: Seen) -> DataFrame:
    """Items whose link is not in the table; items without a link stay."""
    return items.join(items.sparkSession.table(seen.table), KEY, "left_anti")
