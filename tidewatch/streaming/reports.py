"""The report producer as one stateful stream.

The reference fetches a feed every 300 s, takes its first five items, and
publishes those whose link it has not seen; the links seen are a set in memory
that only grows and is lost on a restart.  Here a poll is one stream record
with its items; the first five of each are cut in the row, and a keyed state
remembers every link with the time it was first published.  Timers drop links
older than ``max_age``, so the state is bounded by the feed's own pace, and it
survives restarts with the checkpoint (RocksDB state store).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators.feed import ITEMS_PER_POLL, with_link_hash

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

POLL = ("poll_id BIGINT, polled_at TIMESTAMP, "
        "items ARRAY<STRUCT<position: INT, title: STRING, link: STRING>>")


def polls_of(items: DataFrame) -> DataFrame:
    """Feed items (poll_id, polled_at, position, title, link) as one row a
    poll, the shape in which a poll is fetched."""
    return items.groupBy("poll_id", F.col("polled_at").cast("timestamp").alias("polled_at")).agg(
        F.array_sort(F.collect_list(F.struct("position", "title", "link"))).alias("items"))


def first_items(polls: DataFrame, k: int = ITEMS_PER_POLL) -> DataFrame:
    """The first ``k`` items of every poll in feed order, inside the row."""
    return with_link_hash(polls.select("poll_id", "polled_at", F.explode(F.slice(F.array_sort("items"), 1, k)).alias("i"))
                          .select("poll_id", "polled_at", "i.position", "i.title", "i.link"))


class FirstSeen(StatefulProcessor):
    """One link: its earliest row is emitted, later ones are not until the
    link is forgotten ``max_age_ms`` after it was published."""

    def __init__(self, max_age_ms: int):
        self.max_age_ms = max_age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "polled_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # a link's rows of one batch; only the earliest is held
        first = None
        for part in rows:
            least = part.sort_values(["poll_id", "position"]).iloc[:1]
            if first is None or tuple(least[["poll_id", "position"]].iloc[0]) < tuple(first[["poll_id", "position"]].iloc[0]):
                first = least
        if first is None or self.seen.exists():
            return
        at = int(first["polled_at"].iloc[0].timestamp() * 1000)
        self.seen.update((at,))
        self.handle.registerTimer(at + self.max_age_ms)
        yield first[["poll_id", "position", "polled_at", "title", "link"]].assign(link_md5=key[0])[OUT_NAMES]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


OUT = "link_md5 STRING, poll_id BIGINT, position INT, polled_at TIMESTAMP, title STRING, link STRING"
OUT_NAMES = [c.split()[0] for c in OUT.split(", ")]


def new_reports_stream(polls: DataFrame, *, k: int = ITEMS_PER_POLL, max_age_s: int, lateness: str = "0 seconds") -> DataFrame:
    """O6 + T6 + J3 + A12 on a stream of polls: items to publish, each link
    once in ``max_age_s`` seconds of poll time.  Polls must arrive in order
    across micro-batches, or not more than ``lateness`` behind."""
    items = first_items(polls, k).withWatermark("polled_at", lateness)
    return items.groupBy("link_md5").transformWithStateInPandas(
        statefulProcessor=FirstSeen(max_age_s * 1000), outputStructType=OUT,
        outputMode="Append", timeMode="EventTime")


def with_rocksdb(spark: SparkSession, start):
    """``start()`` a query on the RocksDB state store, which keyed state with
    timers needs; the session's own setting is as before afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return start()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
