"""Newest record as engine state, outcomes counted in the pass that stores them,
triggers by the clock, and the bucketed archive of seen links."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import rejects as RJ
from tidewatch.plans import catalog as C
from tidewatch.sources import seen as SN
from tidewatch.sources import testbind as TB
from tidewatch.sources import versions as V
from tidewatch.streaming import ingest as ST
from tidewatch.streaming import latest as SL
from tidewatch.streaming import reports as RP

SF = "/root/testdata/sf0.001"
RECORD = "topic string, key string, value string, ts timestamp"


def test_latest_goes_on_after_a_restart_and_ignores_late_records(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def arrive(*rows):
        spark.createDataFrame([(f"x-{t}", k, "{}", day and datetime(2024, 1, day)) for t, k, day in rows], RECORD) \
            .coalesce(1).write.mode("append").parquet(src)
        stream = ST.files_stream(spark, src, spark.createDataFrame([], RECORD).schema)
        ST.run_to_end(RP.with_rocksdb(spark, lambda: SL.publish_latest(stream, out, ck, order_col="ts")))
        return {r.dataset: (r.key, r.ts.day) for r in SL.read_latest(spark, out).collect()}

    assert arrive(("a", "1", 5), ("b", "2", 3), ("a", "0", 1)) == {"a": ("1", 5), "b": ("2", 3)}
    assert arrive(("a", "3", 2), ("c", "4", 1), ("b", "9", None)) == {"a": ("1", 5), "b": ("2", 3), "c": ("4", 1)}
    got = arrive(("b", "5", 4), ("a", "7", 5))              # a tie in time: the greater key
    assert got == {"a": ("7", 5), "b": ("5", 4), "c": ("4", 1)}
    batch = V.committed(spark, out)[-1]
    again = SL.read_latest(spark, out).withColumn("key", F.lit("wrong"))
    for replayed in (batch, batch - 1):
        SL.upsert(again, out, replayed)
    assert {r.dataset: (r.key, r.ts.day) for r in SL.read_latest(spark, out).collect()} == got


def test_counts_equal_the_stored_outcomes(spark, tmp_path):
    rows = [(1, 200, '{"current":{"time":"t","precipitation":1.5,"wind_speed_10m":7.2}}'), (2, 500, None), (3, None, "{}"),
            (4, 200, "nonsense"), (5, 200, '{"current":{"time":"t"}}'), (6, 200, None), (7, 404, '{"current":{"precipitation":1.0}}')]
    raw = spark.createDataFrame(rows, "event_id long, status int, body string")
    judged = RJ.judge(raw)
    assert {r.event_id: r.outcome for r in judged.collect()} == {1: "ok", 2: "status", 3: "status", 4: "body", 5: "rain", 6: "body", 7: "status"}
    assert judged.where("outcome = 'ok'").first().kecepatan_angin_ms == pytest.approx(2.0)
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    for part in (raw.where("event_id < 4"), raw.where("event_id >= 4")):
        part.coalesce(1).write.mode("append").parquet(src)
        ST.run_to_end(RJ.store_stream(ST.files_stream(spark, src, raw.schema), out, ck))
    counts = {r.batch: r for r in RJ.read_counts(spark, out).collect()}
    assert [(counts[b].n_read, counts[b].n_ok, counts[b].n_status, counts[b].n_body, counts[b].n_rain) for b in (0, 1)] \
        == [(3, 1, 2, 0, 0), (4, 0, 1, 2, 1)]
    stored = RJ.read_rows(spark, out, "event_id long, curah_hujan_mm double, batch long, outcome string")
    assert sorted((r.event_id, r.outcome) for r in stored.collect()) == sorted((r.event_id, r.outcome) for r in judged.collect())


def test_counting_needs_no_second_scan(spark, tmp_path):
    src = str(tmp_path / "raw")
    TB.raw_weather_responses(spark, SF).write.parquet(src)
    plan = RJ.judge(spark.read.parquet(src)).observe("n", *RJ.counts())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Exchange" not in plan
    empty = RJ.store(RJ.judge(spark.read.parquet(src).where("event_id < 0")), str(tmp_path / "none"))
    assert set(empty.values()) == {0}


def test_trigger_by_the_clock_runs_two_batches(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.range(3).coalesce(1).write.parquet(src)
    q = ST.start(ST.files_stream(spark, src, spark.range(1).schema), sink="parquet", path=out, checkpoint=ck,
                 trigger=ST.cadence_trigger(1))
    try:
        end, added = time.time() + 90, False
        while time.time() < end:
            done = [p for p in q.recentProgress if p.numInputRows]
            if len(done) == 1 and not added:
                spark.range(3, 5).coalesce(1).write.mode("append").parquet(src)
                added = True
            if len(done) == 2:
                break
            time.sleep(0.3)
        assert q.isActive and [p.numInputRows for p in q.recentProgress if p.numInputRows] == [3, 2]
    finally:
        q.stop()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]


def test_archive_of_seen_links_is_not_shuffled(spark, tmp_path):
    seen = SN.create(spark, str(tmp_path / "seen"), buckets=6)
    assert SN.unseen(spark.createDataFrame([("a",), (None,)], "link_md5 string"), seen).count() == 2
    links = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("link_md5"))
    SN.add(links.limit(300), seen)
    SN.add(links, seen)
    items = spark.range(400, 700).select("id", F.md5(F.col("id").cast("string")).alias("link_md5"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = SN.unseen(items, seen)
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert sorted(r.id for r in left.collect()) == list(range(500, 700))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    new = SN.rewrite(seen, spark, str(tmp_path / "seen2"))
    assert spark.table(new.table).count() == 500 and spark.table(seen.table).count() > 500
    assert len(spark.table(new.table).inputFiles()) <= 6


def test_bucketed_archive_gives_the_same_reports(spark):
    a, b = (C.QUERIES[n](spark, SF) for n in ("feed_exclude_bucketed", "feed_exclude_published"))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 and a.count() > 0
