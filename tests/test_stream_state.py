"""Stateful streams: 3-day rain by windows, the report producer by keyed state."""

import datetime

from pyspark.sql import functions as F

from tidewatch.operators import timeseries as TS
from tidewatch.streaming import ingest as ST
from tidewatch.streaming import rain as SR
from tidewatch.streaming import reports as RP


def test_rain_windows_close_once_and_late_rows_are_counted(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema = "location string, date date, rain_mm double"
    late = []

    def arrive(*rows):
        spark.createDataFrame([(c, datetime.date(2024, 1, d), r) for c, d, r in rows], schema).coalesce(1).write.mode("append").parquet(src)
        days = SR.rolling_sum_stream(ST.files_stream(spark, src, schema), "rain_mm", "rain_3day_mm", lateness="2 days")
        q = ST.start(days, sink="parquet", path=out, checkpoint=ck)
        ST.run_to_end(q)
        late.append(SR.late_rows(q))
        return {(r.location, r.date.day): (r.rain_mm, r.rain_3day_mm) for r in spark.read.parquet(out).collect()}

    assert arrive(("a", 1, 0.1), ("a", 2, 0.2), ("b", 2, 5.0)) == {}
    # the watermark is January 3: windows that end by then are closed
    got = arrive(("a", 5, 1.0), ("b", 5, 2.0))
    assert got == {("a", 1): (0.1, 0.1), ("a", 2): (0.2, 0.3), ("b", 2): (5.0, 5.0)}
    # a day late but inside the lateness, and one that comes too late for its own window
    assert arrive(("a", 4, 10.0), ("a", 2, 99.0)) == got
    assert late[:2] == [0, 0] and late[2] > 0
    got = arrive(("a", 12, 0.0))
    # the late row still counts in the windows that were open
    assert got[("a", 4)] == (10.0, 109.2) and got[("a", 5)] == (1.0, 11.0) and ("a", 12) not in got
    assert ("b", 3) not in got and len(got) == 6


def test_rain_stream_equals_batch_in_any_order(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    days = [("s%d" % (i % 3), datetime.date(2024, 1, 1) + datetime.timedelta(days=(i * 7) % 50), (i % 13) / 10) for i in range(120) if i % 5]
    df = spark.createDataFrame(sorted({(c, d): r for c, d, r in days}.items()), "k struct<location:string, date:date>, rain_mm double") \
        .select("k.location", "k.date", "rain_mm")
    df.repartition(4).write.parquet(src)
    got = SR.rolling_sum_stream(ST.files_stream(spark, src, df.schema, max_files_per_trigger=1), "rain_mm", "r3", lateness="60 days")
    ST.run_to_end(ST.start(got, sink="parquet", path=out, checkpoint=ck))
    spark.createDataFrame([("s0", datetime.date(2024, 9, 1), 0.0)], df.schema).write.mode("append").parquet(src)
    ST.run_to_end(ST.start(SR.rolling_sum_stream(ST.files_stream(spark, src, df.schema), "rain_mm", "r3", lateness="60 days"),
                           sink="parquet", path=out, checkpoint=ck))
    rows = {(r.location, r.date, r.rain_mm, r.r3) for r in spark.read.parquet(out).collect()}
    want = {(r.location, r.date, r.rain_mm, r.r3) for r in TS.rolling_sum_days(df, "rain_mm", "r3").collect()}
    assert rows == want


def test_producer_restart_and_expiry(spark, tmp_path):
    """Five items a poll, unseen links only; the state survives a restart, and
    shrinks when links are older than the age."""
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    kept = []

    def arrive(poll, minute, links):
        items = [(poll, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute), i, "t", x) for i, x in enumerate(links)]
        df = spark.createDataFrame(items, "poll_id bigint, polled_at timestamp, position int, title string, link string")
        RP.polls_of(df).coalesce(1).write.mode("append").parquet(src)
        new = RP.new_reports_stream(ST.files_stream(spark, src, RP.POLL), max_age_s=3600)
        q = RP.with_rocksdb(spark, lambda: ST.start(new, sink="parquet", path=out, checkpoint=ck))
        ST.run_to_end(q)
        kept.append([p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]][-1])
        return sorted((r.poll_id, r.position, r.link) for r in spark.read.schema(RP.OUT).parquet(out).collect())

    assert arrive(0, 0, ["a", "b", "a", "c", "d", "e"]) == [(0, 0, "a"), (0, 1, "b"), (0, 3, "c"), (0, 4, "d")]
    got = arrive(1, 5, ["e", "a", "f"])  # a restart: a is known, e was sixth before
    assert got[4:] == [(1, 0, "e"), (1, 2, "f")]
    assert arrive(2, 300, ["g"])[6:] == [(2, 0, "g")]
    got = arrive(3, 301, ["a", "g"])  # a was forgotten, g was not
    assert got[7:] == [(3, 0, "a")]
    assert kept[1] > kept[0] and kept[-1] < kept[1]
    assert spark.conf.get(RP.PROVIDER, "") != RP.ROCKSDB
