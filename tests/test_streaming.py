"""Structured Streaming operators on file sources with availableNow."""

from pyspark.sql import functions as F

from tidewatch.plans import catalog as C
from tidewatch.sources import testbind as TB
from tidewatch.streaming import ingest as ST

SF = "/root/testdata/sf0.001"


def test_stream_scores_equal_batch(spark):
    stream = C.QUERIES["stream_scores"](spark, SF)
    batch = C.QUERIES["batch_scores"](spark, SF)
    assert stream.count() == batch.count() == 15 * TB.table(spark, SF, "events").count()
    assert stream.exceptAll(batch).count() == 0


def test_snapshot_is_incremental_and_idempotent(spark, tmp_path):
    ev = TB.table(spark, SF, "events")
    src = str(tmp_path / "src")
    # two arrivals: the second batch holds the later half of the events
    cut = ev.approxQuantile("event_id", [0.5], 0.0)[0]
    ev.where(F.col("event_id") <= cut).write.parquet(src + "/a")
    schema = ev.schema
    out, ck, live = str(tmp_path / "snap"), str(tmp_path / "ck"), str(tmp_path / "live")

    def run():
        s = ST.files_stream(spark, src, schema, glob="*.parquet", recursive=True)
        s = s.select("event_id", "ts", F.concat(F.lit("tidewatch-"), F.col("event_type")).alias("topic"),
                     F.col("event_id").cast("string").alias("key"),
                     F.to_json(F.struct("event_id")).alias("value"))
        ST.run_to_end(ST.snapshot_latest(s, out, ck, order_col="ts", live_path=live))

    run()
    first = {r.topic: r.key for r in ST.read_snapshot(spark, out).collect()}
    ev.where(F.col("event_id") > cut).write.parquet(src + "/b")
    run()
    snap = {r.topic: r.key for r in ST.read_snapshot(spark, out).collect()}
    exp = {r.topic: r.key for r in C.QUERIES["latest_per_topic"](spark, SF).collect()}
    assert snap == exp
    assert set(first) == set(snap)
    # re-running with nothing new leaves the snapshot unchanged
    run()
    assert {r.topic: r.key for r in ST.read_snapshot(spark, out).collect()} == exp
    # the live files hold one JSON value per dataset: the newest event
    import json
    livevals = {r.dataset: json.loads(r.value)["event_id"]
                for r in spark.read.text(live).collect()}
    assert {f"tidewatch-{k}": str(v) for k, v in livevals.items()} == exp


def test_stream_dedup_keys(spark):
    got = C.QUERIES["stream_dedup"](spark, SF)
    exp = FD_keys(spark)
    assert sorted(r.link_md5 for r in got.collect()) == exp


def test_streams_read_tables_stored_as_folders(spark, tmp_path):
    """Tables of several part files are streamed whole, as single files are."""
    for name in ("pages", "events"):
        TB.table(spark, SF, name).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = C.QUERIES["stream_dedup"](spark, str(tmp_path))
    assert sorted(r.link_md5 for r in got.collect()) == FD_keys(spark)
    scores = [C.QUERIES["stream_scores"](spark, d) for d in (str(tmp_path), SF)]
    assert scores[0].count() == scores[1].count() > 0 and scores[0].exceptAll(scores[1]).count() == 0


def FD_keys(spark):
    items = TB.feed_items(spark, SF)
    return sorted(r[0] for r in items.select(F.md5("link")).distinct().collect())


def test_archive_partitions_by_dataset(spark):
    df = C.QUERIES["stream_archive"](spark, SF)
    assert df.count() == TB.table(spark, SF, "events").count()
    assert {r.dataset for r in df.select("dataset").distinct().collect()} == \
        {r.event_type for r in TB.table(spark, SF, "events").select("event_type").distinct().collect()}


def test_archive_restart_is_exactly_once(spark, tmp_path):
    """Re-running the archive query on the same checkpoint writes nothing new;
    new input files are archived once."""
    ev = TB.table(spark, SF, "events")
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "arch"), str(tmp_path / "ck")
    ev.where(F.col("event_id") % 2 == 0).write.parquet(src + "/a")

    def run():
        s = ST.files_stream(spark, src, ev.schema, glob="*.parquet", recursive=True)
        rec = s.select("event_id", F.concat(F.lit("tidewatch-"), F.col("event_type")).alias("topic"),
                       F.col("event_id").cast("string").alias("key"), F.lit("{}").alias("value"))
        ST.run_to_end(ST.archive_records(rec, out, ck))
        return spark.read.parquet(out).count()

    first = run()
    assert run() == first
    ev.where(F.col("event_id") % 2 == 1).write.parquet(src + "/b")
    assert run() == ev.count()


def test_publish_latest_scores(spark, tmp_path):
    """The newest event overall is published: a late batch, an empty one
    and one without rain leave the result as it is; old versions go."""
    import json
    from tidewatch import schemas as S
    from tidewatch.streaming.scoring import publish_latest_scores
    src = tmp_path / "w"
    src.mkdir()
    out, ck = str(tmp_path / "pub"), str(tmp_path / "ck")

    def arrive(name, *rows):
        (src / name).write_text("\n".join(json.dumps(dict(zip(S.WEATHER_EVENT.fieldNames(), r))) for r in rows))
        stream = ST.files_stream(spark, str(src), S.WEATHER_EVENT, fmt="json")
        ST.run_to_end(publish_latest_scores(spark, stream, out, ck))
        versions = ST._versions(spark, out + "/results")
        return versions, spark.read.json(f"{out}/results/v={versions[-1]}").orderBy(F.desc("Probabilitas"), "Kecamatan").collect()

    event = lambda t, rain: (f"2026-06-18T{t}", 27.9, 70, rain, 2.5833333333333335, "Surabaya")
    versions, got = arrive("a.json", event("00:30", 0.0), event("00:00", 90.0))
    assert [r.Kecamatan for r in got][:3] == ["Bulak", "Kenjeran", "Semampir"]
    assert len(got) == 15 and got[0].Probabilitas == 24.8   # newest event: rain 0.0
    assert arrive("b.json", event("00:10", 80.0)) == (versions, got)      # late
    assert arrive("c.json", event("02:00", None)) == (versions, got)      # no rain
    for i, t in enumerate(("03:00", "04:00", "05:00")):
        versions, got = arrive(f"d{i}.json", event(t, 200.0))
    assert len(versions) == 2 and got[0].Probabilitas == 100.0


def test_dedup_forgets_keys_after_the_horizon(spark, tmp_path):
    """A key seen again within the horizon is dropped; after the
    watermark has passed it, its state is gone and it counts as new."""
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    schema = "k string, t timestamp"

    def arrive(*rows):
        spark.createDataFrame(list(rows), "k string, t string").select("k", F.col("t").cast("timestamp").alias("t")) \
            .coalesce(1).write.mode("append").parquet(src)
        stream = ST.files_stream(spark, src, schema)
        new = ST.dedup_keys(stream, "k", event_time="t", horizon=ST.DEDUP_HORIZON)
        ST.run_to_end(ST.start(new, sink="parquet", path=out, checkpoint=ck))
        return sorted((r.k, str(r.t)[:10]) for r in spark.read.parquet(out).collect())

    assert arrive(("a", "2024-01-01"), ("a", "2024-01-02")) == [("a", "2024-01-01")]
    assert arrive(("a", "2024-01-05")) == [("a", "2024-01-01")]
    assert arrive(("b", "2024-03-01")) == [("a", "2024-01-01"), ("b", "2024-03-01")]
    assert arrive(("c", "2024-03-02")) == [("a", "2024-01-01"), ("b", "2024-03-01"), ("c", "2024-03-02")]
    assert arrive(("a", "2024-03-03"))[-3:] == [("a", "2024-03-03"), ("b", "2024-03-01"), ("c", "2024-03-02")]


def test_topic_records_parse_back(spark, tmp_path):
    """S7 + F14: weather records written to a (file) topic parse back to the
    flat event schema."""
    from tidewatch import schemas as S
    from tidewatch.sources import publish as PB
    w = TB.weather_events(spark, SF)
    PB.write_topic(PB.weather_records(w, TB.WEATHER_TOPIC), fmt="json", path=str(tmp_path / "t"))
    rec = spark.read.schema("topic string, key string, value string").json(str(tmp_path / "t"))
    back = ST.parse_values(rec, S.WEATHER_EVENT)
    assert back.columns == ["topic", "key"] + S.WEATHER_EVENT.fieldNames()
    assert {r.key for r in back.select("key").distinct().collect()} == {"SBY"}
    exp = w.select(*S.WEATHER_EVENT.fieldNames())
    assert back.drop("topic", "key").exceptAll(exp).count() == 0
    assert back.count() == exp.count()


def test_processing_time_trigger_runs_batch_after_batch(spark, tmp_path):
    """One service query, started once, takes a later arrival by its next
    trigger without a restart."""
    import time

    ev = TB.table(spark, SF, "events").select("event_id", "ts")
    cut = ev.approxQuantile("event_id", [0.5], 0.0)[0]
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    ev.where(F.col("event_id") <= cut).coalesce(1).write.parquet(src + "/a")
    stream = ST.files_stream(spark, src, ev.schema, glob="*.parquet", recursive=True)
    q = ST.start(stream, sink="parquet", path=out, checkpoint=str(tmp_path / "ck"), trigger={"processingTime": "1 second"})

    def wait(rows: int) -> int:
        end = time.time() + 60
        while sum(p["numInputRows"] for p in q.recentProgress) < rows and time.time() < end:
            assert q.exception() is None
            time.sleep(0.2)
        return sum(p["numInputRows"] for p in q.recentProgress)

    try:
        half, every = ev.where(F.col("event_id") <= cut).count(), ev.count()
        assert wait(half) == half
        ev.where(F.col("event_id") > cut).coalesce(1).write.parquet(src + "/b")
        assert wait(every) == every
        full = [p for p in q.recentProgress if p["numInputRows"]]
        assert len(full) == 2 and full[0]["batchId"] < full[1]["batchId"]
    finally:
        q.stop()
    assert spark.read.parquet(out).exceptAll(ev).count() == 0 and spark.read.parquet(out).count() == every
