"""The archive by dataset and day: batches, compaction, pruned reads."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources import dated as DA
from tidewatch.sources import versions as V

SCHEMA = T.StructType([T.StructField("topic", T.StringType()), T.StructField("key", T.StringType()),
                       T.StructField("ts", T.TimestampType())])


def records(spark, rows):
    return spark.createDataFrame([(f"tidewatch-{d}", k, t and datetime.fromisoformat(t)) for d, k, t in rows], SCHEMA)


def content(spark, path):
    return sorted((r.dataset, r.day, r.key) for r in DA.read(spark, path, SCHEMA).collect())


@pytest.fixture
def archive(spark, tmp_path):
    path = str(tmp_path / "archive")
    DA.append(records(spark, [("a", "1", "2024-01-01T10:00"), ("a", "2", "2024-01-02T10:00"), ("b", "3", None)]), path, 0)
    DA.append(records(spark, [("a", "4", "2024-01-01T11:00"), ("b", "5", "2024-01-01T09:00"), ("a", "6", "2024-01-02T09:00")]), path, 1)
    return path


ALL = sorted([("a", "2024-01-01", "1"), ("a", "2024-01-02", "2"), ("b", "none", "3"),
              ("a", "2024-01-01", "4"), ("b", "2024-01-01", "5"), ("a", "2024-01-02", "6")])


def test_replayed_batch_changes_nothing(spark, archive):
    assert content(spark, archive) == ALL
    DA.append(records(spark, [("a", "9", "2024-01-03T10:00")]), archive, 1)
    assert content(spark, archive) == ALL


def test_absent_archive_has_no_rows(spark, tmp_path):
    path = str(tmp_path / "none")
    assert DA.read(spark, path, SCHEMA).columns == ["topic", "key", "ts", "dataset", "day"]
    assert content(spark, path) == [] and DA.compact(spark, path, SCHEMA) == 0
    assert DA.latest(spark, path, SCHEMA, "a").collect() == []


def test_compaction_keeps_rows_and_leaves_one_unit_a_day(spark, archive):
    assert DA.compact(spark, archive, SCHEMA) == 4          # two days of a, two units each
    places = [DA._place(u) for u in DA.manifest(spark, archive)[1]["units"]]
    assert len(places) == len(set(places)) == 4
    assert content(spark, archive) == ALL
    assert DA.compact(spark, archive, SCHEMA) == 0
    assert DA.vacuum(spark, archive) == 0 and DA.vacuum(spark, archive, keep=0) == 4
    assert content(spark, archive) == ALL
    assert V.names(spark, f"{archive}/segment=b0/dataset=a") == []


def test_compaction_that_dies_loses_no_row(spark, archive, monkeypatch):
    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(DA, "_commit", dies)
        with pytest.raises(RuntimeError, match="lost"):     # all is written, nothing committed
            DA.compact(spark, archive, SCHEMA)
    assert content(spark, archive) == ALL
    assert DA.compact(spark, archive, SCHEMA) == 4 and content(spark, archive) == ALL


def test_batches_and_compactions_meanwhile(spark, archive, monkeypatch):
    commit = DA._commit

    def late(spark, path, change):
        monkeypatch.setattr(DA, "_commit", commit)
        DA.append(records(spark, [("a", "7", "2024-01-01T12:00")]), path, 2)
        assert DA.compact(spark, path, SCHEMA) == 5         # another one is faster
        return commit(spark, path, change)

    monkeypatch.setattr(DA, "_commit", late)
    assert DA.compact(spark, archive, SCHEMA) == 0
    assert content(spark, archive) == sorted(ALL + [("a", "2024-01-01", "7")])


def test_latest_opens_the_newest_day_only(spark, archive):
    DA.compact(spark, archive, SCHEMA)
    row = DA.latest(spark, archive, SCHEMA, "a").collect()
    assert [(r.key, r.day) for r in row] == [("2", "2024-01-02")]
    assert DA.latest(spark, archive, SCHEMA, "c").collect() == []
    files = DA.newest_day(spark, archive, SCHEMA, "a").inputFiles()
    assert files and all("dataset=a/day=2024-01-02" in f for f in files)
    day = DA.read(spark, archive, SCHEMA).where((F.col("dataset") == "a") & (F.col("day") == "2024-01-01"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan and "2024-01-01" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert day.count() == 2


def test_many_files_of_a_hot_day(spark, tmp_path):
    path = str(tmp_path / "hot")
    rows = spark.range(20000).select(F.lit("tidewatch-a").alias("topic"), F.col("id").cast("string").alias("key"),
                                     F.lit("2024-05-01 00:00:00").cast("timestamp").alias("ts"))
    DA.append(rows, path, 0)
    DA.append(rows, path, 1)
    assert DA.compact(spark, path, SCHEMA, file_bytes=20000) == 2
    files = DA.newest_day(spark, path, SCHEMA, "a").inputFiles()
    assert len(files) > 3                                   # one instant is still cut over tasks
    assert DA.read(spark, path, SCHEMA).groupBy("key").count().where("count <> 2").count() == 0
