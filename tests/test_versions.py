"""Published tables are replaced by one commit."""

import gzip

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import catalog as C
from tidewatch.plans import scoring_plans as SP
from tidewatch.sources import publish as PB
from tidewatch.sources import versions as V

SF = "/root/testdata/sf0.001"


def test_failing_writer_leaves_the_old_result(spark, tmp_path):
    path = str(tmp_path / "results")
    rows = SP.batch_scores(spark, C.event_scenarios(spark, SF).where("scenario_id < 20"))
    PB.write_results(rows.where("scenario_id < 5"), path)
    old = sorted(PB.read_results(spark, path, keep="scenario_id long").collect())
    bad = rows.withColumn("Probabilitas", F.when(F.col("scenario_id") == 17, F.raise_error(F.lit("lost"))).otherwise(F.col("Probabilitas")))
    with pytest.raises(Exception, match="lost"):
        PB.write_results(bad, path)
    assert sorted(PB.read_results(spark, path, keep="scenario_id long").collect()) == old
    PB.write_results(rows, path)
    assert PB.read_results(spark, path, keep="scenario_id long").count() == rows.count() > len(old)
    assert [n for n in V.names(spark, path) if n.startswith("v=")] == ["v=0", "v=1", "v=2"]  # v=1: what the failure left


def test_reader_of_the_old_version_goes_on(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        V.commit_version(spark, path, lambda to, i=i: spark.range(i + 1).write.parquet(to))
        if i == 1:
            held = spark.read.parquet(V.current_path(spark, path))
        if i == 2:
            assert held.count() == 2
    assert V.committed(spark, path) == [2, 3]
    assert spark.read.parquet(V.current_path(spark, path)).count() == 4


def test_a_version_is_committed_once(spark, tmp_path):
    path = str(tmp_path / "t")
    V.commit_version(spark, path, lambda to: spark.range(3).write.parquet(to), version=7)
    V.commit_version(spark, path, lambda to: spark.range(9).write.parquet(to), version=7)  # a replay
    assert spark.read.parquet(V.current_path(spark, path)).count() == 3

    def slow(to):
        spark.range(1).write.parquet(to)
        V.put_text(spark, f"{path}/_commits/8", "")  # another writer was faster

    with pytest.raises(RuntimeError, match="another writer"):
        V.commit_version(spark, path, slow, version=8)
    assert V.get_text(spark, f"{path}/_commits/9") is None
    assert V.put_text(spark, f"{path}/note", "ü") and V.get_text(spark, f"{path}/note") == "ü"


def test_compressed_tables_read_back_the_same(spark, tmp_path, monkeypatch):
    """Compressed lines take a fraction of the plain ones, in files of bounded length."""
    def size(path):
        return sum(f.stat().st_size for f in tmp_path.glob(f"{path}/v=*/part-*"))

    for name, read in (("result_roundtrip", PB.read_results), ("result_document", PB.read_documents)):
        paths = []

        def scratch(_, what):
            paths.append(f"{what}{len(paths)}")
            return str(tmp_path / paths[-1])

        monkeypatch.setattr(C, "scratch_path", scratch)
        monkeypatch.setattr(PB, "RESULTS_PER_FILE", 700)
        monkeypatch.setattr(PB, "DOCUMENTS_PER_FILE", 50)
        rows = C.QUERIES[name](spark, "/root/testdata/sf0.001")
        back = read(spark, str(tmp_path / paths[0]), keep="scenario_id long")
        plain = str(tmp_path / f"{name}-plain")
        back.write.json(f"{plain}/v=0")
        files = list(tmp_path.glob(f"{paths[0]}/v=*/part-*"))
        assert rows.count() > 0 and back.count() == sum(sum(1 for _ in gzip.open(f)) for f in files)
        assert max(sum(1 for _ in gzip.open(f)) for f in files) <= (700 if name == "result_roundtrip" else 50)
        assert 0 < size(paths[0]) * 4 < size(f"{name}-plain")
