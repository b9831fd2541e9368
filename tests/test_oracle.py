"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck, type_mismatches

from tidewatch.plans.catalog import QUERIES as CATALOG

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = df.toPandas()
    exp = con.execute(E.oracle_sql()[name]).df()
    assert compare(got, exp) is None
    assert type_mismatches(dict(df.dtypes), con, E.oracle_sql()[name]) == []


MODEL = ["forest_table_importance", "forest_table_scores", "model_dashboard_scores", "rf_auc", "rf_cv", "rf_cv_summary",
         "rf_evaluation", "rf_importance", "rf_scores", "rf_threshold", "stream_model_scores"]


def test_only_the_forest_has_no_oracle():
    """(beside the training-data queries, which have tests of their own)"""
    missing = set(E.queries()) - set(E.oracle_sql())
    assert sorted(n for n in missing if n in CATALOG) == MODEL


def test_forest_queries(spark):
    """Every forest query runs; its results have the stated ranges."""
    got = {n: E.queries()[n](spark, SF).collect() for n in MODEL}
    assert all(0 <= r.model_prob <= 100 and r.pred in (0, 1) for r in got["rf_scores"])
    cut = got["rf_threshold"][0].threshold
    assert all(r.pred == int(r.model_prob / 100 >= cut) for r in got["rf_scores"])
    assert abs(sum(r.importance for r in got["rf_importance"]) - 1) < 1e-9 and len(got["rf_importance"]) == 12
    assert [r.fold for r in sorted(got["rf_cv"], key=lambda r: r.fold)] == [1, 2, 3, 4, 5]
    folds = [r.accuracy for r in got["rf_cv"]]
    assert got["rf_cv_summary"][0].accuracy_mean == pytest.approx(sum(folds) / 5, abs=1e-4)
    assert sum(r.support for r in got["rf_evaluation"]) == len(got["rf_scores"])
    assert all(0 <= r["Probabilitas (%)"] <= 100 for r in got["model_dashboard_scores"])
    ranks = lambda n: [(r["rank"], r.feature, round(r.importance, 12)) for r in got[n]]
    assert ranks("forest_table_importance") == ranks("rf_importance")


def test_reloaded_forest_gives_the_same_scores(spark, tmp_path):
    from tidewatch.plans import catalog, training

    rows = catalog.matrix(spark, SF)
    model = training.fit_forest(rows, num_trees=5)
    training.save_model(model, str(tmp_path / "m"))
    again = training.load_model(str(tmp_path / "m"))
    a, b = (training.model_probability(m, rows).select("date", "district", "model_prob") for m in (model, again))
    assert a.exceptAll(b).count() == 0 and a.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 15
    assert df.columns == ["Kecamatan", "Status", "Probabilitas", "Tinggi_Genangan_m",
                          "Penduduk_Terdampak", "Lead_Time_jam"]
