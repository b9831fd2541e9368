"""Physical-plan properties the design relies on (checked with explain)."""

import re

from tidewatch.plans import catalog as C
from tidewatch.sources import testbind as TB

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(p: str) -> list[str]:
    return [line.strip() for line in p.splitlines() if re.search(r"\bExchange\b", line)
            and "BroadcastExchange" not in line]


def test_scoring_reads_two_columns_and_never_shuffles_scored_rows(spark):
    p = plan(C.QUERIES["batch_scores"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in p
    assert "props" not in p and "event_type" not in p
    ex = exchanges(p)
    # at most the round-robin spread of the narrow scenario rows before the fan-out
    assert all("RoundRobinPartitioning" in e for e in ex)
    assert "BroadcastExchange" in p


def test_top_k_reuses_scenario_partitioning(spark):
    p = plan(C.QUERIES["top5_priority"](spark, SF))
    ex = exchanges(p)
    assert len(ex) == 1 and "REPARTITION_BY_NUM" in ex[0]
    assert "WindowGroupLimit" in p
    assert "ReadSchema: struct<event_id:bigint,value:double>" in p


def test_recommendations_aggregate_without_second_exchange(spark):
    ex = exchanges(plan(C.QUERIES["top3_recommendations"](spark, SF)))
    assert len(ex) == 1 and "REPARTITION_BY_NUM" in ex[0]


def test_latest_is_take_ordered(spark):
    p = plan(C.QUERIES["latest_weather"](spark, SF))
    assert "TakeOrderedAndProject" in p and not exchanges(p)


def test_kpis_aggregate_partially_before_shuffle(spark):
    p = plan(C.QUERIES["kpi_cards"](spark, SF))
    assert "partial_count" in p


def test_rolling_rain_has_no_unpartitioned_window(spark):
    p = plan(C.QUERIES["rain_3day"](spark, SF))
    assert "Window" not in p and "SinglePartition" not in p


def test_dedup_uses_partial_min_by(spark):
    p = plan(C.QUERIES["feed_new_only"](spark, SF))
    assert "partial_min_by" in p and "WindowGroupLimit" in p


def test_documents_scan_prunes_text(spark):
    # (the metric itself reads a checkpoint of the score counts)
    p = plan(TB.classifier_scores(spark, SF))
    assert "text" not in re.findall(r"ReadSchema: struct<[^>]*>", p)[-1]


def test_formulas_run_in_whole_stage_codegen(spark):
    """The join and every formula projection after it share one generated
    stage (no interpreted fallback for the SQL-expression formulas)."""
    df = C.QUERIES["dashboard_scores"](spark, SF)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    stage_lines = [line for line in p.splitlines() if "BroadcastNestedLoopJoin" in line
                   or "Project [scenario_id" in line]
    assert stage_lines and all("*(" in line for line in stage_lines[:8])


def test_several_cities_plan_an_equi_join(spark):
    """J1 with the location from the data: hash join, no nested loop."""
    from tidewatch.plans.catalog import QUERIES

    plan = QUERIES["multi_city_scores"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_keys_alone_are_salted(spark):
    """A dimension too large to broadcast: only the key with many rows is split."""
    from tidewatch.operators import joins

    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"c{i}") for i in range(300)], "scenario_id long, location string")
    dim = spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"c{i}", 3) for i in range(300)], "location string, d int")
    got = joins.attach_dimension(facts, dim, "location", max_bytes=0, hot_rows=50, salt_key="scenario_id")
    want = facts.join(dim, "location")
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == want.count() == 500


def test_unknown_dimension_is_measured_before_broadcast(spark):
    from tidewatch.operators import joins

    assert joins.fits_broadcast(spark.range(100)) and not joins.fits_broadcast(spark.range(1000), max_bytes=2000)
