"""Unit tests of individual operators on small fixtures, checked against
brute-force Python restatements."""

import datetime as dt
import itertools
import json
import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas as S
from tidewatch.functions import numeric as N
from tidewatch.functions import text as TX
from tidewatch.operators import evaluation as EV
from tidewatch.operators import feed as FD
from tidewatch.operators import ingest, joins, kpi, timeseries as TS
from tidewatch.sources import archive as AR
from tidewatch.sources.districts import district_codes, districts


def test_rint_rounding_matches_numpy(spark):
    vals = [0.125, 0.135, 2.5, 3.5, 12.5, -0.5, 1.005, 2.675, 0.045]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.select(N.r2("x").alias("a"), N.r0("x").alias("b"), N.r1("x").alias("c")).collect()
    for v, r in zip(vals, got):
        assert r.a == float(np.round(v, 2))
        assert r.b == round(v)
        assert r.c == float(np.round(v, 1))


def test_fixed_and_thousands_match_python(spark):
    vals = [0.0, 12.5, 13.5, 0.125, 99.99, 1234567.0, 3.14159]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.select(TX.fixed("x", 0).alias("f0"), TX.fixed("x", 2).alias("f2"),
                    TX.thousands("x").alias("t")).collect()
    for v, r in zip(vals, got):
        assert r.f0 == f"{float(np.round(v, 0)):.0f}"
        assert r.f2 == f"{float(np.round(v, 2)):.2f}"
        assert r.t == f"{int(v):,}"


def test_band_directions(spark):
    df = spark.createDataFrame([(80.0, 2), (50.0, 5), (10.0, 9)], "p double, lead int")
    got = df.select(N.band("p", 70.0, 40.0).alias("a"),
                    N.band("lead", 3, 6, higher_is_worse=False).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [("danger", "danger"), ("warn", "warn"), ("safe", "safe")]


def test_string_indexer_codes_match_dimension(spark):
    from pyspark.ml.feature import StringIndexer
    d = districts(spark)
    m = StringIndexer(inputCol="district", outputCol="c", stringOrderType="alphabetAsc").fit(d)
    got = {r.district: int(r.c) for r in m.transform(d).collect()}
    assert got == district_codes()
    assert got["Benowo"] == 0 and got["Wonokromo"] == 14


def test_salted_join_equals_broadcast(spark):
    sc = spark.createDataFrame([(i, "Surabaya") for i in range(50)], "scenario_id long, location string")
    d = districts(spark)
    a = joins.attach_dimension(sc, d, "location", known_rows=15)
    b = joins.attach_dimension(sc, d, "location", max_bytes=0, salt_key="scenario_id", hot_rows=10)
    key = ["scenario_id", "district"]
    assert sorted(a.select(*key).collect()) == sorted(b.select(*key).collect())
    assert b.count() == 50 * 15


def test_data_location_plans_broadcast_hash_join(spark):
    sc = spark.createDataFrame([(i, "Surabaya" if i % 2 else "Other") for i in range(10)],
                               "scenario_id long, location string")
    j = joins.attach_dimension(sc, districts(spark), "location", known_rows=15)
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert j.count() == 5 * 15


def test_tolerant_read(spark, tmp_path):
    good = tmp_path / "w.json"
    good.write_text(json.dumps({"timestamp": "2026-06-18T00:30", "suhu_c": 27.9,
                                "kelembaban_pct": 70, "curah_hujan_mm": 0.0,
                                "kecepatan_angin_ms": 2.58, "lokasi": "Surabaya"}) + "\n{broken\n")
    df = AR.read_weather_snapshot(spark, str(good))
    assert df.count() == 1
    missing = AR.read_weather_snapshot(spark, str(tmp_path / "nope.json"))
    assert missing.count() == 0 and missing.schema == S.WEATHER_EVENT
    rej = AR.read_rejects(spark, str(good), S.WEATHER_EVENT).cache()
    assert [r._corrupt_record for r in rej.collect()] == ["{broken"]


NESTED = {"result": {"objects": {"output": {"geometries": [{
    "properties": {"pkey": "ID-9926", "created_at": "2026-06-18T02:01:21Z", "source": "facebook",
                   "status": "confirmed", "tags": {"flood_depth": 28, "kecamatan": "Rungkut"},
                   "text": "Macet parah karena genangan"},
    "geometry": {"coordinates": [112.7401, -7.2616]}}]}}}}


def test_report_document_flatten(spark, tmp_path):
    p = tmp_path / "laporan.json"
    p.write_text(json.dumps(NESTED, indent=4))
    rows = ingest.flatten_reports(AR.read_report_snapshot(spark, str(p))).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.pkey, r.created_at, r.source, r.status, r.flood_depth, r.kecamatan, r.lon, r.lat) == \
        ("ID-9926", "2026-06-18T02:01:21Z", "facebook", "confirmed", 28, "Rungkut", 112.7401, -7.2616)


def test_normalize_and_defaults(spark):
    body = json.dumps({"current": {"time": "2026-06-18T00:30", "temperature_2m": 27.9,
                                   "relative_humidity_2m": 70, "wind_speed_10m": 9.3}})
    raw = spark.createDataFrame([(1, 200, body), (2, 503, body)], "event_id long, status int, body string")
    ok, rejected = ingest.split_by_status(raw)
    assert rejected.count() == 1
    n = ingest.normalize_weather(raw).collect()
    assert len(n) == 1 and n[0].curah_hujan_mm is None
    assert n[0].kecepatan_angin_ms == 9.3 / 3.6
    d = ingest.with_defaults(ingest.normalize_weather(raw)).collect()[0]
    assert d.curah_hujan_mm == 0.0 and d.kelembaban_pct == 70


def test_latest_per_key_hot_key(spark):
    rows = [(("a" if i % 3 else "b"), i, float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t long, v double").repartition(7)
    got = {r.k: (r.t, r.v) for r in ingest.latest_per_key(df, "k", "t", ["t", "v"]).collect()}
    assert got == {"a": (299, 299.0), "b": (297, 297.0)}


def test_rolling_sum_brute_force(spark):
    rng = np.random.default_rng(3)
    start = dt.date(2024, 1, 1)
    days = sorted(set(int(x) for x in rng.integers(0, 60, 40)))
    rows = [("A", start + dt.timedelta(days=d), float(rng.integers(0, 400)) / 10) for d in days]
    rows += [("B", start + dt.timedelta(days=d), 1.5) for d in range(5)]
    df = spark.createDataFrame(rows, "location string, date date, rain_mm double")
    got = {(r.location, r.date): r.r3 for r in
           TS.rolling_sum_days(df, "rain_mm", "r3").collect()}
    assert len(got) == len(rows)
    for loc, d, _ in rows:
        exp = sum(v for l2, d2, v in rows if l2 == loc and 0 <= (d - d2).days <= 2)
        assert math.isclose(got[(loc, d)], exp, abs_tol=1e-9)


def test_time_folds_expanding(spark):
    dates = [(dt.date(2024, 1, 1) + dt.timedelta(days=i),) for i in range(20)]
    df = spark.createDataFrame(dates, "date date")
    f = TS.time_series_folds(df, 5).collect()
    for k in range(1, 6):
        train = sorted(r.date for r in f if r.fold == k and r.role == "train")
        test = sorted(r.date for r in f if r.fold == k and r.role == "test")
        assert train and test and max(train) < min(test)
    split = TS.chronological_split(df).collect()
    assert sum(r.role == "test" for r in split) == 4


def _auc_brute(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_roc_fbeta_brute_force(spark):
    rng = np.random.default_rng(11)
    ys = [int(v) for v in rng.integers(0, 2, 400)]
    ss = [float(np.round(v, 2)) for v in rng.random(400) * 0.6 + np.array(ys) * 0.3]
    df = spark.createDataFrame(list(zip(ys, ss)), "y int, score double")
    exp = _auc_brute(ys, ss)
    assert math.isclose(EV.auc(df).collect()[0].auc, exp, rel_tol=1e-12)
    # many small score ranges (quantile cuts + Bucketizer) give the same answer
    assert math.isclose(EV.auc(df, rows_per_bucket=7).collect()[0].auc, exp, rel_tol=1e-12)
    roc = {r.threshold: r for r in EV.roc_curve(df, rows_per_bucket=5).collect()}
    for t in list(roc)[:20]:
        tp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 1)
        fp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 0)
        assert (roc[t].tp, roc[t].fp) == (tp, fp)
    best = EV.best_threshold(EV.roc_curve(df)).collect()[0]
    fb = []
    for t in sorted(set(ss)):
        tp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 1)
        fp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 0)
        p = tp / (tp + fp) if tp + fp else 0.0
        r = tp / sum(ys)
        fb.append(((3.25 * p * r / (2.25 * p + r)) if (2.25 * p + r) else 0.0, -t))
    assert math.isclose(best.fbeta, max(fb)[0], rel_tol=1e-12) and best.threshold == -max(fb)[1]


def test_class_report_matches_counts(spark):
    rows = [(1, 1)] * 7 + [(1, 0)] * 3 + [(0, 1)] * 5 + [(0, 0)] * 85
    df = spark.createDataFrame(rows, "y int, pred int")
    rep = {r["class"]: r for r in EV.class_report(df).collect()}
    assert rep[1].precision == 7 / 12 and rep[1].recall == 0.7 and rep[1].support == 10
    assert rep[0].precision == 85 / 88 and rep[0].support == 90
    avg = {r.average: r for r in EV.report_averages(EV.class_report(df)).collect()}
    assert avg["accuracy"].f1 == 92 / 100


def test_fold_summary_population_std(spark):
    # the five published CV AUC values give the published mean and std
    vals = [0.8967, 0.6292, 0.6877, 0.9029, 0.7479]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "fold int, auc double")
    r = EV.mean_std(df, ["auc"]).collect()[0]
    assert (r.auc_mean, r.auc_std) == (0.7729, 0.1102)


def test_feed_rules(spark):
    items = [(p, pos, f"t{p}{pos}", link) for p, pos, link in [
        (0, 0, "a"), (0, 1, "b"), (0, 2, "a"), (0, 3, "c"), (0, 4, "d"), (0, 5, "e"),
        (1, 0, "b"), (1, 1, "f"), (1, 2, "g")]]
    df = spark.createDataFrame(items, "poll_id long, position int, title string, link string")
    new = FD.new_reports(df).collect()
    # poll 0: a, b, c, d (position 5 is beyond the first five; second "a" is a repeat)
    # poll 1: f, g (b already sent)
    assert sorted((r.poll_id, r.link) for r in new) == [(0, "a"), (0, "b"), (0, "c"), (0, "d"),
                                                       (1, "f"), (1, "g")]
    seen = spark.createDataFrame([(TX_md5("c"),)], "link_md5 string")
    fresh = FD.new_reports(df, archive=seen).collect()
    assert "c" not in {r.link for r in fresh}


def TX_md5(s):
    import hashlib
    return hashlib.md5(s.encode()).hexdigest()


def test_kpi_cards(spark):
    rows = [(1, 75.0, 100, 2), (1, 50.0, 2000, 5), (1, 10.0, 3000, 9), (2, 5.0, 10, 12)]
    df = spark.createDataFrame(rows, "scenario_id long, probability double, people_affected long, lead_time_h int")
    got = {r.scenario_id: r for r in kpi.kpi_cards(df).collect()}
    r = got[1]
    assert (r.critical_count, r.watch_count, r.total_people, r.min_lead_time_h) == (1, 1, 5100, 2)
    assert (r.critical_band, r.watch_band, r.people_band, r.lead_band) == ("danger", "warn", "danger", "danger")
    assert got[2].people_band == "safe" and got[2].lead_band == "safe"


def test_text_patterns_and_triggers(spark):
    from tidewatch.streaming import ingest as ST
    df = spark.createDataFrame([("2026-06-18 00:30:05",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("t"))
    r = df.select(TX.minute_text("t").alias("a"), TX.second_text("t").alias("b"),
                  TX.archive_stamp_text("t").alias("c"), TX.iso_text("t").alias("d"),
                  TX.dataset_of_topic(F.lit("tidewatch-cuaca")).alias("e")).collect()[0]
    assert (r.a, r.b, r.c, r.d, r.e) == ("2026-06-18T00:30", "2026-06-18 00:30:05",
                                         "2026-06-18_00-30-05", "2026-06-18T00:30:05.000000", "cuaca")
    assert ST.WEATHER_TRIGGER == {"processingTime": "60 seconds"}
    assert ST.RESCORE_TRIGGER == {"processingTime": "20 seconds"}


def test_multi_city_scoring_joins_by_location(spark):
    """Several cities in one job: every scenario meets only its own city's
    districts (equi-join on location, broadcast hash join)."""
    from tidewatch.operators import scoring
    a = districts(spark, "Surabaya")
    b = districts(spark, "Sidoarjo").where(F.col("district_code") < 4)
    dims = a.unionByName(b)
    sc = spark.createDataFrame(
        [(i, "Surabaya" if i % 3 else "Sidoarjo", "t", float(i), 80, 28.0, 3.0, 1, None, None)
         for i in range(30)],
        "scenario_id long, location string, observed_text string, rain_mm double, humidity_pct long, "
        "temp_c double, wind_ms double, month int, rain_3day_mm double, sunshine_h double")
    out = scoring.score(sc, dims, "batch", district_rows=None)
    counts = {r.scenario_id: r["count"] for r in out.groupBy("scenario_id").count().collect()}
    assert all(counts[i] == (15 if i % 3 else 4) for i in range(30))
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_rank_metrics_leave_out_unusable_scores(spark):
    """NaN and NULL scores and NULL labels are rejected alike, in one score
    range and in several."""
    nan = float("nan")
    rows = [(1, 0.9), (0, 0.2), (1, 0.4), (0, 0.4), (1, nan), (0, nan), (1, None), (None, 0.3), (0, 0.1), (1, 0.7)]
    df = spark.createDataFrame(rows, "y int, score double")
    clean = spark.createDataFrame([r for r in rows if None not in r and r[1] == r[1]], "y int, score double")
    want = EV.auc(clean).collect()
    assert want[0].positives == 3 and want[0].negatives == 3
    for size in (2, 3, 1_000_000):
        assert EV.auc(df, rows_per_bucket=size).collect() == want
    good, bad = EV.split_scored(df)
    assert good.count() == 6 and bad.count() == 4
