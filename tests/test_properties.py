"""Hypothesis property tests: distributed operators equal brute force."""

import datetime as dt
import itertools
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewatch.operators import evaluation as EV
from tidewatch.operators import timeseries as TS

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 40),
                          st.integers(0, 999)), min_size=1, max_size=40,
                unique_by=lambda t: (t[0], t[1])))
def test_rolling_sum_property(spark, rows):
    start = dt.date(2024, 1, 1)
    data = [(loc, start + dt.timedelta(days=d), v / 10) for loc, d, v in rows]
    df = spark.createDataFrame(data, "location string, date date, rain_mm double")
    got = {(r.location, r.date): r.r3 for r in TS.rolling_sum_days(df, "rain_mm", "r3").collect()}
    assert len(got) == len(data)
    for loc, d, _ in data:
        exp = sum(v for l2, d2, v in data if l2 == loc and 0 <= (d - d2).days <= 2)
        assert math.isclose(got[(loc, d)], exp, abs_tol=1e-9)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=2, max_size=60)
       .filter(lambda xs: 0 < sum(y for y, _ in xs) < len(xs)))
def test_auc_property(spark, rows):
    data = [(y, s / 20) for y, s in rows]
    df = spark.createDataFrame(data, "y int, score double")
    got = EV.auc(df).collect()[0].auc
    got_ranges = EV.auc(df, rows_per_bucket=3).collect()[0].auc
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    exp = sum(1.0 if p > q else 0.5 if p == q else 0.0
              for p, q in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert math.isclose(got, exp, rel_tol=1e-12)
    assert math.isclose(got_ranges, exp, rel_tol=1e-12)
