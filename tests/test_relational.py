import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from canopy.constants import AGE_BINS, BED_BINS
from canopy.functions import scalars as X
from canopy.operators import aggregates as A, quality as Q, relational as R

D, T = dt.date, dt.datetime


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_two_months_before_the_last_of_april(spark, rows):
    df = spark.createDataFrame([(D(2024, 2, 28),), (D(2024, 2, 29),), (D(2024, 5, 1),)], "date date")
    assert rows(R.since(df, "date", "2 months", D(2024, 4, 30))) == [(D(2024, 2, 29),), (D(2024, 5, 1),)]


def test_rounding_and_bins(spark):
    assert [one(spark, X.round_to_int(F.lit(v))) for v in (2.5, 3.5, 2.7, -0.5)] == [2, 4, 3, 0]
    ages = [one(spark, X.classify(F.lit(float(v)), AGE_BINS)) for v in (0, 3, 3.5, 10, 100, 101)]
    assert ages == [None, "jung", "mittel", "mittel", "alt", None]
    assert [one(spark, X.classify(F.lit(v), BED_BINS)) for v in (5.0, 5.1)] == ["klein", "groß"]


def test_last_minute_50(spark):
    got = [one(spark, X.last_minute_50(F.lit(t))) for t in (T(2024, 1, 2, 3, 50), T(2024, 1, 2, 3, 49, 59), T(2024, 1, 2, 0, 10))]
    assert got == [T(2024, 1, 2, 3, 50), T(2024, 1, 2, 2, 50), T(2024, 1, 1, 23, 50)]


def test_day_of_mixed_input(spark):
    assert one(spark, X.as_day(F.lit("2024-05-01"))) == D(2024, 5, 1)
    for text in ("no day", "2024-01-01xyz", "2024-13-01", "2024-05-01 9"):
        assert one(spark, X.as_day(F.lit(text))) is None
    assert one(spark, X.as_day(F.lit(T(2024, 5, 1, 9)))) == D(2024, 5, 1)


def test_nan_becomes_null(spark):
    assert one(spark, X.nullable(F.lit(float("nan")))) is None


def test_daily_weather_days_are_central_european_across_the_clock_change(spark, rows):
    """On 31 March the day starts at 23:00 UTC and, after the change, ends at 22:00 UTC."""
    hours = [T(2024, 3, 30, 22), T(2024, 3, 30, 23), T(2024, 3, 31, 21), T(2024, 3, 31, 22)]
    df = spark.createDataFrame([(2, t, 1.0, 1.0, 1.0, 5.0, 2.0, None) for t in hours],
                               "tile_id int, ts timestamp, ghi double, dni double, dhi double, temp double, wind double, rainfall_mm double")
    out = A.daily_weather(df)
    assert rows(out, "date", "ghi_sum_whm2", "rainfall_mm") == [
        (D(2024, 3, 30), 1.0, 0.0), (D(2024, 3, 31), 2.0, 0.0), (D(2024, 4, 1), 1.0, 0.0)]


def test_daily_rain_is_a_mean_with_the_sum_on_request(spark, rows):
    df = spark.createDataFrame([(1, T(2024, 1, 1, 1), 2.0), (1, T(2024, 1, 1, 2), 4.0)], "tile_id int, ts timestamp, rainfall_mm double")
    assert rows(A.daily_rain(df)) == [(1, D(2024, 1, 1), 3.0, 4.0)]
    assert rows(A.daily_rain(df, "sum")) == [(1, D(2024, 1, 1), 6.0, 4.0)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0, -1.0])), min_size=1, max_size=60))
def test_percentiles_are_exact(spark, values):
    df = spark.createDataFrame([(None, v) for v in values], "k string, v double")
    r = A.exact_percentiles(df, ["k"], "v", {"a": 0.1, "m": 0.5, "z": 1.0}, "mean", leaf=7, buckets=4).first()
    assert [r.a, r.m, r.z] == pytest.approx(list(np.percentile(values, [10, 50, 100])), rel=1e-9, abs=1e-9)
    assert r.mean == pytest.approx(np.mean(values), rel=1e-6, abs=1e-6)


def test_percentiles_of_a_narrow_hot_group_infinities_and_null_groups(spark):
    inf = float("inf")
    rows_ = [("hot", 1000 + i / 5000) for i in range(5000)] + [(None, v) for v in (1.0, inf, 2.0)] + [("i", inf), ("i", -inf), ("i", inf)]
    df = spark.createDataFrame(rows_, "k string, v double").repartition(4)
    out = A.exact_percentiles(df, ["k"], "v", {"m": 0.5, "q": 0.9}, leaf=2, buckets=16)
    assert "_bin" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r.k: r for r in out.collect()}
    assert got["hot"].m == pytest.approx(np.percentile([v for k, v in rows_ if k == "hot"], 50))
    assert got["hot"].q == pytest.approx(np.percentile([v for k, v in rows_ if k == "hot"], 90))
    assert got[None].m == 2.0 and got[None].q == inf and got["i"].m == inf
    box = {r.k: r for r in A.error_quantiles(df.where("v < 1e9"), "v", ["k"]).collect()}
    assert (box[None].whisker_low, box[None].whisker_high) == (1.0, 2.0)


def test_percentiles_of_large_groups_sort_parts_only(spark):
    """Copies of one value, a lone giant and infinities around it; a group of few rows beside them."""
    values = [3.0] * 400 + [float(i) ** 3 for i in range(300)] + [1e300, -1e300, float("inf"), float("-inf")]
    df = spark.createDataFrame([("big", v) for v in values] + [("few", 1.0), ("few", 4.0), ("few", float("nan")), ("few", None)], "k string, v double")
    out = {r.k: r for r in A.exact_percentiles(df, ["k"], "v", {"a": 0.01, "m": 0.5, "z": 0.97}, leaf=20, buckets=8).collect()}
    assert [out["big"][c] for c in "amz"] == pytest.approx(list(np.percentile(values, [1, 50, 97])))
    assert out["few"].m == 2.5 and set(out) == {"big", "few"}


def test_impute_mode_breaks_ties_downwards_or_by_rank(spark, rows):
    df = spark.createDataFrame([("klein", 2.0), ("groß", 1.0), (None, None)], "bed string, n double")
    assert rows(A.impute_mode(df, ["bed", "n", "absent"]).where("n = 1.0"), "bed") == [("groß",), ("groß",)]
    rank = F.when(F.col("bed") == "klein", 0).otherwise(1)
    assert ("klein", 1.0) in rows(A.impute_mode(df, ["bed", "n"], {"bed": rank}))


def test_depth_mean_only_of_the_run(spark, rows):
    df = spark.createDataFrame([("a", 1, T(2024, 1, 1), 2.0, T(2024, 1, 2), "m"), ("a", 2, T(2024, 1, 1), 4.0, T(2024, 1, 2), "m"),
                                ("a", 1, T(2024, 1, 1), 9.0, T(2024, 1, 1), "m")],
                               "tree_id string, type_id int, timestamp timestamp, value double, created_at timestamp, model_id string")
    out = A.add_depth_mean(df, T(2024, 1, 2))
    assert rows(out.where("type_id = 4"), "value") == [(3.0,)] and out.count() == 4


def test_pivot_keeps_columns_where_the_positional_one_shifts_them(spark):
    df = spark.createDataFrame([("a", 1, "x_30", T(2024, 1, 1), 1.0), ("a", 3, "x_90", T(2024, 1, 1), 3.0), ("a", 1, "x_30", T(2023, 1, 1), 7.0)],
                               "tree_id string, type_id int, name string, timestamp timestamp, value double")
    wide = A.pivot_latest(df, "tree_id", "type_id", {1: "30", 2: "60", 3: "90"}, {"values": "value"}, ["timestamp"]).first()
    assert (wide.nowcast_values_30, wide.nowcast_values_60, wide.nowcast_values_90) == (1.0, None, 3.0)
    newest = df.where("year(timestamp) = 2024")
    shifted = A.pivot_latest_positional(newest, "tree_id", "name", ["30", "60", "90"], {"values": "value"}).first()
    assert (shifted.nowcast_values_30, shifted.nowcast_values_60, shifted.nowcast_values_90) == (1.0, 3.0, None)


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "y double, p double")
    r = A.regression_metrics(df, "y", "p").first()
    assert (r.rmse, r.mae) == (1.58, 1.5)
    e = A.error_summary(df, "y", "p").first()
    assert e.bias == 0.5 and e.sigma == 1.5 and e.error_std == pytest.approx(2.1213, abs=1e-4)


def test_page_and_sample(spark, rows):
    df = spark.range(250).select((249 - F.col("id")).alias("id"))
    assert rows(R.page(df, ["id"], 100, 2)) == [(i,) for i in range(200, 250)]
    assert R.page(df, ["id"], 100, 3).count() == 0
    assert rows(R.sample_n(df, ["id"], 20)) == rows(R.sample_n(df.repartition(7), ["id"], 20))
    assert rows(R.sample_frac(df, ["id"], 0.3)) == rows(R.sample_frac(df.repartition(7), ["id"], 0.3))
    assert 40 < R.sample_frac(df, ["id"], 0.3).count() < 110 and R.sample_n(df, ["id"], 20).count() == 20


def test_pages_sort_their_range_only(spark, rows):
    """Deep pages of a large table with null keys and a hot leading key: few of its rows are sorted."""
    df = spark.range(40_000).selectExpr("if(id % 3 = 0, null, if(id % 2 = 0, 'hot', concat('k', id % 100))) as k", "(id * 7919) % 40009 as n", "id")
    want = [tuple(r) for r in df.orderBy("k", "n").select("k", "n").collect()]
    for size, number in ((100, 0), (100, 3), (500, 26), (500, 79), (500, 80), (7, 2000)):
        got = R.page(df, ["k", "n"], size, number).orderBy("k", "n").select("k", "n").collect()
        assert [tuple(r) for r in got] == want[size * number:size * (number + 1)]
    part, before = R.key_range(df, ["k", "n"], 20_001, 20_100)
    assert part.count() < 4000 and before <= 20_000
    assert R.slice_ranked(df, [F.col("id").desc()], 9_990, 10_050).count() == 61
    assert R.sample_n(df, ["id"], 30_000).count() == 30_000 and R.sample_n(df, ["id"], 50_000).count() == 40_000


def test_serial_id_wraps(spark, rows):
    df = spark.range(5)
    assert rows(R.with_serial_id(df.withColumnRenamed("id", "k"), ["k"], start=4, maximum=5), "k", "id") == [
        (0, 4), (1, 5), (2, 1), (3, 2), (4, 3)]


def test_duplicate_report(spark, rows):
    batch = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "id string")
    known = spark.createDataFrame([("b",), ("b",)], "id string")
    assert rows(R.duplicate_report(batch, known, "id")) == [("a", 2, False), ("b", 1, True)]


def test_audit(spark, rows):
    trees = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    sensors = spark.createDataFrame([("a", 1, T(2024, 1, 1)), ("x", 1, T(2024, 1, 1)), ("x", 2, T(2024, 1, 1)), (None, 1, T(2024, 1, 1))],
                                    "tree_id string, type_id int, timestamp timestamp")
    found = rows(Q.audit({"trees": trees, "sensor_measurements": sensors}), "table", "rule", "violations")
    assert found == [("sensor_measurements", "foreign key", 2), ("sensor_measurements", "primary key", 1), ("trees", "primary key", 2)]


@pytest.mark.parametrize("weather, sensor, want", [
    (D(2024, 5, 9), D(2024, 5, 9), D(2024, 5, 9)), (D(2024, 5, 10), D(2024, 5, 12), D(2024, 5, 9)),
    (D(2024, 5, 3), D(2024, 5, 9), D(2024, 5, 3)), (None, D(2024, 5, 9), None)])
def test_nowcast_date(spark, weather, sensor, want):
    w = spark.createDataFrame([(weather,)], "date date")
    s = spark.createDataFrame([(sensor,)], "timestamp date")
    assert Q.nowcast_date(w, s, D(2024, 5, 10)).first().nowcast_date == want
