import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from canopy.operators import ranking, windows as W

T = dt.datetime
D = dt.date


def test_trailing_counts_rows_not_days(spark, rows):
    df = spark.createDataFrame([(1, D(2024, 1, d), float(d)) for d in (1, 2, 9, 20)], "k int, date date, v double")
    out = W.trailing(df, "date", 2, {"s": F.sum("v")}, ["k"])
    assert [r[1] for r in rows(out, "date", "s")] == [1.0, 3.0, 11.0, 29.0]


def test_trailing_of_one_row_is_identity(spark, rows):
    df = spark.createDataFrame([(1, D(2024, 1, d), float(d)) for d in range(1, 9)], "k int, date date, v double")
    out = W.trailing(df, "date", 1, {"s": F.sum("v")}, ["k"])
    assert all(a == b for a, b in rows(out, "v", "s"))


def test_rolling_weather_skips_nulls_and_keeps_all_null_frames(spark, rows):
    data = [(D(2024, 1, d), None if d < 3 else 2.0, None if d < 3 else float(d)) for d in range(1, 5)]
    df = spark.createDataFrame(data, "date date, rainfall_mm double, temp_avg_c double")
    out = W.rolling_weather(df, ["rainfall_mm", "temp_avg_c"])
    assert rows(out, "date", "rainfall_mm", "temp_avg_c") == [
        (D(2024, 1, 1), None, None), (D(2024, 1, 2), None, None), (D(2024, 1, 3), 2.0, 3.0), (D(2024, 1, 4), 4.0, 3.5)]


@pytest.mark.parametrize("chunks", [2, 7, 64])
def test_chunked_windows_equal_plain_ones(spark, rows, chunks):
    """One key holds most rows, one a single row, one is null."""
    df = (spark.range(3000).select(
        F.when(F.col("id") < 2500, "hot").when(F.col("id") == 2999, "lone").when(F.col("id") < 2700, F.lit(None)).otherwise("b").alias("k"),
        (F.col("id") * 7919 % 3000).alias("o"), (F.col("id") % 17).cast("double").alias("v")))
    for back in (1, 5):
        plain = W.add_lags(df, ["k"], "o", "v", back)
        cut = W.add_lags(df, ["k"], "o", "v", back, chunks=chunks)
        assert rows(plain) == rows(cut)
    aggs = {"s": F.sum("v"), "n": F.count("v")}
    assert rows(W.trailing(df, "o", 14, aggs, ["k"])) == rows(W.trailing(df, "o", 14, aggs, ["k"], chunks=chunks))


def test_ranked_is_a_global_row_number(spark, rows):
    df = spark.range(1000).select((F.col("id") * 7 % 10).alias("a"), F.concat(F.lit("x"), "id").alias("b"))
    want = df.withColumn("rank", F.row_number().over(Window.orderBy("a", "b")))
    got = ranking.ranked(df, ["a", "b"], chunks=5)
    assert rows(got, "a", "b", "rank") == rows(want, "a", "b", "rank")
    nulls = spark.createDataFrame([(None,), (2,), (1,)], "a int")
    assert rows(ranking.ranked(nulls, ["a"]), "rank", "a") == [(1, None), (2, 1), (3, 2)]


def test_latest_takes_null_times_as_newest_and_breaks_ties(spark, rows):
    data = [(1, T(2024, 1, 1), 1), (1, T(2024, 1, 2), 2), (1, T(2024, 1, 2), 3), (2, None, 4), (2, T(2024, 1, 1), 5)]
    df = spark.createDataFrame(data, "k int, t timestamp, i int")
    assert rows(W.latest_per(df, ["k"], W.newest_first("t", "i")), "k", "i") == [(1, 3), (2, 4)]
    assert rows(W.latest_rows(df, ["k"], "t"), "i") == [(2,), (3,), (5,)]


def test_latest_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = W.latest_per(df, ["k"], W.newest_first("id"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_dedup_is_idempotent(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 0, 7), ("b", 1, 1), ("a", 0, 6)], "id string, source int, row int")
    once = W.dedup_first(df, ["id"], ["source", "row"])
    assert rows(once) == [("a", 0, 6), ("b", 1, 1)] == rows(W.dedup_first(once, ["id"], ["source", "row"]))


def test_mean_yesterday_uses_the_previous_available_time(spark, rows):
    data = [(D(2024, 5, 1), 1, 2.0), (D(2024, 5, 1), 1, 4.0), (D(2024, 5, 9), 1, 9.0), (D(2024, 5, 9), 2, 1.0)]
    df = spark.createDataFrame(data, "timestamp date, type_id int, value double")
    assert rows(W.mean_yesterday(df)) == [(D(2024, 5, 1), 1, None), (D(2024, 5, 9), 1, 3.0), (D(2024, 5, 9), 2, None)]
    assert rows(W.last_group_mean(df)) == [(1, 9.0), (2, 1.0)]


class TestResample:
    def run(self, spark, data, **kw):
        df = spark.createDataFrame(data, "tree_id string, type_id int, timestamp timestamp, value double, note string")
        return sorted((r.timestamp, r.value, r.note) for r in
                      W.resample_ffill(df, ["type_id", "tree_id"], **kw).collect())

    def test_gap_of_seven_days_is_filled_and_of_eight_is_not(self, spark):
        out = self.run(spark, [("a", 1, T(2024, 5, 1), 1.0, "x"), ("a", 1, T(2024, 5, 8), 2.0, "y"), ("a", 1, T(2024, 5, 17), 3.0, "z")])
        by_day = {t.day: v for t, v, _ in out}
        assert by_day[7] == 1.0 and by_day[8] == 2.0 and by_day[15] == 2.0 and by_day[16] is None and by_day[17] == 3.0
        assert len(out) == 17

    def test_the_whole_row_is_carried_with_its_nulls(self, spark):
        df = spark.createDataFrame([("a", 1, T(2024, 5, 1), 1.0, "x"), ("a", 1, T(2024, 5, 2), None, "y"), ("a", 1, T(2024, 5, 4), 4.0, "z")],
                                   "tree_id string, type_id int, timestamp timestamp, value double, note string")
        out = {r.timestamp.day: (r.value, r.note) for r in W.resample_ffill(df, ["type_id", "tree_id"]).collect()}
        assert out == {1: (1.0, "x"), 2: (None, "y"), 3: (None, "y"), 4: (4.0, "z")}

    def test_readings_between_midnights_show_from_the_next(self, spark):
        df = spark.createDataFrame([("a", 1, T(2024, 5, 1, 6), 1.0, "x"), ("a", 1, T(2024, 5, 1, 18), 2.0, "y"), ("a", 1, T(2024, 5, 3, 9), 3.0, "z")],
                                   "tree_id string, type_id int, timestamp timestamp, value double, note string")
        out = {r.timestamp.day: r.value for r in W.resample_ffill(df, ["type_id", "tree_id"]).collect()}
        assert out == {1: None, 2: 2.0, 3: 2.0}

    def test_a_midnight_reading_hides_the_evening_before(self, spark):
        df = spark.createDataFrame([("a", 1, T(2024, 5, 1, 18), 1.0, "x"), ("a", 1, T(2024, 5, 2), 2.0, "y")],
                                   "tree_id string, type_id int, timestamp timestamp, value double, note string")
        out = {r.timestamp.day: r.value for r in W.resample_ffill(df, ["type_id", "tree_id"]).collect()}
        assert out == {1: None, 2: 2.0}

    @settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(st.lists(st.integers(0, 24 * 40), min_size=1, max_size=12, unique=True))
    def test_against_a_plain_scan(self, spark, hours):
        start = T(2024, 5, 1)
        times = sorted(start + dt.timedelta(hours=h) for h in hours)
        df = spark.createDataFrame([("a", 1, t, float(i)) for i, t in enumerate(times)],
                                   "tree_id string, type_id int, timestamp timestamp, value double")
        got = {r.timestamp: r.value for r in W.resample_ffill(df, ["type_id", "tree_id"]).collect()}
        day, want = T(times[0].year, times[0].month, times[0].day), {}
        while day <= times[-1]:
            seen = [(t, i) for i, t in enumerate(times) if t <= day]
            want[day] = float(seen[-1][1]) if seen and (day.date() - seen[-1][0].date()).days <= 7 else None
            day += dt.timedelta(days=1)
        assert got == want


def test_week_blocks(spark, rows):
    df = spark.range(1, 22).select(F.col("id").alias("week"))
    parts = dict(rows(W.week_block_split(df, "week"), "week", "part"))
    assert [parts[w] for w in (1, 5, 6, 9, 10, 14, 15, 18)] == ["train", "train", "test", "test", "train", "train", "test", "test"]
    assert parts[19] is None and parts[21] is None
