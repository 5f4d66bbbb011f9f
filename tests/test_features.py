import datetime as dt

import pytest
from pyspark.sql import functions as F

from canopy.constants import MONTHS
from canopy.operators import features as E

D, T = dt.date, dt.datetime


def test_monthly_long_keeps_nulls(spark, rows):
    values = [0.1 * i for i in range(1, 13)]
    values[4] = None
    df = spark.createDataFrame([("a", *values)], "tree_id string, " + ", ".join(f"{m} double" for m in MONTHS))
    out = rows(E.monthly_long(df), "month", "shading_index")
    assert len(out) == 12 and (5, None) in out and out[0] == (1, 0.1)


class TestWatering:
    SCHEMA = "tree_id string, amount_liters double, date date"

    def run(self, spark, gdk, sga, lo, hi, **kw):
        out = E.watering_features(spark.createDataFrame(gdk, self.SCHEMA), spark.createDataFrame(sga, self.SCHEMA), lo, hi, **kw)
        return {(r.tree_id, r.timestamp): (r.water_gdk, r.water_sga) for r in out.collect()}

    def test_the_winter_is_bridged_by_rows(self, spark):
        out = self.run(spark, [("a", 10.0, D(2022, 10, 30))], [("b", 5.0, D(2022, 4, 2))], D(2022, 10, 1), D(2023, 4, 10))
        assert out["a", D(2022, 10, 31)] == (10.0, 0.0)
        assert out["a", D(2023, 4, 5)] == (10.0, 0.0)       # five rows after the 30th
        assert out["a", D(2023, 4, 6)] == (0.0, 0.0)
        assert ("a", D(2022, 11, 1)) not in out
        # b is watered before the spine begins: it is on the spine, without water.
        assert set(v for k, v in out.items() if k[0] == "b") == {(0.0, 0.0)}
        assert len(out) == 2 * (31 + 10)

    def test_spine_of_one_day_holds_nine_days(self, spark):
        df = spark.createDataFrame([("a", 3.0, D(2024, 1, 5)), ("a", 4.0, D(2024, 1, 9))], self.SCHEMA)
        out = rows_of(E.watering_features_on(df, df.limit(0), D(2024, 1, 10)))
        assert sorted(out) == [D(2024, 1, d) for d in range(2, 11)]
        assert out[D(2024, 1, 10)] == 7.0 and out[D(2024, 1, 4)] == 0.0


def rows_of(df):
    return {r.timestamp: r.water_gdk for r in df.collect()}


def test_fill_linear_holds_at_most_the_limit(spark):
    vals = [None, 1.0, None, None, 4.0] + [None] * 9
    df = spark.createDataFrame([(D(2024, 1, 1 + i), v) for i, v in enumerate(vals)], "date date, temp_avg_c double")
    out = [r.temp_avg_c for r in E.fill_linear(df, ["temp_avg_c"], []).orderBy("date").collect()]
    assert out == [None, 1.0, 2.0, 3.0, 4.0] + [4.0] * 7 + [None, None]


def test_weather_modes(spark):
    with pytest.raises(ValueError):
        E.weather_features("other")


def test_ordinal_codes(spark):
    df = spark.createDataFrame([("alt", 10), ("jung", 2), ("mittel", 4), (None, None)], "age string, month int")
    codes = E.OrdinalCodes.fit(df, ["age", "month"])
    new = spark.createDataFrame([("mittel", 10), ("unseen", 3), (None, None)], "age string, month int")
    out = [tuple(r) for r in codes.transform(new, ["age", "month"]).collect()]
    assert sorted(out, key=str) == sorted([(2.0, 2.0), (-1.0, -1.0), (None, None)], key=str)


def fixture_tables(spark):
    trees = spark.createDataFrame(
        [("t1", "Tilia", 2.0, True), ("t2", "Acer", 50.0, True), ("t3", "Tilia", 200.0, True), ("p1", "Quercus", 9.0, False)],
        "id string, gattung string, standalter double, street_tree boolean")
    days = [T(2023, 5, d) for d in range(1, 21)]
    sensors = [(t, k, ts, 10.0 * k + i + (5 if t == "t2" else 0)) for t in ("t1", "t2", "p1") for k in (1, 2, 3, 4) for i, ts in enumerate(days)]
    shading = spark.createDataFrame([(t, *[0.1 * m for m in range(1, 13)]) for t in ("t1", "t2", "t3")],
                                    "tree_id string, " + ", ".join(f"{m} double" for m in MONTHS))
    wx = [(433, D(2023, 4, 20) + dt.timedelta(days=i), 5.0, 2.0, 1.0, 20.0, 12.0, 60.0) for i in range(40)]
    tiles = [(k, D(2023, 4, 20) + dt.timedelta(days=i), 5.0, 2.0, 1.0, 20.0, 12.0, 1000.0 * k) for k in (2, 3) for i in range(40)]
    return E.Tables(
        trees=trees, sensors=spark.createDataFrame(sensors, "tree_id string, type_id int, timestamp timestamp, value double"),
        devices=spark.createDataFrame([("t1", 7, D(2023, 5, 1), D(2023, 5, 10)), ("t2", 8, None, None), ("t2", 9, D(2024, 1, 1), None)],
                                      "tree_id string, site_id long, valid_from_date date, valid_to_date date"),
        trees_private=spark.createDataFrame([("t1", 4.0, "kies"), ("t2", 30.0, None)],
                                            "tree_id string, baumscheibe_m2 double, baumscheibe_surface string"),
        watering_gdk=spark.createDataFrame([("t1", 20.0, D(2023, 5, 3))], TestWatering.SCHEMA),
        watering_sga=spark.createDataFrame([("t1", 8.0, D(2023, 5, 3)), ("p1", 8.0, D(2023, 5, 3))], TestWatering.SCHEMA),
        shading_monthly=shading,
        weather=spark.createDataFrame(wx, "stations_id long, date date, wind_max_ms double, wind_avg_ms double, rainfall_mm double, "
                                          "temp_max_c double, temp_avg_c double, upm double"),
        weather_tiles=spark.createDataFrame(tiles, "tile_id long, date date, wind_max_ms double, wind_avg_ms double, rainfall_mm double, "
                                                   "temp_max_c double, temp_avg_c double, ghi_sum_whm2 double"))


def test_sensor_base_fans_out_over_devices_unless_valid_ones_are_asked_for(spark):
    t = fixture_tables(spark)
    counts = {r.tree_id: r["count"] for r in E.sensor_base(t).groupBy("tree_id").count().collect()}
    assert counts == {"t1": 80, "t2": 160}      # park tree p1 is left out, t2 has two devices
    valid = {r.tree_id: r["count"] for r in E.sensor_base(t, valid_devices_only=True).groupBy("tree_id").count().collect()}
    assert valid == {"t1": 40, "t2": 80}


def test_training_frame(spark):
    frame = E.training_frame(fixture_tables(spark), False, D(2023, 6, 1))
    r = frame.where("tree_id = 't1' and type_id = 1 and timestamp = timestamp'2023-05-09'").first()
    assert (r.standalter, r.baumscheibe_m2, r.month, r.site_id) == ("jung", "klein", 5, 7)
    assert (r.water_gdk, r.water_sga) == (20.0, 8.0)
    assert r.shading_index == pytest.approx(0.5) and r.rainfall_mm == 7.0 and r.ghi_sum_whm2 == 2500.0
    never = frame.where("tree_id = 't2'").first()
    assert never.water_gdk is None and never.baumscheibe_surface is None


def test_public_and_forecast_frames_differ_in_their_columns(spark):
    t = fixture_tables(spark)
    public = E.training_frame(t, False, D(2023, 6, 1), public=True)
    assert "upm" in public.columns and "water_gdk" not in public.columns and "baumscheibe_m2" not in public.columns
    ahead = E.training_frame(t, True, D(2023, 6, 1))
    assert "upm" not in ahead.columns and "ghi_sum_whm2" in ahead.columns and "water_gdk" not in ahead.columns
    assert "rainfall_mm" not in E.inference_frame(t, True, D(2023, 5, 20)).columns


def test_preprocessor(spark):
    t = fixture_tables(spark)
    frame = E.training_frame(t, True, D(2023, 6, 1))
    prep = E.Preprocessor(True).fit(frame)
    out = prep.transform_train(frame)
    first = out.where("tree_id = 't1' and type_id = 2").orderBy("timestamp").first()
    assert first.mean_yesterday is None and first.shift_1 is None and first.target == 20.0
    fourth = out.where("tree_id = 't1' and type_id = 2 and timestamp = timestamp'2023-05-04'").first()
    assert (fourth.shift_1, fourth.shift_2, fourth.shift_3) == (22.0, 21.0, 20.0)
    assert {r.type_id for r in out.select("type_id").distinct().collect()} == {1, 2, 3}
    # ages: alt 0, jung 1; the missing surface takes the most frequent one
    assert fourth.standalter == 1.0 and out.where("baumscheibe_surface is null").count() == 0
    inference = prep.transform_inference(E.inference_frame(t, True, D(2023, 5, 20)))
    assert set(inference.columns) == {"tree_id", "timestamp", "month", "gattung", "standalter", "baumscheibe_m2",
                                      "baumscheibe_surface", "shading_index"}
    assert inference.where("tree_id = 't3'").first().standalter is None      # older than all classes
    assert inference.count() == 3


def test_folds_are_disjoint_balanced_and_learn_from_train_only(spark):
    df = spark.range(40).select((F.col("id") % 10).alias("site_id"), F.lit(1).alias("type_id"),
                                F.date_add(F.lit(D(2023, 5, 1)), (F.col("id") / 10).cast("int")).alias("timestamp"),
                                F.col("id").cast("double").alias("value"))
    folds = E.site_folds(df, 4).persist()
    sizes = sorted(r["count"] for r in folds.groupBy("fold").count().collect())
    assert sizes == [2, 2, 3, 3]
    train, test = E.fold_frames(df, folds, 0)
    a, b = ({r.site_id for r in p.collect()} for p in (train, test))
    assert not a & b and len(a | b) == 10
    means = {r.timestamp: r.m for r in train.groupBy("timestamp").agg(F.first("mean_yesterday").alias("m")).collect()}
    assert all(r.mean_yesterday == means[r.timestamp] for r in test.collect())
