"""Jobs end to end on a small database, the streams against their batch counterparts, the models."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from canopy.constants import LAG_FEATURES, MONTHS
from canopy.operators import aggregates as A, features as E, models as M
from canopy.plans import jobs as J, views as V
from canopy.schemas import SCHEMAS
from canopy.sources.sinks import append, create_table, current
from canopy.streaming import jobs as S

D, T = dt.date, dt.datetime
UTC = dt.timezone.utc
TODAY = D(2023, 5, 28)
FOREST = {"numTrees": 4, "maxDepth": 4, "featureSubsetStrategy": "sqrt"}


@pytest.fixture(scope="module")
def db(spark):
    name = f"city_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    database = J.Database(spark, name)
    database.create()
    return database


def trees(spark, ids, **cols):
    df = spark.createDataFrame([(i, "Tilia" if n % 2 else "Acer", float(5 + n), 600.5 + 0.01 * n, 700.5) for n, i in enumerate(ids)],
                               "baumid string, gattung string, standalter double, x double, y double")
    return df.select("baumid", F.col("baumid").alias("gml_id"), "gattung", F.col("gattung").alias("gattung_deutsch"), "standalter",
                     F.struct("x", "y").alias("geometry"))


class TestDatabase:
    """The tests of this class build on each other, in file order."""

    def test_trees_are_loaded_once_street_trees_first(self, spark, db):
        now = T(2023, 5, 28, tzinfo=UTC)
        street = J.prepare_trees(trees(spark, ["a", "b", "b", "c"]), True, now, projected=False)
        park = J.prepare_trees(trees(spark, ["c", "p"]), False, now, projected=False)
        assert J.load_trees(db, street, park)
        got = {r.id: r.street_tree for r in db.table("trees").collect()}
        assert got == {"a": True, "b": True, "c": True, "p": False}
        assert not J.load_trees(db, street, park)
        assert db.table("trees").where("id = 'a'").first().lng == 600.5

    def test_dropped_duplicates_are_reported(self, spark, rows):
        street = trees(spark, ["a", "b", "b", "c"]).withColumnRenamed("baumid", "id")
        park = trees(spark, ["c", "p"]).withColumnRenamed("baumid", "id")
        assert rows(J.tree_duplicates(street, park)) == [("b", 2, False, "street"), ("c", 1, True, "park")]

    def test_shading_from_maps(self, spark, db):
        seasons = ["spring", "summer", "fall", "winter"]
        cells = spark.createDataFrame([(s, 0, 0, 3.0 + i) for i, s in enumerate(seasons)], SCHEMAS["raster_cells"])
        place = spark.createDataFrame([(s, 0.0, 0.0, 1.0, 1.0, 1, 1) for s in seasons], SCHEMAS["raster_transform"])
        daylight = spark.createDataFrame([(s, 36000.0) for s in seasons], "season string, daylight_s double")
        known = spark.createDataFrame([("a", 13.4, 52.5)], "id string, lng double, lat double")
        other = J.Database(spark, db.name)
        other.table = lambda name: known if name == "trees" else db.table(name)
        J.load_shading_from_maps(other, cells, place, daylight)
        r = db.table("shading").first()
        assert (r.tree_id, r.spring, r.summer, r.fall, r.winter) == ("a", 0.7, 0.6, 0.5, 0.4)
        many = place.limit(1).crossJoin(spark.range(65)).withColumn("raster_id", F.concat("raster_id", "id")).drop("id")
        assert J.spatial.sample_nearest(known, cells, many, ["id"], F.col("lng"), F.col("lat")).count() == 65

    def test_projected_trees(self, spark):
        r = J.prepare_trees(trees(spark, ["a"]).withColumn("geometry", F.struct(F.lit(389917.8).alias("x"), F.lit(5819699.6).alias("y"))),
                            True, T(2023, 5, 28, tzinfo=UTC)).first()
        assert r.lng == pytest.approx(13.3777, abs=0.01) and r.lat == pytest.approx(52.516, abs=0.01)

    def test_soil_and_shading(self, spark, db):
        soil = spark.createDataFrame([], SCHEMAS["soil"]).drop("created_at", "updated_at")
        one = spark.range(1).select(F.lit("s1").alias("id"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in soil.schema if f.name != "id"])
        assert J.load_soil(db, one, T(2023, 5, 28, tzinfo=UTC)) and not J.load_soil(db, one, T(2023, 5, 28, tzinfo=UTC))
        rows = [(t, *[0.05 * m for m in range(1, 13)]) for t in ("a", "a", "b", "c", "nowhere")]
        J.load_shading(db, spark.createDataFrame(rows, SCHEMAS["shading_monthly"]))
        assert sorted(r.tree_id for r in db.table("shading_monthly").collect()) == ["a", "b", "c"]

    def test_rain(self, spark, db):
        corners = spark.createDataFrame([(x, y, float(x), float(y)) for x in range(600, 604) for y in range(700, 704)], SCHEMAS["lattice_corners"])
        square = [[[{"x": 600.0, "y": 700.0}, {"x": 602.5, "y": 700.0}, {"x": 602.5, "y": 702.5}, {"x": 600.0, "y": 702.5}, {"x": 600.0, "y": 700.0}]]]
        mask = spark.createDataFrame([(square,)], f"geometry {SCHEMAS['soil'].split('geometry ')[1].split(', created')[0]}")

        def cells(days, mm):
            return spark.createDataFrame([(T(2023, 5, d, h, 50), x, y, mm) for d in days for h in (1, 2) for x in range(600, 603) for y in range(700, 703)],
                                         SCHEMAS["rain_cells"])

        J.load_rain(db, cells([25, 26], 2.0), corners, mask, D(2023, 5, 26))
        assert db.table("radolan_tiles").count() == 9
        assert db.table("tree_radolan_tile").count() == 4      # all trees stand in the first cell
        assert db.table("radolan").count() == 18
        J.load_rain(db, cells([25, 26, 27], 4.0), corners, mask, D(2023, 5, 27))
        days = {r.date: r.mm for r in db.table("radolan").groupBy("date").agg(F.avg("rainfall_mm").alias("mm")).collect()}
        assert days == {D(2023, 5, 25): 2.0, D(2023, 5, 26): 4.0, D(2023, 5, 27): 4.0}     # the last day is redone
        assert {r.rainfall_in_mm for r in db.table("rainfall").collect()} == {10.0}
        own = V.rainfall_for("a", db.table("trees"), db.table("radolan_tiles"), db.table("radolan"), D(2023, 5, 27)).collect()
        assert [(r.date.day, r.rainfall_in_mm) for r in own] == [(27, 4.0), (26, 4.0), (25, 2.0)]

    def test_watering(self, spark, db):
        def events(*rows):
            return spark.createDataFrame(list(rows), "tree_id string, ts timestamp, amount_liters double")
        first = [("a", T(2023, 4, 1, 9), 10.0), ("a", T(2023, 5, 20, 9), 5.0), ("a", T(2023, 5, 20, 12), 5.0), ("a", T(2021, 1, 1), 1.0)]
        J.load_watering(db, events(*first), TODAY)
        late = first + [("b", T(2023, 5, 21, 9), 7.0), ("b", T(2023, 3, 1), 9.0)]
        J.load_watering(db, events(*late), TODAY)
        got = sorted((r.tree_id, r.date, r.amount_liters) for r in db.table("watering_gdk").collect())
        assert got == [("a", D(2023, 4, 1), 10.0), ("a", D(2023, 5, 20), 10.0), ("b", D(2023, 5, 21), 7.0)]
        assert db.table("watering").count() == 3

    def test_weather(self, spark, db):
        days = [D(2023, 4, 20) + dt.timedelta(days=i) for i in range(36)]
        wx = spark.createDataFrame([(433, d, 1.0 + d.day, 12.0, 20.0, 2.0, 6.0, 60.0) for d in days],
                                   "stations_id long, date date, rainfall_mm double, temp_avg_c double, temp_max_c double, wind_avg_ms double, "
                                   "wind_max_ms double, upm double")
        full = spark.createDataFrame([], SCHEMAS["weather"])
        wx = wx.withColumns({f.name: F.lit(None).cast(f.dataType) for f in full.schema if f.name not in wx.columns})
        stations = spark.createDataFrame([(433, None, None, 48, 52.5, 13.4, "T", "B", {"x": 13.4, "y": 52.5})], SCHEMAS["weather_stations"])
        J.load_station_weather(db, stations, wx.where("date < '2023-05-20'"), TODAY)
        J.load_station_weather(db, stations, wx, TODAY)
        assert db.table("weather").count() == 36 and db.table("weather_stations").count() == 1
        assert db.table("weather_14d_agg").count() == 36

        hours = [T(2023, 4, 20, 12) + dt.timedelta(days=i) for i in range(36)]
        schema = "tile_id long, ts timestamp, ghi double, dni double, dhi double, temp double, wind double, rainfall_mm double"
        hourly = spark.createDataFrame([(2, t, 100.0, 1.0, 1.0, 15.0, 3.0, 1.0) for t in hours], schema)
        J.load_tile_weather(db, hourly.where("ts < '2023-05-10'"), TODAY)
        J.load_tile_weather(db, hourly, TODAY)
        assert db.table("weather_tile_measurement").count() == 36
        ahead = spark.createDataFrame([(2, T(2023, 5, 26, 12) + dt.timedelta(days=i), 90.0, 1.0, 1.0, 17.0, 4.0, 0.0) for i in range(16)], schema)
        for hour in (1, 2):
            J.load_tile_forecast(db, ahead, D(2023, 5, 26), D(2023, 6, 15), T(2023, 5, 25, hour, tzinfo=UTC))
        assert db.table("weather_tile_forecast").count() == 16

    def test_training_and_prediction(self, spark, db, tmp_path):
        rows = [(t, k, 1, T(2023, 5, d), 10.0 * k + d + n) for n, t in enumerate("abc") for k in (1, 2, 3) for d in range(1, 25)]
        append(spark.createDataFrame(rows, SCHEMAS["sensor_measurements"]), db("sensor_measurements"))
        append(spark.createDataFrame([(t, 2, n, n, None, None) for n, t in enumerate("abc")], SCHEMAS["tree_devices"]), db("tree_devices"))
        append(spark.createDataFrame([("a", 1.0, 4.0, "kies"), ("b", 1.0, 20.0, None)], SCHEMAS["trees_private"]), db("trees_private"))
        db.refresh("sensor_measurements_agg", today=TODAY)
        folder, created = str(tmp_path / "models"), T(2023, 5, 28, tzinfo=UTC)
        J.train(db, False, TODAY, folder, FOREST)
        J.nowcast(db, folder, TODAY, created)
        now = db.table("nowcast")
        # trees a, b, c; c was never watered, so its water is imputed
        assert now.count() == 3 * 4 and sorted(r.id for r in now.collect()) == list(range(1, 13))
        by = {(r.tree_id, r.type_id): r.value for r in now.collect()}
        assert by["a", 4] == pytest.approx((by["a", 1] + by["a", 2] + by["a", 3]) / 3)
        assert by["a", 1] < by["a", 2] < by["a", 3]

        J.train(db, True, TODAY, folder, FOREST, FOREST)
        J.forecast(db, folder, TODAY, created)
        ahead = db.table("forecast")
        assert ahead.count() == 3 * 4 * 14
        assert ahead.agg(F.min("timestamp"), F.max("timestamp")).first()[:] == (T(2023, 5, 26), T(2023, 6, 8))

    def test_end_products(self, spark, db):
        board = db.table("expert_dashboard")
        assert board.count() == 12 and dict(board.dtypes)["saugspannung"] == "int" and "Verschattung Frühling" in board.columns
        wide = {r.trees_id: r for r in db.table("vector_tiles").collect()}
        assert set(wide) == {"a", "b", "c", "p"} and wide["p"].nowcast_values_30cm is None
        assert wide["a"].nowcast_type_stamm == 4 and wide["a"].nowcast_model_id_4 == "Random Forest (full)"
        positional = V.vector_tiles(db.table("trees"), db.table("nowcast"), db.table("trees_private"), True, db.table("sensor_types"))
        assert {r.trees_id: r.nowcast_values_30cm for r in positional.collect()} == {t: r.nowcast_values_30cm for t, r in wide.items()}
        kinds = {r.tree_id: r.nowcast_types_array for r in V.nowcast_kinds(db.table("nowcast"), db.table("sensor_types")).collect()}
        assert kinds["a"] == ["saugspannung_30cm", "saugspannung_60cm", "saugspannung_90cm", "saugspannung_stamm"]
        star = V.nowcast_training_data(db.table("sensor_measurements"), db.table("shading"), db.table("trees"), db.table("weather_tile_14d_agg"),
                                       db.table("sensor_measurements_agg"), ordered=True)
        assert star.count() == 216 and star.first().tree_id == "a" and star.first().nowcast_date == T(2023, 5, 24)

    def test_the_database_keeps_its_promises(self, db):
        broken = [(r.table, r.rule) for r in J.check(db).collect() if r.violations]
        assert broken == []


class TestStreams:
    def files(self, spark, tmp_path, schema, *batches):
        folder = str(tmp_path / "in")
        for batch in batches:
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
        return folder

    def run(self, spark, tmp_path, stream, schema, keys):
        table = f"t_{uuid.uuid4().hex[:8]}"
        create_table(spark, table, schema, "date", str(tmp_path / "out"))
        S.run_upserts(stream, table, keys, str(tmp_path / "cp")).awaitTermination()
        return spark.table(table), table

    def test_late_watering_updates_its_day_and_too_late_is_dropped(self, spark, tmp_path):
        schema = "tree_id string, ts timestamp, amount_liters double"
        target = "tree_id string, amount_liters double, date date"
        folder = self.files(spark, tmp_path, schema, [("a", T(2024, 5, 1, 8), 1.0), ("a", T(2024, 5, 20, 8), 2.0)])
        out, table = self.run(spark, tmp_path, S.watering_stream(S.file_stream(spark, folder, schema)), target, ["tree_id", "date"])
        assert out.count() == 2
        late = [("a", T(2024, 5, 10, 9), 5.0), ("a", T(2024, 5, 20, 9), 3.0), ("a", T(2024, 5, 2), 9.0)]
        spark.createDataFrame(late, schema).write.mode("append").parquet(folder)
        S.run_upserts(S.watering_stream(S.file_stream(spark, folder, schema)), table, ["tree_id", "date"], str(tmp_path / "cp")).awaitTermination()
        got = sorted((r.date.day, r.amount_liters) for r in current(spark, table).collect())
        assert got == [(1, 1.0), (10, 5.0), (20, 5.0)]

    def test_streams_equal_their_batch(self, spark, tmp_path, rows):
        schema = "tile_id long, ts timestamp, ghi double, dni double, dhi double, temp double, wind double, rainfall_mm double"
        data = [(k, T(2024, 3, 30, 20) + dt.timedelta(hours=h), float(h), 1.0, 2.0, 3.0 + h, 4.0, 0.5 * h) for k in (2, 3) for h in range(40)]
        folder = self.files(spark, tmp_path, schema, data[:50], data[50:])
        batch = A.daily_weather(spark.createDataFrame(data, schema))
        target = ", ".join(f"{n} {t}" for n, t in batch.dtypes if n != "date") + ", date date"
        out, _ = self.run(spark, tmp_path, S.weather_stream(S.file_stream(spark, folder, schema, files_per_batch=1), lateness="10 days"), target, ["tile_id", "date"])
        assert rows(out.select(*batch.columns)) == rows(batch)

    def test_sensor_readings_are_kept_once(self, spark, tmp_path):
        schema = "tree_id string, type_id int, timestamp timestamp, value double"
        r = ("a", 1, T(2024, 5, 1, 8), 1.0)
        folder = self.files(spark, tmp_path, schema, [r, r], [r, ("a", 2, T(2024, 5, 1, 8), 1.0)])
        table = f"t_{uuid.uuid4().hex[:8]}"
        create_table(spark, table, schema, None, str(tmp_path / "out"))
        S.run_appends(S.sensor_stream(S.file_stream(spark, folder, schema, files_per_batch=1)), table, str(tmp_path / "cp")).awaitTermination()
        assert spark.table(table).count() == 2


class TestModels:
    """A forest on a rule it can learn, and the recursion on models whose answer is known."""

    def rows(self, spark, days=40):
        base = spark.range(6 * 3 * days).select(
            F.concat(F.lit("t"), (F.col("id") % 6)).alias("tree_id"), ((F.col("id") / 6).cast("int") % 3 + 1).alias("type_id"),
            F.date_add(F.lit(D(2023, 5, 1)), (F.col("id") / 18).cast("int")).cast("timestamp").alias("timestamp"))
        feats = {c: F.lit(1.0) for c in ("month", "gattung", "standalter", "shading_index", "wind_max_ms", "rainfall_mm", "ghi_sum_whm2", "mean_yesterday")}
        temp = F.datediff("timestamp", F.lit(D(2023, 5, 1))).cast("double")
        df = base.withColumns({**feats, "temp_avg_c": temp, "target": temp * 2 + F.col("type_id")})
        return E.add_lags(df, ["tree_id", "type_id"], "timestamp", "target")

    def test_fold_figures_become_a_record(self, spark, tmp_path):
        from canopy.sources.readers import read_experiments
        from canopy.sources.sinks import log_experiment
        p = spark.createDataFrame([("m", k, f, 10.0, 10.0 + k + f) for k in (1, 2, 3) for f in (0, 1)],
                                  "model string, type_id int, fold int, value double, y_hat double")
        log_experiment(M.experiment_records(p, "first", ["month"], {"m": {"trees": 3}}), str(tmp_path / "log"))
        r = read_experiments(spark, str(tmp_path / "log")).first()
        assert (r["Mean 30cm"].rmse, r["Mean 90cm"].mae) == (1.5, 3.5) and [x.mae for x in r["Folds 60cm"]] == [2.0, 3.0]
        assert (r.experiment_id, r.model, r.features, r.hyper_parameters) == ("first", "m", ["month"], {"trees": "3"})

    def test_a_linear_scorer_stands_in_for_a_model(self, spark, rows):
        df = spark.createDataFrame([(2.0, 3.0), (None, 1.0)], "a double, b double")
        out = M.score(df, M.Linear((10.0, 0.5), 1.0), [F.col("a"), F.col("b")], "y")
        assert rows(out, "y") == [(22.5,), (None,)]

    def test_fits_run_side_by_side(self, spark):
        df = self.rows(spark, 12).withColumnRenamed("target", "value").withColumn("site_id", F.col("tree_id"))
        folds = E.site_folds(df, 3)
        for per_depth in (True, False):
            out = M.predict_folds(df.drop(*LAG_FEATURES).withColumns({"water_sga": F.lit(0.0), "water_gdk": F.lit(0.0)}), folds, 3,
                                  M.estimators(FOREST, {"maxIter": 2, "maxDepth": 2}), ["temp_avg_c", "mean_yesterday"], per_depth)
            assert {r.model for r in M.evaluate_models(out).collect()} == {*M.estimators(), "benchmark"}

    def test_scores_are_null_for_missing_inputs(self, spark):
        rows = self.rows(spark)
        model = M.train(rows, ["temp_avg_c", "shift_1"], M.forest(FOREST))
        out = M.score(rows, model, [F.col("temp_avg_c"), F.col("shift_1")], "p")
        assert out.where("shift_1 is null").where("p is not null").count() == 0
        assert out.where("shift_1 is not null").where("p is null").count() == 0

    def test_backtest_drops_series_that_break(self, spark):
        rows = self.rows(spark).where("not (tree_id = 't0' and timestamp = timestamp'2023-05-22')")
        out = M.backtest(rows, [D(2023, 5, 20)], [D(2023, 5, 18)], FOREST, horizon=5, drop_days=9)
        assert out.where("tree_id = 't0'").agg(F.max("window")).first()[0] == 2
        assert out.where("tree_id = 't1'").agg(F.max("window")).first()[0] == 5
        assert A.metrics_by_horizon(out).count() == 5

    def test_season_starts_anew_after_a_gap(self, spark):
        rows = self.rows(spark, 20).where("not (tree_id = 't0' and timestamp = timestamp'2023-05-06')")
        model = M.train_season(rows, D(2023, 5, 20), FOREST)
        out = M.season_forecast(model, rows, D(2023, 5, 1), 12)
        n = {r.tree_id: r["count"] for r in out.groupBy("tree_id").count().collect()}
        assert n["t0"] == 33 and n["t1"] == 36

    def test_missing_weather_ends_the_forecast(self, spark):
        rows = self.rows(spark)
        models, aux = M.train_forecast(rows, FOREST), M.train_auxiliary(rows, FOREST)
        base = rows.where("timestamp = timestamp'2023-05-20'").select("tree_id", "month", "gattung", "standalter", "shading_index").distinct()
        weather = {D(2023, 5, 1) + dt.timedelta(days=i): dict.fromkeys(M._WEATHER, 1.0) for i in range(40)}
        whole = M.forecast(models, aux, base, {1: 1.0, 2: 1.0, 3: 1.0}, weather, weather, D(2023, 5, 20), T(2023, 5, 21), horizon=4)
        assert whole.count() == 6 * 4 * 4
        holes = {d: w for d, w in weather.items() if d != D(2023, 5, 23)}
        cut = M.forecast(models, aux, base, {1: 1.0, 2: 1.0, 3: 1.0}, weather, holes, D(2023, 5, 20), T(2023, 5, 21), horizon=4)
        assert cut.count() == 6 * 2 * 4

    def test_models_survive_storage(self, spark, tmp_path):
        rows = self.rows(spark, 15)
        models = M.train_per_type(rows, LAG_FEATURES, FOREST)
        M.save_models(models, str(tmp_path / "m"), "x_")
        back = M.load_models(str(tmp_path / "m"), prefix="x_")
        for k in models:
            a, b = (M.score(rows, m[k], [F.col(c) for c in LAG_FEATURES], "p").agg(F.sum("p")).first()[0] for m in (models, back))
            assert a == b
        ranks = M.importances(spark, models[1], LAG_FEATURES).collect()
        assert len(ranks) == 3 and sum(r.importance for r in ranks) == pytest.approx(1.0)


def test_months_are_the_shading_columns():
    assert all(f"{m} double" in SCHEMAS["shading_monthly"] for m in MONTHS)
