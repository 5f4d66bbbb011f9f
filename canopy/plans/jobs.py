"""The daily jobs: load, refresh, train, predict. Each reads and writes catalog tables of one database."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from canopy.constants import (
    BACKTEST_DROP_STARTS, BACKTEST_STARTS, CITY_TILE, FORECAST_FOREST, HORIZON_DAYS, LAG_FEATURES, NOWCAST_FEATURES,
    NOWCAST_FOREST, SEASONS, TRAILING_ROWS, WATERING_RESUME)
from canopy.functions.geo import to_utm33, to_wgs84
from canopy.operators import aggregates, features, models, quality, spatial
from canopy.operators.relational import (
    distinct_keys, duplicate_report, only_new, restrict, stamp, union_all, with_lat_lng, with_serial_id)
from canopy.operators.windows import dedup_first
from canopy.plans import views
from canopy.schemas import SCHEMAS
from canopy.session import cut_lineage
from canopy.sources import sinks
from canopy.sources.readers import seed_dimensions

DAILY_TABLES = {"radolan": "date", "weather": "date", "watering_gdk": "date", "watering_sga": "date",
                "weather_tile_measurement": "date", "weather_tile_forecast": "date"}
_INPUTS = ("rain_cells", "lattice_corners", "raster_cells", "raster_transform")


class Database:
    """Names of the tables of one catalog database."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def __call__(self, table: str) -> str:
        return f"{self.name}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self(table))

    def create(self) -> None:
        """All base tables, empty, and the static dimensions."""
        for table, schema in SCHEMAS.items():
            if table not in _INPUTS:
                sinks.create_table(self.spark, self(table), schema, DAILY_TABLES.get(table))
        for table, df in seed_dimensions(self.spark).items():
            sinks.load_once(df, self(table))

    def refresh(self, *wanted: str, today: dt.date) -> list[str]:
        """Rewrite materialized views, each after those it reads; trailing views only where days have changed."""
        t, v = self.table, {}

        def trailing(name: str, table: str, key: str, make):
            v[name] = ((), lambda: sinks.refresh_trailing(self.spark, self(name), self(table), [key], TRAILING_ROWS, make) and None)

        trailing("weather_14d_agg", "weather", "stations_id", views.weather_14d_agg)
        trailing("weather_tile_14d_agg", "weather_tile_measurement", "tile_id", views.weather_tile_14d_agg)
        v["tree_radolan_tile"] = ((), lambda: views.tree_radolan_tile(t("trees"), t("radolan_tiles")))
        trailing("radolan_14d_agg", "radolan", "tile_id", views.radolan_14d_agg)
        v["rainfall"] = (("tree_radolan_tile", "radolan_14d_agg"),
                         lambda: views.rainfall(t("tree_radolan_tile"), t("radolan_14d_agg")))
        v["sensor_measurements_agg"] = ((), lambda: views.sensor_measurements_agg(t("sensor_measurements")))
        v["expert_dashboard"] = ((), lambda: views.expert_dashboard(t("trees"), t("nowcast"), t("shading")))
        v["vector_tiles"] = ((), lambda: views.vector_tiles(t("trees"), t("nowcast"), t("trees_private")))
        v["watering"] = ((), lambda: views.watering(t("watering_gdk"), t("watering_sga"), today))
        chosen = {self(n): (tuple(self(i) for i in v[n][0]), v[n][1]) for n in wanted or v}
        return sinks.refresh(self.spark, chosen)

    def tables(self) -> features.Tables:
        t = self.table
        return features.Tables(
            trees=t("trees"), sensors=t("sensor_measurements"), devices=t("tree_devices"),
            trees_private=t("trees_private"), watering_gdk=t("watering_gdk"), watering_sga=t("watering_sga"),
            shading_monthly=t("shading_monthly"), weather=t("weather"), weather_tiles=t("weather_tile_measurement"))


# --- loads ------------------------------------------------------------------------------------

def prepare_trees(raw: DataFrame, street: bool, now: dt.datetime, projected: bool = True) -> DataFrame:
    """Tree features of one source: projection to longitude and latitude, flags and stamps."""
    if projected:
        raw = raw.withColumn("geometry", to_wgs84("geometry.x", "geometry.y"))
    return stamp(with_lat_lng(raw.withColumnRenamed("baumid", "id").drop("gml_id")), now, street_tree=street)


def load_trees(db: Database, street: DataFrame, park: DataFrame) -> bool:
    """Once only. A tree in both sources is a street tree; within a source the first row counts."""
    both = union_all(street.withColumn("_source", F.lit(0)), park.withColumn("_source", F.lit(1)))
    both = both.withColumn("_row", F.monotonically_increasing_id())
    unique = dedup_first(both, ["id"], ["_source", "_row"]).drop("_source", "_row")
    missing = [c for c in db.table("trees").columns if c not in unique.columns]
    return sinks.load_once(unique.withColumns({c: F.lit(None) for c in missing}), db("trees"))


def tree_duplicates(street: DataFrame, park: DataFrame) -> DataFrame:
    """Ids that ``load_trees`` drops rows of: more than once in a source, or street trees that are park trees too."""
    twice = duplicate_report(park, street, "id")
    return union_all(duplicate_report(street, park, "id").where("n_in_batch > 1").withColumn("source", F.lit("street")),
                     twice.withColumn("source", F.lit("park")))


def load_soil(db: Database, raw: DataFrame, now: dt.datetime) -> bool:
    return sinks.load_once(stamp(raw, now), db("soil"))


def load_shading(db: Database, shading: DataFrame, table: str = "shading_monthly") -> None:
    """Full replacement by the known trees, first row per tree."""
    known = restrict(shading, db.table("trees").select(F.col("id").alias("tree_id")), ["tree_id"])
    first = dedup_first(known.withColumn("_row", F.monotonically_increasing_id()), ["tree_id"], ["_row"])
    sinks.replace(first.drop("_row"), db(table))


def load_shading_from_maps(db: Database, cells: DataFrame, transform: DataFrame, daylight: DataFrame) -> None:
    """Seasonal sun hours, as cells of maps in the metric grid, to the shading index of every tree."""
    trees = db.table("trees").select(F.col("id").alias("tree_id"), to_utm33("lng", "lat").alias("_g"))
    samples = spatial.sample_nearest(trees, cells, transform, ["tree_id"], F.col("_g.x"), F.col("_g.y"))
    index = spatial.shading_index(samples, daylight, SEASONS)
    sinks.replace(index.select(*db.table("shading").columns), db("shading"))


def load_rain(db: Database, cells: DataFrame, corners: DataFrame, mask: DataFrame, today: dt.date,
              days: int = 14) -> None:
    """Hourly rain to daily rain per tile, redoing the last loaded day, then the rain views."""
    known = db.table("radolan_tiles")
    tiles = spatial.restrict_to_mask(spatial.lattice_to_cells(corners), mask, "id", mask_kind="multi")
    new = spatial.register_tiles(tiles, known)
    grown = not new.isEmpty()
    if grown:
        sinks.append(new, db("radolan_tiles"))
    spark = db.spark
    if grown or not spark.catalog.tableExists(db("tree_radolan_tile")) or db.table("tree_radolan_tile").isEmpty():
        db.refresh("tree_radolan_tile", today=today)
    resume = sinks.resume_point(db.table("radolan"), "date", default=today - dt.timedelta(days=days)).first()[0]
    rain = spatial.rain_tiles(cells.where(F.to_date("ts") >= F.lit(resume)))
    inside = db.table("radolan_tiles").select(F.col("id").alias("tile_id"))
    sinks.replace_range(aggregates.daily_rain(restrict(rain, inside, ["tile_id"])), db("radolan"), "date", resume)
    db.refresh("radolan_14d_agg", "rainfall", today=today)


def load_watering(db: Database, events: DataFrame, today: dt.date, days: int = 14) -> None:
    """Redo the last two weeks, because citizens report late; events are (tree_id, ts, amount_liters)."""
    since = today - dt.timedelta(days=days)
    kept = db.table("watering_gdk").where(F.col("date") < F.lit(since))
    resume = sinks.resume_point(kept, "date", default=WATERING_RESUME).first()[0]
    fresh = aggregates.daily_watering(events.where(F.to_date("ts") > F.lit(resume)))
    sinks.replace_range(fresh, db("watering_gdk"), "date", since)
    db.refresh("watering", today=today)


def load_station_weather(db: Database, stations: DataFrame, weather: DataFrame, today: dt.date) -> None:
    """New stations and, per station, new days."""
    sinks.append(only_new(stations, db.table("weather_stations"), ["id"]), db("weather_stations"))
    sinks.append(only_new(weather, db.table("weather"), ["stations_id", "date"]), db("weather"))
    db.refresh("weather_14d_agg", today=today)


def load_tile_weather(db: Database, hourly: DataFrame, today: dt.date) -> None:
    """Days after the last loaded one, per tile."""
    daily = aggregates.daily_weather(hourly)
    resume = sinks.resume_point(db.table("weather_tile_measurement"), "date", ["tile_id"])
    sinks.append(sinks.incremental(daily, resume, "date", ["tile_id"]), db("weather_tile_measurement"))
    db.refresh("weather_tile_14d_agg", today=today)


def load_tile_forecast(db: Database, hourly: DataFrame, start: dt.date, end: dt.date, created_at: dt.datetime) -> None:
    """Replace the days ``[start, end)`` of the delivered tiles."""
    daily = aggregates.daily_weather(hourly).withColumn("created_at", F.lit(created_at))
    tiles = distinct_keys(hourly, "tile_id")
    sinks.replace_range(daily, db("weather_tile_forecast"), "date", start, end, tiles, ["tile_id"])


# --- models -----------------------------------------------------------------------------------

def train(db: Database, forecast: bool, today: dt.date, folder: str, forest: Mapping | None = None,
          auxiliary_forest: Mapping | None = None) -> features.Preprocessor:
    """Fit the preprocessor and one forest per depth; forecasts also get their auxiliary models."""
    frame = cut_lineage(features.training_frame(db.tables(), forecast, today))
    prep = features.Preprocessor(forecast).fit(frame)
    rows = prep.transform_train(frame).drop("site_id").na.drop("any").persist()
    kind = "forecast" if forecast else "nowcast"
    if forecast:
        fitted = models.train_forecast(rows, forest or FORECAST_FOREST)
        models.save_models(models.train_auxiliary(rows, auxiliary_forest or NOWCAST_FOREST), f"{folder}/auxiliary")
    else:
        fitted = models.train_nowcast(rows, forest or NOWCAST_FOREST)
    models.save_models(fitted, f"{folder}/{kind}")
    rows.unpersist()
    save_preprocessor(prep, f"{folder}/preprocessor_{kind}")
    return prep


def save_preprocessor(prep: features.Preprocessor, folder: str) -> None:
    prep.codes.codes.write.mode("overwrite").parquet(f"{folder}/codes")
    prep.last_mean.write.mode("overwrite").parquet(f"{folder}/last_mean")
    spark = prep.last_mean.sparkSession
    cols = [(c, "category") for c in prep.cat_columns] + [(c, "number") for c in prep.num_columns]
    (spark.createDataFrame([(i, c, k) for i, (c, k) in enumerate(cols)], "i int, column string, kind string")
     .write.mode("overwrite").parquet(f"{folder}/columns"))


def load_preprocessor(spark: SparkSession, folder: str, forecast: bool) -> features.Preprocessor:
    prep = features.Preprocessor(forecast)
    rows = spark.read.parquet(f"{folder}/columns").orderBy("i").collect()
    prep.cat_columns = [r["column"] for r in rows if r["kind"] == "category"]
    prep.num_columns = [r["column"] for r in rows if r["kind"] == "number"]
    prep.codes = features.OrdinalCodes(spark.read.parquet(f"{folder}/codes"))
    prep.last_mean = spark.read.parquet(f"{folder}/last_mean")
    return prep


def _store(db: Database, predictions: DataFrame, table: str, today: dt.date) -> None:
    """Full replacement of a prediction table; the ids follow tree, time and kind, and go on from run to run.

    The rows are numbered before they are written, so no reader sees rows without ids.
    """
    last = db.table(table).agg(F.max("id")).first()[0] or 0
    numbered = with_serial_id(predictions, ["tree_id", "timestamp", "type_id"], start=last + 1)
    sinks.replace(numbered.withColumn("id", F.col("id").cast("int")).select(*db.table(table).columns), db(table))
    db.refresh("expert_dashboard", "vector_tiles", today=today)


def nowcast(db: Database, folder: str, today: dt.date, created_at: dt.datetime) -> None:
    """All street trees at the last day with station weather."""
    date = aggregates.max_date(db.table("weather"), "date").first()[0]
    prep = load_preprocessor(db.spark, f"{folder}/preprocessor_nowcast", False)
    frame = prep.transform_inference(cut_lineage(features.inference_frame(db.tables(), False, date)))
    rows = models.nowcast(models.load_models(f"{folder}/nowcast"), frame, models.group_means(prep.last_mean),
                          date, created_at)
    _store(db, rows, "nowcast", today)


def forecast(db: Database, folder: str, today: dt.date, created_at: dt.datetime, horizon: int = HORIZON_DAYS,
             tile: int = CITY_TILE, rolled: bool = True) -> None:
    """All street trees, ``horizon`` days after the last measured weather.

    The models are trained on trailing weather, so the inputs are rolled as well; ``rolled=False``
    feeds single days, as the original does.
    """
    last = aggregates.max_date(db.table("weather_tile_measurement"), "date").first()[0]
    prep = load_preprocessor(db.spark, f"{folder}/preprocessor_forecast", True)
    base = prep.transform_inference(cut_lineage(features.inference_frame(db.tables(), True, last)))
    measured = db.table("weather_tile_measurement").where(F.col("tile_id") == tile)
    coming = models.newest_forecast(db.table("weather_tile_forecast"), tile).where(F.col("date") > F.lit(last))
    if rolled:
        cols = [c for c in coming.columns if c != "date"]
        series = union_all(measured.select("date", *cols), coming).withColumn("tile_id", F.lit(tile))
        measured = coming = features.rolling_weather(series, cols, ["tile_id"])
    past = models.weather_by_day(measured, last - dt.timedelta(days=len(LAG_FEATURES) - 1), last)
    ahead = models.weather_by_day(coming, last + dt.timedelta(days=1), last + dt.timedelta(days=horizon))
    rows = models.forecast(models.load_models(f"{folder}/forecast"), models.load_models(f"{folder}/auxiliary"),
                           base, models.group_means(prep.last_mean), past, ahead, last, created_at, horizon)
    _store(db, rows, "forecast", today)


# --- evaluation -------------------------------------------------------------------------------

def evaluate(db: Database, today: dt.date, experiment: str, path: str, k: int = 4, estimators: Mapping | None = None) -> DataFrame:
    """Site folds of every regressor; the figures go to the experiment log and the summary is returned."""
    frame = cut_lineage(features.training_frame(db.tables(), False, today))
    rows = features.Preprocessor(False).fit(frame).transform_train(frame).withColumnRenamed("target", "value")
    rows = cut_lineage(rows)
    folds = cut_lineage(features.site_folds(rows, k))
    chosen = estimators or models.estimators()
    predictions = cut_lineage(models.predict_folds(rows, folds, k, chosen))
    parameters = {n: {p.name: v for p, v in e.extractParamMap().items()} for n, e in chosen.items()}
    sinks.log_experiment(models.experiment_records(predictions, experiment, NOWCAST_FEATURES, parameters), path)
    return models.evaluate_models(predictions)


def evaluate_windows(db: Database, today: dt.date, forest: Mapping | None = None, starts=BACKTEST_STARTS,
                     drop_starts=BACKTEST_DROP_STARTS) -> DataFrame:
    """Errors of the recursive forecast by step over the held-out windows."""
    frame = cut_lineage(features.training_frame(db.tables(), True, today))
    rows = cut_lineage(features.Preprocessor(True).fit(frame).transform_train(frame).drop("site_id"))
    return aggregates.metrics_by_horizon(models.backtest(rows, starts, drop_starts, forest or FORECAST_FOREST))


def check(db: Database) -> DataFrame:
    return quality.audit({t: db.table(t) for t in quality.MODEL_RULES})
