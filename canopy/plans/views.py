"""The named views and table functions, as compositions over the base tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from canopy.constants import CITY_STATION, CITY_TILE, SENSOR_TYPES, TRAILING_ROWS
from canopy.functions import geo
from canopy.functions.scalars import literal_day, round_to_int
from canopy.operators.aggregates import (
    distinct_sorted_array, pivot_latest, pivot_latest_positional, sensor_group_stats, watering_view)
from canopy.operators.relational import since
from canopy.operators.spatial import join_contains
from canopy.operators.windows import latest_per, newest_first, trailing, trailing_weather

_TRAILING = ["rainfall_mm_14d_sum", "temp_avg_c_14d_avg", "wind_avg_ms_14d_avg", "temp_max_c_14d_avg",
             "wind_max_ms_14d_avg"]


def weather_14d_agg(weather: DataFrame, station: int = CITY_STATION) -> DataFrame:
    """The filter is applied before the window; the filtered key stays its partition."""
    df = weather.where(F.col("stations_id") == station)
    return trailing_weather(df, ["stations_id"]).select("date", *_TRAILING)


def weather_tile_14d_agg(measurement: DataFrame, tile: int | None = CITY_TILE) -> DataFrame:
    if tile is None:
        return trailing_weather(measurement, ["tile_id"]).select("tile_id", "date", *_TRAILING)
    return trailing_weather(measurement.where(F.col("tile_id") == tile), ["tile_id"]).select("date", *_TRAILING)


def tree_radolan_tile(trees: DataFrame, tiles: DataFrame) -> DataFrame:
    return join_contains(trees.select(F.col("id").alias("tree_id"), "geometry"),
                         tiles.select(F.col("id").alias("tile_id"), "geometry"),
                         "tree_id", "tile_id")


def radolan_14d_agg(radolan: DataFrame) -> DataFrame:
    """One row per tile and day, so a tile's partition is bounded by its days."""
    return trailing(radolan, "date", TRAILING_ROWS, {"rainfall_mm_14d_sum": F.sum("rainfall_mm")},
                    ["tile_id"]).select("date", "tile_id", "rainfall_mm_14d_sum")


def rainfall(tree_tiles: DataFrame, radolan_agg: DataFrame) -> DataFrame:
    """Newest trailing rain per tree. The newest row is picked per tile before the trees join."""
    newest = radolan_agg.groupBy("tile_id").agg(F.max_by("rainfall_mm_14d_sum", "date").alias("rainfall_in_mm"))
    return tree_tiles.join(newest, "tile_id").select("tree_id", "rainfall_in_mm")


def sensor_measurements_agg(sensors: DataFrame) -> DataFrame:
    return sensor_group_stats(sensors)


def _training_base(sensors: DataFrame, shading: DataFrame, trees: DataFrame) -> DataFrame:
    """Readings with what depends on the tree alone. ``_day`` is cut once and kept for the joins by day."""
    shade = shading.select("tree_id", *[F.col(s).alias(f"shading_{s}") for s in ("winter", "spring", "summer", "fall")])
    kind = trees.select(F.col("id").alias("tree_id"), F.col("gattung_deutsch").alias("tree_gattung"),
                        F.col("standalter").alias("tree_standalter"))
    return (sensors.select("tree_id", "type_id", F.col("timestamp").alias("nowcast_date"),
                           F.col("value").alias("target"), F.to_date("timestamp").alias("_day"))
            .join(shade, "tree_id", "left").join(kind, "tree_id", "left"))


def _by_day(df: DataFrame, side: DataFrame, *keys: str) -> DataFrame:
    return df.join(side.withColumnRenamed("date", "_day"), ["_day", *keys], "left")


def _with_group_figures(df: DataFrame, city: DataFrame, sensor_agg: DataFrame) -> DataFrame:
    """``city`` has one row per day, so its size is bounded by the calendar."""
    medians = sensor_agg.select("type_id", F.to_date("timestamp").alias("date"),
                                F.col("median_value").alias("sensor_group_median"))
    return _by_day(_by_day(df, city), medians, "type_id")


def _city_weather(weather_agg: DataFrame) -> DataFrame:
    return weather_agg.select("date", F.col("rainfall_mm_14d_sum").alias("weather_rainfall_mm_14d_sum"),
                              F.col("temp_avg_c_14d_avg").alias("weather_temp_avg_c_14d_avg"))


_BASE = ["tree_id", "type_id", "nowcast_date", "shading_winter", "shading_spring", "shading_summer",
         "shading_fall", "tree_gattung", "tree_standalter"]
_FIGURES = ["weather_rainfall_mm_14d_sum", "weather_temp_avg_c_14d_avg", "sensor_group_median"]


def _ordered(df: DataFrame, ordered: bool) -> DataFrame:
    return df.orderBy("tree_id", F.col("nowcast_date").desc()) if ordered else df


def nowcast_training_data(sensors: DataFrame, shading: DataFrame, trees: DataFrame, weather_agg: DataFrame,
                          sensor_agg: DataFrame, ordered: bool = False) -> DataFrame:
    """Sensor readings with shading, tree and group figures.

    ``ordered`` adds the view's sort, a full shuffle that training does not need.
    """
    df = _with_group_figures(_training_base(sensors, shading, trees), _city_weather(weather_agg), sensor_agg)
    return _ordered(df.select(*_BASE, *_FIGURES, "target"), ordered)


def newest_weather_forecast(forecast: DataFrame, cols: list[str], tile: int | None = None) -> DataFrame:
    """Newest issue per day; all tiles are mixed unless one is given. Of equally new ones the first tile counts."""
    df = forecast if tile is None else forecast.where(F.col("tile_id") == tile)
    return latest_per(df, ["date"], [*newest_first("created_at"), F.col("tile_id").asc()]).select("date", *cols)


def forecast_training_data(sensors: DataFrame, shading: DataFrame, trees: DataFrame, weather_agg: DataFrame,
                           sensor_agg: DataFrame, weather_forecast: DataFrame, tile: int | None = None,
                           ordered: bool = False) -> DataFrame:
    current = newest_weather_forecast(weather_forecast, ["temp_max_c", "rainfall_mm"], tile)
    city = _city_weather(weather_agg).join(current, "date", "full_outer")
    df = _with_group_figures(_training_base(sensors, shading, trees), city, sensor_agg)
    return _ordered(df.select(*_BASE, *_FIGURES, "temp_max_c", "rainfall_mm", "target"), ordered)


_SUN = ["ghi_max_wm2", "dni_max_wm2", "dhi_max_wm2", "ghi_sum_whm2", "dni_sum_whm2", "dhi_sum_whm2",
        "wind_avg_ms", "wind_max_ms", "temp_avg_c", "temp_max_c", "rainfall_mm"]


def forecast_training_data_dev(sensors: DataFrame, shading: DataFrame, trees: DataFrame, trees_private: DataFrame,
                               weather_agg: DataFrame, tile_weather: DataFrame, gdk: DataFrame, sga: DataFrame,
                               tree_tiles: DataFrame, radolan_agg: DataFrame, sensor_agg: DataFrame,
                               tile: int = CITY_TILE, ordered: bool = False) -> DataFrame:
    """The widest training frame.

    The readings are shuffled once for all joins by tree and once for both waterings; what is known per
    day for the whole city is joined together first.
    """
    private = trees_private.select("tree_id", F.col("baumscheibe_m2").alias("tree_baumscheibe"),
                                   F.col("vitality_index").alias("tree_vitality_index"))
    df = (_training_base(sensors, shading, trees).join(private, "tree_id", "left")
          .join(tree_tiles.select("tree_id", "tile_id"), "tree_id", "left"))
    for source, name in ((gdk, "gdk_amount_liters"), (sga, "sga_amount_liters")):
        df = _by_day(df, source.select("tree_id", "date", F.col("amount_liters").alias(name)), "tree_id")
    rain = radolan_agg.select("tile_id", "date", F.col("rainfall_mm_14d_sum").alias("radolan_mm_14d_sum"))
    df = _by_day(df, rain, "tile_id")
    sun = tile_weather.where(F.col("tile_id") == tile).select("date", *_SUN)
    city = _city_weather(weather_agg).join(sun, "date", "full_outer")
    df = _with_group_figures(df, city, sensor_agg)
    return _ordered(df.select(*_BASE, "tree_baumscheibe", "tree_vitality_index", *_FIGURES, *_SUN,
                              "gdk_amount_liters", "sga_amount_liters", "tile_id", "radolan_mm_14d_sum",
                              "target"), ordered)


def expert_dashboard(trees: DataFrame, nowcast: DataFrame, shading: DataFrame) -> DataFrame:
    """Street trees at the newest nowcast time, the tension as a whole number."""
    newest = nowcast.agg(F.max("timestamp")).scalar()
    now = nowcast.where(F.col("timestamp") == newest).select(
        F.col("tree_id").alias("id"), "type_id", "model_id", F.col("timestamp").alias("datum"),
        round_to_int("value").alias("saugspannung"))
    shade = shading.select(F.col("tree_id").alias("id"), F.col("spring").alias("Verschattung Frühling"),
                           F.col("summer").alias("Verschattung Sommer"), F.col("fall").alias("Verschattung Herbst"),
                           F.col("winter").alias("Verschattung Winter"))
    tree_cols = ["art_dtsch", "art_bot", "bezirk", "stammumfg", "standalter", "baumhoehe"]
    place_cols = ["kennzeich", "standortnr", "lat", "lng", "strname", "hausnr"]
    return (trees.where("street_tree").select("id", *tree_cols, *place_cols)
            .join(now, "id").join(shade, "id", "left")
            .select("id", "saugspannung", "datum", *[c for c in shade.columns if c != "id"], *tree_cols,
                    "type_id", "model_id", *place_cols))


_WIDE = {"type": "type_id", "timestamp": "timestamp", "values": "value", "created_at": "created_at",
         "model_id": "model_id"}
_LABELS = {i: name.removeprefix("saugspannung_") for i, name in SENSOR_TYPES}


def vector_tiles(trees: DataFrame, nowcast: DataFrame, trees_private: DataFrame, positional: bool = False,
                 sensor_types: DataFrame | None = None) -> DataFrame:
    """One wide row per tree with the newest nowcast of each kind.

    ``positional`` fills the columns in the order of the kind names, so a missing kind shifts the rest,
    as picking array elements by position does.
    """
    if positional:
        named = nowcast.join(sensor_types.select(F.col("id").alias("type_id"), "name"), "type_id")
        newest = latest_per(named, ["tree_id", "name"], newest_first("timestamp", "created_at", "id"))
        wide = pivot_latest_positional(newest, "tree_id", "name", list(_LABELS.values()), _WIDE)
    else:
        wide = pivot_latest(nowcast, "tree_id", "type_id", _LABELS, _WIDE, ["timestamp", "created_at", "id"])
    wide = wide.withColumnRenamed("nowcast_model_id_stamm", "nowcast_model_id_4")
    tree_cols = [c for c in trees.columns if c not in ("id", "baumscheibe")]
    left = trees.select(F.col("id").alias("trees_id"), *[F.col(c).alias(f"trees_{c}") for c in tree_cols])
    beds = trees_private.select(F.col("tree_id").alias("trees_id"), F.col("baumscheibe_m2").alias("trees_baumscheibe"))
    wide = wide.withColumn("trees_id", F.col("tree_id")).withColumnRenamed("tree_id", "nowcast_tree_id")
    return left.join(beds, "trees_id", "left").join(wide, "trees_id", "left")


def nowcast_kinds(nowcast: DataFrame, sensor_types: DataFrame) -> DataFrame:
    """Sorted names of the kinds each tree has a nowcast for."""
    named = nowcast.join(sensor_types.select(F.col("id").alias("type_id"), "name"), "type_id")
    return distinct_sorted_array(named, ["tree_id"], "name", "nowcast_types_array")


def watering(gdk: DataFrame, sga: DataFrame, today: dt.date) -> DataFrame:
    return watering_view(gdk, sga, today)


# --- table functions --------------------------------------------------------------------------

def rainfall_for(tree_id: str, trees: DataFrame, tiles: DataFrame, radolan: DataFrame, today: dt.date) -> DataFrame:
    """Daily rain on the tile of one tree, last 13 days, newest first."""
    place = trees.where(F.col("id") == tree_id).select("geometry").scalar()
    tile = (tiles.withColumn("_p", place)
            .where(geo.contains(geo.edges("geometry"), "_p.x", "_p.y")).select(F.col("id").alias("tile_id")))
    return (since(radolan, "date", "13 days", today).join(tile, "tile_id", "left_semi")
            .groupBy("tile_id", "date").agg(F.sum("rainfall_mm").alias("rainfall_in_mm"))
            .select("date", "rainfall_in_mm").orderBy(F.col("date").desc()))


def inference_input(date: dt.date, type_id: int, trees: DataFrame, shading: DataFrame, weather_agg: DataFrame,
                    sensor_agg: DataFrame) -> DataFrame:
    """Street trees with the group figures of one day and kind. Each figure is one value or null."""
    on_day = weather_agg.where(F.col("date") == literal_day(date))
    median = sensor_agg.where((F.to_date("timestamp") == literal_day(date)) & (F.col("type_id") == type_id))
    shade = shading.select("tree_id", *[F.col(s).alias(f"shading_{s}") for s in ("spring", "summer", "fall", "winter")])
    return (trees.where("street_tree")
            .select(F.col("id").alias("tree_id"), F.col("gattung_deutsch").alias("tree_gattung"),
                    F.col("standalter").alias("tree_standalter"))
            .join(shade, "tree_id", "left")
            .select("tree_id", F.lit(type_id).alias("type_id"), literal_day(date).alias("nowcast_date"),
                    "shading_spring", "shading_summer", "shading_fall", "shading_winter", "tree_gattung",
                    "tree_standalter",
                    on_day.select("rainfall_mm_14d_sum").scalar().alias("weather_rainfall_mm_14d_sum"),
                    on_day.select("temp_avg_c_14d_avg").scalar().alias("weather_temp_avg_c_14d_avg"),
                    median.select("median_value").scalar().alias("sensor_group_median")))
