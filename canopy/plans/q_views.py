"""Registered queries: views, table functions and the steps under them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from canopy.constants import SENSOR_TYPES
from canopy.operators import aggregates as A, windows as W
from canopy.plans import views as V
from canopy.plans.registry import query
from canopy.plans.standins import Roles, rounded, text, with_roles

TRAILING = ["rainfall_mm_14d_sum", "temp_avg_c_14d_avg", "wind_avg_ms_14d_avg", "temp_max_c_14d_avg", "wind_max_ms_14d_avg"]
_R = ", ".join(f"round({c} + 1e-9, 4) AS {c}" for c in TRAILING)


@query("rainfall_latest", with_roles("radolan_agg") + """
SELECT s_name AS tree_id, round(a.rainfall_mm_14d_sum + 1e-9, 4) AS rainfall_in_mm
FROM supplier JOIN (SELECT DISTINCT ON (tile_id) tile_id, rainfall_mm_14d_sum FROM radolan_agg
 ORDER BY tile_id, date DESC) a ON a.tile_id = s_suppkey""")
def rainfall_latest(r: Roles) -> DataFrame:
    tree_tiles = r.supplier.select(F.col("s_name").alias("tree_id"), F.col("s_suppkey").alias("tile_id"))
    return rounded(V.rainfall(tree_tiles, V.radolan_14d_agg(r.radolan)), "rainfall_in_mm")


@query("trailing_14_sum_avg", with_roles("weather_agg") + f"SELECT date, {_R} FROM weather_agg")
def trailing_14_sum_avg(r: Roles) -> DataFrame:
    return rounded(V.weather_14d_agg(r.weather), *TRAILING)


@query("trailing_14_tile_weather", with_roles(
    "two_tiles", agg="""SELECT tile_id, date, sum(rainfall_mm) OVER w AS rainfall_mm_14d_sum,
 avg(temp_avg_c) OVER w AS temp_avg_c_14d_avg, avg(wind_avg_ms) OVER w AS wind_avg_ms_14d_avg,
 avg(temp_max_c) OVER w AS temp_max_c_14d_avg, avg(wind_max_ms) OVER w AS wind_max_ms_14d_avg FROM two_tiles
 WINDOW w AS (PARTITION BY tile_id ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""")
    + f"SELECT tile_id, date, {_R} FROM agg")
def trailing_14_tile_weather(r: Roles) -> DataFrame:
    return rounded(V.weather_tile_14d_agg(r.two_tiles, tile=None), *TRAILING)


@query("trailing_14_by_tile", with_roles("radolan_agg") + """
SELECT date, tile_id, round(rainfall_mm_14d_sum + 1e-9, 4) AS rainfall_mm_14d_sum FROM radolan_agg""")
def trailing_14_by_tile(r: Roles) -> DataFrame:
    return rounded(V.radolan_14d_agg(r.radolan), "rainfall_mm_14d_sum")


@query("trailing_hot_keys", with_roles("readings") + """
SELECT id, type_id, round(sum(value) OVER w + 1e-9, 4) AS sum_7, round(avg(value) OVER w + 1e-9, 4) AS avg_7 FROM readings
WINDOW w AS (PARTITION BY type_id ORDER BY timestamp, id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def trailing_hot_keys(r: Roles) -> DataFrame:
    """Four keys hold all readings, so each is cut into chunks that carry their history."""
    df = W.trailing(r.readings.select("id", "type_id", "timestamp", "value"), ["timestamp", "id"], 7,
                    {"sum_7": F.sum("value"), "avg_7": F.avg("value")}, ["type_id"], chunks=0)
    return rounded(df.select("id", "type_id", "sum_7", "avg_7"), "sum_7", "avg_7")


@query("sensor_group_stats", with_roles("sensor_agg") + """
SELECT type_id, timestamp, round(mean_value + 1e-9, 4) AS mean_value, round(median_value + 1e-9, 4) AS median_value FROM sensor_agg""")
def sensor_group_stats(r: Roles) -> DataFrame:
    return rounded(V.sensor_measurements_agg(r.sensors), "mean_value", "median_value")


_BASE_SQL = """s.tree_id, s.type_id, s.timestamp AS nowcast_date, round(h.winter + 1e-9, 4) AS shading_winter,
 round(h.spring + 1e-9, 4) AS shading_spring, round(h.summer + 1e-9, 4) AS shading_summer, round(h.fall + 1e-9, 4) AS shading_fall,
 t.gattung_deutsch AS tree_gattung, t.standalter AS tree_standalter"""
_FIGURES_SQL = """round(w.rainfall_mm_14d_sum + 1e-9, 4) AS weather_rainfall_mm_14d_sum,
 round(w.temp_avg_c_14d_avg + 1e-9, 4) AS weather_temp_avg_c_14d_avg, round(g.median_value + 1e-9, 4) AS sensor_group_median"""
_STAR_SQL = """FROM sensors s LEFT JOIN shading h ON h.tree_id = s.tree_id LEFT JOIN trees t ON t.id = s.tree_id
LEFT JOIN tile_agg w ON w.date = s.timestamp
LEFT JOIN sensor_agg g ON g.timestamp = s.timestamp AND g.type_id = s.type_id"""
_STAR_ROLES = ("sensors", "shading", "trees", "tile_agg", "sensor_agg")
_STAR_COLS = ["shading_winter", "shading_spring", "shading_summer", "shading_fall", "weather_rainfall_mm_14d_sum",
              "weather_temp_avg_c_14d_avg", "sensor_group_median", "target"]


def _star(r: Roles):
    return (r.sensors, r.shading, r.trees, V.weather_tile_14d_agg(r.tile_weather), V.sensor_measurements_agg(r.sensors))


@query("training_star", with_roles(*_STAR_ROLES)
       + f"SELECT {_BASE_SQL}, {_FIGURES_SQL}, round(s.value + 1e-9, 4) AS target {_STAR_SQL} ORDER BY s.tree_id, s.timestamp DESC")
def training_star(r: Roles) -> DataFrame:
    s, h, t, w, g = _star(r)
    return rounded(V.nowcast_training_data(s, h, t, w, g), *_STAR_COLS).orderBy("tree_id", F.col("nowcast_date").desc())


@query("newest_forecast_star", with_roles(*_STAR_ROLES, "tile_forecast", newest="""
SELECT DISTINCT ON (date) date, temp_max_c, rainfall_mm FROM tile_forecast ORDER BY date, created_at DESC""") + f"""
SELECT {_BASE_SQL}, {_FIGURES_SQL}, round(n.temp_max_c + 1e-9, 4) AS temp_max_c, round(n.rainfall_mm + 1e-9, 4) AS rainfall_mm,
 round(s.value + 1e-9, 4) AS target {_STAR_SQL} LEFT JOIN newest n ON n.date = s.timestamp""")
def newest_forecast_star(r: Roles) -> DataFrame:
    s, h, t, w, g = _star(r)
    return rounded(V.forecast_training_data(s, h, t, w, g, r.tile_forecast), *_STAR_COLS, "temp_max_c", "rainfall_mm")


_SUN_SQL = ", ".join(f"round(x.{c} + 1e-9, 4) AS {c}" for c in V._SUN)


@query("training_star_dev", with_roles(*_STAR_ROLES, "trees_private", "gdk", "sga", "tree_tile", "radolan_agg") + f"""
SELECT {_BASE_SQL}, round(p.baumscheibe_m2 + 1e-9, 4) AS tree_baumscheibe, p.vitality_index AS tree_vitality_index, {_FIGURES_SQL},
 {_SUN_SQL}, round(a.amount_liters + 1e-9, 4) AS gdk_amount_liters, round(b.amount_liters + 1e-9, 4) AS sga_amount_liters,
 k.tile_id, round(d.rainfall_mm_14d_sum + 1e-9, 4) AS radolan_mm_14d_sum, round(s.value + 1e-9, 4) AS target {_STAR_SQL}
LEFT JOIN trees_private p ON p.tree_id = s.tree_id LEFT JOIN tile_weather x ON x.date = s.timestamp
LEFT JOIN gdk a ON a.date = s.timestamp AND a.tree_id = s.tree_id
LEFT JOIN sga b ON b.date = s.timestamp AND b.tree_id = s.tree_id
LEFT JOIN tree_tile k ON k.tree_id = s.tree_id
LEFT JOIN radolan_agg d ON d.tile_id = k.tile_id AND d.date = s.timestamp""")
def training_star_dev(r: Roles) -> DataFrame:
    s, h, t, w, g = _star(r)
    df = V.forecast_training_data_dev(s, h, t, r.trees_private, w, r.tile_weather, r.gdk, r.sga, r.tree_tile,
                                      V.radolan_14d_agg(r.radolan), g)
    return rounded(df, *_STAR_COLS, *V._SUN, "tree_baumscheibe", "gdk_amount_liters", "sga_amount_liters",
                   "radolan_mm_14d_sum")


@query("dashboard_latest", with_roles("trees", "nowcast", "shading") + """
SELECT t.id, CAST(n.value AS INTEGER) AS saugspannung, n.timestamp AS datum, round(h.spring + 1e-9, 4) AS "Verschattung Frühling",
 round(h.summer + 1e-9, 4) AS "Verschattung Sommer", round(h.fall + 1e-9, 4) AS "Verschattung Herbst",
 round(h.winter + 1e-9, 4) AS "Verschattung Winter", art_dtsch, art_bot, bezirk, stammumfg, standalter, baumhoehe, n.type_id,
 n.model_id, kennzeich, standortnr, lat, lng, strname, hausnr
FROM trees t LEFT JOIN nowcast n ON t.id = n.tree_id LEFT JOIN shading h ON t.id = h.tree_id
WHERE t.street_tree AND n.timestamp = (SELECT max(timestamp) FROM nowcast)""")
def dashboard_latest(r: Roles) -> DataFrame:
    df = V.expert_dashboard(r.trees, r.nowcast, r.shading)
    return rounded(df, *[c for c in df.columns if c.startswith("Verschattung")])


_LABELS = ["30cm", "60cm", "90cm", "stamm"]
_PIVOT_SQL = ", ".join(
    f"max(CASE WHEN type_id = {i} THEN {c} END) AS nowcast_{s}_{'4' if (s, l) == ('model_id', 'stamm') else l}"
    for s, c in (("type", "type_id"), ("timestamp", "timestamp"), ("values", "value"), ("created_at", "created_at"),
                 ("model_id", "model_id"))
    for i, l in enumerate(_LABELS, start=1))
_TREE_COLS = ["standortnr", "kennzeich", "gattung_deutsch", "gattung", "art_dtsch", "art_bot", "strname", "hausnr",
              "standalter", "stammumfg", "baumhoehe", "bezirk", "lat", "lng", "street_tree"]


@query("wide_latest_pivot", with_roles("trees", "readings", "trees_private", newest="""
SELECT DISTINCT ON (tree_id, type_id) * FROM readings ORDER BY tree_id, type_id, timestamp DESC, created_at DESC, id DESC""",
       wide=f"SELECT tree_id AS nowcast_tree_id, {_PIVOT_SQL} FROM newest GROUP BY 1") + f"""
SELECT t.id AS trees_id, {", ".join(f"t.{c} AS trees_{c}" for c in _TREE_COLS)},
 round(p.baumscheibe_m2 + 1e-9, 4) AS trees_baumscheibe, w.* FROM trees t
LEFT JOIN wide w ON t.id = w.nowcast_tree_id LEFT JOIN trees_private p ON t.id = p.tree_id""")
def wide_latest_pivot(r: Roles) -> DataFrame:
    df = V.vector_tiles(r.trees.drop("geometry"), r.readings, r.trees_private)
    return rounded(df, "trees_baumscheibe")


@query("wide_positional_pivot", with_roles("readings", newest="""
SELECT DISTINCT ON (tree_id, type_id) * FROM readings ORDER BY tree_id, type_id, timestamp DESC, created_at DESC, id DESC""",
       placed="SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY type_id) AS place FROM newest") + """
SELECT tree_id, """ + ", ".join(
    f"max(CASE WHEN place = {i} THEN value END) AS nowcast_values_{l}, max(CASE WHEN place = {i} THEN type_id END) AS nowcast_type_{l}"
    for i, l in enumerate(_LABELS, start=1)) + " FROM placed GROUP BY 1")
def wide_positional_pivot(r: Roles) -> DataFrame:
    """Kinds fill the columns from the left, so a tree without a depth shifts the later ones."""
    names = r.spark.createDataFrame(SENSOR_TYPES, "type_id int, name string")
    newest = W.latest_per(r.readings.join(names, "type_id"), ["tree_id", "name"],
                          W.newest_first("timestamp", "created_at", "id"))
    return A.pivot_latest_positional(newest, "tree_id", "name", _LABELS, {"values": "value", "type": "type_id"})


@query("nowcast_kinds", with_roles("readings") + """
SELECT tree_id, string_agg(DISTINCT CAST(type_id AS VARCHAR), ',' ORDER BY CAST(type_id AS VARCHAR)) AS kinds
FROM readings GROUP BY 1""")
def nowcast_kinds(r: Roles) -> DataFrame:
    df = A.distinct_sorted_array(r.readings, ["tree_id"], "type_id", "kinds")
    return df.select("tree_id", F.array_join(F.transform("kinds", lambda k: k.cast("string")), ",").alias("kinds"))


@query("watering_union", with_roles("gdk", "sga") + """
SELECT tree_id, round(sum(amount_liters) + 1e-9, 4) AS sum, date FROM (SELECT * FROM gdk UNION ALL SELECT * FROM sga)
WHERE date >= DATE '2024-07-10' - INTERVAL 2 MONTH GROUP BY tree_id, date""")
def watering_union(r: Roles) -> DataFrame:
    return rounded(V.watering(r.gdk, r.sga, dt.date(2024, 7, 10)), "sum")


@query("tree_rain_fn", with_roles("trees", "tiles", "radolan") + """
SELECT r.date, round(sum(r.rainfall_mm) + 1e-9, 4) AS rainfall_in_mm FROM radolan r JOIN tiles ON tiles.id = r.tile_id
JOIN trees t ON t.id = '0' AND t.lng > x0 AND t.lng < x1 AND t.lat > y0 AND t.lat < y1
WHERE r.date >= DATE '2024-06-01' - INTERVAL 13 DAY GROUP BY r.tile_id, r.date ORDER BY r.date DESC""")
def tree_rain_fn(r: Roles) -> DataFrame:
    return rounded(V.rainfall_for("0", r.trees, r.tiles, r.radolan, dt.date(2024, 6, 1)), "rainfall_in_mm")


@query("inference_fn", with_roles("trees", "shading", "tile_agg", "sensor_agg") + """
SELECT t.id AS tree_id, 1 AS type_id, DATE '2024-05-20' AS nowcast_date, round(h.spring + 1e-9, 4) AS shading_spring,
 round(h.summer + 1e-9, 4) AS shading_summer, round(h.fall + 1e-9, 4) AS shading_fall, round(h.winter + 1e-9, 4) AS shading_winter,
 t.gattung_deutsch AS tree_gattung, t.standalter AS tree_standalter,
 (SELECT round(rainfall_mm_14d_sum + 1e-9, 4) FROM tile_agg WHERE date = DATE '2024-05-20') AS weather_rainfall_mm_14d_sum,
 (SELECT round(temp_avg_c_14d_avg + 1e-9, 4) FROM tile_agg WHERE date = DATE '2024-05-20') AS weather_temp_avg_c_14d_avg,
 (SELECT round(median_value + 1e-9, 4) FROM sensor_agg WHERE timestamp = DATE '2024-05-20' AND type_id = 1) AS sensor_group_median
FROM trees t LEFT JOIN shading h ON h.tree_id = t.id WHERE t.street_tree""")
def inference_fn(r: Roles) -> DataFrame:
    df = V.inference_input(dt.date(2024, 5, 20), 1, r.trees, r.shading, V.weather_tile_14d_agg(r.tile_weather),
                           V.sensor_measurements_agg(r.sensors))
    return rounded(df, *[c for c in _STAR_COLS if c != "target"])


# --- aggregates under the views ---------------------------------------------------------------

@query("daily_weather", """
WITH h AS (SELECT ts + INTERVAL 1 HOUR AS local, event_type, value FROM events)
SELECT CASE event_type WHEN 'view' THEN 2 ELSE 3 END AS tile_id, CAST(local AS DATE) AS date, max(value) AS ghi_max_wm2,
 max(value * 2) AS dni_max_wm2, max(value * 3) AS dhi_max_wm2, round(sum(value) + 1e-9, 4) AS ghi_sum_whm2,
 round(sum(value * 2) + 1e-9, 4) AS dni_sum_whm2, round(sum(value * 3) + 1e-9, 4) AS dhi_sum_whm2, round(avg(value / 10) + 1e-9, 4) AS wind_avg_ms,
 max(value / 10) AS wind_max_ms, round(avg(value / 5) + 1e-9, 4) AS temp_avg_c, max(value / 5) AS temp_max_c,
 round(coalesce(sum(CASE WHEN event_type <> 'view' THEN value END), 0) + 1e-9, 4) AS rainfall_mm
FROM h GROUP BY 1, 2""")
def daily_weather(r: Roles) -> DataFrame:
    """Hours of January, so central European time is one hour ahead. One tile delivers no rain at all."""
    v, e = F.col("value"), F.col("event_type")
    hourly = r.events.select(F.when(e == "view", 2).otherwise(3).alias("tile_id"), F.col("ts").cast("timestamp").alias("ts"),
                             v.alias("ghi"), (v * 2).alias("dni"), (v * 3).alias("dhi"), (v / 10).alias("wind"),
                             (v / 5).alias("temp"), F.when(e != "view", v).alias("rainfall_mm"))
    return rounded(A.daily_weather(hourly), "ghi_sum_whm2", "dni_sum_whm2", "dhi_sum_whm2", "wind_avg_ms", "temp_avg_c",
                   "rainfall_mm")


@query("daily_rain", """
SELECT l_suppkey AS tile_id, CAST(l_shipdate AS DATE) AS date, round(avg(l_quantity) + 1e-9, 4) AS rainfall_mm,
 max(l_quantity) AS rainfall_max_mm FROM lineitem GROUP BY 1, 2""")
def daily_rain(r: Roles) -> DataFrame:
    cells = r.lineitem.select(F.col("l_suppkey").alias("tile_id"), F.col("l_shipdate").alias("ts"),
                              F.col("l_quantity").alias("rainfall_mm"))
    return rounded(A.daily_rain(cells), "rainfall_mm")


@query("daily_watering", """
SELECT CAST(user_id AS VARCHAR) AS tree_id, CAST(ts AS DATE) AS date, round(sum(value) + 1e-9, 4) AS amount_liters FROM events GROUP BY 1, 2""")
def daily_watering(r: Roles) -> DataFrame:
    events = r.events.select(text("user_id").alias("tree_id"), "ts", F.col("value").alias("amount_liters"))
    return rounded(A.daily_watering(events), "amount_liters")


@query("depth_mean_append", with_roles("nowcast", every="""
SELECT tree_id, type_id, timestamp, value, created_at, 'm' AS model_id FROM nowcast WHERE type_id <= 3""", every_kind="""
SELECT * FROM every UNION ALL SELECT tree_id, 4, timestamp, avg(value), created_at, model_id FROM every
GROUP BY tree_id, timestamp, created_at, model_id""") + """
SELECT row_number() OVER (ORDER BY tree_id, timestamp, type_id) AS id, tree_id, type_id, timestamp, round(value + 1e-9, 4) AS value FROM every_kind""")
def depth_mean_append(r: Roles) -> DataFrame:
    from canopy.operators.relational import with_serial_id
    every = r.nowcast.where("type_id <= 3").select("tree_id", "type_id", "timestamp", "value", "created_at",
                                                   F.lit("m").alias("model_id"))
    df = with_serial_id(A.add_depth_mean(every), ["tree_id", "timestamp", "type_id"])
    return rounded(df.select("id", "tree_id", "type_id", "timestamp", "value"), "value")


@query("mean_over_tiles", with_roles("two_tiles") + """
SELECT date, round(avg(ghi_sum_whm2) + 1e-9, 4) AS ghi_sum_whm2, round(avg(temp_avg_c) + 1e-9, 4) AS temp_avg_c FROM two_tiles GROUP BY 1""")
def mean_over_tiles(r: Roles) -> DataFrame:
    return rounded(A.mean_over_tiles(r.two_tiles, ["ghi_sum_whm2", "temp_avg_c"]), "ghi_sum_whm2", "temp_avg_c")


@query("site_mean", with_roles("sensors", "devices") + """
SELECT d.site_id, s.type_id, s.timestamp, round(avg(s.value) + 1e-9, 4) AS value FROM sensors s JOIN devices d USING (tree_id)
GROUP BY 1, 2, 3""")
def site_mean(r: Roles) -> DataFrame:
    return rounded(A.site_mean(r.sensors.join(r.devices, "tree_id").drop("tree_id")), "value")


# --- latest rows ------------------------------------------------------------------------------

@query("latest_per_key", with_roles("readings") + """
SELECT DISTINCT ON (tree_id, type_id) tree_id, type_id, id, value FROM readings ORDER BY tree_id, type_id, timestamp DESC, id DESC""")
def latest_per_key(r: Roles) -> DataFrame:
    return W.latest_per(r.readings, ["tree_id", "type_id"], W.newest_first("timestamp", "id")).select(
        "tree_id", "type_id", "id", "value")


@query("correlated_latest", with_roles("nowcast") + """
SELECT n.tree_id, n.type_id, n.timestamp, round(n.value + 1e-9, 4) AS value FROM nowcast n
WHERE n.timestamp = (SELECT max(m.timestamp) FROM nowcast m WHERE m.tree_id = n.tree_id)""")
def correlated_latest(r: Roles) -> DataFrame:
    return rounded(W.latest_rows(r.nowcast, ["tree_id"], "timestamp").select("tree_id", "type_id", "timestamp", "value"), "value")


@query("join_latest", with_roles("trees", "readings", newest="""
SELECT DISTINCT ON (tree_id) tree_id, id AS reading, value FROM readings ORDER BY tree_id, timestamp DESC, id DESC""") + """
SELECT t.id AS tree_id, n.reading, n.value FROM trees t LEFT JOIN newest n ON n.tree_id = t.id""")
def join_latest(r: Roles) -> DataFrame:
    from canopy.operators.relational import join_latest as join
    right = r.readings.select("tree_id", F.col("id").alias("reading"), "value", "timestamp")
    return join(r.trees.select(F.col("id").alias("tree_id")), right, ["tree_id"],
                W.newest_first("timestamp", "reading")).select("tree_id", "reading", "value")
