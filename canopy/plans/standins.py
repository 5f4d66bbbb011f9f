"""The given star-schema tables in the roles of the sensing tables.

Each role exists twice: as a DataFrame for the operators and as the same SELECT for the SQL check.
Every role is built from whole tables. Order and shipping days are moved by ``DAY_SHIFT`` days and
events by four months, so that weather, rain and sensors share the spring of 2024.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from canopy.functions import geo

DAY_SHIFT = 8401
KIND_SQL = "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kind() -> Column:
    e = F.col("event_type")
    return F.when(e == "view", 1).when(e == "click", 2).when(e == "purchase", 3).otherwise(4)


def text(c: str) -> Column:
    return F.col(c).cast("string")


def sensor_day() -> Column:
    return F.to_date(F.col("ts") + F.expr("interval 4 months"))


def order_day() -> Column:
    return F.date_add(F.to_date("o_orderdate"), DAY_SHIFT)


def rd(c: Column | str, digits: int = 4) -> Column:
    """Rounded for comparison. The tiny shift, also in the SQL, keeps sums off the exact halves, where
    the last bit of a sum would decide."""
    return F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, digits)


def rounded(df: DataFrame, *cols: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: rd(c, digits) for c in cols})


class Roles:
    """DataFrames of one data folder by role."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
            return load(self.spark, self.folder, name)
        raise AttributeError(name)

    @property
    def trees(self) -> DataFrame:
        x = (F.col("c_custkey") * 37 % 500 + 0.5) / 100
        y = (F.col("c_custkey") * 91 % 500 + 0.5) / 100
        return self.customer.select(
            text("c_custkey").alias("id"), text("c_nationkey").alias("standortnr"), F.col("c_name").alias("kennzeich"),
            F.col("c_mktsegment").alias("gattung_deutsch"), F.col("c_mktsegment").alias("gattung"),
            F.col("c_name").alias("art_dtsch"), F.col("c_name").alias("art_bot"),
            F.col("c_name").alias("strname"), text("c_nationkey").alias("hausnr"),
            F.pmod("c_custkey", F.lit(120)).cast("double").alias("standalter"),
            F.col("c_acctbal").alias("stammumfg"), F.col("c_acctbal").alias("baumhoehe"),
            text("c_nationkey").alias("bezirk"), geo.point(x, y).alias("geometry"),
            y.alias("lat"), x.alias("lng"), (F.col("c_acctbal") > 0).alias("street_tree"))

    @property
    def sensors(self) -> DataFrame:
        return (self.events.groupBy(text("user_id").alias("tree_id"), kind().alias("type_id"),
                                    sensor_day().alias("timestamp")).agg(F.avg("value").alias("value")))

    @property
    def nowcast(self) -> DataFrame:
        return (self.events.groupBy(text("user_id").alias("tree_id"), kind().alias("type_id"),
                                    F.to_date("ts").alias("timestamp"))
                .agg(F.avg("value").alias("value"), F.min("props").alias("model_id"),
                     F.min("event_id").alias("id"), F.max(F.to_date("ts")).alias("created_at")))

    @property
    def readings(self) -> DataFrame:
        """Events as single readings with their own times."""
        return self.events.select(F.col("event_id").alias("id"), text("user_id").alias("tree_id"),
                                  kind().alias("type_id"), F.col("ts").alias("timestamp"), "value",
                                  F.to_date("ts").alias("created_at"), F.col("props").alias("model_id"))

    def _water(self, what: str) -> DataFrame:
        return (self.events.where(F.col("event_type") == what)
                .groupBy(text("user_id").alias("tree_id"), sensor_day().alias("date"))
                .agg(F.sum("value").alias("amount_liters")))

    @property
    def gdk(self) -> DataFrame:
        return self._water("purchase")

    @property
    def sga(self) -> DataFrame:
        return self._water("click")

    @property
    def weather(self) -> DataFrame:
        p, c = F.col("o_totalprice"), F.col("o_custkey")
        return (self.orders.groupBy(order_day().alias("date"))
                .agg((F.sum(p) / 1e6).alias("rainfall_mm"), (F.avg(p) / 1e4).alias("temp_avg_c"),
                     (F.max(p) / 1e4).alias("temp_max_c"), F.avg(c).alias("wind_avg_ms"),
                     F.max(c).cast("double").alias("wind_max_ms"), (F.min(p) / 1e4).alias("upm"))
                .withColumn("stations_id", F.lit(433).cast("bigint")))

    def _tile_weather(self, *extra: Column) -> DataFrame:
        p, c = F.col("o_totalprice"), F.col("o_custkey")
        return (self.orders.groupBy(*extra, order_day().alias("date"))
                .agg((F.max(p) / 1e3).alias("ghi_max_wm2"), F.max(c).cast("double").alias("dni_max_wm2"),
                     (F.min(p) / 1e3).alias("dhi_max_wm2"), (F.sum(p) / 1e3).alias("ghi_sum_whm2"),
                     F.sum(c).cast("double").alias("dni_sum_whm2"), F.count("*").cast("double").alias("dhi_sum_whm2"),
                     F.avg(c).alias("wind_avg_ms"), F.max(c).cast("double").alias("wind_max_ms"),
                     (F.avg(p) / 1e4).alias("temp_avg_c"), (F.max(p) / 1e4).alias("temp_max_c"),
                     (F.sum(p) / 1e6).alias("rainfall_mm")))

    @property
    def tile_weather(self) -> DataFrame:
        return self._tile_weather().withColumn("tile_id", F.lit(2).cast("bigint"))

    @property
    def two_tiles(self) -> DataFrame:
        return self._tile_weather((F.pmod("o_custkey", F.lit(2)) + 2).alias("tile_id"))

    @property
    def tile_forecast(self) -> DataFrame:
        issued = F.substring("o_orderpriority", 1, 1).cast("int").alias("created_at")
        return self._tile_weather(issued).withColumn("tile_id", F.lit(2).cast("bigint"))

    @property
    def radolan(self) -> DataFrame:
        return (self.lineitem.groupBy(F.col("l_suppkey").alias("tile_id"),
                                      F.date_add(F.to_date("l_shipdate"), DAY_SHIFT).alias("date"))
                .agg(F.avg("l_quantity").alias("rainfall_mm"), F.max("l_quantity").alias("rainfall_max_mm")))

    @property
    def tiles(self) -> DataFrame:
        x = F.col("n_nationkey") % 5
        y = F.floor(F.col("n_nationkey") / 5)
        return self.nation.select(F.col("n_nationkey").cast("bigint").alias("id"),
                                  geo.box_ring(x, y, x + 1, y + 1).alias("geometry"))

    @property
    def tree_tile(self) -> DataFrame:
        return self.customer.select(text("c_custkey").alias("tree_id"), F.col("c_nationkey").cast("bigint").alias("tile_id"))

    @property
    def shading(self) -> DataFrame:
        m, share = F.month("o_orderdate"), F.col("o_totalprice") / 1e6
        return self.orders.groupBy(text("o_custkey").alias("tree_id")).agg(
            F.avg(F.when(m.between(3, 5), share)).alias("spring"), F.avg(F.when(m.between(6, 8), share)).alias("summer"),
            F.avg(F.when(m.between(9, 11), share)).alias("fall"), F.avg(F.when((m < 3) | (m > 11), share)).alias("winter"))

    @property
    def shading_monthly(self) -> DataFrame:
        from canopy.constants import MONTHS
        m, share = F.month("o_orderdate"), F.col("o_totalprice") / 1e6
        return self.orders.groupBy(text("o_custkey").alias("tree_id")).agg(
            *[F.avg(F.when(m == i, share)).alias(n) for i, n in enumerate(MONTHS, start=1)])

    @property
    def trees_private(self) -> DataFrame:
        return self.customer.select(text("c_custkey").alias("tree_id"), F.col("c_acctbal").alias("vitality_index"),
                                    (F.col("c_acctbal") / 100).alias("baumscheibe_m2"),
                                    F.col("c_mktsegment").alias("baumscheibe_surface"))

    @property
    def devices(self) -> DataFrame:
        return self.customer.select(text("c_custkey").alias("tree_id"), F.col("c_nationkey").cast("bigint").alias("site_id"))

    @property
    def raster(self) -> DataFrame:
        return self.part.select(F.lit("map").alias("raster_id"), F.floor(F.col("p_partkey") / 50).cast("int").alias("row"),
                                F.pmod("p_partkey", F.lit(50)).cast("int").alias("col"),
                                F.col("p_retailprice").alias("value"))

    @property
    def rasters(self) -> DataFrame:
        """Maps of 20 by 50 cells, one per thousand parts."""
        line = F.floor(F.col("p_partkey") / 50)
        return self.part.select(F.floor(F.col("p_partkey") / 1000).cast("string").alias("raster_id"),
                                F.pmod(line, F.lit(20)).cast("int").alias("row"),
                                F.pmod("p_partkey", F.lit(50)).cast("int").alias("col"),
                                (F.col("p_retailprice") + F.col("p_size")).alias("value"))


# --- the same roles as SQL --------------------------------------------------------------------

_WATER = ("SELECT CAST(user_id AS VARCHAR) AS tree_id, CAST(ts + INTERVAL 4 MONTH AS DATE) AS date, "
          "sum(value) AS amount_liters FROM events WHERE event_type = '{}' GROUP BY 1, 2")
_ORDER_DAY = f"CAST(o_orderdate AS DATE) + {DAY_SHIFT}"
_TILE = f"""max(o_totalprice) / 1e3 AS ghi_max_wm2, CAST(max(o_custkey) AS DOUBLE) AS dni_max_wm2,
 min(o_totalprice) / 1e3 AS dhi_max_wm2, sum(o_totalprice) / 1e3 AS ghi_sum_whm2,
 CAST(sum(o_custkey) AS DOUBLE) AS dni_sum_whm2, CAST(count(*) AS DOUBLE) AS dhi_sum_whm2,
 avg(o_custkey) AS wind_avg_ms, CAST(max(o_custkey) AS DOUBLE) AS wind_max_ms, avg(o_totalprice) / 1e4 AS temp_avg_c,
 max(o_totalprice) / 1e4 AS temp_max_c, sum(o_totalprice) / 1e6 AS rainfall_mm"""
_SEASON = "avg(CASE WHEN month(o_orderdate) IN ({}) THEN o_totalprice / 1e6 END) AS {}"

ROLE_SQL = {
    "trees": """SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS standortnr, c_name AS kennzeich,
 c_mktsegment AS gattung_deutsch, c_mktsegment AS gattung, c_name AS art_dtsch, c_name AS art_bot, c_name AS strname,
 CAST(c_nationkey AS VARCHAR) AS hausnr, CAST(c_custkey % 120 AS DOUBLE) AS standalter, c_acctbal AS stammumfg,
 c_acctbal AS baumhoehe, CAST(c_nationkey AS VARCHAR) AS bezirk, (c_custkey * 37 % 500 + 0.5) / 100 AS lng,
 (c_custkey * 91 % 500 + 0.5) / 100 AS lat, c_acctbal > 0 AS street_tree FROM customer""",
    "sensors": f"""SELECT CAST(user_id AS VARCHAR) AS tree_id, {KIND_SQL} AS type_id,
 CAST(ts + INTERVAL 4 MONTH AS DATE) AS timestamp, avg(value) AS value FROM events GROUP BY 1, 2, 3""",
    "nowcast": f"""SELECT CAST(user_id AS VARCHAR) AS tree_id, {KIND_SQL} AS type_id, CAST(ts AS DATE) AS timestamp,
 avg(value) AS value, min(props) AS model_id, min(event_id) AS id, max(CAST(ts AS DATE)) AS created_at
 FROM events GROUP BY 1, 2, 3""",
    "readings": f"""SELECT event_id AS id, CAST(user_id AS VARCHAR) AS tree_id, {KIND_SQL} AS type_id, ts AS timestamp,
 value, CAST(ts AS DATE) AS created_at, props AS model_id FROM events""",
    "gdk": _WATER.format("purchase"),
    "sga": _WATER.format("click"),
    "weather": f"""SELECT {_ORDER_DAY} AS date, sum(o_totalprice) / 1e6 AS rainfall_mm, avg(o_totalprice) / 1e4 AS temp_avg_c,
 max(o_totalprice) / 1e4 AS temp_max_c, avg(o_custkey) AS wind_avg_ms, CAST(max(o_custkey) AS DOUBLE) AS wind_max_ms,
 min(o_totalprice) / 1e4 AS upm, 433 AS stations_id FROM orders GROUP BY 1""",
    "tile_weather": f"SELECT {_ORDER_DAY} AS date, 2 AS tile_id, {_TILE} FROM orders GROUP BY 1",
    "two_tiles": f"SELECT {_ORDER_DAY} AS date, o_custkey % 2 + 2 AS tile_id, {_TILE} FROM orders GROUP BY 1, 2",
    "tile_forecast": f"""SELECT {_ORDER_DAY} AS date, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS created_at, 2 AS tile_id,
 {_TILE} FROM orders GROUP BY 1, 2""",
    "radolan": f"""SELECT l_suppkey AS tile_id, CAST(l_shipdate AS DATE) + {DAY_SHIFT} AS date, avg(l_quantity) AS rainfall_mm,
 max(l_quantity) AS rainfall_max_mm FROM lineitem GROUP BY 1, 2""",
    "tiles": """SELECT n_nationkey AS id, n_nationkey % 5 AS x0, n_nationkey // 5 AS y0, n_nationkey % 5 + 1 AS x1,
 n_nationkey // 5 + 1 AS y1 FROM nation""",
    "tree_tile": "SELECT CAST(c_custkey AS VARCHAR) AS tree_id, CAST(c_nationkey AS BIGINT) AS tile_id FROM customer",
    "shading": "SELECT CAST(o_custkey AS VARCHAR) AS tree_id, " + ", ".join([
        _SEASON.format("3, 4, 5", "spring"), _SEASON.format("6, 7, 8", "summer"),
        _SEASON.format("9, 10, 11", "fall"), _SEASON.format("12, 1, 2", "winter")]) + " FROM orders GROUP BY 1",
    "trees_private": """SELECT CAST(c_custkey AS VARCHAR) AS tree_id, c_acctbal AS vitality_index,
 c_acctbal / 100 AS baumscheibe_m2, c_mktsegment AS baumscheibe_surface FROM customer""",
    "devices": "SELECT CAST(c_custkey AS VARCHAR) AS tree_id, CAST(c_nationkey AS BIGINT) AS site_id FROM customer",
    "raster": """SELECT 'map' AS raster_id, CAST(p_partkey // 50 AS INTEGER) AS "row", CAST(p_partkey % 50 AS INTEGER) AS col,
 p_retailprice AS value FROM part""",
    "rasters": """SELECT CAST(p_partkey // 1000 AS VARCHAR) AS raster_id, CAST(p_partkey // 50 % 20 AS INTEGER) AS "row",
 CAST(p_partkey % 50 AS INTEGER) AS col, p_retailprice + p_size AS value FROM part""",
    # Derived steps several checks share.
    "weather_agg": """SELECT date, sum(rainfall_mm) OVER w AS rainfall_mm_14d_sum, avg(temp_avg_c) OVER w AS temp_avg_c_14d_avg,
 avg(wind_avg_ms) OVER w AS wind_avg_ms_14d_avg, avg(temp_max_c) OVER w AS temp_max_c_14d_avg,
 avg(wind_max_ms) OVER w AS wind_max_ms_14d_avg FROM weather
 WINDOW w AS (ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
    "tile_agg": """SELECT date, sum(rainfall_mm) OVER w AS rainfall_mm_14d_sum, avg(temp_avg_c) OVER w AS temp_avg_c_14d_avg,
 avg(wind_avg_ms) OVER w AS wind_avg_ms_14d_avg, avg(temp_max_c) OVER w AS temp_max_c_14d_avg,
 avg(wind_max_ms) OVER w AS wind_max_ms_14d_avg FROM tile_weather
 WINDOW w AS (ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
    "radolan_agg": """SELECT date, tile_id, sum(rainfall_mm) OVER (PARTITION BY tile_id ORDER BY date
 ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS rainfall_mm_14d_sum FROM radolan""",
    "sensor_agg": """SELECT type_id, timestamp, avg(value) AS mean_value, quantile_cont(value, 0.5) AS median_value
 FROM sensors GROUP BY 1, 2""",
}
_NEEDS = {"weather_agg": ["weather"], "tile_agg": ["tile_weather"], "radolan_agg": ["radolan"], "sensor_agg": ["sensors"]}


def with_roles(*names: str, **extra: str) -> str:
    """WITH clause for the named roles (and what they need), then any further steps."""
    order = reduce(lambda seen, n: seen + [x for x in _NEEDS.get(n, []) + [n] if x not in seen], names, [])
    steps = [f"{n} AS ({ROLE_SQL[n]})" for n in order] + [f"{n} AS ({s})" for n, s in extra.items()]
    return "WITH " + ",\n".join(steps) + "\n"
