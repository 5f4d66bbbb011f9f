"""Registered queries: spatial joins, the rain lattice and raster maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from canopy.functions import geo
from canopy.operators import raster as RA, spatial as S
from canopy.plans import views as V
from canopy.plans.registry import query
from canopy.plans.standins import Roles, rounded, with_roles


@query("tile_join", with_roles("trees", "tiles") + """
SELECT t.id AS tree_id, CAST(tiles.id AS BIGINT) AS tile_id FROM trees t JOIN tiles ON t.lng > x0 AND t.lng < x1 AND t.lat > y0 AND t.lat < y1""")
def tile_join(r: Roles) -> DataFrame:
    return V.tree_radolan_tile(r.trees, r.tiles)


@query("triangle_join", with_roles("trees", "tiles") + """
SELECT t.id AS tree_id, CAST(tiles.id AS BIGINT) AS tile_id FROM trees t JOIN tiles ON t.lng > x0 AND t.lat > y0
 AND (t.lng - x0) + (t.lat - y0) < 1""")
def triangle_join(r: Roles) -> DataFrame:
    """Lower left halves of the tiles: slanted edges, and trees that lie in no shape."""
    x, y = F.col("geometry")[0]["x"], F.col("geometry")[0]["y"]
    half = r.tiles.withColumn("geometry", F.array(geo.point(x, y), geo.point(x + 1, y), geo.point(x, y + 1), geo.point(x, y)))
    return V.tree_radolan_tile(r.trees, half)


RING_KEYS = 100_000     # keys of a skyline


@query("skyline_join", f"""
WITH v AS (SELECT o_orderkey AS k, o_orderkey // {RING_KEYS} AS ring, max(o_totalprice) AS h FROM orders GROUP BY 1, 2),
p AS (SELECT l_orderkey, l_linenumber, l_orderkey + l_linenumber / 10.0::DOUBLE AS x, l_extendedprice * 3.0::DOUBLE AS y FROM lineitem WHERE l_quantity > 16
 UNION ALL SELECT l_orderkey, l_linenumber, 1 + l_partkey % 1000 / 1000.0::DOUBLE, l_extendedprice * 1.0::DOUBLE FROM lineitem WHERE l_quantity <= 16),
w AS (SELECT k, ring, h, lead(k) OVER (PARTITION BY ring ORDER BY k) AS k2, lead(h) OVER (PARTITION BY ring ORDER BY k) AS h2,
 lag(k) OVER (PARTITION BY ring ORDER BY k) AS k0 FROM v)
SELECT p.l_orderkey, p.l_linenumber, CAST(w.ring AS BIGINT) AS ring FROM p ASOF JOIN w ON p.x >= w.k
WHERE (p.x > w.k OR w.k0 IS NOT NULL) AND p.x < w.k2 AND p.y > 0 AND p.y < w.h + (p.x - w.k) * (w.h2 - w.h) / (w.k2 - w.k)""")
def skyline_join(r: Roles) -> DataFrame:
    """Rings of up to 100,000 edges, the prices along the order keys, and points of which a third lie in one cell."""
    v = r.orders.groupBy(F.col("o_orderkey").alias("k"), F.floor(F.col("o_orderkey") / RING_KEYS).alias("ring")).agg(F.max("o_totalprice").alias("h"))
    line = F.transform(F.sort_array(F.collect_list(F.struct("k", "h"))), lambda t: geo.point(t["k"], t["h"]))
    ends = [geo.point(f("k"), F.lit(0.0)) for f in (F.min, F.max)]
    rings = (v.groupBy("ring").agg(F.count("*").alias("n"), F.concat(F.array(ends[0]), line, F.array(ends[1], ends[0])).alias("geometry"))
             .where("n > 1").select(F.col("ring").cast("long").alias("ring"), "geometry"))
    apart = F.col("l_quantity") > 16
    x = F.when(apart, F.col("l_orderkey") + F.col("l_linenumber") / F.lit(10.0)).otherwise(1 + F.col("l_partkey") % 1000 / F.lit(1000.0))
    y = F.col("l_extendedprice") * F.when(apart, F.lit(3.0)).otherwise(F.lit(1.0))
    points = r.lineitem.select(F.struct("l_orderkey", "l_linenumber").alias("id"), geo.point(x, y).alias("geometry"))
    return S.join_contains(points, rings, "id", "ring").select("id.*", "ring")


_BOXES = """boxes AS (SELECT r_regionkey AS k, r_regionkey * 0.9 + 0.25 AS x0, r_regionkey * 0.8 + 0.1 AS y0,
 r_regionkey * 0.9 + 0.65 AS x1, r_regionkey * 0.8 + 1.3 AS y1 FROM region)"""


@query("mask_intersects", with_roles("trees").rstrip() + "," + _BOXES + """
SELECT id FROM trees WHERE EXISTS (SELECT 1 FROM boxes WHERE lng - 0.05 <= x1 AND lng + 0.05 >= x0 AND lat - 0.05 <= y1 AND lat + 0.05 >= y0)""")
def mask_intersects(r: Roles) -> DataFrame:
    """Squares around the trees that meet any district; the districts overlap."""
    x, y, k = F.col("geometry.x"), F.col("geometry.y"), F.col("r_regionkey")
    squares = r.trees.select("id", geo.box_ring(x - 0.05, y - 0.05, x + 0.05, y + 0.05).alias("geometry"))
    mask = r.region.select(geo.box_ring(k * 0.9 + 0.25, k * 0.8 + 0.1, k * 0.9 + 0.65, k * 0.8 + 1.3).alias("geometry"))
    return S.restrict_to_mask(squares, mask, "id").select("id")


_CORNERS = """corners AS (SELECT p_partkey // 50 AS x, p_partkey % 50 AS y, 13 + (p_partkey // 50) * 0.01 + (p_partkey % 50) * 0.001 AS lon,
 52 + (p_partkey % 50) * 0.006 AS lat FROM part)"""


def corners(r: Roles) -> DataFrame:
    x, y = F.floor(F.col("p_partkey") / 50).cast("int"), F.pmod("p_partkey", F.lit(50)).cast("int")
    return r.part.select(x.alias("x"), y.alias("y"), (13 + x * F.lit(0.01) + y * F.lit(0.001)).alias("lon"),
                         (52 + y * F.lit(0.006)).alias("lat"))


def _ring_sql() -> str:
    return ", ".join(f"round({t}.{c} + 1e-9, 4) AS {c}{i}" for i, t in enumerate("abcd") for c in ("lon", "lat"))


@query("lattice_cells", "WITH " + _CORNERS + f"""
SELECT CAST(a.x * 49 + a.y AS BIGINT) AS id, CAST(a.x AS INTEGER) AS x, CAST(a.y AS INTEGER) AS y, {_ring_sql()}, 5 AS vertices
FROM corners a JOIN corners b ON b.x = a.x AND b.y = a.y + 1 JOIN corners c ON c.x = a.x + 1 AND c.y = a.y + 1
JOIN corners d ON d.x = a.x + 1 AND d.y = a.y""")
def lattice_cells(r: Roles) -> DataFrame:
    cells = S.lattice_to_cells(corners(r), (0, None), (0, 50))
    points = {f"{c}{i}": F.col("geometry")[i]["x" if c == "lon" else "y"] for i in range(4) for c in ("lon", "lat")}
    df = cells.select("id", "x", "y", *[v.alias(k) for k, v in points.items()], F.size("geometry").alias("vertices"))
    return rounded(df, *points)


@query("register_tiles", "WITH " + _CORNERS + """
SELECT CAST(a.x * 49 + a.y AS BIGINT) AS id FROM corners a JOIN corners c ON c.x = a.x + 1 AND c.y = a.y + 1
WHERE a.x * 49 + a.y NOT IN (SELECT s_suppkey FROM supplier)""")
def register_tiles(r: Roles) -> DataFrame:
    cells = S.lattice_to_cells(corners(r), (0, None), (0, 50))
    return S.register_tiles(cells, r.supplier.select(F.col("s_suppkey").alias("id"))).select("id")


@query("rain_by_tile", """
SELECT l_partkey AS tile_id, CAST(l_shipdate AS DATE) AS date,
 round(avg(l_quantity) + 1e-9, 4) AS rainfall_mm, max(l_quantity) AS rainfall_max_mm FROM lineitem GROUP BY 1, 2""")
def rain_by_tile(r: Roles) -> DataFrame:
    """Hourly cells to daily tiles; a window of 51 corners has 50 cells across."""
    from canopy.operators.aggregates import daily_rain
    cells = r.lineitem.select(F.floor(F.col("l_partkey") / 50).cast("int").alias("x"),
                              F.pmod("l_partkey", F.lit(50)).cast("int").alias("y"), F.col("l_shipdate").alias("ts"),
                              F.col("l_quantity").alias("rainfall_mm"))
    return rounded(daily_rain(S.rain_tiles(cells, (0, None), (0, 51))), "rainfall_mm")


SEASONS = ["spring", "summer", "fall", "winter"]
_SHARES = {"spring": 1.0, "summer": 2.0, "fall": 3.0, "winter": 4.0}


def season_maps(r: Roles) -> tuple[DataFrame, DataFrame]:
    """Four maps over the part raster, each with its own factor, and their placement (0.1307 per cell)."""
    maps = F.explode(F.array(*[F.struct(F.lit(s).alias("season"), F.lit(f).alias("f")) for s, f in _SHARES.items()]))
    cells = r.raster.withColumn("_m", maps).select(F.col("_m.season").alias("raster_id"), "row", "col",
                                                   (F.col("value") * F.col("_m.f") / 1e3).alias("value"))
    place = cells.groupBy("raster_id").agg(
        F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(0.1307).alias("dx"), F.lit(0.1307).alias("dy"),
        (F.max("row") + 1).alias("n_rows"), (F.max("col") + 1).alias("n_cols"))
    return cells, place


_SAMPLES_SQL = with_roles("trees", "raster", s="SELECT unnest(['spring', 'summer', 'fall', 'winter']) AS season, unnest([1.0, 2.0, 3.0, 4.0]) AS f",
                          n='SELECT max("row") AS r, max(col) AS c FROM raster', samples="""
SELECT t.id AS tree_id, s.season AS raster_id, m.value * s.f / 1e3 AS value FROM trees t, s, n LEFT JOIN raster m
 ON m."row" = least(CAST(round(t.lat / 0.1307) AS INTEGER), n.r) AND m.col = least(CAST(round(t.lng / 0.1307) AS INTEGER), n.c)""")


@query("nearest_cell", _SAMPLES_SQL + "SELECT tree_id, raster_id, round(value + 1e-9, 4) AS value FROM samples")
def nearest_cell(r: Roles) -> DataFrame:
    cells, place = season_maps(r)
    df = S.sample_nearest(r.trees.select(F.col("id").alias("tree_id"), "lng", "lat"), cells, place, ["tree_id"],
                          F.col("lng"), F.col("lat"))
    return rounded(df, "value")


@query("tiled_cells", with_roles("trees", "raster") + """
SELECT t.id AS tree_id, round(m.value + 1e-9, 4) AS value FROM trees t JOIN raster m
 ON m."row" = CAST(round(t.lat / 0.1307) AS INTEGER) AND m.col = CAST(round(t.lng / 0.1307) AS INTEGER)""")
def tiled_cells(r: Roles) -> DataFrame:
    """The map in tiles of 8 x 8 cells, more of them the larger it is; a tree looks into the one it lies in."""
    def tile(axis: str) -> Column:
        return F.floor(F.col(axis) / 8).cast("int")

    cells = r.raster.select(F.concat_ws("/", tile("row"), tile("col")).alias("raster_id"), tile("row").alias("tr"), tile("col").alias("tc"),
                            (F.col("row") % 8).alias("row"), (F.col("col") % 8).alias("col"), "value")
    place = cells.groupBy("raster_id").agg(
        (F.first("tc") * 8 * 0.1307).alias("x0"), (F.first("tr") * 8 * 0.1307).alias("y0"), F.lit(0.1307).alias("dx"), F.lit(0.1307).alias("dy"),
        (F.max("row") + 1).alias("n_rows"), (F.max("col") + 1).alias("n_cols"))
    trees = r.trees.select(F.col("id").alias("tree_id"), "lng", "lat")
    found = S.sample_tiles(trees, cells, place, ["tree_id"], F.col("lng"), F.col("lat")).where("value is not null")
    return rounded(found.select("tree_id", "value"), "value")


# The share is rounded exactly: on a half of the scaled value, the error of the scaling decides.
_SHARE = "(value * 3600 / {1})"
_SCALED, _HIGH = _SHARE + " * 100", "(" + _SHARE + " * 134217729.0::DOUBLE - (" + _SHARE + " * 134217729.0::DOUBLE - " + _SHARE + "))"
_OFF = "((" + _HIGH + " * 100 - " + _SCALED + ") + (" + _SHARE + " - " + _HIGH + ") * 100)"
_EXACT = ("CASE WHEN abs(" + _SCALED + " - floor(" + _SCALED + ")) = 0.5 AND " + _OFF + " <> 0 THEN CASE WHEN " + _OFF + " > 0 THEN ceil("
          + _SCALED + ") ELSE floor(" + _SCALED + ") END ELSE round_even(" + _SCALED + ", 0) END / 100")
_INDEX = "max(CASE WHEN raster_id = '{0}' THEN round_even(1 - (" + _EXACT + "), 2) END) AS {0}"
_DAYLIGHT = {"spring": 43300.0, "summer": 60100.0, "fall": 43900.0, "winter": 27500.0}


@query("shading_index", _SAMPLES_SQL + "SELECT tree_id, " + ", ".join(_INDEX.format(s, d) for s, d in _DAYLIGHT.items())
       + " FROM samples GROUP BY 1")
def shading_index(r: Roles) -> DataFrame:
    cells, place = season_maps(r)
    samples = S.sample_nearest(r.trees.select(F.col("id").alias("tree_id"), "lng", "lat"), cells, place, ["tree_id"],
                               F.col("lng"), F.col("lat"))
    daylight = r.spark.createDataFrame(list(_DAYLIGHT.items()), "season string, daylight_s double")
    return S.shading_index(samples, daylight, SEASONS)


@query("mosaic", """
WITH c AS (SELECT p_size % 4 AS k, p_partkey // 50 AS r, p_partkey % 50 AS c, p_retailprice AS value FROM part),
g AS (SELECT CAST(r + 10 * k AS INTEGER) AS "row", CAST(c + 5 * k AS INTEGER) AS col, k, value FROM c)
SELECT DISTINCT ON ("row", col) 'mosaic' AS raster_id, "row", col, value FROM g ORDER BY "row", col, k""")
def mosaic(r: Roles) -> DataFrame:
    """Four overlapping tiles of one map, north up: rows run downwards from the upper edge."""
    k = F.pmod("p_size", F.lit(4))
    cells = r.part.select(k.alias("raster_id"), F.floor(F.col("p_partkey") / 50).cast("int").alias("row"),
                          F.pmod("p_partkey", F.lit(50)).cast("int").alias("col"), F.col("p_retailprice").alias("value"))
    place = cells.select("raster_id").distinct().select(
        "raster_id", (100.0 + F.col("raster_id") * 10.0).alias("x0"), (900.0 - F.col("raster_id") * 20.0).alias("y0"),
        F.lit(2.0).alias("dx"), F.lit(-2.0).alias("dy"))
    return RA.mosaic(cells, place)


def _with_holes(weights: str, source: str) -> str:
    """Brute force over all offsets, mirrored by coordinate; cells that are missing leave their weight to the others."""
    def mirror(v: str, lo: str, hi: str) -> str:
        # A triangle wave between the ends.
        return f"{lo} + {hi} - {lo} - abs({hi} - {lo} - ({v} - {lo} + 1000 * 2 * greatest({hi} - {lo}, 1)) % (2 * greatest({hi} - {lo}, 1)))"

    return source + f"""
, e AS (SELECT raster_id, min("row") AS r0, max("row") AS r1, min(col) AS c0, max(col) AS c1 FROM m GROUP BY 1),
w AS (SELECT * FROM (VALUES {weights}) AS v(d, f))
SELECT m.raster_id, m."row", m.col, round(sum(s.value * a.f * b.f) / sum(a.f * b.f) + 1e-9, 4) AS value
FROM m JOIN e USING (raster_id), w a, w b JOIN m s ON s.raster_id = m.raster_id
 AND s."row" = {mirror('m."row" + a.d', 'e.r0', 'e.r1')} AND s.col = {mirror('m.col + b.d', 'e.c0', 'e.c1')}
GROUP BY 1, 2, 3"""


@query("mosaic_box", _with_holes("(-2, 0.2), (-1, 0.2), (0, 0.2), (1, 0.2), (2, 0.2)", """
WITH c AS (SELECT p_size % 4 AS k, p_partkey // 50 AS r, p_partkey % 50 AS c, p_retailprice AS value FROM part),
g AS (SELECT CAST(r + 10 * k AS INTEGER) AS "row", CAST(c + 5 * k AS INTEGER) AS col, k, value FROM c),
m AS (SELECT DISTINCT ON ("row", col) 'mosaic' AS raster_id, "row", col, value FROM g ORDER BY "row", col, k)"""))
def mosaic_box(r: Roles) -> DataFrame:
    """The mosaic, which has gaps, smoothed."""
    return rounded(RA.box_filter(mosaic(r), 5), "value")


@query("gaussian_holes", _with_holes("(-2, 0.0625), (-1, 0.25), (0, 0.375), (1, 0.25), (2, 0.0625)", """
WITH m AS (SELECT 'r' || CAST(p_partkey // 1000 AS VARCHAR) AS raster_id, CAST(p_partkey // 50 % 20 AS INTEGER) AS "row",
 CAST(p_partkey % 50 AS INTEGER) AS col, p_retailprice AS value FROM part WHERE p_size % 7 > 1)"""))
def gaussian_holes(r: Roles) -> DataFrame:
    """Maps with scattered holes and the small kernel."""
    cells = r.part.where("p_size % 7 > 1").select(
        F.concat(F.lit("r"), F.floor(F.col("p_partkey") / 1000).cast("string")).alias("raster_id"),
        F.pmod(F.floor(F.col("p_partkey") / 50), F.lit(20)).cast("int").alias("row"),
        F.pmod("p_partkey", F.lit(50)).cast("int").alias("col"), F.col("p_retailprice").alias("value"))
    return rounded(RA.gaussian_filter(cells, 5), "value")


@query("mixed_sizes", with_roles("trees").rstrip() + """,
shapes AS (SELECT n_nationkey AS id, n_nationkey % 5 AS x0, n_nationkey // 5 AS y0, n_nationkey % 5 + 1 AS x1, n_nationkey // 5 + 1 AS y1 FROM nation
 UNION ALL SELECT 1000 + r_regionkey, -400 * (r_regionkey + 1), -300, 2.5 + r_regionkey * 0.5, 4.25 FROM region
 UNION ALL SELECT 2000 + s_suppkey, s_suppkey % 97 / 20.0, s_suppkey % 89 / 20.0, s_suppkey % 97 / 20.0 + 0.03, s_suppkey % 89 / 20.0 + 0.03 FROM supplier)
SELECT t.id AS tree_id, CAST(s.id AS BIGINT) AS tile_id FROM trees t JOIN shapes s ON t.lng > s.x0 AND t.lng < s.x1 AND t.lat > s.y0 AND t.lat < s.y1""")
def mixed_sizes(r: Roles) -> DataFrame:
    """Unit tiles, tiny squares and shapes hundreds of units wide in one join."""
    k, s = F.col("r_regionkey"), F.col("s_suppkey")
    wide = r.region.select((k + 1000).cast("bigint").alias("id"), geo.box_ring((k + 1) * -400, F.lit(-300), k * 0.5 + 2.5, F.lit(4.25)).alias("geometry"))
    x, y = s % 97 / 20.0, s % 89 / 20.0
    tiny = r.supplier.select((s + 2000).cast("bigint").alias("id"), geo.box_ring(x, y, x + 0.03, y + 0.03).alias("geometry"))
    return S.join_contains(r.trees.select("id", "geometry"), r.tiles.unionByName(wide).unionByName(tiny).withColumnRenamed("id", "tile_id"),
                           "id", "tile_id").withColumnRenamed("id", "tree_id")


def _filter_sql(weights: list[float]) -> str:
    k = len(weights) // 2
    w = ", ".join(f"({i - k}, {x!r})" for i, x in enumerate(weights))
    return with_roles("rasters", e='SELECT raster_id, max("row") AS r, max(col) AS c FROM rasters GROUP BY 1',
                      w=f"SELECT * FROM (VALUES {w}) AS v(d, f)") + """
SELECT m.raster_id, m."row", m.col, round(sum(s.value * a.f * b.f) + 1e-9, 4) AS value FROM rasters m JOIN e USING (raster_id), w a, w b
JOIN rasters s ON s.raster_id = m.raster_id
 AND s."row" = CASE WHEN m."row" + a.d < 0 THEN -(m."row" + a.d) WHEN m."row" + a.d > e.r THEN 2 * e.r - m."row" - a.d ELSE m."row" + a.d END
 AND s.col = CASE WHEN m.col + b.d < 0 THEN -(m.col + b.d) WHEN m.col + b.d > e.c THEN 2 * e.c - m.col - b.d ELSE m.col + b.d END
GROUP BY 1, 2, 3"""


@query("box_filter", _filter_sql([0.2] * 5))
def box_filter(r: Roles) -> DataFrame:
    return rounded(RA.box_filter(r.rasters, 5), "value")


# exp(-d * d / (2 * 1.3 * 1.3)) over its sum, for d = -2..2.
_GAUSS = [0.09877498815325955, 0.23994707564005802, 0.3225558724133649, 0.23994707564005802, 0.09877498815325955]


@query("gaussian_filter", _filter_sql(_GAUSS))
def gaussian_filter(r: Roles) -> DataFrame:
    return rounded(RA.gaussian_filter(r.rasters, 5, 1.3), "value")


@query("reproject", with_roles("trees") + "SELECT id, round(13 + lng / 10 + 1e-9, 4) AS lon, round(52 + lat / 10 + 1e-9, 4) AS lat, true AS in_zone FROM trees")
def reproject(r: Roles) -> DataFrame:
    """To the metric grid and back again; every point lies in the zone."""
    grid = r.trees.select("id", geo.to_utm33(13 + F.col("lng") / 10, 52 + F.col("lat") / 10).alias("g"))
    back = grid.withColumn("b", geo.to_wgs84("g.x", "g.y"))
    in_zone = F.col("g.x").between(300_000, 700_000) & F.col("g.y").between(5_700_000, 5_900_000)
    return rounded(back.select("id", F.col("b.x").alias("lon"), F.col("b.y").alias("lat"), in_zone.alias("in_zone")), "lon", "lat")
