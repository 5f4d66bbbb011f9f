import math

import random
import re

import pytest
from pyspark.sql import functions as F

from canopy.functions import geo
from canopy.operators import raster as RA, spatial as S
from canopy.plans.catalog import QUERIES

RING = [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4), (0, 0)]     # concave
GEOM = "array<struct<x:double,y:double>>"


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def points(spark, pts):
    return spark.createDataFrame([(i, {"x": float(x), "y": float(y)}) for i, (x, y) in enumerate(pts)],
                                 "pid int, geometry struct<x:double,y:double>")


def test_strictly_inside_a_concave_ring(spark, rows):
    shapes = spark.createDataFrame([(1, ring(RING))], f"sid int, geometry {GEOM}")
    pts = points(spark, [(1, 1), (2, 2), (0, 1), (4, 4), (3, 2), (9, 9), (2, 0), (2, 0.5)])
    for most, few in ((1, 64), (2, 0), (9, 64)):
        got = rows(S.join_contains(pts, shapes, "pid", "sid", task_points=most, few_edges=few), "pid")
        assert got == [(0,), (4,), (7,)]


def test_each_point_lies_in_at_most_one_cell(spark):
    cells = S.lattice_to_cells(lattice(spark, 6, 5), (0, 6), (0, 5))
    pts = points(spark, [(i * 0.37 + 0.01, j * 0.41 + 0.01) for i in range(20) for j in range(20)])
    hits = S.join_contains(pts, cells, "pid", "id").groupBy("pid").count()
    assert hits.where("count > 1").count() == 0 and hits.count() > 50


def lattice(spark, nx, ny):
    return spark.createDataFrame([(x, y, float(x), float(y)) for x in range(nx) for y in range(ny)],
                                 "x int, y int, lon double, lat double")


def test_holes_and_parts(spark, rows):
    multi = [[ring([(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)]), ring([(3, 3), (6, 3), (6, 6), (3, 6), (3, 3)])],
             [ring([(20, 20), (22, 20), (22, 22), (20, 22), (20, 20)])]]
    shapes = spark.createDataFrame([(1, multi)], f"sid int, geometry array<array<{GEOM}>>")
    pts = points(spark, [(1, 1), (4, 4), (21, 21), (3, 4), (30, 30)])
    assert rows(S.join_contains(pts, shapes, "pid", "sid", kind="multi"), "pid") == [(0,), (2,)]


def test_mask(spark, rows):
    def box(x, y, w):
        return ring([(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)])
    shapes = spark.createDataFrame([("inside", box(2, 2, 1)), ("around", box(-5, -5, 30)), ("touching", box(10, 0, 2)),
                                    ("apart", box(40, 40, 1)), ("crossing", box(-1, 4, 2))], f"id string, geometry {GEOM}")
    mask = spark.createDataFrame([(box(0, 0, 10),), (box(1, 1, 3),)], f"geometry {GEOM}")
    assert rows(S.restrict_to_mask(shapes, mask, "id"), "id") == [("around",), ("crossing",), ("inside",), ("touching",)]


def test_tile_ids_and_rings_of_the_default_window(spark):
    corners = spark.createDataFrame([(x, y, float(x), float(y)) for x in (600, 601, 602) for y in (700, 701, 702)],
                                    "x int, y int, lon double, lat double")
    cells = {r.id: r for r in S.lattice_to_cells(corners).collect()}
    assert sorted(cells) == [0, 1, 99, 100]
    assert [(p.x, p.y) for p in cells[100].geometry] == [(601, 701), (601, 702), (602, 702), (602, 701), (601, 701)]


@pytest.mark.parametrize("lon, lat, east, north", [
    (15.0, 52.0, 500000.0, 5761038.2), (13.3777, 52.5163, 389917.8, 5819699.6)])
def test_utm_against_known_places(spark, lon, lat, east, north):
    """On the central meridian the northing is the meridian arc times 0.9996."""
    r = spark.range(1).select(geo.to_utm33(F.lit(lon), F.lit(lat)).alias("g")).select("g.*").first()
    assert r.x == pytest.approx(east, abs=150) and r.y == pytest.approx(north, abs=150)


def test_meridian_arc(spark):
    """Independent check: integrate the meridian radius of curvature."""
    e2 = geo.FLATTENING * (2 - geo.FLATTENING)
    n, lat = 20000, math.radians(52.5)
    arc = sum(geo.SEMI_MAJOR * (1 - e2) / (1 - e2 * math.sin((i + 0.5) * lat / n) ** 2) ** 1.5 for i in range(n)) * lat / n
    r = spark.range(1).select(geo.to_utm33(F.lit(15.0), F.lit(52.5)).alias("g")).select("g.*").first()
    assert r.y == pytest.approx(arc * 0.9996, abs=1e-3) and r.x == pytest.approx(500000, abs=1e-6)


def test_projection_round_trip(spark):
    df = spark.range(200).select((10.0 + F.col("id") * 0.05).alias("lon"), (47.0 + F.col("id") * 0.04).alias("lat"))
    back = df.withColumn("g", geo.to_utm33("lon", "lat")).withColumn("b", geo.to_wgs84("g.x", "g.y"))
    worst = back.agg(F.max(F.abs(F.col("b.x") - F.col("lon"))).alias("x"), F.max(F.abs(F.col("b.y") - F.col("lat"))).alias("y")).first()
    assert worst.x < 1e-9 and worst.y < 1e-9


def raster(spark, rows_, cols):
    return spark.createDataFrame([("m", r, c, float(r * r + 3 * c)) for r in range(rows_) for c in range(cols)],
                                 "raster_id string, row int, col int, value double")


def plain_filter(rows_, cols, weights):
    k = len(weights) // 2

    def mirror(i, n):
        return -i if i < 0 else 2 * (n - 1) - i if i >= n else i
    return {(r, c): sum(weights[a + k] * weights[b + k] * (mirror(r + a, rows_) ** 2 + 3 * mirror(c + b, cols))
                        for a in range(-k, k + 1) for b in range(-k, k + 1)) for r in range(rows_) for c in range(cols)}


@pytest.mark.parametrize("k", [3, 5])
def test_filters_mirror_at_the_border(spark, k):
    for out, weights in ((RA.box_filter(raster(spark, 6, 7), k), [1 / k] * k),
                         (RA.gaussian_filter(raster(spark, 6, 7), k), RA.gaussian_weights(k))):
        want = plain_filter(6, 7, weights)
        got = {(r.row, r.col): r.value for r in out.collect()}
        assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want)


def test_gaussian_weights_sum_to_one():
    assert sum(RA.gaussian_weights(9)) == pytest.approx(1) and sum(RA.gaussian_weights(5, 2.0)) == pytest.approx(1)


def test_mosaic_first_tile_wins(spark, rows):
    cells = spark.createDataFrame([(1, 0, 0, 1.0), (1, 0, 1, 2.0), (2, 0, 0, 9.0), (2, 0, 1, 8.0)], "raster_id int, row int, col int, value double")
    place = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, 1.0, 0.0, 1.0, 1.0)], "raster_id int, x0 double, y0 double, dx double, dy double")
    assert rows(RA.mosaic(cells, place), "row", "col", "value") == [(0, 0, 1.0), (0, 1, 2.0), (0, 2, 8.0)]


def test_shading_index(spark):
    cells = spark.createDataFrame([(s, 0, c, 4.0 + c) for s in ("spring", "winter") for c in (0, 1)], "raster_id string, row int, col int, value double")
    place = spark.createDataFrame([("spring", 0.0, 0.0, 1.0, -1.0, 1, 2), ("winter", 0.0, 0.0, 1.0, -1.0, 1, 2)],
                                  "raster_id string, x0 double, y0 double, dx double, dy double, n_rows int, n_cols int")
    trees = spark.createDataFrame([("a", 0.2, 0.0), ("far", 50.0, 9.0)], "tree_id string, x double, y double")
    daylight = spark.createDataFrame([("spring", 43200.0), ("winter", 28800.0)], "season string, daylight_s double")
    out = {r.tree_id: r for r in S.shading_index(S.sample_nearest(trees, cells, place, ["tree_id"], F.col("x"), F.col("y")),
                                                 daylight, ["spring", "summer", "fall", "winter"]).collect()}
    assert (out["a"].spring, out["a"].winter, out["a"].summer) == (0.67, 0.5, None)
    assert out["far"].spring == 0.58      # the nearest cell of a point beyond the map is at its edge


def test_spatial_join_is_an_equi_join(spark):
    shapes = spark.createDataFrame([(1, ring(RING))], f"sid int, geometry {GEOM}")
    plan = S.join_contains(points(spark, [(1, 1)]), shapes, "pid", "sid")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_one_large_shape_among_small_ones_has_few_bins(spark, rows):
    def box(x, y, w):
        return ring([(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)])
    small = [(i, box(i % 40, i // 40, 1)) for i in range(800)] + [(1000, box(-200, -200, 400)), (1001, box(5, 5, 0))]
    shapes = spark.createDataFrame(small, f"sid int, geometry {GEOM}")
    boxed = S._boxed(shapes, "geometry", "ring")
    assert S._binned(boxed, F.array("_own")).groupBy("sid").count().agg(F.max("count")).first()[0] <= 4
    pts = points(spark, [(0.5, 0.5), (39.5, 19.5), (100, 100), (300, 0)])
    assert rows(S.join_contains(pts, shapes, "pid", "sid"), "pid", "sid") == [(0, 0), (0, 1000), (1, 799), (1, 1000), (2, 1000)]
    mask = spark.createDataFrame([(box(-0.5, -0.5, 0.9),), (box(150, 150, 1000),)], f"geometry {GEOM}")
    assert rows(S.restrict_to_mask(shapes, mask, "sid"), "sid") == [(0,), (1000,)]


def plain_with_holes(cells, weights):
    k = len(weights) // 2
    ends = [(min(x[i] for x in cells), max(x[i] for x in cells)) for i in (0, 1)]

    def mirror(i, lo, hi):
        while not lo <= i <= hi:
            i = 2 * lo - i if i < lo else 2 * hi - i
            if lo == hi:
                i = lo
        return i
    out = {}
    for r, c in cells:
        w, v = 0.0, 0.0
        for a in range(-k, k + 1):
            for b in range(-k, k + 1):
                at = mirror(r + a, *ends[0]), mirror(c + b, *ends[1])
                if at in cells:
                    w += weights[a + k] * weights[b + k]
                    v += weights[a + k] * weights[b + k] * cells[at]
        out[r, c] = v / w
    return out


@pytest.mark.parametrize("shape, gone", [((6, 7), {(2, 3)}), ((6, 7), {(0, 0), (5, 6), (2, 3), (2, 4)}), ((2, 2), set()), ((1, 4), set()), ((1, 1), set())])
@pytest.mark.parametrize("k", [3, 5])
def test_filters_with_holes_and_on_narrow_maps(spark, shape, gone, k):
    cells = {(r + 10, c - 3): float(r * r + 3 * c) for r in range(shape[0]) for c in range(shape[1]) if (r, c) not in gone}
    df = spark.createDataFrame([("m", r, c, v) for (r, c), v in cells.items()] + [("m", 10, -3, None)] * ((0, 0) in gone),
                               "raster_id string, row int, col int, value double")
    for out, weights in ((RA.box_filter(df, k), [1 / k] * k), (RA.gaussian_filter(df, k), RA.gaussian_weights(k))):
        got = {(r.row, r.col): r.value for r in out.collect()}
        want = plain_with_holes(cells, weights)
        assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want)


def even_odd(rings, x, y):
    inside = False
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:]):
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x:
                inside = not inside
    return inside


def test_clipped_shapes_hold_the_same_points(spark, rows):
    """Stars, combs and boxes along grid lines, with holes; points on vertices, edges and grid lines among them."""
    rng = random.Random(11)

    def star(n, cx, cy, size):
        pts = [(cx + size * rng.uniform(0.2, 1) * math.cos(2 * math.pi * i / n), cy + size * rng.uniform(0.2, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]
        return [*pts, pts[0]]

    def comb(n):
        pts = [(float(i // 2), 8.0 if i % 4 in (1, 2) else 0.0) for i in range(2 * n)] + [(float(n), -4.0), (0.0, -4.0)]
        return [*pts, pts[0]]

    grid = [(0.0, 0.0), *[(float(i), 0.0) for i in range(1, 17)], *[(16.0, float(i)) for i in range(1, 17)],
            *[(16.0 - i, 16.0) for i in range(1, 17)], *[(0.0, 16.0 - i) for i in range(1, 17)]]
    hole = [(4.0, 4.0), (4.0, 8.0), (8.0, 8.0), (8.0, 4.0), (4.0, 4.0)]
    shapes = {1: [star(700, 3.3, -1.7, 40)], 2: [comb(60)], 3: [grid, hole], 4: [star(90, 0, 0, 0.01)], 5: [star(1500, 1e5, 1e5, 3e4)]}
    pts = [(rng.uniform(-20, 40), rng.uniform(-20, 40)) for _ in range(500)] + [(rng.uniform(7e4, 1.3e5), rng.uniform(7e4, 1.3e5)) for _ in range(100)]
    pts += [(float(rng.randrange(-2, 20)), float(rng.randrange(-6, 18))) for _ in range(400)] + [(rng.randrange(0, 40) / 2, rng.randrange(-8, 34) / 2) for _ in range(300)]
    pts += [p for rings in shapes.values() for r in rings for p in r[::7]] + [(rng.uniform(-0.01, 0.01), rng.uniform(-0.01, 0.01)) for _ in range(100)]
    df = spark.createDataFrame([(i, [ring(r) for r in rings]) for i, rings in shapes.items()], f"sid int, geometry array<{GEOM}>")
    want = sorted((i, s) for i, (x, y) in enumerate(pts) for s, rings in shapes.items() if even_odd(rings, x, y))
    for few in (10, 1000):
        got = S.join_contains(points(spark, pts), df, "pid", "sid", kind="polygon", task_points=200, few_edges=few)
        assert rows(got, "pid", "sid") == want


def test_a_full_bin_is_dealt_to_as_many_tasks_as_it_fills(spark):
    p = spark.range(1000).selectExpr("id", "0 as _level", "if(id % 3 = 0, 7, id % 100) as _bx", "cast(0 as bigint) as _by")
    hot = S._hot(p, 50)
    assert hot == [(0, 7, 0, 7)]
    parts = S._dealt(p, hot, lambda n: F.pmod(F.xxhash64("id"), n)).groupBy("_bx", "_salt").count().where("_bx = 7").collect()
    assert len(parts) == 7 and max(r["count"] for r in parts) < 75


@pytest.mark.parametrize("side", [3, 4, 8])
def test_blocks_lend_their_borders(spark, side):
    rng = random.Random(side)
    cells = {(r - 5, c + 2): rng.random() for r in range(17) for c in range(13) if rng.random() > 0.2}
    df = spark.createDataFrame([(m, r, c, v) for m in ("m", "n") for (r, c), v in cells.items()], "raster_id string, row int, col int, value double")
    want = plain_with_holes(cells, RA.gaussian_weights(7))
    got = {(r.raster_id, r.row, r.col): r.value for r in RA.gaussian_filter(df, 7, side=side).collect()}
    assert got.keys() == {(m, *at) for m in ("m", "n") for at in want}
    assert all(got[m, *at] == pytest.approx(want[at]) for m in ("m", "n") for at in want)


def test_tiles_of_a_map(spark, rows):
    """Overlapping tiles north up, one of another map; a point on a shared edge, one outside."""
    place = spark.createDataFrame([("a", "s", 0.0, 9.0, 1.0, -1.0, 2, 2), ("b", "s", 1.0, 9.0, 1.0, -1.0, 2, 3), ("z", "w", 0.0, 0.0, 50.0, 50.0, 1, 1)],
                                  "raster_id string, season string, x0 double, y0 double, dx double, dy double, n_rows int, n_cols int")
    cells = spark.createDataFrame([("a", r, c, 10.0 * r + c) for r in (0, 1) for c in (0,)] + [("a", 0, 1, None)] +
                                  [("b", r, c, 100.0 + 10 * r + c) for r in (0, 1) for c in (0, 1, 2)] + [("z", 0, 0, 7.0)],
                                  "raster_id string, row int, col int, value double")
    points = spark.createDataFrame([(1, 0.2, 9.3), (2, 1.0, 8.9), (3, 0.5, 8.0), (4, 3.6, 9.0), (5, 3.4, 7.6)], "id int, x double, y double")
    out = S.sample_tiles(points, cells, place, ["id"], F.col("x"), F.col("y"), "season")
    assert rows(out.where("map = 's'"), "id", "value") == [(1, 0.0), (2, 100.0), (3, 10.0), (5, 112.0)]
    assert rows(out.where("map = 'w'"), "id", "value") == [(i, 7.0) for i in (1, 2, 3, 4, 5)]


def test_round_exact_is_the_scalar_rounding(spark):

    from canopy.functions.scalars import round_exact
    rng = random.Random(1)
    values = [0.165, 0.145, 2.675, 1.005, 0.125, 0.375, -0.165, -0.125, 1e-9, 0.0] + [rng.randint(0, 4000) / 1000 for _ in range(2000)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_exact("v").alias("r")).collect()
    assert [r.r for r in got] == [round(r.v, 2) for r in got]


@pytest.mark.parametrize("name", ["nearest_cell", "shading_index", "tiled_cells"])
def test_no_task_holds_all_cells_of_the_maps(spark, name):
    """The cells are merged with the points; their rows unfold late, so a broadcast would be chosen by too small a size."""
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[raster_id#\d+, row", plan) and not re.search(r"BroadcastHashJoin \[raster_id#\d+, row", plan)


def test_the_test_of_a_point_works_nothing_out_again_for_every_edge(spark):
    plan = QUERIES["skyline_join"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    tests = [line for line in plan.splitlines() if re.search(r"Join \[_level#", line) and "lambda" in line]
    assert tests and not any("POWER" in line.upper() or "FLOOR" in line.upper() for line in tests)
