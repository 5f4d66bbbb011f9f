"""Spatial joins as equi joins on grid bins, the rain lattice, and point sampling of raster maps."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from canopy.constants import LATTICE_X, LATTICE_Y
from canopy.functions import geo
from canopy.functions.scalars import round_exact, round_half_even
from canopy.operators import clipping
from canopy.operators.relational import only_new, union_all
from canopy.session import cut_lineage

_EDGES = {"ring": geo.edges, "polygon": geo.polygon_edges, "multi": geo.multi_edges}
FEW_EDGES = 64
TASK_POINTS = 1 << 20     # points of a bin for one task
SMALLEST = 2.0 ** -40     # side of a shape without extent


def _boxed(shapes: DataFrame, geometry: str, kind: str) -> DataFrame:
    """Edges, bounding box and grid level: the cells of a level are at least as wide as its shapes."""
    box = F.col("_box")
    side = F.greatest(box["x1"] - box["x0"], box["y1"] - box["y0"], F.lit(SMALLEST))
    return (shapes.withColumn("_edges", _EDGES[kind](geometry)).withColumn("_box", geo.bbox("_edges"))
            .withColumn("_own", F.ceil(F.log2(side)).cast("int")))


def _levels(*shapes: DataFrame) -> Column:
    """The grid levels that occur, a few dozen at most."""
    both = union_all(*[s.select("_own") for s in shapes])
    return both.agg(F.sort_array(F.collect_set("_own"))).scalar()


def _bin(v: Column, level: Column) -> Column:
    return F.floor(v / F.pow(F.lit(2.0), level))


def _binned(boxed: DataFrame, levels: Column) -> DataFrame:
    """One row per bin that a shape's box touches, at its own level and the wider ones: four bins a level at most."""
    at = F.col("_level")
    return (boxed.withColumn("_level", F.explode(levels)).where(at >= F.col("_own"))
            .withColumn("_bx", F.explode(F.sequence(_bin(F.col("_box.x0"), at), _bin(F.col("_box.x1"), at))))
            .withColumn("_by", F.explode(F.sequence(_bin(F.col("_box.y0"), at), _bin(F.col("_box.y1"), at)))))


def _hot(rows: DataFrame, task_rows: int) -> list[tuple]:
    """(level, x, y, parts) of the bins with more than ``task_rows`` rows, and more than a thousandth of all: few."""
    counts = rows.groupBy("_level", "_bx", "_by").agg(F.count("*").alias("n"))
    all_rows = counts.agg(F.sum("n")).scalar()
    hot = counts.where(F.col("n") > F.greatest(F.lit(task_rows), F.floor(all_rows / 1000)))
    return [(h["_level"], h["_bx"], h["_by"], -(-h["n"] // task_rows)) for h in hot.collect()]


def _dealt(rows: DataFrame, hot: list[tuple], number: Callable[[Column], Column], name: str = "_salt") -> DataFrame:
    """Give the rows of hot bins a part each by ``number`` (parts to part); those of others have part 0."""
    if not hot:
        return rows.withColumn(name, number(F.lit(1)))
    bins = rows.sparkSession.createDataFrame(hot, "_level int, _bx bigint, _by bigint, _parts long")
    return (rows.join(F.broadcast(bins), ["_level", "_bx", "_by"], "left")
            .withColumn(name, number(F.coalesce("_parts", F.lit(1)))).drop("_parts"))


def join_contains(points: DataFrame, shapes: DataFrame, point_id: str, shape_id: str,
                  point: str = "geometry", geometry: str = "geometry", kind: str = "ring",
                  task_points: int = TASK_POINTS, few_edges: int = FEW_EDGES) -> DataFrame:
    """(point id, shape id) for every point strictly inside a shape.

    An equi join on the grid bin, at the level of each shape's size, so a large shape among small ones
    has four bins like any other; the exact test is part of the join condition, so only true pairs leave
    it. A shape of more than ``few_edges`` edges is cut to the cells of a finer grid, each with the edges that touch
    it (see ``clipping``). A bin of more than ``task_points`` points is dealt to several tasks, as many as its
    points fill, and its few shapes are copied to each.
    """
    x, y = F.col(f"{point}.x"), F.col(f"{point}.y")
    boxed = _boxed(shapes, geometry, kind)
    small = boxed.where(F.size("_edges") <= few_edges)
    s = (_binned(small, F.array("_own")).select(shape_id, clipping.code(F.col("_own"), F.col("_own")).alias("_level"), "_bx", "_by", F.lit(None).cast("boolean").alias("_corner"), "_edges"))
    most, levels = boxed.agg(F.max(F.size("_edges")), F.collect_set(F.when(F.size("_edges") <= few_edges, clipping.code(F.col("_own"), F.col("_own"))))).first()
    if most is not None and most > few_edges:
        cut = cut_lineage(clipping.clipped(boxed.where(F.size("_edges") > few_edges), shape_id))
        levels = sorted({*levels, *(r[0] for r in cut.select("_level").distinct().collect())})      # a few dozen at most
        s = s.union(cut)
    p = (points.select(point_id, x.alias("_x"), y.alias("_y"))
         .withColumn("_level", F.explode(F.lit(sorted(levels)).cast("array<int>")))
         .withColumns({f"_b{c}": F.floor(F.col(f"_{c}") / side) for c, side in zip("xy", clipping.sides(F.col("_level")))}))
    s = s.withColumns({f"_c{c}": F.col(f"_b{c}") * side for c, side in zip("xy", clipping.sides(F.col("_level")))})
    hot = _hot(p, task_points)
    p = _dealt(p, hot, lambda parts: F.pmod(F.xxhash64(point_id), parts))
    s = _dealt(s, hot, lambda parts: F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1)).withColumn("_salt", F.explode("_salt"))
    p, s = p.alias("p"), s.alias("s")
    same = reduce(and_, [F.col(f"p.{c}") == F.col(f"s.{c}") for c in ("_level", "_bx", "_by", "_salt")])
    inside = (F.when(F.col("_corner").isNull(), geo.contains("_edges", "_x", "_y"))
              .otherwise(clipping.inside_cell(F.col("_corner"), F.col("_edges"), F.col("_cx"), F.col("_cy"), F.col("_x"), F.col("_y"))))
    return p.join(s, same & inside).select(f"p.{point_id}", f"s.{shape_id}")


def restrict_to_mask(shapes: DataFrame, mask: DataFrame, shape_id: str, geometry: str = "geometry",
                     kind: str = "ring", mask_geometry: str = "geometry", mask_kind: str = "ring") -> DataFrame:
    """Shapes that share a point with any mask shape.

    Meeting the union of the districts is meeting one of them, so nothing is dissolved. Two shapes meet at
    the level of the larger one, where the smaller is binned as well.
    """
    left, right = _boxed(shapes, geometry, kind), _boxed(mask, mask_geometry, mask_kind)
    levels = _levels(left, right)
    a = _binned(left, levels).select(shape_id, "_edges", "_box", "_own", "_level", "_bx", "_by").alias("a")
    b = _binned(right, levels).select(
        F.col("_edges").alias("_m_edges"), F.col("_box").alias("_m_box"), F.col("_own").alias("_m_own"),
        "_level", "_bx", "_by").alias("b")
    near = ((F.col("_box.x0") <= F.col("_m_box.x1")) & (F.col("_box.x1") >= F.col("_m_box.x0"))
            & (F.col("_box.y0") <= F.col("_m_box.y1")) & (F.col("_box.y1") >= F.col("_m_box.y0")))
    same = reduce(and_, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("_level", "_bx", "_by")])
    # A pair that shares several bins is tested once: in the bin of the lower left corner both boxes share.
    at = F.col("a._level")
    once = ((at == F.greatest("_own", "_m_own"))
            & (F.col("a._bx") == _bin(F.greatest("_box.x0", "_m_box.x0"), at))
            & (F.col("a._by") == _bin(F.greatest("_box.y0", "_m_box.y0"), at)))
    hits = a.join(b, same & near & once & geo.intersects("_edges", "_m_edges"), "left_semi")
    return shapes.join(hits.select(shape_id).distinct(), shape_id, "left_semi")


# --- rain lattice -----------------------------------------------------------------------------

def tile_id(x: Column, y: Column, xs: tuple[int, int] = LATTICE_X, ys: tuple[int, int] = LATTICE_Y) -> Column:
    """Row-major ordinal of a cell inside the sub-window; stays the same under any mask."""
    return (x - xs[0]) * (ys[1] - 1 - ys[0]) + (y - ys[0])


def in_window(x: Column, y: Column, xs: tuple[int, int | None] = LATTICE_X, ys: tuple[int, int] = LATTICE_Y) -> Column:
    """Whether a cell lies in the window; an upper bound of x that is None is open."""
    in_x = x >= xs[0] if xs[1] is None else x.between(xs[0], xs[1] - 2)
    return in_x & y.between(ys[0], ys[1] - 2)


def lattice_to_cells(corners: DataFrame, xs: tuple[int, int] = LATTICE_X,
                     ys: tuple[int, int] = LATTICE_Y) -> DataFrame:
    """Closed cell rings from lattice corners ``(x, y, lon, lat)``.

    Each corner is sent to the four cells it belongs to and a cell gathers its corners: one shuffle
    instead of three self joins.
    """
    # corner number in ring order -> offset of the corner from the cell's own index
    steps = [(0, 0), (0, 1), (1, 1), (1, 0)]
    sent = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), (F.col("x") - dx).alias("x"), (F.col("y") - dy).alias("y"))
        for i, (dx, dy) in enumerate(steps)]))
    parts = corners.select(sent.alias("c"), "lon", "lat").select("c.i", "c.x", "c.y", "lon", "lat")
    at = F.col("i")
    picks = [F.max(F.when(at == i, F.col(c))).alias(f"{c}{i}") for i in range(4) for c in ("lon", "lat")]
    cells = (parts.where(in_window(F.col("x"), F.col("y"), xs, ys))
             .groupBy("x", "y").agg(F.count("*").alias("_n"), *picks)
             .where("_n = 4"))
    ring = F.array(*[geo.point(f"lon{i}", f"lat{i}") for i in (0, 1, 2, 3, 0)])
    return cells.select(tile_id(F.col("x"), F.col("y"), xs, ys).cast("long").alias("id"), "x", "y",
                        ring.alias("geometry"))


def rain_tiles(cells: DataFrame, xs: tuple[int, int] = LATTICE_X, ys: tuple[int, int] = LATTICE_Y) -> DataFrame:
    """Hourly rain per tile id from the cell table, cut to the sub-window before anything else."""
    x, y = F.col("x"), F.col("y")
    return (cells.where(in_window(x, y, xs, ys))
            .select(tile_id(x, y, xs, ys).cast("long").alias("tile_id"), "ts", "rainfall_mm"))


def register_tiles(cells: DataFrame, known: DataFrame) -> DataFrame:
    """Tiles not registered yet; when there are any, the tree-to-tile map is due."""
    return only_new(cells.select("id", "geometry"), known, ["id"])


# --- raster maps ------------------------------------------------------------------------------

def sample_nearest(points: DataFrame, cells: DataFrame, transform: DataFrame, keep: Sequence[str],
                   x: Column, y: Column) -> DataFrame:
    """Value of the nearest cell of every map at each point.

    ``transform`` has one row per map (raster_id, x0, y0, dx, dy, n_rows, n_cols); there are as many
    as seasons, so they unfold from one small array instead of a join without keys; every point has a row for
    every map, however many. Where a map comes in many tiles, ``sample_tiles`` looks into the tiles at a point.
    """
    maps = transform.agg(F.collect_list(F.struct(*transform.columns))).scalar()

    at = points.select(*keep, x.alias("_x"), y.alias("_y")).withColumn("_t", F.explode(maps)).select(*keep, *_cell_of("_t"))
    return at.join(_sorted(cells), ["raster_id", "row", "col"], "left").select(*keep, "raster_id", "value")


def _sorted(cells: DataFrame) -> DataFrame:
    """For a merge join: maps are taken to be a fraction of their size, as their rows unfold late, and a broadcast puts all cells into every task."""
    return cells.hint("merge")


def _cell_of(place: str) -> list[Column]:
    """Map, row and column of the cell nearest to (_x, _y) in a map."""
    def index(v: str, origin: str, step: str, n: str) -> Column:
        i = F.rint((F.col(v) - F.col(f"{place}.{origin}")) / F.col(f"{place}.{step}")).cast("int")
        return F.least(F.greatest(i, F.lit(0)), F.col(f"{place}.{n}") - 1)

    return [F.col(f"{place}.raster_id").alias("raster_id"), index("_y", "y0", "dy", "n_rows").alias("row"),
            index("_x", "x0", "dx", "n_cols").alias("col")]


def sample_tiles(points: DataFrame, cells: DataFrame, transform: DataFrame, keep: Sequence[str], x: Column, y: Column,
                 of: str | None = None) -> DataFrame:
    """(keep, map, value) at each point, of maps that come in any number of tiles.

    ``of`` names the column of ``transform`` that tells a tile's map; without it all tiles are one map. A point
    looks only into the tiles whose cells it lies in, half a cell around each: tiles are binned by their extent like the
    shapes of a join, at the level of their size. Where tiles overlap, the first in order of ``raster_id`` with
    a value counts; a point outside all tiles of a map has no row for it.
    """
    def reach(origin: str, step: str, n: str) -> tuple[Column, Column]:
        a, b, half = F.col(origin), F.col(origin) + F.col(step) * (F.col(n) - 1), F.abs(F.col(step)) / 2
        return F.least(a, b) - half, F.greatest(a, b) + half

    (x0, x1), (y0, y1) = reach("x0", "dx", "n_cols"), reach("y0", "dy", "n_rows")
    name = F.col(of) if of else F.lit("map")
    boxed = (transform.select(F.struct("raster_id", "x0", "y0", "dx", "dy", "n_rows", "n_cols").alias("_t"), name.alias("map"),
                              F.struct(x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1")).alias("_box"))
             .withColumn("_own", F.ceil(F.log2(F.greatest(F.col("_box.x1") - F.col("_box.x0"), F.col("_box.y1") - F.col("_box.y0"), F.lit(SMALLEST)))).cast("int")))
    at = (points.select(*keep, x.alias("_x"), y.alias("_y")).withColumn("_level", F.explode(_levels(boxed)))
          .withColumns({"_bx": _bin(F.col("_x"), F.col("_level")), "_by": _bin(F.col("_y"), F.col("_level"))}))
    tiles = _binned(boxed, F.array("_own"))
    inside = ((F.col("_x") >= F.col("_box.x0")) & (F.col("_x") < F.col("_box.x1")) & (F.col("_y") >= F.col("_box.y0")) & (F.col("_y") < F.col("_box.y1")))
    found = at.join(tiles, ["_level", "_bx", "_by"]).where(inside).select(*keep, "map", *_cell_of("_t"))
    known = cells.where(F.col("value").isNotNull()).select("raster_id", "row", "col", "value")
    return (found.join(_sorted(known), ["raster_id", "row", "col"], "left")
            .groupBy(*keep, "map").agg(F.min_by("value", F.when(F.col("value").isNotNull(), F.col("raster_id"))).alias("value")))


def shading_index(samples: DataFrame, daylight: DataFrame, seasons: Sequence[str],
                  key: str = "tree_id") -> DataFrame:
    """1 - sun hours / daylight per season, as four season columns.

    The share is rounded like a single number, the difference like an array of numbers.
    """
    sun = round_exact(F.col("value") * 3600 / F.col("daylight_s"))
    return (samples.join(daylight, samples["raster_id"] == daylight["season"])
            .select(key, "season", round_half_even(1 - sun).alias("_i"))
            .groupBy(key).pivot("season", list(seasons)).agg(F.max("_i")))
