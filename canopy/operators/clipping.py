"""Shapes with very many edges, cut to the cells of a grid: each cell holds the few edges that touch it.

A cell also knows whether its lower left corner lies inside the shape. A point of the cell is then inside if the
path from the corner, up to the point's height and across to it, meets an odd number of the cell's edges
more or less. All comparisons are signs of one product, so that a line through a corner is judged alike by both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from canopy.functions import geo
from canopy.session import share_package

CELL_EDGES = 8          # edges of a cell, about
MOST_COPIES = 16        # times an edge may be in the cells of a shape, on average
ZERO = 2048             # code of the power 0
EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


def _turn(e: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (e[:, 2] - e[:, 0]) * (y - e[:, 1]) - (e[:, 3] - e[:, 1]) * (x - e[:, 0])


def _unfolded(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and value of every number from first to last, element by element."""
    n = last - first + 1
    at = np.repeat(np.arange(len(n)), n)
    return at, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[at]


def _met(e: np.ndarray, sx: float, sy: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edge, column, row) of all cells that an edge may touch, row by row."""
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    at, row = _unfolded(np.floor(low / sy).astype(np.int64), np.floor(high / sy).astype(np.int64))
    s = e[at]
    y0, y1 = np.maximum(row * sy, low[at]), np.minimum((row + 1) * sy, high[at])
    rise = s[:, 3] - s[:, 1]
    with np.errstate(divide="ignore", invalid="ignore"):
        xs = [np.where(rise == 0, end, s[:, 0] + (y - s[:, 1]) * (s[:, 2] - s[:, 0]) / rise) for y, end in ((y0, s[:, 0]), (y1, s[:, 2]))]
    margin = sx * 1e-9
    own = np.minimum(s[:, 0], s[:, 2]), np.maximum(s[:, 0], s[:, 2])
    x0 = np.maximum(np.minimum(*xs) - margin, own[0])
    x1 = np.minimum(np.maximum(*xs) + margin, own[1])
    again, col = _unfolded(np.floor(x0 / sx).astype(np.int64), np.floor(np.maximum(x1, x0) / sx).astype(np.int64))
    return at[again], col, row[again]


def _corners(e: np.ndarray, sx: float, sy: float, c0: int, c1: int, r0: int, r1: int) -> np.ndarray:
    """Whether the lower left corner of each cell is inside: rows by columns."""
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    # Rows whose lower line the edge spans: low <= line < high.
    first, last = np.ceil(low / sy).astype(np.int64), np.ceil(high / sy).astype(np.int64) - 1
    spans = last >= first
    at, row = _unfolded(first[spans], last[spans])
    s = e[spans][at]
    y = row * sy
    up = s[:, 3] > s[:, 1]
    x = s[:, 0] + (y - s[:, 1]) * (s[:, 2] - s[:, 0]) / (s[:, 3] - s[:, 1])
    # The first corner of the row at or right of the edge; the quotient is off by a cell at most.
    col = np.floor(x / sx).astype(np.int64) + 2
    for step in (1, 0, -1):
        corner = np.floor(x / sx).astype(np.int64) + step
        turn = _turn(s, corner * sx, y)
        col = np.where((turn == 0) | ((turn > 0) != up), corner, col)
    flips = np.zeros((r1 - r0 + 1, c1 - c0 + 2), np.int64)
    np.add.at(flips, (row - r0, np.clip(col - c0, 0, c1 - c0 + 1)), 1)
    return np.cumsum(flips, 1)[:, :-1] % 2 == 1


def code(lx: int | Column, ly: int | Column) -> int | Column:
    """One number for the powers of two of a cell's sides."""
    return (lx + ZERO) * 2 * ZERO + (ly + ZERO)


def sides(level: Column) -> tuple[Column, Column]:
    two = F.lit(2.0)
    return F.pow(two, F.floor(level / (2 * ZERO)) - ZERO), F.pow(two, level % (2 * ZERO) - ZERO)


def _levels(e: np.ndarray) -> tuple[int, int]:
    """Powers of two of a cell's sides. The axis whose halving copies fewer edges is halved next, until a cell has
    few edges or the copies are too many: a skyline gets columns, a round shape squares."""
    run, rise = np.abs(e[:, 2] - e[:, 0]).sum(), np.abs(e[:, 3] - e[:, 1]).sum()
    lx, ly = (int(np.ceil(np.log2(max(np.ptp(e[:, c]), 2.0 ** -40)))) for c in ([0, 2], [1, 3]))
    cells = 1

    def copies(x: int, y: int) -> float:
        return run / 2.0 ** x + rise / 2.0 ** y + len(e)

    while copies(lx, ly) > CELL_EDGES * cells:
        x, y = (lx - 1, ly) if copies(lx - 1, ly) <= copies(lx, ly - 1) else (lx, ly - 1)
        if copies(x, y) > MOST_COPIES * len(e):
            break
        lx, ly, cells = x, y, cells * 2
    return lx, ly


def cells_of(e: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(level, column, row, corner inside, first edge and its end, order of edges) of the cells of a shape.

    Only cells that edges touch, or that lie inside.
    """
    lx, ly = _levels(e)
    sx, sy = 2.0 ** lx, 2.0 ** ly
    edge, col, row = _met(e, sx, sy)
    c0, c1, r0, r1 = col.min(), col.max(), row.min(), row.max()
    inside = _corners(e, sx, sy, c0, c1, r0, r1)
    place = (row - r0) * (c1 - c0 + 1) + (col - c0)
    order = np.argsort(place, kind="stable")
    counts = np.bincount(place, minlength=inside.size)
    kept = np.flatnonzero((counts > 0) | inside.ravel())
    ends = np.cumsum(counts)
    return (code(lx, ly), kept % (c1 - c0 + 1) + c0, kept // (c1 - c0 + 1) + r0, inside.ravel()[kept],
            np.column_stack([ends - counts, ends])[kept], edge[order])


def clipped(boxed: DataFrame, shape_id: str) -> DataFrame:
    """(shape id, _level, _bx, _by, _corner, _edges) of shapes that have their edges in ``_edges``; a row a cell."""
    share_package(boxed.sparkSession)
    schema = f"{shape_id} {boxed.schema[shape_id].dataType.simpleString()}, _level int, _bx bigint, _by bigint, _corner boolean, _edges array<{EDGE}>"
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = batch.column("_edges")[i].values
                e = np.column_stack([found.field(c).to_numpy() for c in ("x1", "y1", "x2", "y2")])
                level, col, row, inside, span, order = cells_of(e)
                for a in range(0, len(col), 4096):
                    b = min(a + 4096, len(col))
                    lo, hi = span[a, 0], span[b - 1, 1]
                    part = e[order[lo:hi]]
                    lists = pa.ListArray.from_arrays(pa.array(np.append(span[a:b, 0], hi) - lo, pa.int32()),
                                                     pa.StructArray.from_arrays([pa.array(part[:, c]) for c in range(4)], ["x1", "y1", "x2", "y2"]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(shape_id)[i].as_py()] * (b - a), out.field(0).type), pa.array(np.full(b - a, level, np.int32)),
                         pa.array(col[a:b]), pa.array(row[a:b]), pa.array(inside[a:b]), lists.cast(out.field(5).type)], schema=out)

    return boxed.select(shape_id, "_edges").mapInArrow(run, schema)


def inside_cell(corner: Column, edges: Column, xc: Column, yc: Column, x: Column, y: Column) -> Column:
    """Whether a point of a cell is strictly inside the shape, from the cell's corner and edges alone.

    The place of the corner must be a plain column: the edges' test would work out an expression again for every edge.
    """

    def flip(inside: Column, e: Column) -> Column:
        up, right = e["y2"] > e["y1"], e["x2"] > e["x1"]
        at_corner, below, here = geo.turn(e, xc, yc), geo.turn(e, xc, y), geo.turn(e, x, y)
        # Up along the cell's left side: met above the corner, and not above the point's height.
        rises = ((e["x1"] > xc) != (e["x2"] > xc)) & ((below == 0) | ((below > 0) == right)) & ~((at_corner == 0) | ((at_corner > 0) == right))
        # Across at the point's height: right of the cell's left side, and left of the point.
        across = ((e["y1"] > y) != (e["y2"] > y)) & (below != 0) & ((below > 0) == up) & ((here == 0) | ((here > 0) != up))
        return inside != (rises != across)

    return F.aggregate(edges, corner, flip) & ~F.exists(edges, lambda e: geo.on_edge(e, x, y))
