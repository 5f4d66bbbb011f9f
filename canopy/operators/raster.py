"""Raster maps as cell tables ``(raster_id, row, col, value)``: mosaic and smoothing."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from canopy.session import share_package

BLOCK_SIDE = 256        # cells along a block: a block is one row of about a megabyte

# Small smoothing kernels used when no width is given.
SMALL_KERNELS = {
    1: [1.0],
    3: [0.25, 0.5, 0.25],
    5: [0.0625, 0.25, 0.375, 0.25, 0.0625],
    7: [0.03125, 0.109375, 0.21875, 0.28125, 0.21875, 0.109375, 0.03125],
}


def mosaic(cells: DataFrame, transform: DataFrame, order: str = "raster_id", name: str = "mosaic") -> DataFrame:
    """One map called ``name`` from overlapping tiles; where tiles overlap, the first in ``order`` wins.

    All tiles share one cell size. A partial aggregate keeps one value per cell and task. Places that no tile
    covers have no cell; the filters leave them out.
    """
    x0 = transform.agg(F.min("x0")).scalar()
    y0 = transform.agg(F.when(F.min("dy") < 0, F.max("y0")).otherwise(F.min("y0"))).scalar()
    placed = cells.join(transform, "raster_id").select(
        F.rint((F.col("y0") - y0) / F.col("dy") + F.col("row")).cast("int").alias("row"),
        F.rint((F.col("x0") - x0) / F.col("dx") + F.col("col")).cast("int").alias("col"),
        F.col(order).alias("_order"), "value")
    # The name comes out of the data: as a constant it would leave later joins on it without a key.
    named = F.concat(F.lit(name), F.substring(F.min(F.col("_order").cast("string")), 1, 0))
    return (placed.groupBy("row", "col").agg(F.min_by("value", "_order").alias("value"), named.alias("raster_id"))
            .select("raster_id", "row", "col", "value"))


def _mirrored(at: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Places beyond the ends of a map, by reflection without the border itself, as often as a narrow map needs."""
    end = hi - lo
    return lo + end - np.abs(end - (at - lo) % (2 * end)) if end else np.full_like(at, lo)


def _smooth(known: np.ndarray, weights: Sequence[float], side: int) -> np.ndarray:
    """Weighted sums along the first axis."""
    return sum(w * known[d:d + side] for d, w in enumerate(weights))


def separable_filter(cells: DataFrame, weights: Sequence[float], side: int = BLOCK_SIDE) -> DataFrame:
    """Weighted mean of the cells around each cell, the border mirrored, block by block.

    A map is cut into squares of ``side`` cells; a cell goes to its block and, as a border strip, to those
    within reach, so one shuffle brings a block all it needs, at any size of a map. A block is one row and is
    filtered as an array: 2k products a cell. A missing or null cell takes no part: the weights of the others are
    scaled up, and no value is made for it. A cell that is there twice counts with its mean.
    """
    share_package(cells.sparkSession)
    reach = len(weights) // 2

    def blocks(axis: str) -> Column:
        """The blocks a cell is in or lends itself to: those its window begins and ends in, and any between."""
        return F.explode(F.sequence(*[F.floor((F.col(axis) + d) / side).cast("int") for d in (-reach, reach)]))

    known = cells.where(F.col("value").isNotNull() & ~F.isnan("value"))
    ends = cells.groupBy("raster_id").agg(*[f(c).alias(f"{n}_{c}") for c in ("row", "col") for f, n in ((F.min, "lo"), (F.max, "hi"))])
    held = (known.select("raster_id", "row", "col", F.col("value").cast("double").alias("value"), blocks("row").alias("_br"))
            .withColumn("_bc", blocks("col"))
            .groupBy("raster_id", "_br", "_bc").agg(F.collect_list(F.struct("row", "col", "value")).alias("_cells")))
    schema = StructType([cells.schema[c] for c in ("raster_id", "row", "col")] + [StructField("value", DoubleType())])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = {n: batch.column(n)[i] for n in batch.schema.names}
                found = b["_cells"].values
                row, col, value = (found.field(c).to_numpy() for c in ("row", "col", "value"))
                r0, c0 = b["_br"].as_py() * side, b["_bc"].as_py() * side
                wide = side + 2 * reach
                at = (row - (r0 - reach)) * wide + col - (c0 - reach)
                # The places of the block and its border, each as the place that stands for it.
                places = [np.clip(_mirrored(np.arange(z - reach, z + side + reach), b[f"lo_{c}"].as_py(), b[f"hi_{c}"].as_py()) - (z - reach), 0, wide - 1)
                          for z, c in ((r0, "row"), (c0, "col"))]
                sums = []
                for x in (value, None):
                    grid = np.bincount(at, x, wide * wide).reshape(wide, wide)[np.ix_(*places)]
                    sums.append(_smooth(_smooth(grid, weights, side).T, weights, side).T)
                own = np.flatnonzero((row >= r0) & (row < r0 + side) & (col >= c0) & (col < c0 + side))
                own = own[np.unique(at[own], return_index=True)[1]]
                y, x = row[own] - r0, col[own] - c0
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b["raster_id"].as_py()] * len(own), out.field("raster_id").type), pa.array(row[own]), pa.array(col[own]),
                     pa.array(sums[0][y, x] / sums[1][y, x])], schema=out)

    return held.join(ends, "raster_id").mapInArrow(run, schema)


def box_filter(cells: DataFrame, k: int = 5, side: int = BLOCK_SIDE) -> DataFrame:
    return separable_filter(cells, [1.0 / k] * k, side)


def gaussian_weights(k: int, sigma: float | None = None) -> list[float]:
    if sigma is None and k in SMALL_KERNELS:
        return SMALL_KERNELS[k]
    if sigma is None:
        sigma = 0.3 * ((k - 1) * 0.5 - 1) + 0.8
    raw = [math.exp(-((i - k // 2) ** 2) / (2 * sigma * sigma)) for i in range(k)]
    return [w / sum(raw) for w in raw]


def gaussian_filter(cells: DataFrame, k: int = 5, sigma: float | None = None, side: int = BLOCK_SIDE) -> DataFrame:
    return separable_filter(cells, gaussian_weights(k, sigma), side)
