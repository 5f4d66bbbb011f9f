"""Exact order-dependent work on groups of any size.

A window partitioned by a key puts the whole key into one task. Where a key has no natural bound
(raw sensor timestamps, one global order) the rows are first range partitioned by the *whole* sort
tuple, so a key that holds a third of the data is cut into many chunks like any other rows.

The chunks are checkpointed before they are used: every later step then sees the same cut, also when
executors are lost in between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from canopy.session import cut_lineage


def chunked(df: DataFrame, cols: Sequence[str | Column], chunks: int = 0) -> DataFrame:
    """Rows sorted into range chunks: ``_chunk`` rises with the sort tuple, ``_at`` within a chunk.

    ``chunks=0`` takes the shuffle partitions of the session, joined by the adaptive planner where they
    are small.
    """
    ranged = df.repartitionByRange(chunks, *cols) if chunks else df.repartitionByRange(*cols)
    return cut_lineage(ranged.sortWithinPartitions(*cols).withColumns(
        {"_chunk": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))


def ranked(df: DataFrame, order: Sequence[str | Column], name: str = "rank", chunks: int = 0) -> DataFrame:
    """Global 1-based row number over a unique ascending order, without one task seeing all rows."""
    parts = chunked(df, order, chunks)
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # One row per chunk, so the window over it and the broadcast are bounded by the partition count.
    offsets = (parts.groupBy("_chunk").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
               .select("_chunk", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")))
    return (parts.join(F.broadcast(offsets), "_chunk")
            .withColumn(name, F.col("_at") + F.col("_shift")).drop("_chunk", "_at", "_shift"))


def with_history(df: DataFrame, keys: Sequence[str], order: Sequence[str], back: int,
                 chunks: int = 0) -> DataFrame:
    """Cut every key into chunks and give each chunk the ``back`` rows that precede it.

    Adds ``_chunk`` (window over keys + ``_chunk``) and ``_halo`` (true on the copied rows, to be
    dropped afterwards). A chunk lends at most ``back`` rows, so the copies stay a small constant.
    """
    keys, order = list(keys), list(order)
    parts = chunked(df, keys + order, chunks).drop("_at")
    newest = Window.partitionBy("_chunk", *keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    tails = (parts.withColumn("_i", F.row_number().over(newest)).where(F.col("_i") <= back)
             .groupBy("_chunk", *keys)
             .agg(F.sort_array(F.collect_list(
                 F.struct((-F.col("_i")).alias("i"), F.struct(*df.columns).alias("row")))).alias("_tail")))
    # Every chunk that holds a key has at least one row of it: the last `back` chunks suffice.
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(-back, -1)
    halo = (tails.withColumn("_seen", F.flatten(F.collect_list("_tail").over(earlier)))
            .where(F.size("_seen") > 0)
            .select("_chunk", F.explode(F.slice("_seen", F.greatest(F.size("_seen") - back + 1, F.lit(1)),
                                                back)).alias("_s"))
            .select("_chunk", "_s.row.*", F.lit(True).alias("_halo")))
    return parts.withColumn("_halo", F.lit(False)).unionByName(halo)
