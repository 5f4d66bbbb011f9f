"""Documents cut into chunks that follow the order of their ids and hold about as many bytes each."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, IntegralType, StructField, StructType

from canopy.llm.batches import bound_batches

CHUNK_BYTES = 6 << 20
FINER = 8      # ranges looked at for one chunk, so that long texts even out


def id_bounds(df: DataFrame, key: str, text: str, chunk_bytes: int = CHUNK_BYTES) -> list[int]:
    """Largest id of every chunk but the last, rising. One entry a chunk is all the driver sees.

    Quantiles of the ids cut the documents into ranges of equal count; ranges in a row are joined until
    they hold ``chunk_bytes`` of text. Equal ids always share a chunk. Ids of any type but whole numbers are an error.
    """
    kind = df.schema[key].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"column {key} is {kind.simpleString()}, ids must be whole numbers")
    total, least, most = df.agg(F.sum(F.octet_length(text)), F.min(key), F.max(key)).first()
    ranges = FINER * -(-(total or 0) // chunk_bytes)
    if ranges <= FINER or least == most:
        return []
    ids = df.where(F.col(key).isNotNull())
    cuts = sorted(set(map(int, ids.approxQuantile(key, [i / ranges for i in range(1, ranges)], 0.5 / ranges))))
    sizes = dict.fromkeys(range(len(cuts) + 1), 0)
    for i, n in numbered(ids.select(key, F.octet_length(text).alias("size")), key, "size", cuts).groupBy("chunk").agg(
            F.sum("size")).collect():
        sizes[i] = n or 0
    bounds, held = [], 0
    for i, cut in enumerate(cuts):
        held += sizes[i]
        if held + sizes[i + 1] / 2 > chunk_bytes:
            bounds.append(cut)
            held = 0
    return bounds


def numbered(df: DataFrame, key: str, text: str, bounds: list[int]) -> DataFrame:
    """Add ``chunk``, the number of bounds below the id; rows without an id are spread by their text."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(np.array(bounds, np.int64))   # one entry a chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(key)
            chunk = np.searchsorted(shared.value, ids.fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int32)
            for i in np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False)).tolist():
                chunk[i] = zlib.crc32(str(batch.column(text)[i].as_py()).encode()) % (len(bounds) + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunk)], names=[*batch.schema.names, "chunk"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("chunk", IntegerType())]))


def chunk_of(bounds: list[int], key: int) -> int:
    return bisect_left(bounds, key)
