"""Arrow batches: columns computed beside a table's own, with a bound on what a task holds."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# A batch ends at this many rows or bytes, whichever comes first, so long texts make small batches.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20

Columns = Callable[[pa.RecordBatch], list]


def bound_batches(spark: SparkSession) -> None:
    """Bound the batches, and let Python workers import this package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def add_columns(df: DataFrame, schema: str, start: Callable[[], Columns]) -> DataFrame:
    """Append the columns of ``schema`` to every row; a column of the same name is replaced.

    ``start`` runs once a task and returns the function that turns a batch into lists, one per new
    column. Rows, their order and the other columns stay.
    """
    bound_batches(df.sparkSession)
    added = StructType.fromDDL(schema)
    new = set(added.names)
    kept = [c for c in df.columns if c not in new]
    out = StructType([df.schema[c] for c in kept] + added.fields)
    types = [f.type for f in to_arrow_schema(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = start()
        for batch in batches:
            made = [pa.array(values, t) for values, t in zip(columns(batch), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + made, names=kept + added.names)

    return df.mapInArrow(run, out)


def quoted(name: str) -> str:
    """A column's name as Spark reads it, also with dots in it."""
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(name).to_pylist()
