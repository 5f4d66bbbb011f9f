"""Load strategies onto catalog tables.

Daily tables are partitioned by day, so replacing or dropping a range touches only the files of
those days, and a repeated run leaves the same table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from canopy.constants import EXPERIMENT_COLUMNS
from canopy.functions.scalars import literal_day
from canopy.operators.relational import ranks_between, union_all
from canopy.session import cut_lineage, drop_folder
from canopy.sources.readers import table_exists


def create_table(spark: SparkSession, table: str, schema: str | StructType, day: str | None = None,
                 path: str | None = None) -> None:
    """An empty parquet table unless it exists already."""
    if table_exists(spark, table):
        return
    writer = spark.createDataFrame([], schema).write.format("parquet")
    if day:
        writer = writer.partitionBy(day)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def _in_table_order(df: DataFrame, table: str) -> DataFrame:
    """Columns as the table has them; rows gathered by its partition, a large day over several tasks.

    Without the gathering every task would write a small file into every day.
    """
    spark = df.sparkSession
    days = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    df = df.select(*spark.table(table).columns)
    return df.hint("rebalance", *days) if days else df


def current(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now, also when another session (such as a stream's) has replaced files of it."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def append(df: DataFrame, table: str) -> None:
    if table_exists(df.sparkSession, table):
        _in_table_order(df, table).write.mode("append").insertInto(table)
    else:
        df.write.format("parquet").saveAsTable(table)


def location(spark: SparkSession, table: str) -> str:
    """The folder of a table."""
    return spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]


def replace(df: DataFrame, table: str, day: str | None = None) -> None:
    """Full replacement, which may be read from the table itself.

    The rows are written to a new folder, and the table is switched to it once they are all there: a write that
    fails leaves the table as it was, and readers see the old rows or the new ones. A table partitioned by day is
    overwritten in place of its days, which are put in place after all were written. Other columns or types than
    the table's make a new table of that name over the written folder.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        writer = df.write.format("parquet")
        (writer.partitionBy(day) if day else writer).saveAsTable(table)
        return
    if day:
        replace_range(df, table, day)
        return
    old = location(spark, table)
    folder = f"{old.rstrip('/').rsplit('/', 1)[0]}/{table.rsplit('.', 1)[-1]}-{uuid.uuid4().hex}"
    kinds = {f.name: f.dataType.simpleString() for f in spark.table(table).schema}
    same = kinds == {f.name: f.dataType.simpleString() for f in df.schema}
    try:
        (df.select(*kinds) if same else df).write.parquet(folder)
    except Exception:
        drop_folder(spark, folder)
        raise
    if not same:
        spark.sql(f"DROP TABLE {table}")
        spark.createDataFrame([], df.schema).write.format("parquet").saveAsTable(table)
        old = location(spark, table)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    drop_folder(spark, old)


def rewrite(df: DataFrame, table: str, day: str | None = None) -> None:
    """Replace a table by content derived from it."""
    replace(df, table, day)


def in_range(day: str, lo: dt.date | None, hi: dt.date | None) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(day) >= literal_day(lo))
    if hi is not None:
        cond = cond & (F.col(day) < literal_day(hi))
    return cond


def without_range(old: DataFrame, day: str, lo: dt.date | None, hi: dt.date | None,
                  keys: DataFrame | None = None, on: Sequence[str] = ()) -> DataFrame:
    """Old rows that survive the deletion of ``lo <= day < hi`` (of the given keys only)."""
    gone = in_range(day, lo, hi)
    if keys is None:
        return old.where(~gone)
    mark = keys.select(*on).distinct().withColumn("_gone", F.lit(True))
    return (old.join(mark, list(on), "left")
            .where(~(gone & F.coalesce("_gone", F.lit(False)))).select(*old.columns))


def replaced(old: DataFrame, new: DataFrame, day: str, lo=None, hi=None,
             keys: DataFrame | None = None, on: Sequence[str] = ()) -> DataFrame:
    """Content after deleting the range and appending the new rows."""
    return union_all(without_range(old, day, lo, hi, keys, on), new)


def _days(df: DataFrame, day: str) -> list[dt.date]:
    """Distinct days, bounded by the calendar."""
    return [r[0] for r in df.select(day).distinct().collect()]


def _overwrite_days(df: DataFrame, table: str) -> None:
    """Replace the partitions the rows fall in. Only this mode lets the rows come from the table itself:
    new files are put in place after all were written."""
    if df.sparkSession.conf.get("spark.sql.sources.partitionOverwriteMode").lower() != "dynamic":
        raise RuntimeError("the session needs canopy.session.apply_settings: a static overwrite would empty the table")
    _in_table_order(df, table).write.mode("overwrite").insertInto(table)


def replace_range(new: DataFrame, table: str, day: str, lo: dt.date | None = None, hi: dt.date | None = None,
                  keys: DataFrame | None = None, on: Sequence[str] = ()) -> None:
    """Delete ``lo <= day < hi`` from a day-partitioned table, then append.

    Rewrites only the partitions of the range and of the new rows. Days left without a row are
    dropped, which a dynamic overwrite alone would not do.
    """
    spark = new.sparkSession
    old = current(spark, table)
    new = cut_lineage(new)      # read for its days, for the days of the content and for the rows
    new_days = _days(new, day)
    touched = in_range(day, lo, hi)
    if new_days:
        touched = touched | F.col(day).isin(new_days)
    content = replaced(old.where(touched), new.select(*old.columns), day, lo, hi, keys, on)
    stale = set(_days(old.where(touched), day)) - set(_days(content, day))
    _overwrite_days(content, table)
    _drop_days(spark, table, day, stale)


def _drop_days(spark: SparkSession, table: str, day: str, stale: Iterable[dt.date]) -> None:
    """Drop partitions left without a row, which a dynamic overwrite alone would not do."""
    for d in sorted(stale):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({day} = DATE'{d}')")


def upsert(new: DataFrame, table: str, keys: Sequence[str], day: str) -> None:
    """Replace the rows with the same key, add the others; rewrites only the days that hold either.

    A key is in the table once afterwards, also if its day has moved; of new rows with one key the one with the
    latest day counts.
    """
    spark, keys = new.sparkSession, list(keys)
    old = current(spark, table)
    row = F.struct(*old.columns)
    newest = new.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max_by(row, F.struct(day, F.xxhash64(row))).alias("_r"))
    new = cut_lineage(newest.select("_r.*"))        # read for its keys, its days and the rows
    mark = new.select(*keys)
    days = set(_days(new, day))
    if day not in keys:
        days |= set(_days(old.join(mark, keys, "left_semi"), day))
    if not days:
        return
    touched = old.where(F.col(day).isin(list(days)))
    content = union_all(touched.join(mark, keys, "left_anti"), new)
    stale = days - set(_days(content, day))
    _overwrite_days(content, table)
    _drop_days(spark, table, day, stale)


def resume_point(df: DataFrame, day: str, keys: Sequence[str] = (), default: dt.date | None = None) -> DataFrame:
    """Last loaded day (per key); a table without rows resumes at the default."""
    last = df.groupBy(*keys).agg(F.max(day).cast("date").alias("resume"))
    return last.withColumn("resume", F.coalesce("resume", literal_day(default) if default else F.lit(None).cast("date")))


def incremental(src: DataFrame, resume: DataFrame, day: str, keys: Sequence[str] = (),
                inclusive: bool = False, default: dt.date | None = None) -> DataFrame:
    """Rows after the resume point; ``inclusive`` starts at it. Keys never seen start at the default."""
    d = F.col(day).cast("date")
    start = F.col("resume") if keys else resume.select("resume").scalar()
    if default is not None:
        start = F.coalesce(start, literal_day(default))
    df = src.join(resume, list(keys), "left") if keys else src
    return df.where(start.isNull() | (d >= start if inclusive else d > start)).select(*src.columns)


def load_once(df: DataFrame, table: str) -> bool:
    """Write unless the table has rows; tells whether it wrote."""
    spark = df.sparkSession
    if table_exists(spark, table) and not spark.table(table).isEmpty():
        return False
    append(df, table)
    return True


def retain(df: DataFrame, ts: str, days: int, now: dt.datetime) -> DataFrame:
    """Rows not older than ``days`` before ``now``."""
    return df.where(F.col(ts) >= F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days)))


def refresh(spark: SparkSession, views: Mapping[str, tuple[Sequence[str], Callable[[], DataFrame | None]]]) -> list[str]:
    """Write every view after the views it reads; returns the order used.

    A view is what its function returns; one that keeps itself, such as ``refresh_trailing``, returns nothing.
    """
    graph = {name: [i for i in inputs if i in views] for name, (inputs, _) in views.items()}
    order = list(TopologicalSorter(graph).static_order())
    for name in order:
        content = views[name][1]()
        if content is not None:
            replace(content, name)
    return order


def _marks(source: DataFrame, day: str) -> DataFrame:
    """(day, mark) of a partitioned table: a mark changes with the day's files. Reads no data, only which files there are."""
    files = source.select(day, F.xxhash64("_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size").alias("f"))
    return files.groupBy(F.col(day).alias("day")).agg(F.concat_ws("/", F.count("*"), F.sum(F.col("f").cast("decimal(38,0)"))).alias("mark"))


def refresh_trailing(spark: SparkSession, view: str, table: str, keys: Sequence[str], rows: int, make: Callable[[DataFrame], DataFrame],
                     day: str = "date") -> list[dt.date]:
    """Bring a view with trailing windows of ``rows`` rows per key up to date; returns the days written anew.

    ``make`` turns rows of the table into rows of the view, which has the table's days and is partitioned by
    them. Beside the view a record keeps the days it was built from. Only days whose files differ from the record, and the
    days of the rows after them that look back on them, are computed, from the rows those look back on.
    """
    source, record = current(spark, table), f"{view}_built"
    marks = cut_lineage(_marks(source, day))        # a row a day
    if not table_exists(spark, view) or not table_exists(spark, record):
        content = make(source)
        create_table(spark, view, content.schema, day)
        replace(content, view, day)
        replace(marks, record)
        return sorted(_days(marks, "day"))
    built = current(spark, record).withColumnRenamed("mark", "was")
    changed = [r["day"] for r in marks.join(built, "day", "full").where(~F.col("mark").eqNullSafe(F.col("was"))).select("day").collect()]
    if not changed:
        return []
    # Rows from the first changed day on; a changed day that lost a key's row still counts for the rows after it.
    days, keys = F.col(day).isin(changed), list(keys)
    later = source.where(F.col(day) >= literal_day(min(changed))).select(*keys, day).withColumn("_real", F.lit(True))
    old = current(spark, view).where(days)
    if not set(keys) <= set(old.columns):       # a view of one key: any key may have lost a row on a changed day
        old = later.select(*keys).distinct().withColumn(day, F.explode(F.array(*map(literal_day, sorted(changed)))))
    gone = cut_lineage(old.select(*keys, day).join(later.where(days), [*keys, day], "left_anti").withColumn("_real", F.lit(False)))
    series = union_all(later, gone).withColumn("_hit", days.cast("int"))
    back = Window.partitionBy(*keys).orderBy(day, "_real").rowsBetween(-(rows - 1 + len(_days(gone, day))), 0)      # a row a day
    hit = cut_lineage(series.withColumn("_hit", F.max("_hit").over(back)).where("_hit = 1 and _real").select(*keys, day))
    touched = sorted({*_days(hit, day), *changed})
    # As far back as the first of them looks, for every key with a row on a day that is written anew.
    there = source.where(F.col(day).isin(touched)).select(*keys).distinct()
    before = source.where(F.col(day) < literal_day(touched[0])).select(*keys, day).join(there, keys, "left_semi")
    newest = Window.partitionBy(*keys).orderBy(F.desc(day))
    lowest = before.withColumn("_i", F.row_number().over(newest)).where(F.col("_i") < rows).agg(F.min(day)).first()[0]
    needed = source.where(F.col(day).between(literal_day(lowest or touched[0]), literal_day(touched[-1])))
    content = cut_lineage(make(needed).where(F.col(day).isin(touched)))
    _overwrite_days(content, view)
    _drop_days(spark, view, day, set(touched) - set(_days(content, day)))
    replace(marks, record)
    return touched


def log_experiment(df: DataFrame, path: str) -> None:
    """Append experiment records; struct and array columns are stored as JSON text."""
    flat = [F.to_json(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() in ("struct", "array", "map")
            else F.col(f"`{f.name}`") for f in df.select(*[f"`{c}`" for c in EXPERIMENT_COLUMNS]).schema]
    df.select(*flat).write.mode("append").option("header", True).option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def pages(df: DataFrame, order: Sequence[str], size: int, count: int):
    """Pages of a unique order one after the other, for callers that hand out bounded batches.

    The rows of all pages are ranked once, into a checkpoint that the pages read.
    """
    rows = cut_lineage(ranks_between(df, order, 1, size * count))
    for i in range(count):
        yield rows.where((F.col("_rank") > size * i) & (F.col("_rank") <= size * (i + 1))).drop("_rank")
