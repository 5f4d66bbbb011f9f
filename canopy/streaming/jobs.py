"""Structured Streaming counterparts of the daily loads.

Open days change while late rows arrive, so the daily aggregates run in update mode and every
micro-batch upserts its days into a day-partitioned table. A replayed batch writes the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from canopy.operators.aggregates import daily_rain_aggs, daily_weather_aggs
from canopy.operators.relational import union_all
from canopy.sources.sinks import current, upsert

LATENESS = "14 days"


def file_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """New parquet files of a folder, picked up in order of arrival."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _daily(df: DataFrame, keys: Sequence[str], aggs, lateness: str) -> DataFrame:
    """``ts`` must be a timestamp with zone; the session zone (UTC) cuts the days."""
    day = F.window("ts", "1 day")
    return (df.withWatermark("ts", lateness).groupBy(day, *keys).agg(*aggs)
            .withColumn("date", F.to_date("window.start")).drop("window"))


def watering_stream(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Watering events (tree_id, ts, amount_liters) to litres per tree and day."""
    total = F.coalesce(F.sum("amount_liters"), F.lit(0.0)).alias("amount_liters")
    return _daily(events, ["tree_id"], [total], lateness)


def rain_stream(hourly: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Hourly rain per tile (tile_id, ts, rainfall_mm) to its daily mean and maximum."""
    return _daily(hourly, ["tile_id"], daily_rain_aggs(), lateness)


def weather_stream(hourly: DataFrame, zone: str = "CET", lateness: str = "1 day") -> DataFrame:
    """Hourly tile weather to days of the given zone: the time is shifted before the windows are cut."""
    local = hourly.withColumn("ts", F.from_utc_timestamp("ts", zone))
    return _daily(local, ["tile_id"], daily_weather_aggs(), lateness)


def sensor_stream(readings: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Each (tree, kind, time) once, however often it is delivered within the lateness."""
    return (readings.withWatermark("timestamp", lateness)
            .dropDuplicatesWithinWatermark(["tree_id", "type_id", "timestamp"]))


def run_upserts(stream: DataFrame, table: str, keys: Sequence[str], checkpoint: str, day: str = "date") -> StreamingQuery:
    """Take everything that is there, then stop; the next run resumes from the checkpoint."""
    def write(batch: DataFrame, _: int) -> None:
        batch = batch.persist()   # the batch is read for its days, its keys and its rows
        try:
            upsert(batch, table, keys, day)
        finally:
            batch.unpersist()

    return (stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(write).start())


def run_late(events: DataFrame, table: str, checkpoint: str, lateness: str = LATENESS) -> StreamingQuery:
    """Write the rows that a daily stream of the same batches and lateness no longer takes to a side table.

    Such a stream drops a row whose day had ended, by more than the lateness, before the newest row of the batches
    before. The side table, partitioned by ``batch``, has for each batch its late rows and one row without a time but
    with the newest time so far; a replayed batch overwrites its own partition, so no row is there twice.
    """
    spark = events.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        before = current(spark, table).where(F.col("batch") < number).agg(F.max("newest")).scalar()
        day_end = F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY")
        late = batch.where(day_end <= before - F.expr(f"INTERVAL {lateness}")).withColumn("newest", F.lit(None).cast("timestamp"))
        mark = batch.agg(F.max("ts").alias("newest"))
        found = union_all(late, mark).withColumn("batch", F.lit(number).cast("bigint"))
        found.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)

    return (events.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start())


def run_appends(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    return (stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).toTable(table))
