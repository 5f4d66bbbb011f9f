"""Registered queries: the streaming jobs over the event files, checked against the batch result."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, functions as F

from canopy.plans.registry import query
from canopy.plans.standins import Roles, kind, rounded, text
from canopy.session import cut_lineage, drop_folder, new_folder
from canopy.sources.sinks import create_table, current
from canopy.streaming import jobs as T

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _events(r: Roles) -> DataFrame:
    """A watermark needs a timestamp with zone."""
    df = T.file_stream(r.spark, r.folder, _EVENTS, "events.parquet")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


@contextmanager
def _target(r: Roles, label: str, schema: str, day: str | None = "date") -> Iterator[tuple[str, str]]:
    """A new table in the shared folder and the checkpoint beside it, removed afterwards."""
    table = f"{label}_{uuid.uuid4().hex}"
    folders = [new_folder(r.spark, f"{label}-{what}") for what in ("table", "checkpoint")]
    create_table(r.spark, table, schema, day, path=folders[0])
    try:
        yield table, folders[1]
    finally:
        r.spark.sql(f"DROP TABLE {table}")
        for folder in folders:
            drop_folder(r.spark, folder)


def _upserted(r: Roles, stream: DataFrame, label: str, schema: str, keys: list[str]) -> DataFrame:
    with _target(r, label, schema) as (table, checkpoint):
        T.run_upserts(stream, table, keys, checkpoint).awaitTermination()
        return cut_lineage(current(r.spark, table))


@query("stream_daily", """
SELECT CAST(user_id AS VARCHAR) AS tree_id, CAST(ts AS DATE) AS date, round(sum(value) + 1e-9, 4) AS amount_liters FROM events GROUP BY 1, 2""")
def stream_daily(r: Roles) -> DataFrame:
    events = _events(r).select(text("user_id").alias("tree_id"), "ts", F.col("value").alias("amount_liters"))
    df = _upserted(r, T.watering_stream(events), "watering", "tree_id string, amount_liters double, date date", ["tree_id", "date"])
    return rounded(df, "amount_liters")


@query("stream_rain", """
SELECT user_id AS tile_id, CAST(ts AS DATE) AS date, round(avg(value) + 1e-9, 4) AS rainfall_mm, max(value) AS rainfall_max_mm FROM events GROUP BY 1, 2""")
def stream_rain(r: Roles) -> DataFrame:
    hourly = _events(r).select(F.col("user_id").alias("tile_id"), "ts", F.col("value").alias("rainfall_mm"))
    df = _upserted(r, T.rain_stream(hourly), "rain", "tile_id bigint, rainfall_mm double, rainfall_max_mm double, date date", ["tile_id", "date"])
    return rounded(df, "rainfall_mm")


@query("stream_weather", """
SELECT 2 AS tile_id, CAST(ts + INTERVAL 1 HOUR AS DATE) AS date, max(value) AS ghi_max_wm2, round(sum(value) + 1e-9, 4) AS ghi_sum_whm2,
 round(avg(value / 5) + 1e-9, 4) AS temp_avg_c, max(value / 5) AS temp_max_c FROM events GROUP BY 2""")
def stream_weather(r: Roles) -> DataFrame:
    v = F.col("value")
    hourly = _events(r).select(F.lit(2).alias("tile_id"), "ts", *[v.alias(c) for c in ("ghi", "dni", "dhi", "wind", "rainfall_mm")],
                               (v / 5).alias("temp"))
    stream = T.weather_stream(hourly).select("tile_id", "date", "ghi_max_wm2", "ghi_sum_whm2", "temp_avg_c", "temp_max_c")
    schema = "tile_id int, ghi_max_wm2 double, ghi_sum_whm2 double, temp_avg_c double, temp_max_c double, date date"
    return rounded(_upserted(r, stream, "weather", schema, ["tile_id", "date"]), "ghi_sum_whm2", "temp_avg_c")


@query("stream_dedup", """
SELECT CAST(user_id AS VARCHAR) AS tree_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END AS type_id,
 CAST(ts AS DATE) AS day FROM events GROUP BY 1, 2, 3""")
def stream_dedup(r: Roles) -> DataFrame:
    """Readings cut to their day, so several share a key; every key is kept once."""
    readings = _events(r).select(text("user_id").alias("tree_id"), kind().alias("type_id"),
                                 F.date_trunc("day", "ts").alias("timestamp"), "value")
    with _target(r, "readings", "tree_id string, type_id int, timestamp timestamp, value double", None) as (table, checkpoint):
        T.run_appends(T.sensor_stream(readings), table, checkpoint).awaitTermination()
        return cut_lineage(current(r.spark, table).select("tree_id", "type_id", F.to_date("timestamp").alias("day")))


_PARTS = """parts AS (SELECT *, CAST(ts AS DATE) AS day, min(CAST(ts AS DATE)) OVER () AS first FROM events),
delivered AS (SELECT *, CASE WHEN day - first <= 2 AND event_id % 5 = 0 THEN 3 WHEN day - first > 17 AND event_id % 7 = 0 THEN 3
 WHEN day - first <= 19 THEN 1 ELSE 2 END AS run FROM parts)"""


@query("stream_runs", f"""
WITH {_PARTS}
SELECT CAST(user_id AS VARCHAR) AS tree_id, day AS date, round(sum(value) + 1e-9, 4) AS amount_liters, 'daily' AS kind FROM delivered
 WHERE NOT (run = 3 AND day - first <= 2) GROUP BY 1, 2
UNION ALL SELECT CAST(user_id AS VARCHAR), day, round(value + 1e-9, 4), 'late' FROM delivered WHERE run = 3 AND day - first <= 2""")
def stream_runs(r: Roles) -> DataFrame:
    """Three runs that resume from their checkpoints, each finding new files; the last brings rows in time and rows too late.

    The second run finds files it has read already beside the new ones and takes none of them twice.
    """
    events = r.events.withColumn("day", F.to_date("ts"))
    age = F.datediff("day", F.lit(events.agg(F.min("day")).first()[0]))
    late = ((age <= 2) & (F.col("event_id") % 5 == 0)) | ((age > 17) & (F.col("event_id") % 7 == 0))
    runs = [~late & (age <= 19), ~late & (age > 19), late]
    folder = new_folder(r.spark, "deliveries")
    sums, side = "tree_id string, amount_liters double, date date", "tree_id string, ts timestamp, amount_liters double, newest timestamp, batch bigint"
    try:
        with _target(r, "daily", sums) as (table, checkpoint), _target(r, "late", side, "batch") as (late_table, late_checkpoint):
            for i, part in enumerate(runs):
                events.where(part).drop("day").withColumn("run", F.lit(i)).coalesce(1).write.mode("append").parquet(folder)
                stream = T.file_stream(r.spark, folder, _EVENTS).withColumn("ts", F.col("ts").cast("timestamp"))
                rows = stream.select(text("user_id").alias("tree_id"), "ts", F.col("value").alias("amount_liters"))
                T.run_late(rows, late_table, late_checkpoint).awaitTermination()
                T.run_upserts(T.watering_stream(rows), table, ["tree_id", "date"], checkpoint).awaitTermination()
            daily = current(r.spark, table).select("tree_id", "date", "amount_liters", F.lit("daily").alias("kind"))
            behind = current(r.spark, late_table).where("ts is not null").select(
                "tree_id", F.to_date("ts").alias("date"), "amount_liters", F.lit("late").alias("kind"))
            return rounded(cut_lineage(daily.union(behind)), "amount_liters")
    finally:
        drop_folder(r.spark, folder)
