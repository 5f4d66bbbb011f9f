"""Checks on loaded tables: keys, references, nulls, duplicates and freshness."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from canopy.operators.relational import union_all


@dataclass(frozen=True)
class Rules:
    """What a table promises. ``foreign`` maps its columns to (table, columns)."""
    primary: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    foreign: Mapping[tuple[str, ...], tuple[str, tuple[str, ...]]] = field(default_factory=dict)


# The promises of the data model. Two tables on purpose allow unknown trees and have no reference.
MODEL_RULES = {
    "trees": Rules(("id",)),
    "soil": Rules(("id",)),
    "issue_types": Rules(("id",), ("title", "description")),
    "issues": Rules(("id",), ("issue_type_id", "created_at", "tree_id"),
                    {("issue_type_id",): ("issue_types", ("id",)), ("tree_id",): ("trees", ("id",))}),
    "weather_stations": Rules(("id",)),
    "weather": Rules(("stations_id", "date"), ("date",),
                     {("stations_id",): ("weather_stations", ("id",))}),
    "radolan_tiles": Rules(("id",)),
    "radolan": Rules(("tile_id", "date"), ("date",), {("tile_id",): ("radolan_tiles", ("id",))}),
    "shading": Rules(("tree_id",), (), {("tree_id",): ("trees", ("id",))}),
    "shading_monthly": Rules(("tree_id",), (), {("tree_id",): ("trees", ("id",))}),
    "sensor_types": Rules(("id",), ("name",)),
    "forecast": Rules(("id",), ("created_at",),
                      {("tree_id",): ("trees", ("id",)), ("type_id",): ("sensor_types", ("id",))}),
    "nowcast": Rules(("id",), ("created_at",),
                     {("tree_id",): ("trees", ("id",)), ("type_id",): ("sensor_types", ("id",))}),
    "customers": Rules(("id",), ("name",)),
    "tree_devices": Rules(("tree_id", "customer_id", "device_id"), (),
                          {("tree_id",): ("trees", ("id",)), ("customer_id",): ("customers", ("id",))}),
    "trees_private": Rules(("tree_id",)),
    "sensor_measurements": Rules(("tree_id", "type_id", "timestamp"), (),
                                 {("tree_id",): ("trees", ("id",)), ("type_id",): ("sensor_types", ("id",))}),
    "watering_gdk": Rules(("tree_id", "date"), (), {("tree_id",): ("trees", ("id",))}),
    "watering_sga": Rules(("tree_id", "date")),
    "weather_tiles": Rules(("id",)),
    "weather_tile_measurement": Rules(("tile_id", "date"), ("date",),
                                      {("tile_id",): ("weather_tiles", ("id",))}),
    "weather_tile_forecast": Rules(("tile_id", "date", "created_at"), ("date", "created_at"),
                                   {("tile_id",): ("weather_tiles", ("id",))}),
}


def _finding(df: DataFrame, table: str, rule: str, cols: tuple[str, ...]) -> DataFrame:
    return df.select(F.lit(table).alias("table"), F.lit(rule).alias("rule"),
                     F.lit(",".join(cols)).alias("columns"),
                     F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("violations"))


def _check_key(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """Rows too many per key, plus rows with a null inside the key."""
    has_null = F.lit(False)
    for c in cols:
        has_null = has_null | F.col(c).isNull()
    return (df.groupBy(*cols).agg(F.count("*").alias("_c"))
            .agg(F.sum(F.when(has_null, F.col("_c")).otherwise(F.col("_c") - 1)).alias("n")))


def _check_nulls(df: DataFrame, table: str, cols: tuple[str, ...]) -> DataFrame:
    """Nulls of all columns in one pass, one finding each."""
    sums = df.agg(*[F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(f"_{i}") for i, c in enumerate(cols)])
    rows = F.explode(F.array(*[F.struct(F.lit(table).alias("table"), F.lit("not null").alias("rule"), F.lit(c).alias("columns"),
                                        F.col(f"_{i}").cast("long").alias("violations")) for i, c in enumerate(cols)]))
    return sums.select(rows.alias("_r")).select("_r.*")


def _check_reference(child: DataFrame, cols: tuple[str, ...], parent: DataFrame,
                     parent_cols: tuple[str, ...]) -> DataFrame:
    """Rows without a parent. Child keys are counted first, so a hot key meets the parents once."""
    keys = child.na.drop("any", subset=list(cols)).groupBy(*cols).agg(F.count("*").alias("_c"))
    parents = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_cols, cols)])
    return keys.join(parents, list(cols), "left_anti").agg(F.sum("_c").alias("n"))


def audit(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules] = MODEL_RULES) -> DataFrame:
    """One row per promise with the number of rows that break it."""
    findings = []
    for name, df in tables.items():
        r = rules[name]
        if r.primary:
            findings.append(_finding(_check_key(df, r.primary), name, "primary key", r.primary))
        if r.not_null:
            findings.append(_check_nulls(df, name, r.not_null))
        for cols, (parent, parent_cols) in r.foreign.items():
            if parent in tables:
                bad = _check_reference(df, cols, tables[parent], parent_cols)
                findings.append(_finding(bad, name, "foreign key", cols))
    return union_all(*findings)


def nowcast_date(weather: DataFrame, sensors: DataFrame, today: dt.date, day: str = "date",
                 ts: str = "timestamp") -> DataFrame:
    """Yesterday if both feeds reach it, else the older of their last days; null without any data."""
    yesterday = F.date_sub(F.lit(today).cast("date"), 1)
    last = weather.agg(F.max(day).cast("date").alias("last_weather")).withColumn(
        "last_sensor", sensors.agg(F.max(ts).cast("date")).scalar())
    w, s = F.col("last_weather"), F.col("last_sensor")
    return last.withColumn("nowcast_date", F.when(w.isNull() | s.isNull(), F.lit(None).cast("date"))
                           .when((w < yesterday) | (s < yesterday), F.least(w, s)).otherwise(yesterday))
