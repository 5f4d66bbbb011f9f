"""Readers of files and tables. Schemas are explicit, so no reader scans its input twice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from canopy.constants import (
    CUSTOMERS, EXPERIMENT_COLUMNS, HOURLY_FIELDS, ISSUE_TYPES, SENSOR_TYPES, STATION_FIELDS, WEATHER_TILES)
from canopy.functions import geo
from canopy.functions.scalars import nullable, parse_day
from canopy.operators.relational import rename
from canopy.schemas import SCHEMAS

# --- tables -----------------------------------------------------------------------------------


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str, cols: Sequence[str] | None = None,
               predicate: Column | str | None = None) -> DataFrame:
    """A catalog table, or a parquet folder when the name is a path. Columns and filter reach the scan."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    if predicate is not None:
        df = df.where(predicate)
    return df.select(*cols) if cols else df


def read_jdbc(spark: SparkSession, url: str, table: str, cols: Sequence[str] | None = None,
              predicate: str | None = None, split: tuple[str, str, str, int] | None = None,
              **options: str) -> DataFrame:
    """A database table; ``split`` (column, low, high, parts) reads it with several connections."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split:
        column, low, high, parts = split
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
    df = reader.load()
    if predicate:
        df = df.where(predicate)
    return df.select(*cols) if cols else df


# --- weather ----------------------------------------------------------------------------------

MISSING = -999
_STATION_TYPES = {"stations_id": "bigint", "qn_3": "bigint", "qn_4": "bigint", "rskf": "bigint",
                  "shk_tag": "bigint", "nm": "bigint", "eor": "string", "mess_datum": "string"}


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Station observations: ``;`` separated, padded with blanks, -999 for missing, header in any case."""
    df = (spark.read.option("sep", ";").option("header", True)
          .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
          .option("nullValue", str(MISSING)).csv(path))
    df = rename(df, lower=True)

    def typed(c: str) -> Column:
        kind = _STATION_TYPES.get(c, "double")
        v = F.col(c).cast(kind)
        if kind == "string":
            return v
        v = nullable(v) if kind == "double" else v
        return F.nullif(v, F.lit(MISSING).cast(kind))

    df = df.select(*[typed(c).alias(c) for c in df.columns])
    return df.withColumn("mess_datum", parse_day("mess_datum", "yyyyMMdd"))


def to_weather(observations: DataFrame) -> DataFrame:
    """Observation columns under the names of the weather table."""
    return rename(observations, STATION_FIELDS, drop=["eor"])


def read_stations(spark: SparkSession, path: str, ids: Sequence[int] | None = None) -> DataFrame:
    """Fixed-width station list in Latin-1 with two header lines."""
    lines = (spark.read.option("encoding", "ISO-8859-1").option("sep", "\u0001").option("quote", "")
             .schema("line string").csv(path))
    front = r"^\s*(\d+)\s+(\d{8})\s+(\d{8})\s+(-?\d+)\s+(-?[\d.]+)\s+(-?[\d.]+)\s+(.*?)\s+(\S+?)(?:\s+Frei)?\s*$"

    def part(i: int) -> Column:
        return F.regexp_extract("line", front, i)

    df = lines.where(F.col("line").rlike(front)).select(
        part(1).cast("bigint").alias("id"), parse_day(part(2), "yyyyMMdd").alias("von_datum"),
        parse_day(part(3), "yyyyMMdd").alias("bis_datum"), part(4).cast("bigint").alias("stationshoehe"),
        part(5).cast("double").alias("lat"), part(6).cast("double").alias("lon"),
        part(7).alias("stationsname"), part(8).alias("bundesland"))
    if ids is not None:
        df = df.where(F.col("id").isin(list(ids)))
    return df.withColumn("geometry", geo.point("lon", "lat"))


def read_hourly_weather(spark: SparkSession, path: str, tile_id: int) -> DataFrame:
    """Hourly weather of one site from the service's nested JSON; rain is null when not delivered."""
    fields = ", ".join(f"{f}: double" for f in HOURLY_FIELDS)
    schema = ("WeatherDataResults array<struct<WeatherDataPeriods: struct<WeatherDataPeriods: "
              f"array<struct<StartTime: string, {fields}>>>>>")
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    hours = raw.select(F.explode(F.col("WeatherDataResults")[0]["WeatherDataPeriods"]["WeatherDataPeriods"]).alias("p"))
    return hours.select(F.lit(tile_id).cast("bigint").alias("tile_id"),
                        F.to_timestamp("p.StartTime").alias("ts"),
                        *[F.col(f"p.{f}").alias(n) for f, n in HOURLY_FIELDS.items()])


RAIN_PRODUCTS = ("hourly", "daily")


def read_rain_cells(spark: SparkSession, path: str, product: str = "hourly") -> DataFrame:
    """Rain per lattice cell; each product lies in a folder of its own."""
    if product not in RAIN_PRODUCTS:
        raise ValueError(f"product must be one of {RAIN_PRODUCTS}, not {product!r}")
    return spark.read.schema(SCHEMAS["rain_cells"]).parquet(f"{path}/{product}")


def read_corners(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMAS["lattice_corners"]).parquet(path)


# --- vector features --------------------------------------------------------------------------

_COORDINATES = {"Point": "array<double>", "Polygon": "array<array<array<double>>>",
                "MultiPolygon": "array<array<array<array<double>>>>"}
KINDS = {"point": ("Point",), "multi": ("Polygon", "MultiPolygon"), "polygon": ("Polygon",)}


def _vertex(c: Column) -> Column:
    return geo.point(c[0], c[1])


def _ring(c: Column) -> Column:
    return F.transform(c, _vertex)


def _rings(c: Column) -> Column:
    return F.transform(c, _ring)


def _unknown(found: Column, kind: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"a geometry for {kind!r} cannot be of type "), F.coalesce(found, F.lit("null"))))


def _shape(geometry: Column, kind: str) -> Column:
    """Geometry by its type, its coordinates given as JSON text; ``multi`` takes polygons as well.

    A feature without geometry has none; any other type than the kind's is an error.
    """
    found = geometry["type"]

    def coordinates(name: str) -> Column:
        return F.from_json(geometry["coordinates"], _COORDINATES[name])

    made = {"Point": lambda: _vertex(coordinates("Point")),
            "Polygon": lambda: (F.array(_rings(coordinates("Polygon"))) if kind == "multi" else _rings(coordinates("Polygon"))),
            "MultiPolygon": lambda: F.transform(coordinates("MultiPolygon"), _rings)}
    shape = F.when(geometry.isNull() | (found.isNull() & geometry["coordinates"].isNull()), F.lit(None))
    for name in KINDS[kind]:
        shape = shape.when(found == name, made[name]())
    return shape.otherwise(_unknown(found, kind))


def read_geojson(spark: SparkSession, path: str, properties: str, kind: str = "point",
                 lines: bool = False, separator: str | None = None) -> DataFrame:
    """Features with their properties and a ``geometry`` column.

    ``properties`` is their DDL. Kind ``multi`` takes Polygon and MultiPolygon side by side and gives
    multi-polygons. With ``lines`` each text line is one feature. A document is read by one task, unless
    ``separator`` tells the text that every feature begins with, such as ``{"type":"Feature"``: it then cuts the file, on
    one line or many, at any place, and a file of a city's size is read by many tasks. What does not parse as a
    feature, or a collection whose features begin otherwise, is an error.
    """
    shape = "struct<type: string, coordinates: string>"
    feature = f"properties struct<{properties}>, geometry {shape}"
    if lines:
        df = spark.read.schema(feature).json(path)
    elif separator:
        # The record before the first separator is the collection's head; after a feature's own object the
        # rest of the record is the comma, the collection's end, or the head of the next one.
        text = spark.read.option("lineSep", separator).text(path).where(F.trim("value") != "")
        head = F.ltrim("value").startswith("{") | F.ltrim("value").startswith("\ufeff")
        empty = F.regexp_like(F.split("value", F.lit('"features"')).getItem(1), F.lit(r"^\s*:\s*\[\s*(\]|$)"))
        checked = F.when(~head, F.col("value")).when(~F.coalesce(empty, F.lit(False)), F.raise_error(F.lit("features do not begin with the separator")))
        whole = F.concat(F.lit(separator), checked.alias("value"))
        df = (text.select(whole.alias("value")).where(F.col("value").isNotNull())
              .select(F.from_json("value", feature, {"mode": "FAILFAST"}).alias("f")).select("f.*"))
    else:
        inner = f"struct<properties: struct<{properties}>, geometry: {shape}>"
        df = (spark.read.schema(f"features array<{inner}>").option("multiLine", True).json(path)
              .select(F.explode("features").alias("f")).select("f.*"))
    return df.select("properties.*", _shape(F.col("geometry"), kind).alias("geometry"))


def _numbers(text: Column) -> Column:
    return F.transform(F.split(F.trim(text), r"\s+"), lambda s: s.cast("double"))


def _pairs(text: Column) -> Column:
    v = _numbers(text)
    return F.transform(F.sequence(F.lit(0), (F.size(v) / 2).cast("int") - 1),
                       lambda i: geo.point(F.get(v, i * 2), F.get(v, i * 2 + 1)))


_LINEAR = "LinearRing: struct<posList: string>"
_GML_POLYGON = f"struct<exterior: struct<{_LINEAR}>, interior: array<struct<{_LINEAR}>>>"
_GML = (f"struct<Point: struct<pos: string>, Polygon: {_GML_POLYGON}, "
        f"MultiSurface: struct<surfaceMember: array<struct<Polygon: {_GML_POLYGON}>>>>")


def _gml_polygon(polygon: Column) -> Column:
    shell = F.array(_pairs(polygon["exterior"]["LinearRing"]["posList"]))
    holes = F.transform(F.coalesce(polygon["interior"], F.array()), lambda h: _pairs(h["LinearRing"]["posList"]))
    return F.concat(shell, holes)


def read_gml(spark: SparkSession, path: str, row_tag: str, properties: str, kind: str = "point",
             geometry_tag: str = "geom") -> DataFrame:
    """Features of a GML feature collection; ``row_tag`` is the element of one feature.

    Names are matched without their namespace prefix. Kind ``multi`` takes Polygon and MultiSurface; a
    geometry that is there but of none of the kind's types is an error.
    """
    df = (spark.read.option("rowTag", row_tag.split(":")[-1]).option("ignoreNamespace", True)
          .schema(f"{properties}, {geometry_tag} {_GML}").xml(path))
    g = F.col(geometry_tag)
    xy = _numbers(g["Point"]["pos"])
    made = {"point": [(g["Point"].isNotNull(), geo.point(F.get(xy, F.lit(0)), F.get(xy, F.lit(1))))],
            "multi": [(g["Polygon"].isNotNull(), F.array(_gml_polygon(g["Polygon"]))),
                      (g["MultiSurface"].isNotNull(), F.transform(g["MultiSurface"]["surfaceMember"], lambda m: _gml_polygon(m["Polygon"])))]}
    shape = F.when(g.isNull(), F.lit(None))
    for there, value in made[kind]:
        shape = shape.when(there, value)
    return df.withColumn("geometry", shape.otherwise(_unknown(F.lit("another element"), kind))).drop(geometry_tag)


def read_features(spark: SparkSession, path: str, fmt: str, properties: str, kind: str = "point",
                  row_tag: str | None = None) -> DataFrame:
    if fmt == "gml":
        return read_gml(spark, path, row_tag, properties, kind)
    if fmt in ("geojson", "geojsonl"):
        return read_geojson(spark, path, properties, kind, lines=fmt == "geojsonl")
    raise ValueError(f"unknown feature format {fmt!r}")


def read_mask(spark: SparkSession, path: str, properties: str = "name string", kind: str = "multi") -> DataFrame:
    """District boundaries, one row per district; they need not be dissolved (see restrict_to_mask)."""
    return read_geojson(spark, path, properties, kind)


# --- shading and raster -----------------------------------------------------------------------

def read_shading_monthly(spark: SparkSession, path: str) -> DataFrame:
    """Monthly shading: a key and twelve columns whose names do not matter, only their order."""
    return spark.read.option("header", True).schema(SCHEMAS["shading_monthly"]).csv(path)


def read_shading(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(SCHEMAS["shading"]).csv(path)


def read_raster_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMAS["raster_cells"]).parquet(path)


def read_raster_transform(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMAS["raster_transform"]).parquet(path)


# --- dimensions and logs ----------------------------------------------------------------------

def seed_dimensions(spark: SparkSession) -> Mapping[str, DataFrame]:
    """The static dimension tables."""
    tiles = [(i, lat, lng, [{"x": x, "y": y} for x, y in ring]) for i, lng, lat, ring in WEATHER_TILES]
    issues = [(i, *row) for i, row in enumerate(ISSUE_TYPES, start=1)]
    return {
        "sensor_types": spark.createDataFrame(SENSOR_TYPES, SCHEMAS["sensor_types"]),
        "customers": spark.createDataFrame(CUSTOMERS, SCHEMAS["customers"]),
        "issue_types": spark.createDataFrame(issues, SCHEMAS["issue_types"]),
        "weather_tiles": spark.createDataFrame(tiles, SCHEMAS["weather_tiles"]),
    }


_METRICS = "struct<rmse: double, mae: double>"


def read_experiments(spark: SparkSession, path: str) -> DataFrame:
    """The experiment log with its JSON columns decoded."""
    df = (spark.read.option("header", True).option("escape", '"')
          .schema(", ".join(f"`{c}` string" for c in EXPERIMENT_COLUMNS)).csv(path))
    decoded = {c: F.from_json(F.col(f"`{c}`"), _METRICS) for c in EXPERIMENT_COLUMNS if c.startswith("Mean")}
    decoded |= {c: F.from_json(F.col(f"`{c}`"), f"array<{_METRICS}>")
                for c in EXPERIMENT_COLUMNS if c.startswith("Folds")}
    decoded |= {"features": F.from_json("features", "array<string>"),
                "hyper_parameters": F.from_json("hyper_parameters", "map<string, string>")}
    return df.withColumns(decoded)
