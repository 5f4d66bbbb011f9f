"""Registered queries: given tables written in the formats of the sources and read back, and the load strategies
on scratch tables. Folders and tables are removed before the result is handed on."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, functions as F

from canopy.constants import HOURLY_FIELDS, MONTHS
from canopy.operators import models as M
from canopy.plans import views as V
from canopy.plans.registry import query
from canopy.plans.standins import Roles, rounded, text, with_roles
from canopy.session import cut_lineage, drop_folder, new_folder
from canopy.sources import readers as IO, sinks as K


@contextmanager
def scratch(r: Roles, label: str) -> Iterator[str]:
    folder = new_folder(r.spark, label)
    try:
        yield folder
    finally:
        drop_folder(r.spark, folder)


@contextmanager
def scratch_table(r: Roles, label: str, schema: str | None = None, day: str | None = None) -> Iterator[str]:
    name = f"{label}_{uuid.uuid4().hex}"
    with scratch(r, f"{label}-table") as folder:
        if schema:
            K.create_table(r.spark, name, schema, day, path=f"{folder}/rows")
        try:
            yield name
        finally:
            r.spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- readers ----------------------------------------------------------------------------------

@query("read_table", "SELECT p_partkey, p_brand FROM part WHERE p_size > 25")
def read_table(r: Roles) -> DataFrame:
    with scratch(r, "parts") as folder:
        r.part.write.parquet(folder)
        return cut_lineage(IO.read_table(r.spark, folder, ["p_partkey", "p_brand"], F.col("p_size") > 25))


@query("read_observations", """
SELECT o_orderkey AS stations_id, CAST(o_orderdate AS DATE) AS date, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS rainfall_mm,
 CASE WHEN o_custkey % 3 > 0 THEN o_custkey / 10 END AS temp_avg_c FROM orders""")
def read_observations(r: Roles) -> DataFrame:
    """Orders as station observations: blanks around the numbers, -999 for missing."""
    def number(known: Column, v: Column) -> Column:
        return F.when(known, F.concat(F.lit("  "), v.cast("string"))).otherwise(F.lit(" -999"))

    rows = r.orders.select(
        text("o_orderkey").alias("STATIONS_ID"), F.date_format("o_orderdate", "yyyyMMdd").alias("MESS_DATUM"),
        number(F.col("o_orderkey") % 5 > 0, F.col("o_totalprice")).alias(" RSK"),
        number(F.col("o_custkey") % 3 > 0, F.col("o_custkey") / 10).alias(" TMK"), F.lit("eor").alias("eor"))
    with scratch(r, "observations") as folder:
        (rows.write.option("sep", ";").option("header", True).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(folder))
        return cut_lineage(IO.to_weather(IO.read_observations(r.spark, folder)))


@query("read_stations", """
SELECT s_suppkey AS id, DATE '1990-01-02' AS von_datum, DATE '2024-05-06' AS bis_datum, CAST(s_nationkey AS BIGINT) AS stationshoehe,
 52.5::DOUBLE AS lat, 13.0::DOUBLE + s_nationkey / 10 AS lon, s_name AS stationsname, 'Berlin' AS bundesland FROM supplier""")
def read_stations(r: Roles) -> DataFrame:
    """Suppliers as the fixed-width station list, with its two header lines in every file."""
    n = F.col("s_nationkey")
    lines = r.supplier.select(F.format_string(
        "%05d 19900102 20240506 %14d %11.4f %9.4f %-40s %s", F.col("s_suppkey"), n, F.lit(52.5), 13.0 + n / 10, F.col("s_name"),
        F.lit("Berlin")).alias("value"))
    heads = r.region.limit(1).select(F.explode(F.array(F.lit("Stations_id von_datum bis_datum"), F.lit("----------- --------- ---------"))).alias("value"))
    with scratch(r, "stations") as folder:
        heads.union(lines).write.text(folder)
        return cut_lineage(IO.read_stations(r.spark, folder).drop("geometry"))


DOCUMENT_HOURS = 10_000    # span of event ids in one document, so that documents multiply with the table


@query("read_hourly_weather", """
SELECT CAST(2 AS BIGINT) AS tile_id, ts, value AS ghi, value / 2 AS temp, CASE WHEN event_id % 4 > 0 THEN value / 8 END AS rainfall_mm FROM events""")
def read_hourly_weather(r: Roles) -> DataFrame:
    """Events as the service's nested documents, a day in parts of bounded size; rain is not always delivered."""
    named = {ours: theirs for theirs, ours in HOURLY_FIELDS.items()}
    v = F.col("value")
    period = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("StartTime"), v.alias(named["ghi"]), (v / 2).alias(named["temp"]),
                      F.when(F.col("event_id") % 4 > 0, v / 8).alias(named["rainfall_mm"]))
    parts = r.events.groupBy(F.to_date("ts").alias("day"), F.floor(F.col("event_id") / DOCUMENT_HOURS).alias("part")).agg(F.collect_list(period).alias("p"))
    documents = parts.select(F.array(F.struct(F.struct(F.col("p").alias("WeatherDataPeriods")).alias("WeatherDataPeriods"))).alias("WeatherDataResults"))
    with scratch(r, "hourly") as folder:
        documents.write.option("maxRecordsPerFile", 1).json(folder)
        read = IO.read_hourly_weather(r.spark, folder, 2).select("tile_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "ghi", "temp", "rainfall_mm")
        return cut_lineage(read)


def _square(x: str, y: str, side: str) -> str:
    """Coordinates of a closed ring as JSON, in SQL."""
    corners = [(x, y), (f"({x} + {side})", y), (f"({x} + {side})", f"({y} + {side})"), (x, f"({y} + {side})"), (x, y)]
    return "concat('[', " + ", ',', ".join(f"concat('[', {a}, ',', {b}, ']')" for a, b in corners) + ", ']')"


_ODD = "n_nationkey % 2 = 1"
_RING = _square("n_nationkey", "n_regionkey", "2")


def _features() -> Column:
    """Odd nations are MultiPolygons of two parts, even ones plain Polygons; one has no geometry."""
    geometry = f"""CASE WHEN n_nationkey = 3 THEN 'null' WHEN {_ODD} THEN concat('{{"type":"MultiPolygon","coordinates":[[', {_RING}, '],[',
 {_square("(n_nationkey + 100)", "n_regionkey", "1")}, ']]}}') ELSE concat('{{"type":"Polygon","coordinates":[', {_RING}, ']}}') END"""
    return F.expr(f"""concat('{{"type":"Feature","properties":{{"name":"', n_name, '","k":', n_nationkey, '}},"geometry":', {geometry}, '}}')""")


_PARTS = f"""SELECT n_name AS name, n_nationkey AS k, CASE WHEN n_nationkey = 3 THEN NULL WHEN {_ODD} THEN 2 ELSE 1 END AS parts,
 CASE WHEN n_nationkey <> 3 THEN CASE WHEN {_ODD} THEN n_nationkey + 101.0::DOUBLE ELSE n_nationkey + 2.0::DOUBLE END END AS x FROM nation"""


def _summary(df: DataFrame) -> DataFrame:
    """Number of parts and the largest x: the geometry as plain columns."""
    xs = F.flatten(F.flatten(F.col("geometry")))
    return df.select("name", "k", F.when(F.col("geometry").isNotNull(), F.size("geometry")).alias("parts"),
                     F.array_max(F.transform(xs, lambda p: p["x"])).alias("x"))


@query("read_geojson", _PARTS)
def read_geojson(r: Roles) -> DataFrame:
    """Polygons and multi-polygons in one file, one feature a line."""
    with scratch(r, "features") as folder:
        r.nation.select(_features().alias("value")).write.text(folder)
        return cut_lineage(_summary(IO.read_geojson(r.spark, folder, "name string, k int", "multi", lines=True)))


@query("read_mask", f"SELECT name, parts, x FROM ({_PARTS})")
def read_mask(r: Roles) -> DataFrame:
    """The same as whole documents, one a region."""
    documents = r.nation.groupBy("n_regionkey").agg(F.concat(
        F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(_features()), ","), F.lit("]}")).alias("value"))
    with scratch(r, "mask") as folder:
        documents.select("value").write.option("maxRecordsPerFile", 1).text(folder)
        read = IO.read_mask(r.spark, folder).withColumn("k", F.lit(0))
        return cut_lineage(_summary(read).drop("k"))


@query("read_geojson_cut", "SELECT c_name AS name, c_custkey AS k, c_custkey / 8 AS x, c_nationkey / 4 AS y FROM customer")
def read_geojson_cut(r: Roles) -> DataFrame:
    """Collections of a thousand features a line, cut at the features, so that any task may read any of them."""
    begin = '{"type":"Feature"'
    feature = F.concat(F.lit(begin), F.expr("""concat(',"properties":{"name":"', c_name, '","k":', c_custkey, '},"geometry":{"type":"Point","coordinates":[', c_custkey / 8, ',', c_nationkey / 4, ']}}')"""))
    documents = r.customer.groupBy(F.floor(F.col("c_custkey") / 1000)).agg(F.concat(
        F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("value"))
    with scratch(r, "collections") as folder:
        documents.select("value").write.text(folder)
        df = IO.read_geojson(r.spark, folder, "name string, k bigint", separator=begin)
        return cut_lineage(df.select("name", "k", F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y")))


@query("read_features_points", "SELECT c_name AS name, c_custkey AS k, c_custkey / 8 AS x, c_nationkey / 4 AS y FROM customer")
def read_features_points(r: Roles) -> DataFrame:
    line = F.expr("""concat('{"properties":{"name":"', c_name, '","k":', c_custkey, '},"geometry":{"type":"Point","coordinates":[', c_custkey / 8, ',', c_nationkey / 4, ']}}')""")
    with scratch(r, "points") as folder:
        r.customer.select(line.alias("value")).write.text(folder)
        read = IO.read_features(r.spark, folder, "geojsonl", "name string, k bigint")
        return cut_lineage(read.select("name", "k", "geometry.x", "geometry.y"))


_POSITIONS = "concat_ws(' ', n_nationkey, n_regionkey, n_nationkey + 2, n_regionkey, n_nationkey + 2, n_regionkey + 2, n_nationkey, n_regionkey)"


@query("read_gml", f"""
SELECT n_name AS name, n_nationkey AS k, CASE WHEN {_ODD} THEN 2 ELSE 1 END AS parts, n_nationkey + 2.0::DOUBLE AS x FROM nation""")
def read_gml(r: Roles) -> DataFrame:
    """Plain polygons and surfaces of several members side by side."""
    polygon = f"concat('<Polygon><exterior><LinearRing><posList>', {_POSITIONS}, '</posList></LinearRing></exterior></Polygon>')"
    member = f"concat('<surfaceMember>', {polygon}, '</surfaceMember>')"
    shape = f"CASE WHEN {_ODD} THEN concat('<MultiSurface>', {member}, {member}, '</MultiSurface>') ELSE {polygon} END"
    line = F.expr(f"concat('<district><name>', n_name, '</name><k>', n_nationkey, '</k><geom>', {shape}, '</geom></district>')")
    documents = r.nation.groupBy("n_regionkey").agg(F.concat(
        F.lit("<collection>"), F.array_join(F.collect_list(line), ""), F.lit("</collection>")).alias("value"))
    with scratch(r, "gml") as folder:
        documents.select("value").write.option("maxRecordsPerFile", 1).text(folder)
        return cut_lineage(_summary(IO.read_features(r.spark, folder, "gml", "name string, k int", "multi", "fis:district")))


@query("read_rain_cells", """
SELECT CAST(l_shipdate AS TIMESTAMP) AS ts, CAST(l_partkey AS INTEGER) AS x, CAST(l_suppkey AS INTEGER) AS y, l_quantity AS rainfall_mm FROM lineitem""")
def read_rain_cells(r: Roles) -> DataFrame:
    cells = r.lineitem.select(F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_partkey").cast("int").alias("x"),
                              F.col("l_suppkey").cast("int").alias("y"), F.col("l_quantity").alias("rainfall_mm"))
    with scratch(r, "rain") as folder:
        cells.write.parquet(f"{folder}/hourly")
        read = IO.read_rain_cells(r.spark, folder)
        return cut_lineage(read.select(F.col("ts").cast("timestamp_ntz").alias("ts"), "x", "y", "rainfall_mm"))


@query("read_shading", "SELECT CAST(c_custkey AS VARCHAR) AS tree_id, " + ", ".join(
    f"CASE WHEN c_custkey % {i + 2} > 0 THEN c_acctbal * {i} END AS {m}" for i, m in enumerate(MONTHS, start=1)) + " FROM customer")
def read_shading(r: Roles) -> DataFrame:
    """Twelve months under other names, some empty."""
    k = F.col("c_custkey")
    months = [F.when(k % (i + 2) > 0, F.col("c_acctbal") * i).alias(f"m{i}") for i in range(1, 13)]
    with scratch(r, "shading") as folder:
        K.write_csv(r.customer.select(text("c_custkey").alias("id"), *months), folder)
        return cut_lineage(IO.read_shading_monthly(r.spark, folder))


@query("read_raster", with_roles("raster") + 'SELECT raster_id, "row", col, value FROM raster')
def read_raster(r: Roles) -> DataFrame:
    with scratch(r, "raster") as folder:
        r.raster.write.parquet(folder)
        return cut_lineage(IO.read_raster_cells(r.spark, folder).select("raster_id", "row", "col", "value"))


RECORD_FOLDS = 1000        # span of order keys whose folds one record carries


@query("experiment_log", """
SELECT CAST(o_orderpriority AS VARCHAR) AS experiment_id, round(avg(o_totalprice) + 1e-9, 4) AS rmse, count(*) AS folds, 'forest' AS model FROM orders GROUP BY 1""")
def experiment_log(r: Roles) -> DataFrame:
    """Figures per priority in records of bounded size, of two runs, appended one after the other."""
    means = r.orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("v"))
    parts = r.orders.groupBy("o_orderpriority", F.floor(F.col("o_orderkey") / RECORD_FOLDS)).agg(F.count("*").alias("n"))
    figures = parts.join(means, "o_orderpriority")
    metric = F.struct(F.col("v").alias("rmse"), F.lit(0.5).alias("mae"))
    cols = {f"Mean {d}cm": metric for d in (30, 60, 90)}
    cols |= {f"Folds {d}cm": F.array_repeat(metric, F.col("n").cast("int")) for d in (30, 60, 90)}
    records = figures.select(F.col("o_orderpriority").alias("experiment_id"), *[c.alias(n) for n, c in cols.items()], F.lit("forest").alias("model"),
                             F.array(F.lit("month")).alias("features"), F.create_map(F.lit("trees"), F.lit("300")).alias("hyper_parameters"))
    with scratch(r, "experiments") as folder:
        for part in (F.col("experiment_id") < "3", F.col("experiment_id") >= "3"):
            K.log_experiment(records.where(part), folder)
        read = IO.read_experiments(r.spark, folder)
        whole = read.groupBy("experiment_id", "model").agg(
            F.max("`Mean 60cm`.rmse").alias("rmse"), F.sum(F.size("`Folds 90cm`")).alias("folds"))
        return cut_lineage(rounded(whole.select("experiment_id", "rmse", "folds", "model"), "rmse"))


# --- load strategies on tables ------------------------------------------------------------------

_LOADED = "k bigint, amount double, date date"


def _day_rows(r: Roles) -> DataFrame:
    return r.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("amount"),
                           F.trunc(F.to_date("o_orderdate"), "year").alias("date"))


_DAY_SQL = "SELECT o_orderkey AS k, o_totalprice AS amount, CAST(date_trunc('year', o_orderdate) AS DATE) AS date FROM orders"


@query("table_append", _DAY_SQL)
def table_append(r: Roles) -> DataFrame:
    """Three appends, and a load that finds rows and leaves them."""
    with scratch_table(r, "appended", _LOADED, "date") as table:
        for i in range(3):
            K.append(_day_rows(r).where(F.col("k") % 3 == i), table)
        if K.load_once(_day_rows(r), table):
            raise AssertionError("the table has rows already")
        return cut_lineage(K.current(r.spark, table))


@query("table_replace_range", f"""
WITH o AS ({_DAY_SQL}) SELECT k, amount, date FROM o WHERE date < DATE '1997-01-01' OR date >= DATE '1999-01-01'
UNION ALL SELECT k, -amount, date FROM o WHERE date = DATE '1997-01-01' AND k % 2 = 0""")
def table_replace_range(r: Roles) -> DataFrame:
    """Two years deleted, one of them delivered anew; the other's partition goes."""
    rows = _day_rows(r)
    with scratch_table(r, "ranged", _LOADED, "date") as table:
        K.append(rows, table)
        fresh = rows.where((F.col("date") == F.lit(dt.date(1997, 1, 1))) & (F.col("k") % 2 == 0)).withColumn("amount", -F.col("amount"))
        for _ in range(2):       # a repeated run leaves the same table
            K.replace_range(fresh, table, "date", dt.date(1997, 1, 1), dt.date(1999, 1, 1))
        return cut_lineage(K.current(r.spark, table))


@query("table_upsert", f"""
WITH o AS ({_DAY_SQL}) SELECT k, CASE WHEN k % 4 = 0 THEN 0.0 ELSE amount END AS amount,
 CASE WHEN k % 8 = 0 THEN CAST(date + INTERVAL 1 YEAR AS DATE) ELSE date END AS date FROM o""")
def table_upsert(r: Roles) -> DataFrame:
    """All rows but a quarter are there; a third comes anew, some of them twice and with another day."""
    k, rows = F.col("k"), _day_rows(r)
    moved = F.when(k % 8 == 0, F.add_months("date", 12)).otherwise(F.col("date"))
    with scratch_table(r, "upserted", _LOADED, "date") as table:
        K.append(rows.where((k % 4 != 0) | (k % 16 == 0)), table)
        late = rows.where(k % 4 == 0).withColumns({"amount": F.lit(0.0), "date": moved})
        early = late.where(k % 8 == 0).withColumns({"amount": F.lit(-1.0), "date": F.add_months("date", -24)})
        K.upsert(late.union(early), table, ["k"], "date")
        return cut_lineage(K.current(r.spark, table))


@query("table_replace", f"SELECT k, amount * 2 AS amount, date FROM ({_DAY_SQL})")
def table_replace(r: Roles) -> DataFrame:
    """A full replacement whose write fails and leaves the rows, then one from the table itself."""
    with scratch_table(r, "replaced", _LOADED, None) as table:
        K.append(_day_rows(r), table)
        try:
            K.replace(K.current(r.spark, table).withColumn("amount", F.raise_error(F.lit("lost")).cast("double")), table)
        except Exception as e:  # noqa: BLE001
            if "lost" not in str(e):
                raise
        K.replace(K.current(r.spark, table).withColumn("amount", F.col("amount") * 2), table)
        return cut_lineage(K.current(r.spark, table))


@query("view_refresh", f"SELECT date, count(*) AS n, sum(CAST(k AS HUGEINT))::BIGINT AS s FROM ({_DAY_SQL}) GROUP BY 1")
def view_refresh(r: Roles) -> DataFrame:
    """Two views written after what they read, whatever the order they are given in."""
    names = [f"{n}_{uuid.uuid4().hex}" for n in ("per_day", "base")]
    views = {names[0]: ([names[1]], lambda: r.spark.table(names[1]).groupBy("date").agg(F.count("*").alias("n"), F.sum("k").alias("s"))),
             names[1]: ([], lambda: _day_rows(r))}
    try:
        if K.refresh(r.spark, views) != names[::-1]:
            raise AssertionError("a view was written before what it reads")
        return cut_lineage(r.spark.table(names[0]))
    finally:
        for n in names:
            r.spark.sql(f"DROP TABLE IF EXISTS {n}")


_BY_DAY = "SELECT user_id AS tile_id, CAST(ts AS DATE) AS date, sum(value) AS rainfall_mm FROM events GROUP BY 1, 2"


@query("view_by_change", f"""
WITH d AS ({_BY_DAY}), v AS (SELECT tile_id, date, sum(rainfall_mm) OVER (PARTITION BY tile_id ORDER BY date ROWS 13 PRECEDING) AS s FROM d)
SELECT tile_id, date, round(s + 1e-9, 4) AS rainfall_mm_14d_sum FROM v""")
def view_by_change(r: Roles) -> DataFrame:
    """Trailing rain built without one day, which comes late: only that day and those that look back on it are written."""
    daily = r.events.groupBy(F.col("user_id").alias("tile_id"), F.to_date("ts").alias("date")).agg(F.sum("value").alias("rainfall_mm"))
    daily = cut_lineage(daily)
    late = F.date_add(daily.agg(F.min("date")).scalar(), 5)
    view = f"trailing_{uuid.uuid4().hex}"

    def bring_up() -> list[dt.date]:
        return K.refresh_trailing(r.spark, view, table, ["tile_id"], 14, V.radolan_14d_agg)

    with scratch_table(r, "rain", "tile_id bigint, rainfall_mm double, date date", "date") as table:
        try:
            K.append(daily.where(F.col("date") != late), table)
            first = bring_up()
            K.append(daily.where(F.col("date") == late), table)
            if bring_up() == first or bring_up():
                raise AssertionError("days without a change were written")
            return cut_lineage(rounded(K.current(r.spark, view), "rainfall_mm_14d_sum"))
        finally:
            for name in (view, f"{view}_built"):
                r.spark.sql(f"DROP TABLE IF EXISTS {name}")


@query("paged", """
SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 400 AS INTEGER) AS page FROM orders QUALIFY row_number() OVER (ORDER BY o_orderkey) <= 1200""")
def paged(r: Roles) -> DataFrame:
    """Three pages one after the other from one ranking."""
    parts = [p.withColumn("page", F.lit(i)) for i, p in enumerate(K.pages(r.orders.select("o_orderkey"), ["o_orderkey"], 400, 3))]
    return parts[0].union(parts[1]).union(parts[2])


@query("stored_model", """
WITH f AS (SELECT l_linenumber AS type_id, regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b
 FROM lineitem GROUP BY 1)
SELECT p_partkey, type_id, round(a * p_size + b, 2) AS y FROM part, f""")
def stored_model(r: Roles) -> DataFrame:
    """Linear models per kind, saved, loaded and applied."""
    from pyspark.ml.regression import LinearRegression
    rows = r.lineitem.select(F.col("l_linenumber").alias("type_id"), "l_quantity", F.col("l_extendedprice").alias("target"))
    kinds = sorted(x["type_id"] for x in rows.select("type_id").distinct().collect())       # line numbers: a few
    fitted = {k: M.train(rows.where(F.col("type_id") == k), ["l_quantity"], LinearRegression(solver="normal")) for k in kinds}
    with scratch(r, "models") as folder:
        M.save_models(fitted, folder)
        loaded = M.load_models(folder, kinds, kind="LinearRegressionModel")
    df = r.part.select("p_partkey", "p_size")
    for k, model in loaded.items():
        df = M.score(df, model, [F.col("p_size")], f"y{k}")
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("type_id"), F.round(F.col(f"y{k}"), 2).alias("y")) for k in loaded]))
    return df.select("p_partkey", each.alias("e")).select("p_partkey", "e.*")
