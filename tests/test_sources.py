import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from canopy.constants import MONTHS
from canopy.schemas import SCHEMAS
from canopy.sources import readers as S, sinks as K

D, T = dt.date, dt.datetime


def test_observations(spark, tmp_path):
    (tmp_path / "o.txt").write_text(
        "STATIONS_ID;MESS_DATUM;QN_3;  FX;  FM;QN_4; RSK;RSKF; TMK; UPM; TXK;eor\n"
        "        433;20240501;   10;  12.5;   3.1;    3;   0.4;   6;  14.2;  61.0;  -999;eor\n"
        "        433;20240502; -999;-999.0;   2.0;    3;  -999;   6;  -9.9;  61.0;  20.1;eor\n")
    df = S.to_weather(S.read_observations(spark, str(tmp_path / "o.txt"))).orderBy("date")
    a, b = df.collect()
    assert (a.date, a.stations_id, a.wind_max_ms, a.rainfall_mm, a.temp_max_c) == (D(2024, 5, 1), 433, 12.5, 0.4, None)
    assert (b.qn_3, b.wind_max_ms, b.rainfall_mm, b.temp_avg_c) == (None, None, None, -9.9)
    assert "eor" not in df.columns


def test_stations(spark, tmp_path):
    text = ("Stations_id von_datum bis_datum Stationshoehe geoBreite geoLaenge Stationsname Bundesland\n"
            "----------- --------- --------- ------------- --------- --------- ------------ ----------\n"
            "00433 19480101 20240501             48     52.4676   13.4020 Berlin-Tempelhof                         Berlin\n"
            "00044 19690101 20240501             44     52.9336    8.2370 Großenkneten am Ort                      Niedersachsen    Frei\n")
    (tmp_path / "s.txt").write_bytes(text.encode("latin-1"))
    rows = {r.id: r for r in S.read_stations(spark, str(tmp_path / "s.txt")).collect()}
    assert rows[433].lat == 52.4676 and rows[433].geometry.x == 13.402 and rows[433].von_datum == D(1948, 1, 1)
    assert (rows[44].stationsname, rows[44].bundesland) == ("Großenkneten am Ort", "Niedersachsen")
    assert S.read_stations(spark, str(tmp_path / "s.txt"), [433]).count() == 1


def test_hourly_weather(spark, tmp_path):
    period = {"StartTime": "2024-05-01T00:00:00+02:00", "GlobalHorizontalIrradiance_WattsPerMeterSquared": 1,
              "AmbientTemperature_DegreesC": 12.5, "WindSpeed_MetersPerSecond": 3}
    doc = {"Status": "Done", "WeatherDataResults": [{"WeatherDataPeriods": {"WeatherDataPeriods": [period]}}]}
    (tmp_path / "w.json").write_text(json.dumps(doc, indent=2))
    r = S.read_hourly_weather(spark, str(tmp_path / "w.json"), 2).first()
    assert (r.tile_id, r.ts, r.ghi, r.temp, r.wind, r.rainfall_mm) == (2, T(2024, 4, 30, 22), 1.0, 12.5, 3.0, None)


def test_geojson_points_and_lines(spark, tmp_path):
    feature = {"type": "Feature", "properties": {"baumid": "b1", "gattung": "Tilia"}, "geometry": {"type": "Point", "coordinates": [13.4, 52.5]}}
    (tmp_path / "f.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature, feature]}, indent=1))
    (tmp_path / "l.geojson").write_text("\n".join([json.dumps(feature)] * 3))
    df = S.read_features(spark, str(tmp_path / "f.geojson"), "geojson", "baumid string, gattung string")
    assert df.count() == 2 and df.first().geometry.y == 52.5 and df.first().baumid == "b1"
    assert S.read_features(spark, str(tmp_path / "l.geojson"), "geojsonl", "baumid string").count() == 3
    with pytest.raises(ValueError):
        S.read_features(spark, "x", "shp", "a string")


def test_mask_of_multi_polygons(spark, tmp_path):
    square = [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]
    doc = {"features": [{"properties": {"name": "Mitte"}, "geometry": {"type": "MultiPolygon", "coordinates": square}}]}
    (tmp_path / "m.geojson").write_text(json.dumps(doc))
    r = S.read_mask(spark, str(tmp_path / "m.geojson")).first()
    assert r.name == "Mitte" and [(p.x, p.y) for p in r.geometry[0][0]][1] == (1.0, 0.0)


GML = """<?xml version="1.0"?><c:FeatureCollection xmlns:c="http://x/c" xmlns:f="http://x/f" xmlns:g="http://x/g">
<c:member><f:tree g:id="1"><f:baumid>b1</f:baumid><f:standalter>12</f:standalter>
 <f:geom><g:Point><g:pos>389917.8 5819699.6</g:pos></g:Point></f:geom></f:tree></c:member>
<c:member><f:tree g:id="2"><f:baumid>b2</f:baumid><f:geom><g:Point><g:pos>1 2</g:pos></g:Point></f:geom></f:tree></c:member>
</c:FeatureCollection>"""
SOIL = """<?xml version="1.0"?><c:FeatureCollection xmlns:c="http://x/c" xmlns:f="http://x/f" xmlns:g="http://x/g">
<c:member><f:soil><f:id>s1</f:id><f:geom><g:MultiSurface><g:surfaceMember><g:Polygon>
 <g:exterior><g:LinearRing><g:posList>0 0 9 0 9 9 0 0</g:posList></g:LinearRing></g:exterior>
 <g:interior><g:LinearRing><g:posList>1 1 2 1 2 2 1 1</g:posList></g:LinearRing></g:interior>
</g:Polygon></g:surfaceMember></g:MultiSurface></f:geom></f:soil></c:member></c:FeatureCollection>"""


def test_gml(spark, tmp_path):
    (tmp_path / "t.xml").write_text(GML)
    (tmp_path / "s.xml").write_text(SOIL)
    df = S.read_features(spark, str(tmp_path / "t.xml"), "gml", "baumid string, standalter double", row_tag="f:tree")
    got = {r.baumid: (r.standalter, r.geometry.x, r.geometry.y) for r in df.collect()}
    assert got == {"b1": (12.0, 389917.8, 5819699.6), "b2": (None, 1.0, 2.0)}
    soil = S.read_features(spark, str(tmp_path / "s.xml"), "gml", "id string", "multi", "f:soil").first()
    assert len(soil.geometry) == 1 and len(soil.geometry[0]) == 2 and soil.geometry[0][0][1].x == 9.0 and soil.geometry[0][1][2].y == 2.0


def test_shading_months_are_taken_by_position(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id," + ",".join(f"m{i}" for i in range(12)) + "\nb1," + ",".join(str(i / 10) for i in range(12)) + "\n")
    r = S.read_shading_monthly(spark, str(tmp_path / "s.csv")).first()
    assert (r.tree_id, r.january, r.december) == ("b1", 0.0, 1.1) and r.asDict().keys() == {"tree_id", *MONTHS}


def test_rain_products(spark, tmp_path):
    spark.createDataFrame([(T(2024, 1, 1), 1, 2, 0.5)], SCHEMAS["rain_cells"]).write.parquet(str(tmp_path / "hourly"))
    assert S.read_rain_cells(spark, str(tmp_path)).first().rainfall_mm == 0.5
    with pytest.raises(ValueError):
        S.read_rain_cells(spark, str(tmp_path), "weekly")


def test_raster_corners_and_seasonal_shading(spark, tmp_path):
    spark.createDataFrame([("m", 0, 1, 2.5)], SCHEMAS["raster_cells"]).write.parquet(str(tmp_path / "cells"))
    spark.createDataFrame([("m", 0.0, 0.0, 1.0, -1.0, 1, 2)], SCHEMAS["raster_transform"]).write.parquet(str(tmp_path / "place"))
    spark.createDataFrame([(1, 2, 13.0, 52.0)], SCHEMAS["lattice_corners"]).write.parquet(str(tmp_path / "corners"))
    (tmp_path / "s.csv").write_text("tree_id,spring,summer,fall,winter\nb1,0.1,0.2,0.3,\n")
    assert S.read_raster_cells(spark, str(tmp_path / "cells")).first().value == 2.5
    assert S.read_raster_transform(spark, str(tmp_path / "place")).first().n_cols == 2
    assert S.read_corners(spark, str(tmp_path / "corners")).first().lat == 52.0
    r = S.read_shading(spark, str(tmp_path / "s.csv")).first()
    assert (r.fall, r.winter) == (0.3, None)


def test_tables_are_pruned_and_filtered_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.lit("x").alias("s"), F.col("id").alias("v")).write.parquet(path)
    df = S.read_table(spark, path, ["id"], "v > 7")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 2 and "GreaterThan(v,7)" in plan and "s:string" not in plan
    assert not S.table_exists(spark, "no_such_table")


def test_seeds(spark):
    seeds = S.seed_dimensions(spark)
    assert [r.name for r in seeds["sensor_types"].orderBy("id").collect()][3] == "saugspannung_stamm"
    assert {r.id for r in seeds["weather_tiles"].collect()} == {2, 3} and seeds["issue_types"].count() == 2
    assert len(seeds["weather_tiles"].where("id = 2").first().geometry) == 5


def test_all_schemas_parse(spark):
    for name, ddl in SCHEMAS.items():
        assert spark.createDataFrame([], ddl).columns, name
    assert len(spark.createDataFrame([], SCHEMAS["shading_monthly"]).columns) == 13


def test_experiment_log(spark, tmp_path):
    path = str(tmp_path / "log")
    m = (12.34, 9.0)
    row = [("e1", m, m, m, [m, m], [m], [m], "Forest", ["a", "b"], {"numTrees": "3"})]
    ddl = ", ".join(f"`{c}` {t}" for c, t in zip(K.EXPERIMENT_COLUMNS, [
        "string", *["struct<rmse: double, mae: double>"] * 3, *["array<struct<rmse: double, mae: double>>"] * 3, "string",
        "array<string>", "map<string, string>"]))
    for _ in range(2):
        K.log_experiment(spark.createDataFrame(row, ddl), path)
    out = S.read_experiments(spark, path)
    assert out.count() == 2
    r = out.first()
    assert r["Mean 30cm"].rmse == 12.34 and len(r["Folds 30cm"]) == 2 and r.features == ["a", "b"] and r.hyper_parameters["numTrees"] == "3"


def test_geometries_of_both_kinds_and_unknown_types(spark, tmp_path):
    ring_ = "[[0,0],[4,0],[4,4],[0,0]]"
    features = [f'{{"properties":{{"name":"p"}},"geometry":{{"type":"Polygon","coordinates":[{ring_}]}}}}',
                f'{{"properties":{{"name":"m"}},"geometry":{{"type":"MultiPolygon","coordinates":[[{ring_}],[{ring_}]]}}}}',
                '{"properties":{"name":"n"},"geometry":null}']
    path = tmp_path / "mask.geojson"
    path.write_text('{"features":[' + ",".join(features) + "]}")
    got = {r.name: r.geometry for r in S.read_mask(spark, str(path)).collect()}
    assert len(got["p"]) == 1 and len(got["m"]) == 2 and got["n"] is None
    assert [(v.x, v.y) for v in got["p"][0][0]] == [(0, 0), (4, 0), (4, 4), (0, 0)]
    path.write_text('{"features":[{"properties":{"name":"x"},"geometry":{"type":"LineString","coordinates":[[0,0],[1,1]]}}]}')
    with pytest.raises(Exception, match="LineString"):
        S.read_mask(spark, str(path)).collect()


def test_a_polygon_district_keeps_its_cells(spark, tmp_path, rows):
    from canopy.operators import spatial as SP
    path = tmp_path / "district.geojson"
    path.write_text('{"features":[{"properties":{"name":"p"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1.5,0],[1.5,1.5],[0,1.5],[0,0]]]}}]}')
    corners = spark.createDataFrame([(x, y, float(x), float(y)) for x in range(5) for y in range(5)], "x int, y int, lon double, lat double")
    kept = SP.restrict_to_mask(SP.lattice_to_cells(corners, (0, None), (0, 5)), S.read_mask(spark, str(path)), "id", mask_kind="multi")
    assert rows(kept, "x", "y") == [(0, 0), (0, 1), (1, 0), (1, 1)]


def test_documents_and_records_multiply_with_the_table(spark, monkeypatch):
    from types import SimpleNamespace

    from canopy.plans import q_sources as Q
    sizes = {}

    def watched(name, reader, entries):
        def read(session, folder, *rest):
            df = reader(session, folder, *rest)
            sizes[name] = [r[0] for r in entries(session, folder, df).collect()]
            return df
        return read

    document = "size(WeatherDataResults[0].WeatherDataPeriods.WeatherDataPeriods)"
    monkeypatch.setattr(Q.IO, "read_hourly_weather", watched(
        "hours", Q.IO.read_hourly_weather, lambda s, folder, _: s.read.option("multiLine", True).json(folder).selectExpr(document)))
    monkeypatch.setattr(Q.IO, "read_experiments", watched(
        "folds", Q.IO.read_experiments, lambda s, folder, df: df.selectExpr("size(`Folds 90cm`)")))
    # One hot day and one hot priority.
    events = spark.range(25_000).selectExpr("id as event_id", "timestamp_ntz'2024-01-01 12:00:00' as ts", "cast(id as double) as value")
    orders = spark.range(25_000).selectExpr("id as o_orderkey", "'1-URGENT' as o_orderpriority", "cast(id as double) as o_totalprice")
    r = SimpleNamespace(spark=spark, events=events, orders=orders)
    assert Q.read_hourly_weather(r).count() == 25_000
    assert [tuple(x) for x in Q.experiment_log(r).collect()] == [("1-URGENT", 12499.5, 25_000, "forest")]
    assert sum(sizes["hours"]) == sum(sizes["folds"]) == 25_000
    assert max(sizes["hours"]) <= 10_000 and max(sizes["folds"]) <= 1000


SEPARATOR = '{"type":"Feature"'


def collection(n, start=SEPARATOR, sep=","):
    each = [f'{start},"properties":{{"id":"t{i}","note":"a }}],{{ b"}},"geometry":{{"type":"Point","coordinates":[{i}.5,{i % 7}]}}}}' for i in range(n)]
    return '{"type":"FeatureCollection","features":[' + sep.join(each) + '],"crs":{"type":"name"}}'


def test_a_collection_on_one_line_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "city.geojson"
    path.write_text(collection(100_000))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        df = S.read_geojson(spark, str(path), "id string, note string", separator=SEPARATOR)
        per_task = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert len(per_task) > 5 and sum(per_task) == 100_000
    assert df.agg(F.countDistinct("id"), F.sum("geometry.x")).first()[:] == (100_000, sum(i + 0.5 for i in range(100_000)))


def test_separated_collections_of_other_layouts(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "pretty.json").write_text(collection(3, sep=",\n  "))
    (tmp_path / "a" / "two.json").write_text(collection(2) + "\n" + collection(2))
    (tmp_path / "a" / "none.json").write_text(collection(0))
    assert S.read_geojson(spark, str(tmp_path / "a"), "id string", separator=SEPARATOR).count() == 7
    (tmp_path / "b.json").write_text(collection(3, start='{ "type": "Feature"'))
    with pytest.raises(Exception, match="separator"):
        S.read_geojson(spark, str(tmp_path / "b.json"), "id string", separator=SEPARATOR).count()
    (tmp_path / "c.json").write_text(collection(2).replace('"t1"', '"t1'))
    with pytest.raises(Exception):
        S.read_geojson(spark, str(tmp_path / "c.json"), "id string", separator=SEPARATOR).collect()
