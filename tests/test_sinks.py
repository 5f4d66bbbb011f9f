import datetime as dt
import uuid

import pytest

from canopy.sources import sinks as K

D, T = dt.date, dt.datetime
SCHEMA = "tree_id string, v double, date date"


@pytest.fixture
def db(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


@pytest.fixture
def table(spark, db):
    K.create_table(spark, f"{db}.t", SCHEMA, "date")
    K.append(frame(spark, ("a", 1.0, D(2024, 1, 1)), ("b", 2.0, D(2024, 1, 1)), ("a", 3.0, D(2024, 1, 2)), ("a", 4.0, D(2024, 1, 5))), f"{db}.t")
    return f"{db}.t"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def content(spark, rows, table):
    return rows(spark.table(table), "date", "tree_id", "v")


def test_append_and_replace(spark, rows, db):
    K.append(frame(spark, ("a", 1.0, D(2024, 1, 1))), f"{db}.x")
    K.append(frame(spark, ("b", 1.0, D(2024, 1, 1))), f"{db}.x")
    assert spark.table(f"{db}.x").count() == 2
    K.replace(frame(spark, ("c", 1.0, D(2024, 1, 1))), f"{db}.x")
    assert rows(spark.table(f"{db}.x"), "tree_id") == [("c",)]


def test_replace_range_deletes_days_without_new_rows(spark, rows, table):
    new = frame(spark, ("c", 9.0, D(2024, 1, 3)))
    for _ in range(2):      # a repeated run changes nothing
        K.replace_range(new, table, "date", D(2024, 1, 2))
        assert content(spark, rows, table) == [(D(2024, 1, 1), "a", 1.0), (D(2024, 1, 1), "b", 2.0), (D(2024, 1, 3), "c", 9.0)]


def test_replace_range_of_keys(spark, rows, table):
    new = frame(spark, ("b", 8.0, D(2024, 1, 1)), ("b", 7.0, D(2024, 1, 9)))
    K.replace_range(new, table, "date", D(2024, 1, 1), D(2024, 1, 3), new, ["tree_id"])
    assert content(spark, rows, table) == [(D(2024, 1, 1), "a", 1.0), (D(2024, 1, 1), "b", 8.0), (D(2024, 1, 2), "a", 3.0),
                                           (D(2024, 1, 5), "a", 4.0), (D(2024, 1, 9), "b", 7.0)]


def test_upsert(spark, rows, table):
    K.upsert(frame(spark, ("a", 10.0, D(2024, 1, 1)), ("z", 1.0, D(2024, 1, 7))), table, ["tree_id", "date"], "date")
    assert content(spark, rows, table) == [(D(2024, 1, 1), "a", 10.0), (D(2024, 1, 1), "b", 2.0), (D(2024, 1, 2), "a", 3.0),
                                           (D(2024, 1, 5), "a", 4.0), (D(2024, 1, 7), "z", 1.0)]


def test_upsert_of_a_moved_and_a_repeated_key(spark, rows, table):
    new = frame(spark, ("b", 5.0, D(2024, 1, 2)), ("z", 1.0, D(2024, 1, 1)), ("z", 2.0, D(2024, 1, 7)))
    for _ in range(2):
        K.upsert(new, table, ["tree_id"], "date")
        assert content(spark, rows, table) == [(D(2024, 1, 1), "a", 1.0), (D(2024, 1, 2), "a", 3.0), (D(2024, 1, 2), "b", 5.0),
                                               (D(2024, 1, 5), "a", 4.0), (D(2024, 1, 7), "z", 2.0)]
    K.upsert(frame(spark, ("a", 9.0, D(2024, 2, 1))), table, ["tree_id"], "date")
    assert content(spark, rows, table) == [(D(2024, 1, 2), "b", 5.0), (D(2024, 1, 7), "z", 2.0), (D(2024, 2, 1), "a", 9.0)]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == ["date=2024-01-02", "date=2024-01-07", "date=2024-02-01"]


def test_a_failing_replacement_leaves_the_old_rows(spark, rows, db, table):
    K.append(frame(spark, ("a", 1.0, D(2024, 1, 1))), f"{db}.x")
    for name, day in ((f"{db}.x", None), (table, "date")):
        before = content(spark, rows, name)
        bad = frame(spark, ("c", 1.0, D(2024, 1, 1))).selectExpr("tree_id", "cast(raise_error('lost') as double) as v", "date")
        with pytest.raises(Exception, match="lost"):
            K.replace(bad, name, day)
        assert content(spark, rows, name) == before


def test_replace_switches_the_folder(spark, rows, db, table):
    K.append(frame(spark, ("a", 1.0, D(2024, 1, 1))), f"{db}.x")
    old = K.location(spark, f"{db}.x")
    K.replace(spark.table(f"{db}.x").withColumn("v", spark.table(f"{db}.x").v + 1), f"{db}.x")       # from itself
    assert rows(spark.table(f"{db}.x"), "v") == [(2.0,)] and K.location(spark, f"{db}.x") != old
    with pytest.raises(Exception):
        spark.read.parquet(old)
    K.replace(spark.range(3), f"{db}.x")        # other columns
    assert spark.table(f"{db}.x").columns == ["id"] and spark.table(f"{db}.x").count() == 3
    K.append(spark.range(2), f"{db}.x")
    assert spark.table(f"{db}.x").count() == 5
    K.replace(frame(spark, ("q", 1.0, D(2024, 1, 2))), table, "date")
    assert content(spark, rows, table) == [(D(2024, 1, 2), "q", 1.0)]


def test_resume(spark, rows, table):
    old = spark.table(table)
    src = frame(spark, ("a", 1.0, D(2024, 1, 5)), ("a", 1.0, D(2024, 1, 6)), ("b", 1.0, D(2024, 1, 2)), ("n", 1.0, D(2020, 1, 1)))
    point = K.resume_point(old, "date", ["tree_id"])
    assert rows(K.incremental(src, point, "date", ["tree_id"]), "tree_id", "date") == [
        ("a", D(2024, 1, 6)), ("b", D(2024, 1, 2)), ("n", D(2020, 1, 1))]
    whole = K.resume_point(old, "date")
    assert rows(K.incremental(src, whole, "date", inclusive=True), "date") == [(D(2024, 1, 5),), (D(2024, 1, 6),)]
    empty = K.resume_point(old.limit(0), "date", default=D(2021, 12, 31))
    assert empty.first().resume == D(2021, 12, 31) and K.incremental(src, empty, "date").count() == 3


def test_load_once(spark, db):
    df = frame(spark, ("a", 1.0, D(2024, 1, 1)))
    assert K.load_once(df, f"{db}.once") and not K.load_once(df, f"{db}.once")
    assert spark.table(f"{db}.once").count() == 1


def test_rewrite_from_itself(spark, rows, table):
    K.rewrite(spark.table(table).where("tree_id = 'b'"), table, "date")
    assert content(spark, rows, table) == [(D(2024, 1, 1), "b", 2.0)]


def test_retain(spark):
    df = spark.createDataFrame([(T(2024, 1, 1),), (T(2024, 1, 3),)], "ts timestamp")
    assert K.retain(df, "ts", 2, T(2024, 1, 4)).count() == 1


def test_refresh_follows_the_inputs(spark, db):
    views = {f"{db}.late": ([f"{db}.early"], lambda: spark.table(f"{db}.early")),
             f"{db}.early": ([], lambda: spark.range(3))}
    assert K.refresh(spark, views) == [f"{db}.early", f"{db}.late"]
    assert spark.table(f"{db}.late").count() == 3


def test_trailing_views_follow_changed_days(spark, rows, db):
    """A late day, a corrected one and a day that goes: as many days written as look back, and the rows of a full rebuild."""
    from canopy.plans.views import radolan_14d_agg
    start = D(2024, 1, 1)
    def series(days, tile):
        return [(tile, float(d.toordinal() % 17), d) for d in days]
    every = [start + dt.timedelta(days=i) for i in range(40)]
    table, view = f"{db}.rain", f"{db}.trailing"
    K.create_table(spark, table, "tile_id int, rainfall_mm double, date date", "date")

    def load(data):
        K.append(spark.createDataFrame(data, "tile_id int, rainfall_mm double, date date"), table)

    def refresh():
        done = K.refresh_trailing(spark, view, table, ["tile_id"], 14, radolan_14d_agg)
        cols = ["tile_id", "date", "rainfall_mm_14d_sum"]
        assert rows(K.current(spark, view), *cols) == rows(radolan_14d_agg(K.current(spark, table)), *cols)
        return done

    load(series([d for d in every if d != every[10]], 1) + series(every[::3], 2))
    assert refresh() == [d for d in every if d != every[10]] and refresh() == []
    load(series([every[10]], 1))
    assert refresh() == every[10:24]
    K.replace_range(spark.createDataFrame([(1, 99.0, every[30])], "tile_id int, rainfall_mm double, date date"), table, "date", every[30], every[31])
    assert refresh()[0] == every[30]
    K.replace_range(spark.createDataFrame([], "tile_id int, rainfall_mm double, date date"), table, "date", every[20], every[21])
    assert refresh()[0] == every[20] and every[20] not in {r.date for r in spark.table(view).collect()}
    load(series([every[-1] + dt.timedelta(days=1)], 2))
    assert refresh() == [every[-1] + dt.timedelta(days=1)]


def test_csv_and_pages(spark, tmp_path):
    K.write_csv(frame(spark, ("a", 1.0, D(2024, 1, 1))), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().tree_id == "a"
    assert [p.count() for p in K.pages(spark.range(25), ["id"], 10, 3)] == [10, 10, 5]
