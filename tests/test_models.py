"""Fitted forests against their own library, step by step, and against a walk down their table of nodes."""

import datetime as dt

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from canopy.constants import FORECAST_FEATURES, LAG_FEATURES, NOWCAST_FEATURES
from canopy.operators import features as E, growing, models as M
from canopy.operators.forests import Forest, forest_nodes, gain_importances
from canopy.plans.catalog import QUERIES

D = dt.date
SMALL = {"numTrees": 19, "maxDepth": 6, "featureSubsetStrategy": "sqrt"}
FOLDER = "/root/testdata/sf0.001"

WALK = """WITH RECURSIVE w AS (
 SELECT id, tree, x, 0 AS node FROM inputs, (SELECT DISTINCT tree FROM nodes)
 UNION ALL SELECT w.id, w.tree, w.x, CASE WHEN w.x[n.feature + 1] <= n.threshold THEN n."left" ELSE n."right" END
 FROM w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.feature IS NOT NULL)
SELECT w.id, avg(n.value) AS y FROM w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.feature IS NULL GROUP BY 1"""


def walked(nodes, inputs):
    """Mean leaf value of every row (id, x), by a recursive walk in SQL."""
    con = duckdb.connect()
    con.register("nodes", nodes.toArrow())
    con.register("inputs", inputs.toArrow())
    return dict(con.execute(WALK).fetchall())


@pytest.fixture(scope="module")
def readings(spark):
    """Six trees, three depths, forty days; many equal values, so that some meet a threshold."""
    i = F.col("id")
    base = spark.range(6 * 3 * 40).select(
        F.concat(F.lit("t"), i % 6).alias("tree_id"), ((i / 6).cast("int") % 3 + 1).alias("type_id"),
        F.date_add(F.lit(D(2023, 5, 1)), (i / 18).cast("int")).cast("timestamp").alias("timestamp"))
    feats = {c: (F.hash("id", F.lit(n)) % 5).cast("double") for n, c in enumerate(FORECAST_FEATURES)}
    df = base.withColumn("id", F.hash("tree_id", "timestamp")).withColumns(feats).drop("id")
    df = df.withColumn("target", F.col("temp_avg_c") * 2 + F.col("type_id") + F.col("month") * F.col("rainfall_mm"))
    return E.add_lags(df, ["tree_id", "type_id"], "timestamp", "target").cache()


def by_library(model, x):
    """One call of the model's own scorer."""
    from pyspark.ml.linalg import Vectors
    return [model.predict(Vectors.dense(row)) if not np.isnan(row).any() else None for row in x]


def test_flat_arrays_score_like_the_library(spark, readings):
    model = M.train(readings, FORECAST_FEATURES + LAG_FEATURES, M.forest(SMALL))
    nodes = forest_nodes(spark, model)
    flat = Forest.of(model)
    x = np.array([list(r) for r in readings.select(*FORECAST_FEATURES, *LAG_FEATURES).na.drop("any").collect()])
    cuts = [r.threshold for r in nodes.where("threshold is not null").collect()]
    x = np.vstack([x, np.random.default_rng(1).choice(cuts, (50, x.shape[1]))])        # values that equal thresholds
    got = flat(x)
    assert got == pytest.approx(by_library(model, x), abs=1e-12)
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id int, x array<double>")
    seen = walked(nodes, frame)
    assert [seen[i] for i in range(len(x))] == pytest.approx(got.tolist(), abs=1e-12)


def test_a_tree_may_be_a_single_leaf(spark, readings):
    model = M.train(readings.withColumn("target", F.lit(3.5)), LAG_FEATURES, M.forest(SMALL))
    assert Forest.of(model)(np.zeros((2, 3))).tolist() == [3.5, 3.5]


def test_importances_come_from_gains(spark, readings):
    model = M.train(readings, NOW := FORECAST_FEATURES, M.forest(SMALL))
    got = {r.feature: r.importance for r in M.importances(spark, model, NOW).collect()}
    own = {NOW[r.feature]: r.importance for r in gain_importances(forest_nodes(spark, model)).collect()}
    assert {f: own.get(f, 0.0) for f in NOW} == pytest.approx(got, abs=1e-9)


def test_forecast_is_the_library_step_by_step(spark, readings):
    models, aux = M.train_forecast(readings, SMALL), M.train_auxiliary(readings, SMALL)
    last = D(2023, 5, 20)
    base = readings.where(F.col("timestamp") == F.lit(last).cast("timestamp")).where("type_id = 1")
    weather = {last + dt.timedelta(days=i): {c: float((i * 7 + n) % 5) for n, c in enumerate(M._WEATHER)} for i in range(-4, 9)}
    del weather[last + dt.timedelta(days=7)]
    means = {1: 1.0, 2: 2.0, 3: 3.0}
    out = M.forecast(models, aux, base, means, weather, weather, last, dt.datetime(2023, 5, 21), horizon=8)
    got = {(r.tree_id, r.type_id, r.timestamp.date()): r.value for r in out.where("type_id < 4").collect()}
    want = {}
    for r in base.collect():
        def x(k, day, lags):
            values = {**r.asDict(), **weather[day], "mean_yesterday": means[k]}
            return np.array([[values[f] for f in FORECAST_FEATURES] + lags])
        for k in models:
            lags = [by_library(aux[k], x(k, last - dt.timedelta(days=i), []))[0] for i in range(3)]
            for h in range(1, 7):
                day = last + dt.timedelta(days=h)
                lags = [by_library(models[k], x(k, day, lags))[0], *lags[:2]]
                want[r.tree_id, k, day] = lags[0]
    assert got == pytest.approx(want, abs=1e-9)


def test_backtest_is_the_library_step_by_step(spark, readings):
    rows = readings.where("not (tree_id = 't0' and timestamp = timestamp'2023-05-22')")
    model = M.train(rows, FORECAST_FEATURES + LAG_FEATURES, M.forest(SMALL))
    out = M.backtest(rows, [D(2023, 5, 20), D(2023, 6, 1)], [D(2023, 5, 18)], horizon=5, drop_days=9, model=model)
    got = {(r.tree_id, r.type_id, r.timestamp): r.y_pred for r in out.collect()}
    at = {(r.tree_id, r.type_id, r.timestamp.date()): r for r in rows.collect()}
    want = {}
    for start in (D(2023, 5, 20), D(2023, 6, 1)):
        for tree, kind in {(t, k) for t, k, _ in at}:
            first, lags = at.get((tree, kind, start)), None
            for h in range(5):
                r = at.get((tree, kind, start + dt.timedelta(days=h)))
                if first is None or r is None:
                    break
                lags = lags or [first[c] for c in LAG_FEATURES]
                y = by_library(model, np.array([[r[f] for f in FORECAST_FEATURES] + lags]))[0]
                want[tree, kind, start + dt.timedelta(days=h)], lags = y, [y, *lags[:2]]
    assert got == pytest.approx(want, abs=1e-9) and len(got) == 2 * 6 * 3 * 5 - 3 * 3


def test_season_is_the_library_step_by_step(spark, readings):
    rows = readings.where("not (tree_id = 't0' and timestamp = timestamp'2023-05-06')")
    model = M.train_season(rows, D(2023, 5, 30), SMALL)
    out = M.season_forecast(model, rows, D(2023, 5, 1), 12)
    got = {(r.tree_id, r.type_id, r.timestamp): r.y_pred for r in out.collect()}
    at = {(r.tree_id, r.type_id, r.timestamp.date()): r for r in rows.collect()}
    want = {}
    for tree, kind in {(t, k) for t, k, _ in at}:
        lags = [20.0] * 3
        for d in range(12):
            r = at.get((tree, kind, D(2023, 5, 1) + dt.timedelta(days=d)))
            if r is None:
                lags = [20.0] * 3
                continue
            y = by_library(model, np.array([[r[f] for f in FORECAST_FEATURES] + [float(kind)] + lags]))[0]
            want[tree, kind, r.timestamp.date()], lags = y, [y, *lags[:2]]
    assert got == pytest.approx(want, abs=1e-9) and len(got) == 6 * 3 * 12 - 3


def test_backtest_does_not_load_the_librarys_model(readings, monkeypatch):
    monkeypatch.setattr(growing, "_model", None)
    assert M.backtest(readings, [D(2023, 5, 20)], [D(2023, 5, 18)], SMALL, horizon=5, drop_days=9).count() == 6 * 3 * 5


def test_forecast_does_not_load_the_librarys_models(spark, readings, monkeypatch):
    """And hands the tasks the forests of one depth at a time."""
    monkeypatch.setattr(growing, "_model", None)
    models, aux = M.train_forecast(readings, SMALL), M.train_auxiliary(readings, SMALL)
    last, shared = D(2023, 5, 20), []
    base = readings.where((F.col("timestamp") == F.lit(last).cast("timestamp")) & (F.col("type_id") == 1))
    weather = {last + dt.timedelta(days=i): {c: 1.0 for c in M._WEATHER} for i in range(-3, 9)}
    share = spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: shared.append(x) or share(x))
    out = M.forecast(models, aux, base, {1: 1.0, 2: 2.0, 3: 3.0}, weather, weather, last, dt.datetime(2023, 5, 21), horizon=8)
    assert out.count() == 6 * 4 * 8
    assert [len(x) for x in shared] == [2, 2, 2]


def test_season_does_not_load_the_librarys_model(readings, monkeypatch):
    monkeypatch.setattr(growing, "_model", None)
    model = M.train_season(readings, D(2023, 5, 30), SMALL)
    assert M.season_forecast(model, readings, D(2023, 5, 1), 12).count() == 6 * 3 * 12


def test_registered_nowcast_is_the_walk_down_its_forests(spark, monkeypatch):
    """All predictions of the query, its forests cut to a few trees by the one setting."""
    kept = {}
    monkeypatch.setattr(M, "train_nowcast", lambda rows: kept.setdefault("m", M.train_per_type(rows, NOWCAST_FEATURES, SMALL)))
    seen = M.nowcast
    monkeypatch.setattr(M, "nowcast", lambda m, frame, means, *a: kept.update(frame=frame, means=means) or seen(m, frame, means, *a))
    got = {(r.tree_id, r.type_id): r.value for r in QUERIES["train_nowcast"](spark, FOLDER).collect()}
    frame = kept["frame"].na.drop("any", subset=[f for f in NOWCAST_FEATURES if f != "mean_yesterday"])
    want = {}
    for k, model in kept["m"].items():
        cols = [F.lit(kept["means"][k]) if f == "mean_yesterday" else F.col(f) for f in NOWCAST_FEATURES]
        x = F.array(*[c.cast("double") for c in cols]).alias("x")
        want.update({(t, k): y for t, y in walked(forest_nodes(spark, model), frame.select(F.col("tree_id").alias("id"), x)).items()})
    assert want and {key: y for key, y in got.items() if key[1] < 4} == pytest.approx(want, abs=1e-9)
    assert {t for t, k in got if k == 4} == {t for t, _ in want}


def test_registered_importances_are_those_of_the_gains(spark, monkeypatch):
    kept = {}
    fit = M.train
    monkeypatch.setattr(M, "NOWCAST_FOREST", SMALL)
    monkeypatch.setattr(M, "train", lambda *a: kept.setdefault("m", fit(*a)))
    got = {r.feature: r.importance for r in QUERIES["feature_importances"](spark, FOLDER).collect()}
    own = {NOWCAST_FEATURES[r.feature]: r.importance for r in gain_importances(forest_nodes(spark, kept["m"])).collect()}
    assert got == pytest.approx({f: own.get(f, 0.0) for f in NOWCAST_FEATURES}, abs=1e-9)
