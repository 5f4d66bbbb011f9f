"""Forests grown level by level: every node of every tree from the rows themselves."""

import pickle

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from canopy.operators import growing as G, models as M
from canopy.operators.forests import Forest, forest_nodes

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    u = lambda n: F.pmod(F.xxhash64("id", F.lit(n)), F.lit(1000)) / 1000
    df = spark.range(3000).select(u(1).alias("a"), F.floor(u(2) * 5).alias("b"), (u(3) * 40).alias("c"), F.lit(7.0).alias("d"), u(4).alias("noise"))
    return df.select(*FEATURES, (F.when(F.col("a") > 0.3, 10.0).otherwise(0.0) + F.col("b") * F.col("c") / 10 + F.col("noise")).alias("target")).cache()


def small(**other):
    return M.forest({"numTrees": 6, "maxDepth": 4, "featureSubsetStrategy": "sqrt", **other})


@pytest.mark.parametrize("part_rows", [1 << 18, 700])
def test_nodes_hold_the_bootstrap_of_all_rows(spark, rows, monkeypatch, part_rows):
    kept = {}
    monkeypatch.setattr(G, "PART_ROWS", part_rows)
    monkeypatch.setattr(G, "BLOCK_ROWS", 256)
    monkeypatch.setattr(G, "PIECE_NODES", 3)
    packed, cuts = G._packed, G._cuts
    monkeypatch.setattr(G, "_cuts", lambda *a: kept.setdefault("cuts", cuts(*a)))
    monkeypatch.setattr(G, "_packed", lambda *a: kept.update(mean=a[4]) or kept.setdefault("packed", packed(*a)))
    model = M.train(rows, FEATURES, small())
    blocks = {r["_block"]: (np.frombuffer(r["_x"], np.uint8).reshape(-1, 4), np.frombuffer(r["_y"]) + kept["mean"]) for r in kept["packed"].collect()}
    assert sum(len(y) for _, y in blocks.values()) == 3000
    nodes = forest_nodes(spark, model).orderBy("tree", "node").collect()
    for tree in range(6):
        own = [n for n in nodes if n["tree"] == tree]
        x = np.concatenate([np.repeat(x, G.draws(42, tree, b, len(y)), 0) for b, (x, y) in blocks.items()])
        y = np.concatenate([np.repeat(y, G.draws(42, tree, b, len(y))) for b, (x, y) in blocks.items()])
        held = {0: np.arange(len(y))}
        for n in own:
            at = held[n["node"]]
            assert n["rows"] == len(at) and n["value"] == pytest.approx(y[at].mean())
            if n["feature"] is not None:
                cut = np.searchsorted(kept["cuts"][n["feature"]], n["threshold"])
                goes = x[at, n["feature"]] <= cut
                held[n["left"]], held[n["right"]] = at[goes], at[~goes]
                gains = [y[at].var() - sum(len(p) * p.var() for p in (y[at][x[at, n["feature"]] <= c], y[at][x[at, n["feature"]] > c]) if len(p)) / len(at)
                         for c in range(len(kept["cuts"][n["feature"]]))]
                assert n["gain"] == pytest.approx(max(gains)) and n["gain"] == pytest.approx(gains[cut])


def test_the_bootstrap_is_poisson_and_the_same_at_every_call():
    w = G.draws(42, 3, 5, 400_000)
    assert (w == G.draws(42, 3, 5, 400_000)).all() and (w[:1000] != G.draws(42, 4, 5, 1000)).any()
    share = np.bincount(w, minlength=5)[:5] / len(w)
    assert share == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613, 0.0153], abs=0.004)


def test_a_forest_is_as_good_as_the_librarys(spark, rows):
    """The library would hold two numbers for every row and tree; it is not called."""
    own = M.train(rows, FEATURES, small(numTrees=40))
    data = M._assembler(FEATURES).transform(rows)
    library = RandomForestRegressor(seed=1, numTrees=40, maxDepth=4, featureSubsetStrategy="sqrt", featuresCol=M._VECTOR, labelCol="target", predictionCol=M._SCORE).fit(data)
    rmse = [m.transform(data).select(F.sqrt(F.avg((F.col(M._SCORE) - F.col("target")) ** 2))).first()[0] for m in (own, library)]
    assert rmse[0] == pytest.approx(rmse[1], rel=0.15) and own.getNumTrees == 40
    assert own.featureImportances.toArray() == pytest.approx(library.featureImportances.toArray(), abs=0.12)


def test_train_does_not_call_the_librarys_forest(rows, monkeypatch):
    monkeypatch.setattr(RandomForestRegressor, "fit", None)
    assert M.train(rows, FEATURES, small()).getNumTrees == 6
    assert not G.can_grow(small(subsamplingRate=0.5))       # settings not followed are left to the library


def test_a_grown_forest_is_scored_without_the_librarys_model(rows, monkeypatch):
    """All nodes of the library's model are objects in the driver's heap; the arrays hold the same numbers."""
    make = G._model
    monkeypatch.setattr(G, "_model", None)
    grown = M.train(rows, FEATURES, small())
    flat = M.scorer(grown)
    monkeypatch.setattr(G, "_model", make)
    library = Forest.of(grown)
    x = np.array([list(r) for r in rows.select(*FEATURES).collect()])
    assert flat(x).tolist() == library(x).tolist() == pickle.loads(pickle.dumps(flat))(x).tolist()
    for name in ("feature", "threshold", "value", "levels", "roots"):       # the library numbers the nodes of a tree anew
        assert sorted(getattr(flat, name)) == sorted(getattr(library, name))
    assert grown.numFeatures == 4 and not hasattr(grown, "__len__")


def test_the_features_of_nodes_are_drawn_in_pieces(monkeypatch):
    whole = G._picked(np.random.default_rng(3), 100, 7, 3)
    monkeypatch.setattr(G, "PICKED_NODES", 9)
    assert (G._picked(np.random.default_rng(3), 100, 7, 3) == whole).all()


def test_a_fit_by_the_library_has_parts_by_its_rows(rows, monkeypatch):
    """Boosting runs thousands of jobs; each would have as many tasks as the session shuffles into."""
    class Parts:
        copy = setFeaturesCol = setLabelCol = setPredictionCol = lambda self, *_: self

        def fit(self, data):
            return data.rdd.getNumPartitions(), data.count()

    assert M.train(rows, FEATURES, Parts()) == (1, 3000)
    monkeypatch.setattr(M, "FIT_ROWS", 1000)
    assert M.train(rows, FEATURES, Parts()) == (3, 3000)
