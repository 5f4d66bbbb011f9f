"""Per-depth regressors on Spark ML: training, nowcast, recursive forecast and evaluation.

The tree axis is the partitions. A recursion takes all its steps in one Arrow pass over a partition, with the
fitted models broadcast once as flat arrays.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import (
    GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel,
    RandomForestRegressionModel, RandomForestRegressor)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from canopy.constants import (
    BACKTEST_DROP_DAYS, COMPARED_BOOSTING, COMPARED_FOREST, DEPTH_LABELS, DEPTH_MEAN_TYPE, DEPTHS, FORECAST_FEATURES, FORECAST_FOREST, HORIZON_DAYS, LAG_FEATURES,
    MODEL_ID, NOWCAST_FEATURES, NOWCAST_FOREST, SEASON_START_LAG)
from canopy.functions.scalars import literal_day, round_half_even
from canopy.operators.aggregates import fold_summary, regression_metrics
from canopy.operators.features import fold_frames
from canopy.operators.forests import Forest
from canopy.operators.growing import Grown, can_grow, grow
from canopy.operators.relational import union_all, window_split
from canopy.session import cut_lineage, share_package

SIDE_BY_SIDE = 8        # fits at a time
FIT_ROWS = 1 << 16      # rows of a part of a fit by the library
ROWS_AT_ONCE = 512      # rows or series that take their steps together
_VECTOR = "_features"
_SCORE = "_score"


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=_VECTOR, handleInvalid="keep")


def forest(params: Mapping, seed: int = 42) -> RandomForestRegressor:
    # Rows remember their node in every tree, so a level does not walk the trees from the root again.
    return RandomForestRegressor(seed=seed, cacheNodeIds=True, maxMemoryInMB=1024, **params)


def train(df: DataFrame, features: Sequence[str], estimator, label: str = "target") -> Model:
    """Fit on the complete rows. Assembled rows are read once per pass over the data, so keep them."""
    rows = df.select(*features, F.col(label).cast("double").alias("_label")).na.drop("any")
    own = estimator.copy().setFeaturesCol(_VECTOR).setLabelCol("_label").setPredictionCol(_SCORE)
    if can_grow(own):
        return grow(rows, features, "_label", own)
    rows = rows.persist()
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Boosting is thousands of short jobs one after another, each of as many tasks as there are parts.
    data = _assembler(features).transform(rows.repartition(max(1, min(most, -(-rows.count() // FIT_ROWS))))).select(_VECTOR, "_label").persist()
    try:
        return own.fit(data)
    finally:
        data.unpersist()
        rows.unpersist()


def train_per_type(df: DataFrame, features: Sequence[str], params: Mapping, types: Sequence[int] = DEPTHS,
                   label: str = "target") -> dict[int, Model]:
    return {k: train(df.where(F.col("type_id") == k), features, forest(params), label) for k in types}


def train_nowcast(df: DataFrame, params: Mapping = NOWCAST_FOREST) -> dict[int, Model]:
    return train_per_type(df, NOWCAST_FEATURES, params)


def train_forecast(df: DataFrame, params: Mapping = FORECAST_FOREST) -> dict[int, Model]:
    return train_per_type(df, FORECAST_FEATURES + LAG_FEATURES, params)


def train_auxiliary(df: DataFrame, params: Mapping = NOWCAST_FOREST) -> dict[int, Model]:
    """Nowcast models on the forecast features; they supply the lags a forecast starts from."""
    return train_per_type(df, FORECAST_FEATURES, params)


@dataclass(frozen=True)
class Linear:
    """A scorer of stated coefficients; every job takes it in place of a fitted model."""
    coefficients: tuple[float, ...]
    intercept: float = 0.0

    def score(self, inputs: Sequence[Column]) -> Column:
        return reduce(lambda s, x: s + x[0].cast("double") * F.lit(x[1]),
                      zip(inputs, self.coefficients, strict=True), F.lit(self.intercept))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return reduce(lambda s, i: s + x[:, i] * self.coefficients[i], range(len(self.coefficients)), np.full(len(x), self.intercept))


Scorer = Callable[[np.ndarray], np.ndarray]


def scorer(model: Model | Linear) -> Scorer:
    """The model as a function of complete rows that a task can hold."""
    if isinstance(model, Grown):
        return model.flat()
    return model if isinstance(model, Linear) else Forest.of(model)


def known_only(score: Scorer, x: np.ndarray) -> np.ndarray:
    """Scores of the complete rows, NaN for the others."""
    y, known = np.full(len(x), np.nan), ~np.isnan(x).any(1)
    if known.any():
        y[known] = score(x[known])
    return y


def recur(score: Scorer, steps: Iterable[np.ndarray], lags: np.ndarray, restart: float | None = None) -> np.ndarray:
    """(rows, steps): every step sees its own inputs and the predictions of the steps before it, newest first.

    After a step with a missing input a row has no more predictions, or begins anew from ``restart``.
    """
    out = []
    for x in steps:
        y = known_only(score, np.column_stack([x, lags]))
        lags = np.column_stack([y, lags[:, :-1]])
        if restart is not None:
            lags[np.isnan(y)] = restart
        out.append(y)
    return np.column_stack(out)


def arrow_pass(df: DataFrame, schema: StructType, run: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """Columns that ``run`` makes from a few rows at a time; NaN becomes null."""
    share_package(df.sparkSession)
    out = to_arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS_AT_ONCE):
                made = run(batch.slice(i, ROWS_AT_ONCE))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], f.type, from_pandas=True) if isinstance(made[f.name], np.ndarray)
                     else made[f.name].cast(f.type) for f in out], schema=out)

    return df.mapInArrow(task, schema)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """As many parts as the session shuffles into, fixed: a row costs milliseconds, however few bytes it has."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def predict(df: DataFrame, model: Model | Linear, inputs: Sequence[Column], name: str) -> DataFrame:
    """Add one raw prediction column for complete inputs, in the order the model was fitted on."""
    if isinstance(model, Linear):
        return df.withColumn(name, model.score(inputs))
    values = F.array(*[F.coalesce(c.cast("double"), F.lit(float("nan"))) for c in inputs])
    step = model.copy().setFeaturesCol(_VECTOR).setPredictionCol(name)
    return step.transform(df.withColumn(_VECTOR, array_to_vector(values)))


def score(df: DataFrame, model: Model, inputs: Sequence[Column], name: str) -> DataFrame:
    """The same, but a row with a missing input gets a null prediction."""
    known = F.lit(True)
    for c in inputs:
        known = known & c.isNotNull() & ~F.isnan(c.cast("double"))
    df = df.withColumn("_known", known)
    return (predict(df, model, inputs, _SCORE)
            .withColumn(name, F.when(F.col("_known"), F.col(_SCORE))).drop(_VECTOR, _SCORE, "_known"))


def _means(last_mean: Mapping[int, float], kind: int) -> Column:
    return F.lit(last_mean.get(kind)).cast("double")


def group_means(last_mean: DataFrame) -> dict[int, float]:
    """The last group mean per kind as a driver value: one number per sensor kind."""
    return {r["type_id"]: r["mean_yesterday"] for r in last_mean.where(F.col("type_id").isin(DEPTHS)).collect()}


def _long(df: DataFrame, scores: Mapping[int, Column], timestamp: Column, created_at: Column) -> DataFrame:
    """Predictions per depth and their mean as rows of the result table; null predictions leave."""
    values = list(scores.values())
    known = sum((v.isNotNull().cast("int") for v in values[1:]), values[0].isNotNull().cast("int"))
    total = sum((F.coalesce(v, F.lit(0.0)) for v in values[1:]), F.coalesce(values[0], F.lit(0.0)))
    rows = [F.struct(F.lit(k).alias("type_id"), v.alias("value")) for k, v in scores.items()]
    rows.append(F.struct(F.lit(DEPTH_MEAN_TYPE).alias("type_id"), F.try_divide(total, known).alias("value")))
    return (df.select("tree_id", timestamp.alias("timestamp"), created_at.alias("created_at"),
                      F.explode(F.array(*rows)).alias("_r"))
            .where(F.col("_r.value").isNotNull())
            .select("tree_id", "_r.type_id", "timestamp", "_r.value", "created_at",
                    F.lit(MODEL_ID).alias("model_id")))


def nowcast(models: Mapping[int, Model], frame: DataFrame, last_mean: Mapping[int, float],
            date: dt.date, created_at: dt.datetime) -> DataFrame:
    """All depths of all trees in one pass over the frame, plus the mean over the depths."""
    df = frame
    for k, model in models.items():
        inputs = [_means(last_mean, k) if f == "mean_yesterday" else F.col(f) for f in NOWCAST_FEATURES]
        df = score(df, model, inputs, f"_y{k}")
    return _long(df, {k: F.col(f"_y{k}") for k in models}, literal_day(date).cast("timestamp"),
                 F.lit(created_at))


_WEATHER = [c for c in ("wind_avg_ms", "wind_max_ms", "temp_avg_c", "temp_max_c", "rainfall_mm",
                        "ghi_sum_whm2") if c in FORECAST_FEATURES]


def weather_by_day(weather: DataFrame, lo: dt.date, hi: dt.date) -> dict[dt.date, dict[str, float]]:
    """The daily weather of one tile as driver values: one row per day of a horizon, a few weeks at most."""
    rows = weather.where(F.col("date").between(literal_day(lo), literal_day(hi))).select("date", *_WEATHER)
    return {r["date"]: {c: r[c] for c in _WEATHER} for r in rows.collect()}


def newest_forecast(forecast: DataFrame, tile: int | None) -> DataFrame:
    """The newest issued weather forecast per day; of equally new ones the first tile counts."""
    df = forecast if tile is None else forecast.where(F.col("tile_id") == tile)
    newest = F.max_by(F.struct(*_WEATHER), F.struct("created_at", -F.col("tile_id")))
    return df.groupBy("date").agg(newest.alias("_w")).select("date", "_w.*")


def forecast(models: Mapping[int, Model], auxiliary: Mapping[int, Model], base: DataFrame,
             last_mean: Mapping[int, float], past_weather: Mapping[dt.date, Mapping[str, float]],
             coming_weather: Mapping[dt.date, Mapping[str, float]], last_date: dt.date,
             created_at: dt.datetime, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Recursive forecast of every tree and depth.

    The start lags are auxiliary predictions with the weather of the last three days. Each step sees
    the weather forecast of its day and the three predictions before it. A day without weather gives
    no prediction, and none after it that needs one.
    """
    static = [f for f in FORECAST_FEATURES if f not in _WEATHER and f != "mean_yesterday"]
    df = base.select("tree_id", *[F.col(f).cast("double").alias(f) for f in static]).na.drop("any", subset=static)
    own = [FORECAST_FEATURES.index(f) for f in static]

    def known(weather: Mapping[dt.date, Mapping[str, float]], ahead: int, kind: int) -> np.ndarray:
        """The inputs of a day that all trees share; NaN where there is none, and in the places of the trees' own."""
        values = {**(weather.get(last_date + dt.timedelta(days=ahead)) or {}), "mean_yesterday": last_mean.get(kind)}
        return np.array([values.get(f) for f in FORECAST_FEATURES], float)

    def inputs(rows: np.ndarray, day: np.ndarray) -> np.ndarray:
        x = np.tile(day, (len(rows), 1))
        x[:, own] = rows
        return x

    days = {k: ([known(past_weather, -i, k) for i in range(len(LAG_FEATURES))],
                [known(coming_weather, h + 1, k) for h in range(horizon)]) for k in models}
    # Bounded by the settings of the fits; one by one, so that the driver holds the arrays of one depth.
    shared = {k: df.sparkSession.sparkContext.broadcast((scorer(auxiliary[k]), scorer(models[k]))) for k in models}

    def run(batch: pa.RecordBatch) -> dict:
        rows = np.column_stack([batch.column(f).to_numpy() for f in static])
        made = {"tree_id": batch.column("tree_id").take(pa.array(np.repeat(np.arange(len(rows)), horizon))),
                "_ahead": np.tile(np.arange(1, horizon + 1, dtype=np.int32), len(rows))}
        for k, both in shared.items():
            start, score = both.value
            lags = np.column_stack([known_only(start, inputs(rows, day)) for day in days[k][0]])
            made[f"y{k}"] = recur(score, (inputs(rows, day) for day in days[k][1]), lags).ravel()
        return made

    schema = StructType([df.schema["tree_id"], StructField("_ahead", IntegerType()), *[StructField(f"y{k}", DoubleType()) for k in models]])
    return _long(arrow_pass(spread(df, "tree_id"), schema, run), {k: F.col(f"y{k}") for k in models},
                 F.date_add(literal_day(last_date), F.col("_ahead")).cast("timestamp"), F.lit(created_at))


# --- evaluation -------------------------------------------------------------------------------

def _rolled(df: DataFrame, keys: Sequence[str], step: Column, steps: int, features: Sequence[str], model: Model | Linear,
            start_lag: float | None = None) -> DataFrame:
    """(keys, step, target, y_pred) of every series, predicted step by step in one pass.

    The lags begin with those of step 0, or with ``start_lag``, from which they also begin anew after a gap.
    A series is one row with its steps in an array, which the number of steps bounds.
    """
    wanted = [*features, *([] if start_lag is not None else LAG_FEATURES), "target"]
    rows = (spread(df, *keys).withColumn("_step", step).groupBy(*keys, "_step")
            .agg(F.first(F.struct(*[F.col(c).cast("double").alias(c) for c in wanted])).alias("_row")))
    series = rows.groupBy(*keys).agg(F.collect_list(F.struct("_step", "_row.*")).alias("_rows"))
    shared = df.sparkSession.sparkContext.broadcast(scorer(model))      # bounded by the settings of the fit

    def run(batch: pa.RecordBatch) -> dict:
        lists = batch.column("_rows")
        flat, of = lists.flatten(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        x = np.full((len(lists), steps, len(wanted)), np.nan)
        for i, c in enumerate(wanted):
            x[of, flat.field("_step").to_numpy(), i] = flat.field(c).to_numpy(zero_copy_only=False)
        n = len(features)
        lags = x[:, 0, n:n + len(LAG_FEATURES)] if start_lag is None else np.full((len(x), len(LAG_FEATURES)), start_lag)
        y = recur(shared.value, (x[:, i, :n] for i in range(steps)), lags, start_lag)
        at, i = np.nonzero(~np.isnan(y))
        return {**{k: batch.column(k).take(pa.array(at)) for k in keys}, "step": i.astype(np.int32), "target": x[at, i, -1], "y_pred": y[at, i]}

    schema = StructType([*[series.schema[k] for k in keys], StructField("step", IntegerType()),
                         StructField("target", DoubleType()), StructField("y_pred", DoubleType())])
    return arrow_pass(series, schema, run)


def backtest(train_rows: DataFrame, starts: Sequence[dt.date], drop_starts: Sequence[dt.date],
             params: Mapping = FORECAST_FOREST, horizon: int = HORIZON_DAYS, drop_days: int = BACKTEST_DROP_DAYS,
             model: Model | Linear | None = None) -> DataFrame:
    """Recursive predictions inside held-out windows against the sensors (window = step 1..horizon).

    One model over all depths is fitted without the wider drop windows, unless one is given. A series ends
    at its first incomplete day.
    """
    features = FORECAST_FEATURES + LAG_FEATURES
    train_part, test = window_split(train_rows, "timestamp", starts, horizon, drop_starts, drop_days)
    model = model or train(train_part, features, forest(params))
    day = F.to_date("timestamp")
    start = F.coalesce(*[F.when(day.between(literal_day(s), literal_day(s + dt.timedelta(days=horizon - 1))),
                                literal_day(s)) for s in starts])
    test = test.na.drop("any", subset=features + ["target"]).withColumn("_start", start)
    df = _rolled(test, ["_start", "tree_id", "type_id"], F.datediff(day, "_start"), horizon, FORECAST_FEATURES, model)
    return df.select(F.date_add("_start", "step").alias("timestamp"), "tree_id", "type_id",
                     (F.col("step") + 1).alias("window"), "target", "y_pred")


def season_forecast(model: Model | Linear, rows: DataFrame, start: dt.date, days: int,
                    start_lag: float = SEASON_START_LAG) -> DataFrame:
    """Recursion over a whole season without sensors: lags begin, and begin anew after a gap, at a constant."""
    day = F.to_date("timestamp")
    span = rows.where(day.between(literal_day(start), literal_day(start + dt.timedelta(days=days - 1))))
    df = _rolled(span, ["tree_id", "type_id"], F.datediff(day, literal_day(start)), days,
                 FORECAST_FEATURES + ["type_id"], model, start_lag)
    return df.select("tree_id", "type_id", F.date_add(literal_day(start), F.col("step")).alias("timestamp"),
                     "target", "y_pred", (F.col("target") - F.col("y_pred")).alias("error"))


def train_season(rows: DataFrame, before: dt.date, params: Mapping = FORECAST_FOREST) -> Model:
    """One model over all depths, the depth itself a feature, on the rows up to and including a day."""
    part = rows.where(F.to_date("timestamp") <= literal_day(before))
    return train(part, FORECAST_FEATURES + ["type_id"] + LAG_FEATURES, forest(params))


def estimators(forest_params: Mapping = COMPARED_FOREST, boosting: Mapping = COMPARED_BOOSTING) -> dict[str, object]:
    return {
        "GradientBoostingRegressor": GBTRegressor(seed=42, **boosting),
        "LinearRegression": LinearRegression(fitIntercept=True),
        "RandomForestRegressor": forest(forest_params),
    }


def predict_folds(df: DataFrame, folds: DataFrame, k: int, models: Mapping[str, object],
                  features: Sequence[str] = NOWCAST_FEATURES, per_depth: bool = True) -> DataFrame:
    """Held-out predictions of every model, site fold and depth, with the benchmark beside them.

    ``per_depth=False`` fits one model on all depths, as the notebook of the original does. The fits are
    many small jobs, so they run side by side.
    """
    # Both parts are read once per depth and model.
    frames = [[cut_lineage(p) for p in fold_frames(df, folds, fold)] for fold in range(k)]
    kinds = [(d,) for d in DEPTHS] if per_depth else [tuple(DEPTHS)]
    wanted = [(fold, name, depths) for fold in range(k) for name in models for depths in kinds]

    def fit(fold: int, name: str, depths: tuple[int, ...]) -> Model:
        rows = frames[fold][0] if len(depths) > 1 else frames[fold][0].where(F.col("type_id") == depths[0])
        return train(rows, features, models[name], "value")

    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        done = [pool.submit(inheritable_thread_target(df.sparkSession)(fit), *w) for w in wanted]
        by_part = {(fold, name, d): f.result() for (fold, name, depths), f in zip(wanted, done) for d in depths}
    parts = []
    for fold in range(k):
        test_rows = frames[fold][1]
        fitted = {(name, d): by_part[fold, name, d] for name in models for d in DEPTHS}
        for depth in DEPTHS:
            scored = test_rows.where(F.col("type_id") == depth)
            for name in models:
                scored = score(scored, fitted[name, depth], [F.col(f) for f in features], f"_y_{name}")
            each = F.explode(F.array(*[
                F.struct(F.lit(n).alias("model"), F.col(f"_y_{n}").alias("y_hat")) for n in models]))
            parts.append(scored.select("tree_id", "type_id", "timestamp", "value",
                                       F.col("mean_yesterday").alias("benchmark"), each.alias("_m"),
                                       F.lit(fold).alias("fold"))
                         .select("*", "_m.*").drop("_m"))
    return union_all(*parts)


def evaluate_models(predictions: DataFrame) -> DataFrame:
    """Errors per model and depth averaged over all folds; the benchmark is a model of its own.

    Every model row carries the same benchmark, so its errors come out of the same pass.
    """
    keys = ["model", "type_id", "fold"]
    err, base = F.col("value") - F.col("y_hat"), F.col("value") - F.col("benchmark")
    figures = [round_half_even(e).alias(n) for n, e in (
        ("rmse", F.sqrt(F.avg(err * err))), ("mae", F.avg(F.abs(err))),
        ("b_rmse", F.sqrt(F.avg(base * base))), ("b_mae", F.avg(F.abs(base))))]
    per = predictions.groupBy(*keys).agg(*figures)
    each = F.explode(F.array(
        F.struct("model", "rmse", "mae"),
        F.struct(F.lit("benchmark").alias("model"), F.col("b_rmse").alias("rmse"), F.col("b_mae").alias("mae"))))
    return fold_summary(per.select("type_id", each.alias("_e")).select("type_id", "_e.*"))


def experiment_records(predictions: DataFrame, experiment: str, features: Sequence[str],
                       parameters: Mapping[str, Mapping]) -> DataFrame:
    """One record per model for the experiment log: errors per depth, for every fold and averaged over them."""
    folds = F.sort_array(F.collect_list(F.struct("fold", "rmse", "mae")))
    per = (regression_metrics(predictions, "value", "y_hat", ["model", "type_id", "fold"]).groupBy("model", "type_id")
           .agg(F.struct(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae")).alias("_mean"),
                F.transform(folds, lambda s: F.struct(s["rmse"].alias("rmse"), s["mae"].alias("mae"))).alias("_folds")))
    at = {d: DEPTH_LABELS[d].replace(" ", "") for d in DEPTHS}
    picks = [F.max(F.when(F.col("type_id") == d, F.col(c))).alias(f"{name} {label}")
             for name, c in (("Mean", "_mean"), ("Folds", "_folds")) for d, label in at.items()]
    texts = {m: F.create_map(*[x for k, v in p.items() for x in (F.lit(k), F.lit(str(v)))]) for m, p in parameters.items() if p}
    settings = F.coalesce(F.lit(None).cast("map<string,string>"), *[F.when(F.col("model") == m, t) for m, t in texts.items()])
    return per.groupBy("model").agg(*picks).withColumns({
        "experiment_id": F.lit(experiment), "features": F.array(*[F.lit(f) for f in features]), "hyper_parameters": settings})


def benchmark(df: DataFrame, value: str = "value") -> DataFrame:
    """Errors of yesterday's group mean as a prediction, per kind."""
    rows = df.where(F.col(value).isNotNull() & F.col("mean_yesterday").isNotNull())
    return regression_metrics(rows, value, "mean_yesterday", ["type_id"])


def importances(spark: SparkSession, model: Model, features: Sequence[str]) -> DataFrame:
    """Feature importances, largest first; one row per model input."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature")


# --- storage ----------------------------------------------------------------------------------

_MODELS = {"RandomForestRegressionModel": RandomForestRegressionModel,
           "GBTRegressionModel": GBTRegressionModel, "LinearRegressionModel": LinearRegressionModel}


def save_models(models: Mapping[int, Model], folder: str, prefix: str = "") -> None:
    for k, model in models.items():
        model.write().overwrite().save(f"{folder}/{prefix}model_{k}")


def load_models(folder: str, types: Sequence[int] = DEPTHS, prefix: str = "",
                kind: str = "RandomForestRegressionModel") -> dict[int, Model]:
    return {k: _MODELS[kind].load(f"{folder}/{prefix}model_{k}") for k in types}
