"""Registered queries: training, prediction and evaluation on the stand-in tables.

Forests have no SQL check, as libraries differ in seeds and split candidates. The same jobs run with a
linear scorer of stated coefficients, whose recursion SQL can follow; the forests take the sizes of
``constants``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from canopy.constants import (
    BACKTEST_DROP_STARTS, BACKTEST_STARTS, DEPTHS, FORECAST_FEATURES, FORECAST_FOREST, LAG_FEATURES,
    NOWCAST_FEATURES, SEASON_START_LAG)
from canopy.operators import features as E, models as M, windows as W
from canopy.operators.aggregates import error_summary, metrics_by_horizon
from canopy.plans.q_features import tables
from canopy.plans.registry import query
from canopy.plans.standins import DAY_SHIFT, KIND_SQL, Roles, kind, order_day, rounded, with_roles
from canopy.session import cut_lineage

TODAY = dt.date(2024, 6, 10)
LAST = dt.date(2024, 5, 20)
DENSE = dt.date(2021, 5, 13)      # days around it have weather also in the smallest tables
CREATED = dt.datetime(2024, 6, 10, tzinfo=dt.timezone.utc)


def _training(r: Roles, forecast: bool) -> tuple[E.Preprocessor, DataFrame]:
    t = tables(r)
    frame = E.training_frame(t, forecast, TODAY)
    frame = cut_lineage(frame.withColumn("timestamp", F.col("timestamp").cast("timestamp")))
    prep = E.Preprocessor(forecast).fit(frame)
    return prep, cut_lineage(prep.transform_train(frame))


def _coefficients(kind: int, n: int) -> list[float]:
    """Small and different for every input and kind, so that a mixed-up input shows."""
    return [round((i + 1) * (1 + kind / 10) / 1000, 6) for i in range(n)]


_LAGGED = [0.4, 0.2, 0.1]
_START = 0.25
# Weather in the tables runs into thousands; the factors bring all inputs to a few units.
_WEATHER = ["wind_max_ms", "temp_avg_c", "rainfall_mm", "ghi_sum_whm2"]
_SCALE = {"wind_max_ms": 1e-2, "ghi_sum_whm2": 1e-3, "rainfall_mm": 1.0, "temp_avg_c": 1.0}


def _linear(kind: int, features: list[str], lags: bool = False) -> M.Linear:
    own = [c * _SCALE.get(f, 1.0) for c, f in zip(_coefficients(kind, len(features)), features)]
    return M.Linear((*own, *(_LAGGED if lags else [])), _START)


def _linear_sql(kind: int, inputs: dict[str, str], lags: list[str] = ()) -> str:
    own = [f"{x} * {c * _SCALE.get(f, 1.0)!r}" for c, (f, x) in zip(_coefficients(kind, len(inputs)), inputs.items())]
    return " + ".join([repr(_START), *own, *[f"{x} * {c!r}" for x, c in zip(lags, _LAGGED)]])


def _by_kind(make) -> str:
    return "CASE type_id " + " ".join(f"WHEN {k} THEN {make(k)}" for k in DEPTHS) + " END"


# --- nowcast and forecast with a linear scorer -------------------------------------------------

_STATIC = {"month": "5.0", "gattung": "CAST(c_nationkey AS DOUBLE)", "standalter": "CAST(c_custkey % 120 AS DOUBLE)",
           "shading_index": "c_acctbal / 1e4", "water_sga": "CAST(c_custkey % 7 AS DOUBLE)",
           "water_gdk": "CASE WHEN c_custkey % 11 > 0 THEN c_acctbal / 1e3 END", **{c: f"c_nationkey * {i + 1} / 10.0" for i, c in enumerate(_WEATHER)}}
_BASE_SQL = ("SELECT CAST(c_custkey AS VARCHAR) AS tree_id, " + ", ".join(f"{x} AS {c}" for c, x in _STATIC.items()) + " FROM customer")
_LAST_MEAN = """SELECT DISTINCT ON (type_id) type_id, v AS mean_yesterday FROM
 (SELECT timestamp, type_id, avg(value) AS v FROM sensors GROUP BY 1, 2) ORDER BY type_id, timestamp DESC"""


def _base(r: Roles) -> DataFrame:
    """One row per customer with every static input; a few miss the watering."""
    k, n, v = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal")
    cols = {"month": F.lit(5.0), "gattung": n.cast("double"), "standalter": (k % 120).cast("double"), "shading_index": v / 1e4,
            "water_sga": (k % 7).cast("double"), "water_gdk": F.when(k % 11 > 0, v / 1e3),
            **{c: n * (i + 1) / 10.0 for i, c in enumerate(_WEATHER)}}
    return r.customer.select(k.cast("string").alias("tree_id"), *[c.alias(name) for name, c in cols.items()])


def _inputs_sql(features: list[str], prefix: dict[str, str]) -> dict[str, str]:
    return {f: f"{prefix.get(f, 'b')}.{f}" for f in features}


_DEPTHS_SQL = "SELECT unnest([1, 2, 3]) AS type_id"


@query("nowcast_linear", with_roles("sensors", b=_BASE_SQL, k=_DEPTHS_SQL, m=_LAST_MEAN, y=f"""
SELECT b.tree_id, k.type_id, {_by_kind(lambda k: _linear_sql(k, _inputs_sql(NOWCAST_FEATURES, {"mean_yesterday": "m"}))).replace("CASE type_id", "CASE k.type_id")} AS value
 FROM b, k LEFT JOIN m ON m.type_id = k.type_id""") + """
SELECT tree_id, type_id, DATE '2024-05-20' AS day, round(value + 1e-9, 4) AS value FROM y WHERE value IS NOT NULL
UNION ALL SELECT tree_id, 4, DATE '2024-05-20', round(avg(value) + 1e-9, 4) FROM y GROUP BY 1 HAVING count(value) > 0""")
def nowcast_linear(r: Roles) -> DataFrame:
    """Every depth and the mean over the depths; a tree with a missing input has none."""
    fitted = {k: _linear(k, NOWCAST_FEATURES) for k in DEPTHS}
    df = M.nowcast(fitted, _base(r), M.group_means(W.last_group_mean(r.sensors)), LAST, CREATED)
    return rounded(df.select("tree_id", "type_id", F.to_date("timestamp").alias("day"), "value"), "value")


def _rolled_sql() -> str:
    return "SELECT date, " + ", ".join(f"{'sum' if c == 'rainfall_mm' else 'avg'}({c}) OVER w AS {c}" for c in _WEATHER) + (
        " FROM tile_weather WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")


_FORECAST_FROM = {**{c: "w" for c in _WEATHER}, "mean_yesterday": "m"}
_FORECAST_IN = _inputs_sql(FORECAST_FEATURES, _FORECAST_FROM)


@query("forecast_linear", with_roles("sensors", "tile_weather", b=_BASE_SQL, k=_DEPTHS_SQL, m=_LAST_MEAN, rolled=_rolled_sql(), aux=f"""
SELECT b.tree_id, k.type_id, w.date, {_by_kind(lambda k: _linear_sql(k + 3, _FORECAST_IN)).replace("CASE type_id", "CASE k.type_id")} AS y
 FROM b, k JOIN m ON m.type_id = k.type_id JOIN rolled w ON w.date BETWEEN DATE '2021-05-11' AND DATE '2021-05-13'""",
       seed="""SELECT tree_id, type_id, max(CASE WHEN date = DATE '2021-05-13' THEN y END) AS l1, max(CASE WHEN date = DATE '2021-05-12' THEN y END) AS l2,
 max(CASE WHEN date = DATE '2021-05-11' THEN y END) AS l3 FROM aux GROUP BY 1, 2""", r=f"""
SELECT tree_id, type_id, 0 AS h, CAST(NULL AS DOUBLE) AS y, l1, l2, l3 FROM seed
UNION ALL
SELECT tree_id, type_id, h, y, y, l1, l2 FROM (SELECT r.tree_id, r.type_id, r.h + 1 AS h, r.l1, r.l2,
 {_by_kind(lambda k: _linear_sql(k, _FORECAST_IN, ["r.l1", "r.l2", "r.l3"])).replace("CASE type_id", "CASE r.type_id")} AS y
 FROM r JOIN b ON b.tree_id = r.tree_id JOIN m ON m.type_id = r.type_id JOIN rolled w ON w.date = DATE '2021-05-13' + r.h + 1 WHERE r.h < 14)""").replace("WITH ", "WITH RECURSIVE ", 1) + """
SELECT tree_id, type_id, CAST(DATE '2021-05-13' + h AS DATE) AS day, round(y + 1e-9, 4) AS value FROM r WHERE h > 0 AND y IS NOT NULL
UNION ALL SELECT tree_id, 4, CAST(DATE '2021-05-13' + h AS DATE), round(avg(y) + 1e-9, 4) FROM r WHERE h > 0 GROUP BY 1, h HAVING count(y) > 0""")
def forecast_linear(r: Roles) -> DataFrame:
    """Fourteen recursive days for every tree and depth, begun from auxiliary predictions."""
    fitted = {k: _linear(k, FORECAST_FEATURES, lags=True) for k in DEPTHS}
    auxiliary = {k: _linear(k + 3, FORECAST_FEATURES) for k in DEPTHS}
    past, coming = _weather_of_days(r, DENSE)
    df = M.forecast(fitted, auxiliary, _base(r), M.group_means(W.last_group_mean(r.sensors)), past, coming, DENSE, CREATED)
    return rounded(df.select("tree_id", "type_id", F.to_date("timestamp").alias("day"), "value"), "value")


def _weather_of_days(r: Roles, last: dt.date = LAST) -> tuple[dict, dict]:
    days = E.rolling_weather(r.tile_weather, list(M._WEATHER), ["tile_id"])
    return (M.weather_by_day(days, last - dt.timedelta(days=2), last),
            M.weather_by_day(days, last + dt.timedelta(days=1), last + dt.timedelta(days=14)))


# --- back-test and season on years of readings -------------------------------------------------

ORDERS_A_TREE = 2400        # days of the orders, about


def _long_rows(r: Roles) -> DataFrame:
    """Orders as readings of trees at three depths over years, filled to days, with all inputs and lags.

    There are as many trees as leave each about a reading a day, so they grow with the table.
    """
    day = order_day()
    trees = r.orders.agg(F.greatest(F.lit(2), F.floor(F.count("*") / ORDERS_A_TREE))).scalar()
    seen = r.orders.groupBy((F.col("o_custkey") % trees).cast("string").alias("tree_id"), (F.col("o_orderkey") % 3 + 1).cast("int").alias("type_id"),
                            day.alias("timestamp")).agg((F.avg("o_totalprice") / 1e4).alias("value"))
    filled = W.resample_ffill(seen, ["tree_id", "type_id"])
    weather = r.tile_weather.select(F.col("date").alias("timestamp"), *_WEATHER, F.col("temp_max_c").alias("mean_yesterday"))
    rows = W.add_lags(filled, ["tree_id", "type_id"], "timestamp", "value").join(weather, "timestamp", "left")
    month = F.month("timestamp").cast("double")
    return rows.withColumn("month", month).withColumns({
        "gattung": F.col("tree_id").cast("double"), "standalter": F.col("type_id").cast("double"),
        "shading_index": F.col("month") / 12}).withColumnRenamed("value", "target")


_LONG = dict(
    n=f"SELECT greatest(2, count(*) // {ORDERS_A_TREE}) AS trees FROM orders",
    seen=f"""SELECT CAST(o_custkey % trees AS VARCHAR) AS tree_id, CAST(o_orderkey % 3 + 1 AS INTEGER) AS type_id, CAST(o_orderdate AS DATE) + {DAY_SHIFT} AS timestamp,
 avg(o_totalprice) / 1e4 AS value FROM orders, n GROUP BY 1, 2, 3""",
    grid="""SELECT tree_id, type_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS timestamp
 FROM (SELECT tree_id, type_id, min(timestamp) AS lo, max(timestamp) AS hi FROM seen GROUP BY 1, 2)""",
    filled="""SELECT g.*, CASE WHEN g.timestamp - s.timestamp <= 7 THEN s.value END AS target FROM grid g ASOF LEFT JOIN seen s
 ON s.tree_id = g.tree_id AND s.type_id = g.type_id AND s.timestamp <= g.timestamp""",
    lagged="SELECT *, lag(target, 1) OVER w AS shift_1, lag(target, 2) OVER w AS shift_2, lag(target, 3) OVER w AS shift_3 FROM filled"
           " WINDOW w AS (PARTITION BY tree_id, type_id ORDER BY timestamp)",
    x="""SELECT l.*, CAST(month(l.timestamp) AS DOUBLE) AS month, CAST(l.tree_id AS DOUBLE) AS gattung, CAST(l.type_id AS DOUBLE) AS standalter,
 month(l.timestamp) / 12.0 AS shading_index, t.wind_max_ms, t.temp_avg_c, t.rainfall_mm, t.ghi_sum_whm2, t.temp_max_c AS mean_yesterday
 FROM lagged l LEFT JOIN tile_weather t ON t.date = l.timestamp""")
_LONG_IN = {f: f"x.{f}" for f in FORECAST_FEATURES}
_COMPLETE = " AND ".join(f"x.{c} IS NOT NULL" for c in [*FORECAST_FEATURES, *LAG_FEATURES, "target"])
_KEYS = "tree_id, type_id"


@query("backtest_linear", with_roles("tile_weather", **_LONG, s="SELECT unnest([" + ", ".join(f"DATE '{d}'" for d in BACKTEST_STARTS) + "]) AS start", r=f"""
SELECT s.start, x.tree_id, x.type_id, 1 AS h, x.target, {_linear_sql(1, _LONG_IN, ["x.shift_1", "x.shift_2", "x.shift_3"])} AS y, x.shift_1 AS l1, x.shift_2 AS l2
 FROM x JOIN s ON x.timestamp = s.start WHERE {_COMPLETE}
UNION ALL SELECT r.start, r.tree_id, r.type_id, r.h + 1, x.target, {_linear_sql(1, _LONG_IN, ["r.y", "r.l1", "r.l2"])}, r.y, r.l1
 FROM r JOIN x ON x.tree_id = r.tree_id AND x.type_id = r.type_id AND x.timestamp = r.start + r.h WHERE r.h < 14 AND {_COMPLETE}""").replace("WITH ", "WITH RECURSIVE ", 1) + f"""
SELECT CAST(start + h - 1 AS DATE) AS timestamp, {_KEYS}, h AS "window", round(target + 1e-9, 4) AS target, round(y + 1e-9, 4) AS y_pred FROM r""")
def backtest_linear(r: Roles) -> DataFrame:
    """The four held-out windows of fourteen days, each day fed by the predictions before it."""
    df = M.backtest(_long_rows(r), BACKTEST_STARTS, BACKTEST_DROP_STARTS, model=_linear(1, FORECAST_FEATURES, lags=True))
    return rounded(df, "target", "y_pred")


SEASON, SEASON_DAYS = dt.date(2023, 4, 1), 183       # 1 April to 1 October
_SEASON_IN = {**_LONG_IN, "type_id": "x.type_id"}


@query("season_linear", with_roles("tile_weather", **_LONG, s=f"""
SELECT DISTINCT {_KEYS} FROM x WHERE timestamp BETWEEN DATE '{SEASON}' AND DATE '{SEASON}' + {SEASON_DAYS - 1}""", r=f"""
SELECT tree_id, type_id, 0 AS d, CAST(NULL AS DOUBLE) AS target, CAST(NULL AS DOUBLE) AS y, {SEASON_START_LAG}::DOUBLE AS l1, {SEASON_START_LAG}::DOUBLE AS l2,
 {SEASON_START_LAG}::DOUBLE AS l3 FROM s
UNION ALL SELECT tree_id, type_id, d, target, y, coalesce(y, {SEASON_START_LAG}), CASE WHEN y IS NULL THEN {SEASON_START_LAG} ELSE l1 END,
 CASE WHEN y IS NULL THEN {SEASON_START_LAG} ELSE l2 END
 FROM (SELECT r.tree_id, r.type_id, r.d + 1 AS d, x.target, r.l1, r.l2, {_linear_sql(2, _SEASON_IN)} + r.l1 * 0.4 + r.l2 * 0.2 + r.l3 * 0.1 AS y
 FROM r LEFT JOIN x ON x.tree_id = r.tree_id AND x.type_id = r.type_id AND x.timestamp = DATE '{SEASON}' + r.d WHERE r.d < {SEASON_DAYS})""").replace("WITH ", "WITH RECURSIVE ", 1) + f"""
SELECT {_KEYS}, CAST(DATE '{SEASON}' + d - 1 AS DATE) AS timestamp, round(target + 1e-9, 4) AS target, round(y + 1e-9, 4) AS y_pred FROM r WHERE y IS NOT NULL""")
def season_linear(r: Roles) -> DataFrame:
    """A whole season from constant lags."""
    model = _linear(2, [*FORECAST_FEATURES, "type_id"], lags=True)
    df = M.season_forecast(model, _long_rows(r), SEASON, SEASON_DAYS)
    return rounded(df.select("tree_id", "type_id", "timestamp", "target", "y_pred"), "target", "y_pred")


# --- forests ----------------------------------------------------------------------------------

@query("train_nowcast")
def train_nowcast(r: Roles) -> DataFrame:
    """Forests per depth, then all street trees at one day with the mean over the depths."""
    prep, rows = _training(r, False)
    frame = prep.transform_inference(cut_lineage(E.inference_frame(tables(r), False, LAST)))
    return M.nowcast(M.train_nowcast(rows), frame, M.group_means(prep.last_mean), LAST, CREATED)


_KNOWN = """WITH m AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS tree_id FROM orders WHERE month(o_orderdate) = 5),
t AS (SELECT CAST(c_custkey AS VARCHAR) AS tree_id FROM customer WHERE c_acctbal > 0 AND c_custkey % 120 > 0 AND c_custkey % 120 <= 100)
"""


@query("nowcast_coverage", _KNOWN + """
SELECT tree_id, k AS type_id, DATE '2024-05-20' AS day FROM t JOIN m USING (tree_id), (SELECT unnest([1, 2, 3, 4]) AS k)""")
def nowcast_coverage(r: Roles) -> DataFrame:
    """Every street tree with complete inputs has a value per depth and their mean."""
    return train_nowcast(r).select("tree_id", "type_id", F.to_date("timestamp").alias("day"))


@query("forecast_14")
def forecast_14(r: Roles) -> DataFrame:
    """Fourteen recursive days for every street tree and depth."""
    prep, rows = _training(r, True)
    base = prep.transform_inference(cut_lineage(E.inference_frame(tables(r), True, LAST)))
    past, coming = _weather_of_days(r)
    return M.forecast(M.train_forecast(rows), M.train_auxiliary(rows), base, M.group_means(prep.last_mean), past, coming, LAST, CREATED)


@query("feature_importances")
def feature_importances(r: Roles) -> DataFrame:
    """Of the forest over all depths."""
    _, rows = _training(r, False)
    return M.importances(r.spark, M.train(rows, NOWCAST_FEATURES, M.forest(M.NOWCAST_FOREST)), NOWCAST_FEATURES)


@query("backtest")
def backtest(r: Roles) -> DataFrame:
    """Errors by step over the four held-out windows."""
    return metrics_by_horizon(M.backtest(_long_rows(r), BACKTEST_STARTS, BACKTEST_DROP_STARTS, FORECAST_FOREST))


@query("season_forecast")
def season_forecast(r: Roles) -> DataFrame:
    """A whole season from constant lags, by a forest fitted on the years before."""
    rows = _long_rows(r)
    model = M.train_season(rows, SEASON - dt.timedelta(days=1))
    return error_summary(M.season_forecast(model, rows, SEASON, SEASON_DAYS), "target", "y_pred")


@query("compare_models")
def compare_models(r: Roles) -> DataFrame:
    """Three regressors, each fitted on all depths, and the benchmark over four site folds."""
    _, rows = _training(r, False)
    rows = rows.withColumnRenamed("target", "value")
    folds = cut_lineage(E.site_folds(rows, 4))
    return M.evaluate_models(M.predict_folds(rows, folds, 4, M.estimators(), per_depth=False))


@query("compare_linear", f"""
WITH e AS (SELECT user_id AS site_id, {KIND_SQL} AS type_id, CAST(ts AS DATE) AS timestamp, avg(value) AS value FROM events
 WHERE {KIND_SQL} <= 3 GROUP BY 1, 2, 3),
f AS (SELECT site_id, (row_number() OVER (ORDER BY md5(CAST(site_id AS VARCHAR) || '|42'), site_id) - 1) % 4 AS fold FROM (SELECT DISTINCT site_id FROM e)),
k AS (SELECT unnest([0, 1, 2, 3]) AS k),
m AS (SELECT k, type_id, timestamp, avg(value) AS v FROM e JOIN f USING (site_id), k WHERE fold <> k GROUP BY 1, 2, 3),
y AS (SELECT k, type_id, timestamp, lag(v) OVER (PARTITION BY k, type_id ORDER BY timestamp) AS b FROM m),
x AS (SELECT y.k, e.type_id, e.value, y.b, f.fold <> y.k AS train FROM e JOIN f USING (site_id) JOIN y ON y.type_id = e.type_id AND y.timestamp = e.timestamp
 WHERE y.b IS NOT NULL),
c AS (SELECT k, type_id, regr_slope(value, b) AS slope, regr_intercept(value, b) AS base FROM x WHERE train GROUP BY 1, 2),
s AS (SELECT x.k, x.type_id, round_even(sqrt(avg((value - slope * b - base) ** 2)), 2) AS rmse, round_even(avg(abs(value - slope * b - base)), 2) AS mae,
 round_even(sqrt(avg((value - b) ** 2)), 2) AS b_rmse, round_even(avg(abs(value - b)), 2) AS b_mae
 FROM x JOIN c ON c.k = x.k AND c.type_id = x.type_id WHERE NOT train GROUP BY 1, 2)
SELECT 'LinearRegression' AS model, type_id, round(avg(rmse) + 1e-9, 4) AS rmse, round(avg(mae) + 1e-9, 4) AS mae FROM s GROUP BY 2
UNION ALL SELECT 'benchmark', type_id, round(avg(b_rmse) + 1e-9, 4), round(avg(b_mae) + 1e-9, 4) FROM s GROUP BY 2""")
def compare_linear(r: Roles) -> DataFrame:
    """The same comparison with a regression on yesterday's mean alone, per depth, over four site folds."""
    e = (r.events.groupBy(F.col("user_id").alias("site_id"), kind().alias("type_id"), F.to_date("ts").alias("timestamp"))
         .agg(F.avg("value").alias("value")).where("type_id <= 3").withColumn("tree_id", F.col("site_id").cast("string")))
    folds = cut_lineage(E.site_folds(e, 4))
    predicted = M.predict_folds(e, folds, 4, {"LinearRegression": LinearRegression(solver="normal")}, ["mean_yesterday"])
    return rounded(M.evaluate_models(predicted), "rmse", "mae")
