"""Daily roll-ups, exact order statistics, the latest-value pivot and error metrics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from canopy.constants import DEPTH_MEAN_TYPE
from canopy.functions.scalars import round_half_even
from canopy.operators.relational import since, union_all
from canopy.session import cut_lineage

LEAF_ROWS = 1 << 16     # rows of a part that is put in order
BUCKETS = 4096          # parts that a larger one is cut into
SMALL_ROWS = 50_000     # rows of figures by group that may be broadcast: a few megabytes


# --- daily roll-ups ---------------------------------------------------------------------------

def daily_weather_aggs() -> list[Column]:
    """Daily maxima, sums and means of hourly weather. An all-null sum is 0, as in the source."""
    fields = {"ghi": "wm2", "dni": "wm2", "dhi": "wm2"}
    return ([F.max(c).alias(f"{c}_max_{u}") for c, u in fields.items()]
            + [F.coalesce(F.sum(c), F.lit(0.0)).alias(f"{c}_sum_whm2") for c in fields]
            + [F.avg("wind").alias("wind_avg_ms"), F.max("wind").alias("wind_max_ms"),
               F.avg("temp").alias("temp_avg_c"), F.max("temp").alias("temp_max_c"),
               F.coalesce(F.sum("rainfall_mm"), F.lit(0.0)).alias("rainfall_mm")])


def daily_weather(hourly: DataFrame, zone: str = "CET", tile: str = "tile_id") -> DataFrame:
    day = F.to_date(F.from_utc_timestamp(F.col("ts").cast("timestamp"), zone))
    return hourly.groupBy(tile, day.alias("date")).agg(*daily_weather_aggs())


def daily_rain_aggs(agg: str = "mean") -> list[Column]:
    total = F.sum("rainfall_mm") if agg == "sum" else F.avg("rainfall_mm")
    return [total.alias("rainfall_mm"), F.max("rainfall_mm").alias("rainfall_max_mm")]


def daily_rain(cells: DataFrame, agg: str = "mean") -> DataFrame:
    """Mean (not sum) and maximum of the hourly rain per tile and day."""
    return cells.groupBy("tile_id", F.to_date("ts").alias("date")).agg(*daily_rain_aggs(agg))


def daily_watering(events: DataFrame) -> DataFrame:
    return (events.groupBy("tree_id", F.to_date("ts").alias("date"))
            .agg(F.coalesce(F.sum("amount_liters"), F.lit(0.0)).alias("amount_liters")))


def watering_view(gdk: DataFrame, sga: DataFrame, today) -> DataFrame:
    """Litres per tree and day over both sources, last two months."""
    cols = ["tree_id", "amount_liters", "date"]
    both = union_all(gdk.select(*cols), sga.select(*cols))
    return (since(both, "date", "2 months", today)
            .groupBy("tree_id", "date").agg(F.sum("amount_liters").alias("sum")))


def mean_over_tiles(df: DataFrame, cols: Sequence[str], tile: str = "tile_id") -> DataFrame:
    return df.groupBy("date").agg(*[F.avg(c).alias(c) for c in cols if c != tile])


def add_depth_mean(pred: DataFrame, created_at=None) -> DataFrame:
    """Append the mean over the depths as an extra kind, for the rows of one run."""
    run = pred if created_at is None else pred.where(F.col("created_at") == F.lit(created_at))
    keys = ["tree_id", "timestamp", "created_at", "model_id"]
    mean = (run.groupBy(*keys).agg(F.avg("value").alias("value"))
            .withColumn("type_id", F.lit(DEPTH_MEAN_TYPE)))
    return union_all(pred, mean)


def site_mean(df: DataFrame, keys: Sequence[str] = ("site_id", "type_id", "timestamp")) -> DataFrame:
    """Mean of every numeric column per site, kind and time; incomplete groups leave."""
    numeric = [f.name for f in df.schema if f.name not in keys
               and f.dataType.typeName() in {"double", "float", "integer", "long", "short"}]
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in numeric]).na.drop("any", subset=numeric)


def load_summary(df: DataFrame, day: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def max_date(df: DataFrame, day: str) -> DataFrame:
    return df.agg(F.max(day).alias(day))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


# --- exact order statistics -------------------------------------------------------------------

def _span(v: Column) -> Column:
    """A value on a scale whose differences neither overflow nor meet infinities; it never falls as the value rises."""
    return F.greatest(F.least(v, F.lit(1.7e308)), F.lit(-1.7e308)) / 4


def _sized(df: DataFrame) -> DataFrame:
    """Broadcast where a count shows that it is small; joined by shuffle beyond that."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def _wanted_ranks(probs: Iterable[float], n: Column) -> list[Column]:
    return [f((n - 1) * F.lit(p)) for p in probs for f in (F.floor, F.ceil)]


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], mean: str | None = None,
                      leaf: int = LEAF_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """Interpolating percentiles per group, exact for groups of any size, without a sort of the values.

    Spark's own exact percentile holds every distinct value of a group in one buffer. Here a group of more
    than ``leaf`` rows is cut into ``buckets`` parts between its least and largest value and only counted; the parts that
    hold a wanted rank are cut again between their own ends, until they are small or of one value. Counts are
    partial in every task. Only the rows of the last parts are put in order, a part at a time. Two rounds reach a
    part of a group of 10^12 values; each reads ``df`` once more. Infinite values count like any other.
    """
    group_key = F.col("_g")
    # The keys as one struct: null keys compare equal in it.
    rows = df.select(F.struct(*keys).alias("_g"), F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    ends = [F.count("*").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    stats = cut_lineage(rows.groupBy("_g").agg(*ends, F.sum("_v").alias("_sum")))
    small = (F.col("_c") <= leaf) | (_span(F.col("_lo")) == _span(F.col("_hi")))
    parts = stats.select("_g", "_lo", "_hi", "_c", F.lit(0).cast("long").alias("_start"), F.col("_c").alias("_n"))
    leaves = parts.where(small)
    while (parts := parts.where(~small)).take(1):
        at = (_span(F.col("_v")) - _span(F.col("_a"))) / (_span(F.col("_b")) - _span(F.col("_a"))) * buckets
        within = parts.select("_g", F.col("_lo").alias("_a"), F.col("_hi").alias("_b"), "_start", "_n")
        counts = (rows.join(_sized(within), "_g").where(F.col("_v").between(F.col("_a"), F.col("_b")))
                  .groupBy("_g", "_a", "_start", "_n", F.least(F.floor(F.coalesce(at, F.lit(0.0))), F.lit(buckets - 1)).alias("_at")).agg(*ends))
        before = Window.partitionBy("_g", "_a").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)   # `buckets` rows at most
        first = F.col("_start") + F.coalesce(F.sum("_c").over(before), F.lit(0))
        hit = reduce(or_, [(r >= F.col("_first")) & (r < F.col("_first") + F.col("_c")) for r in _wanted_ranks(probs.values(), F.col("_n"))])
        parts = cut_lineage(counts.withColumn("_first", first).where(hit).select("_g", "_lo", "_hi", "_c", F.col("_first").alias("_start"), "_n"))
        leaves = leaves.union(parts.where(small))
    order = Window.partitionBy("_g", "_lo").orderBy("_v")
    found = (rows.join(_sized(leaves), "_g").where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
             .groupBy("_g", "_lo", "_start", "_n", "_v").agg(F.count("*").alias("_c"))
             .withColumn("_to", F.col("_start") + F.sum("_c").over(order)).withColumn("_from", F.col("_to") - F.col("_c")))
    picks, outs = [], []
    for name, p in probs.items():
        h = (F.col("_n") - 1) * F.lit(p)
        for side, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            picks.append(F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_to")), F.col("_v"))).alias(f"_{side}_{name}"))
        below, above = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        outs.append(F.when(below == above, below).otherwise(below + (above - below) * (h - F.floor(h))).alias(name))
    got = found.groupBy("_g").agg(*picks, F.max("_n").alias("_n"))
    if mean:
        got = got.join(stats.select("_g", (F.col("_sum") / F.col("_c")).alias("_mean")), "_g")
        outs.insert(0, F.col("_mean").alias(mean))
    return got.select(*[group_key[k].alias(k) for k in keys], *outs)


def sensor_group_stats(df: DataFrame) -> DataFrame:
    """Mean and exact median of the sensor values per kind and time."""
    return exact_percentiles(df, ["type_id", "timestamp"], "value", {"median_value": 0.5},
                             mean="mean_value")


def most_frequent(df: DataFrame, cols: Sequence[str], ranks: Mapping[str, Column] | None = None) -> DataFrame:
    """One row with the most frequent value of every column; ties go to the smallest (or the lowest rank).

    All columns are counted in one pass over (column, value), which is aggregated before the shuffle.
    """
    numeric = {f.name for f in df.schema if f.dataType.typeName() not in ("string", "date", "timestamp")}
    values = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
        (ranks or {}).get(c, F.lit(0)).cast("int").alias("rank"),
        (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("number")) for c in cols]))
    counts = (df.select(values.alias("_v")).select("_v.*").where(F.col("value").isNotNull())
              .groupBy("column", "value", "rank", "number").agg(F.count("*").alias("n")))
    best = F.struct(-F.col("n"), "rank", "number", "value")
    return counts.agg(*[F.min_by(F.col("value"), F.when(F.col("column") == c, best)).cast(df.schema[c].dataType).alias(c)
                        for c in cols])


def impute_mode(df: DataFrame, cols: Sequence[str], ranks: Mapping[str, Column] | None = None) -> DataFrame:
    """Fill nulls with the most frequent value of the column."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    modes = most_frequent(df, present, ranks).select(F.struct(*present).alias("_m")).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), modes[c]) for c in present})


def distinct_sorted_array(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sorted distinct values per key, nulls included; for small domains such as sensor kinds."""
    values = df.select(*keys, value).distinct()
    boxed = F.sort_array(F.collect_list(F.struct(F.col(value).isNull().alias("n"), F.col(value).alias("v"))))
    return values.groupBy(*keys).agg(F.transform(boxed, lambda s: s["v"]).alias(name))


def pivot_latest(df: DataFrame, key: str, kind: str, kinds: Mapping[int, str], fields: Mapping[str, str],
                 order: Sequence[str], prefix: str = "nowcast") -> DataFrame:
    """One wide row per key with the newest row of each kind.

    ``fields`` maps output stems to columns, ``order`` names the recency columns (nulls count as
    newest). One shuffle with a partial aggregate: a task sends one row per key at most.
    """
    payload = F.struct(*[F.col(c).alias(s) for s, c in fields.items()])
    recency = F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))])
    picks = [F.max_by(payload, F.when(F.col(kind) == k, recency)).alias(f"_{label}")
             for k, label in kinds.items()]
    wide = df.groupBy(key).agg(*picks)
    return wide.select(key, *[F.col(f"_{label}.{s}").alias(f"{prefix}_{s}_{label}")
                              for s in fields for label in kinds.values()])


def pivot_latest_positional(df: DataFrame, key: str, name: str, kinds: Sequence[str],
                            fields: Mapping[str, str], prefix: str = "nowcast") -> DataFrame:
    """As the array-indexed original: rows sorted by kind name fill the columns left to right.

    A missing kind shifts the later ones. Expects one row per key and kind, so arrays stay short.
    """
    rows = F.sort_array(F.collect_list(F.struct(
        F.col(name).alias("_name"), *[F.col(c).alias(s) for s, c in fields.items()])))
    wide = df.groupBy(key).agg(rows.alias("_rows"))
    return wide.select(key, *[F.get("_rows", F.lit(i))[s].alias(f"{prefix}_{s}_{label}")
                              for s in fields for i, label in enumerate(kinds)])


# --- errors -----------------------------------------------------------------------------------

def regression_metrics(df: DataFrame, y: str, y_hat: str, by: Sequence[str] = (),
                       digits: int | None = 2) -> DataFrame:
    err = F.col(y) - F.col(y_hat)
    rmse, mae = F.sqrt(F.avg(err * err)), F.avg(F.abs(err))
    if digits is not None:
        rmse, mae = round_half_even(rmse, digits), round_half_even(mae, digits)
    return df.groupBy(*by).agg(rmse.alias("rmse"), mae.alias("mae"))


def metrics_by_horizon(df: DataFrame, y: str = "target", y_hat: str = "y_pred") -> DataFrame:
    return regression_metrics(df, y, y_hat, ["window"], digits=None)


def error_summary(df: DataFrame, y: str, y_hat: str) -> DataFrame:
    """Bias, mean absolute error, sample deviation and the normal fit of the error."""
    err = F.col(y) - F.col(y_hat)
    return df.agg(F.avg(err).alias("bias"), F.avg(F.abs(err)).alias("mae"),
                  F.stddev_samp(err).alias("error_std"), F.stddev_pop(err).alias("sigma"))


def error_quantiles(df: DataFrame, error: str, by: Sequence[str]) -> DataFrame:
    """Box-plot figures: quartiles, and the outermost values within 1.5 box lengths."""
    box = exact_percentiles(df, by, error, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    v = F.col(error)
    inside = v.between(F.col("q1") - reach, F.col("q3") + reach)
    figures = cut_lineage(box.select(F.struct(*by).alias("_g"), "q1", "median", "q3"))   # null keys compare equal in a struct
    return (df.select(F.struct(*by).alias("_g"), error).join(_sized(figures), "_g")
            .groupBy(*[F.col("_g")[k].alias(k) for k in by], "q1", "median", "q3")
            .agg(F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high")))


def fold_summary(df: DataFrame, by: Sequence[str] = ("model", "type_id")) -> DataFrame:
    return df.groupBy(*by).agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"))


def mean_metrics(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"))


def share(df: DataFrame, key: str, v: str, name: str = "share") -> DataFrame:
    """Each key's part of the sum of absolute values, largest first."""
    sums = df.groupBy(key).agg(F.sum(F.abs(F.col(v))).alias("_s"))
    total = df.agg(F.sum(F.abs(F.col(v))).alias("_t")).scalar()
    return sums.select(key, F.try_divide(F.col("_s"), total).alias(name)).orderBy(F.col(name).desc(), key)
