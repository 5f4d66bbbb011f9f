"""Trailing frames, lags, latest-per-key, gap filling and calendar blocks.

Frames count rows, not days. Where the partition is a daily series its size is bounded by the
calendar and a plain window is used; for raw timestamps pass ``chunks`` (0: as many as the session has
shuffle partitions) and the same result is computed over chunks of each key (see ``ranking``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from canopy.constants import FILL_DAYS, LAGS, ROLLING_ROWS, TRAILING_ROWS
from canopy.operators.ranking import with_history


def _over(df: DataFrame, keys: Sequence[str], order: Sequence[str], back: int,
          exprs, chunks: int | None) -> DataFrame:
    """Add window expressions that look at most ``back`` rows behind."""
    if chunks is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns(exprs(w))
    parts = with_history(df, keys, order, back, chunks)
    w = Window.partitionBy("_chunk", *keys).orderBy(*order)
    return parts.withColumns(exprs(w)).where(~F.col("_halo")).drop("_chunk", "_halo")


def trailing(df: DataFrame, order: str | Sequence[str], rows: int, aggs: Mapping[str, Column],
             partition: Sequence[str] = (), chunks: int | None = None) -> DataFrame:
    """Aggregates over the current row and the ``rows - 1`` rows before it."""
    order = [order] if isinstance(order, str) else list(order)
    return _over(df, list(partition), order, rows - 1,
                 lambda w: {n: a.over(w.rowsBetween(1 - rows, 0)) for n, a in aggs.items()}, chunks)


def trailing_weather(df: DataFrame, partition: Sequence[str], rows: int = TRAILING_ROWS) -> DataFrame:
    """Rain sum and temperature / wind means over the trailing rows of a daily weather series."""
    means = ["temp_avg_c", "wind_avg_ms", "temp_max_c", "wind_max_ms"]
    aggs = {f"rainfall_mm_{rows}d_sum": F.sum("rainfall_mm")}
    aggs |= {f"{c}_{rows}d_avg": F.avg(c) for c in means}
    return trailing(df, "date", rows, aggs, partition)


def rolling_weather(df: DataFrame, cols: Sequence[str], partition: Sequence[str] = (),
                    rows: int = ROLLING_ROWS) -> DataFrame:
    """Replace each column by its trailing value: rain as a sum, all others as a mean."""
    aggs = {c: (F.sum(c) if c == "rainfall_mm" else F.avg(c)) for c in cols}
    return trailing(df, "date", rows, aggs, partition)


def add_lags(df: DataFrame, keys: Sequence[str], order: str, value: str, n: int = LAGS,
             prefix: str = "shift_", chunks: int | None = None) -> DataFrame:
    """``shift_1..n``: the value 1..n rows earlier in the series of a key; no calendar check."""
    return _over(df, list(keys), [order], n,
                 lambda w: {f"{prefix}{i}": F.lag(value, i).over(w) for i in range(1, n + 1)}, chunks)


def newest_first(*cols: str) -> list[Column]:
    """Descending order with nulls first, as a descending sort in the SQL dialect of the views."""
    return [F.col(c).desc_nulls_first() for c in cols]


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order.

    The filter on the row number becomes a group limit before the shuffle: each task sends at most
    one row per key, so a hot key costs no more than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def dedup_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key, e.g. by source rank, then file order."""
    return latest_per(df, key, [F.col(c).asc() for c in order])


def latest_rows(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """All rows at the newest time of their key, ties kept.

    Joining on key *and* time spreads a hot key over its times.
    """
    newest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    return df.join(newest, [*keys, ts], "left_semi")


def group_mean(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def mean_yesterday(df: DataFrame, ts: str = "timestamp", kind: str = "type_id",
                   value: str = "value", chunks: int | None = None) -> DataFrame:
    """Per kind and time: the group mean of the previous *available* time of that kind."""
    means = group_mean(df, [ts, kind], value, "_mean")
    lagged = add_lags(means, [kind], ts, "_mean", 1, prefix="_lag_", chunks=chunks)
    return lagged.select(ts, kind, F.col("_lag_1").alias("mean_yesterday"))


def last_group_mean(df: DataFrame, ts: str = "timestamp", kind: str = "type_id",
                    value: str = "value") -> DataFrame:
    """The newest group mean of each kind; inference uses it as its ``mean_yesterday``."""
    means = group_mean(df, [ts, kind], value, "_mean")
    return means.groupBy(kind).agg(F.max_by("_mean", ts).alias("mean_yesterday"))


def resample_ffill(df: DataFrame, keys: Sequence[str], ts: str = "timestamp",
                   limit: int = FILL_DAYS) -> DataFrame:
    """Carry each whole row forward onto the midnights of its key, at most ``limit`` days.

    The grid runs from the day of the first to the day of the last reading. A reading shows at the
    first midnight at or after it; midnights out of reach keep the key and null values.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys and c != ts]
    day = F.to_date(ts)
    seen = F.when(F.date_trunc("day", F.col(ts)) == F.col(ts), day).otherwise(F.date_add(day, 1))
    # Only the newest reading before a midnight can show: one row per key and day goes on, which
    # bounds every window below by the calendar whatever the rate of readings.
    newest = F.max(F.struct(F.col(ts).alias("_ts"), *payload))
    daily = (df.where(F.col(ts).isNotNull())
             .withColumn("_seen", seen)
             .groupBy(*keys, "_seen").agg(newest.alias("_row"), F.min(ts).alias("_first"))
             .select(*keys, "_seen", "_first", "_row.*"))
    w = Window.partitionBy(*keys).orderBy("_seen")
    last_day = F.to_date("_ts")
    spans = (daily
             .withColumn("_to", F.coalesce(F.date_sub(F.lead("_seen").over(w), 1), last_day))
             .withColumn("_from", F.when(F.lag("_seen").over(w).isNull(), F.to_date("_first"))
                         .otherwise(F.col("_seen")))
             .where(F.col("_from") <= F.col("_to"))
             .withColumn("_day", F.explode(F.sequence("_from", "_to", F.expr("interval 1 day")))))
    shows = (F.col("_day") >= F.col("_seen")) & (F.datediff("_day", last_day) <= limit)
    out = {ts: F.col("_day").cast(df.schema[ts].dataType)} | {c: F.when(shows, F.col(c)) for c in payload}
    return spans.select(*keys, *[e.alias(n) for n, e in out.items()]).select(*df.columns)


def reindex_daily(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Every day between the first and last of a key; days without a row carry nulls."""
    span = df.groupBy(*keys).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    grid = span.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias(day))
    return grid.join(df, [*keys, day], "left").select(*df.columns)


def week_block_split(df: DataFrame, week: str, n_train: int = 5, n_test: int = 4) -> DataFrame:
    """Label rows ``train`` / ``test`` by the position of their week in repeating blocks.

    A block starts only if a test week remains for it; a shorter tail gets a null label.
    """
    size = n_train + n_test
    # Distinct weeks: bounded by the calendar, so ranking them in one task is fine.
    weeks = (df.select(week).distinct()
             .withColumn("_p", F.row_number().over(Window.orderBy(week)) - 1)
             .withColumn("_n", F.count("*").over(Window.partitionBy())))
    in_block = F.pmod("_p", F.lit(size))
    label = F.when(F.col("_p") - in_block + n_train < F.col("_n"),
                   F.when(in_block < n_train, "train").otherwise("test"))
    return df.join(weeks.select(week, label.alias("part")), week, "left")
