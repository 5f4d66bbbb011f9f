"""Projection, filters, joins, set operations, paging and sampling."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from canopy.functions.scalars import in_months, literal_day, ratio as safe_ratio
from canopy.operators.ranking import ranked
from canopy.operators.windows import latest_per

TOP_ROWS = 10_000       # first rows of an order that tasks may hand on whole
SAMPLE_ROWS = 2048      # keys that cut an order into ranges
RANGES = 64

# --- projection -------------------------------------------------------------------------------

def rename(df: DataFrame, mapping: Mapping[str, str] | None = None, drop: Sequence[str] = (),
           lower: bool = False) -> DataFrame:
    if lower:
        df = df.toDF(*[c.lower() for c in df.columns])
    return df.withColumnsRenamed(dict(mapping or {})).drop(*drop)


def stamp(df: DataFrame, now: dt.datetime | dt.date, **consts) -> DataFrame:
    """Constant columns plus ``created_at`` and ``updated_at``."""
    cols = {k: F.lit(v) for k, v in consts.items()}
    return df.withColumns({**cols, "created_at": F.lit(now), "updated_at": F.lit(now)})


def with_lat_lng(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    return df.withColumns({"lat": F.col(f"{geometry}.y"), "lng": F.col(f"{geometry}.x")})


def select_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in names if c in df.columns])


# --- filters ----------------------------------------------------------------------------------

def filter_eq(df: DataFrame, **values) -> DataFrame:
    """Equality on each column; a list means membership."""
    for name, v in values.items():
        df = df.where(F.col(name).isin(v) if isinstance(v, (list, tuple)) else F.col(name) == F.lit(v))
    return df


def in_season(df: DataFrame, day: str, lo: int, hi: int) -> DataFrame:
    return df.where(in_months(day, lo, hi))


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns."""
    return df.na.drop("any", subset=list(cols) if cols is not None else None)


def labelled(df: DataFrame, value: str = "value") -> DataFrame:
    return df.where(F.col(value).isNotNull()).withColumnRenamed(value, "target")


def fill_const(df: DataFrame, cols: Sequence[str], v: float) -> DataFrame:
    return df.na.fill(v, subset=list(cols))


def since(df: DataFrame, day: str, interval: str, today: dt.date | str) -> DataFrame:
    """Rows not older than ``today`` minus an interval such as ``2 months``."""
    return df.where(F.col(day) >= literal_day(today) - F.expr(f"interval {interval}"))


def time_slice(df: DataFrame, ts: str, lo=None, hi=None) -> DataFrame:
    """``lo <= ts < hi``; an open bound is left out, a period without rows is an empty frame."""
    if lo is not None:
        df = df.where(F.col(ts) >= F.lit(lo))
    if hi is not None:
        df = df.where(F.col(ts) < F.lit(hi))
    return df


def _in_windows(day: Column, starts: Sequence[dt.date], days: int) -> Column:
    spans = [day.between(literal_day(s), literal_day(s + dt.timedelta(days=days - 1))) for s in starts]
    return reduce(lambda a, b: a | b, spans)


def window_split(df: DataFrame, ts: str, test_starts: Sequence[dt.date], test_days: int,
                 drop_starts: Sequence[dt.date], drop_days: int) -> tuple[DataFrame, DataFrame]:
    """Rows outside the wider drop windows (train) and rows inside the test windows (test)."""
    day = F.to_date(ts)
    return (df.where(~_in_windows(day, drop_starts, drop_days)),
            df.where(_in_windows(day, test_starts, test_days)))


# --- joins ------------------------------------------------------------------------------------

def join_on_day(left: DataFrame, ts: str, right: DataFrame, day: str,
                extra: Sequence[str] = ()) -> DataFrame:
    """Left join on the day of a timestamp (and equal extra columns). Several rows per day fan out."""
    r = right.withColumnRenamed(day, "_day")
    return left.withColumn("_day", F.to_date(ts)).join(r, ["_day", *extra], "left").drop("_day")


def spine(entities: DataFrame, lo: Column, hi: Column, name: str = "date") -> DataFrame:
    """Entities times days. A generator, so no join: each row unfolds its own calendar."""
    return entities.withColumn(name, F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))))


def with_types(entities: DataFrame, types: Sequence[int], name: str = "type_id") -> DataFrame:
    return entities.withColumn(name, F.explode(F.array(*[F.lit(t) for t in types])))


def only_new(src: DataFrame, known: DataFrame, key: Sequence[str]) -> DataFrame:
    return src.join(known.select(*key), list(key), "left_anti")


def restrict(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*key), list(key), "left_semi")


def join_latest(left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[Column],
                how: str = "left") -> DataFrame:
    return left.join(latest_per(right, keys, order), list(keys), how)


def full_outer(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.join(b, list(keys), "full_outer")


def attach_group_feature(df: DataFrame, feature: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join: rows whose group is missing on the feature side leave."""
    return df.join(feature, list(keys), "inner")


def ratio(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Column-wise quotient of two tables aligned on their keys."""
    cols = [c for c in a.columns if c not in keys]
    other = b.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in cols])
    return (a.join(other, list(keys), "full_outer")
            .select(*keys, *[safe_ratio(c, f"_b_{c}").alias(c) for c in cols]))


# --- sets, order, paging ----------------------------------------------------------------------

def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_keys(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def distinct_union(key: str, *dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, [d.select(key) for d in dfs]).distinct()


def duplicate_report(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys that occur twice in the batch or are known already."""
    seen = known.select(key).distinct().withColumn("in_known", F.lit(True))
    return (df.groupBy(key).agg(F.count("*").alias("n_in_batch"))
            .join(seen, key, "left")
            .select(key, "n_in_batch", F.coalesce("in_known", F.lit(False)).alias("in_known"))
            .where((F.col("n_in_batch") > 1) | F.col("in_known")))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def slice_ranked(df: DataFrame, order: Sequence[Column], lo: int, hi: int) -> DataFrame:
    """Rows ranked lo..hi of a unique order; ``hi`` may be any number.

    Up to ``TOP_ROWS`` every task hands on its first ``hi`` rows only; beyond that the ranks come from range chunks.
    """
    first = df.orderBy(*order).limit(hi) if hi <= TOP_ROWS else df
    return ranked(first, order, "rank").where(F.col("rank").between(lo, hi)).withColumn("rank", F.col("rank").cast("int"))


def key_range(df: DataFrame, order: Sequence[str], lo: int, hi: int) -> tuple[DataFrame, int]:
    """Rows among which are those ranked lo..hi of a unique order, and how many rows come before them.

    Keys of a small sample cut the order into ranges, one pass counts the rows below each cut, and the ranges
    that hold the wanted ranks are kept: no more of the table than these is ever sorted.
    """
    key = F.struct(*order)
    total = df.count()
    share = min(1.0, 2.0 * SAMPLE_ROWS / max(total, 1))
    sample = df.sample(share, seed=7).select(*order).orderBy(*order).limit(4 * SAMPLE_ROWS).collect()
    kinds = [df.schema[c].dataType for c in order]
    step = max(len(sample) // RANGES, 1)
    cuts = [F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(r, kinds, order)]) for r in sample[step::step]]
    if not cuts:
        return df, 0
    counts = df.agg(*[F.count_if(key < c).alias(f"_{i}") for i, c in enumerate(cuts)]).first()
    cuts = [cuts[i] for i in sorted(range(len(cuts)), key=counts.__getitem__)]
    below = [0, *sorted(counts), total]
    at = max(i for i, n in enumerate(below[:-1]) if n < max(lo, 1))
    end = min((i for i, n in enumerate(below) if n >= hi and i > at), default=len(below) - 1)
    if at:
        df = df.where(key >= cuts[at - 1])
    if end <= len(cuts):
        df = df.where(key < cuts[end - 1])
    return df, below[at]


def page(df: DataFrame, order: Sequence[str], size: int, number: int) -> DataFrame:
    """Page ``number`` (from 0) of a unique order. A deep page costs no more than the first."""
    return ranks_between(df, order, size * number + 1, size * (number + 1)).drop("_rank")


def ranks_between(df: DataFrame, order: Sequence[str], lo: int, hi: int) -> DataFrame:
    """Rows ranked lo..hi of a unique order, with ``_rank``."""
    part, before = key_range(df, order, lo, hi)
    rows = ranked(part, order, "_rank").withColumn("_rank", F.col("_rank") + before)
    return rows.where(F.col("_rank").between(lo, hi))


def sample_n(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """The same ``n`` rows on every run: those with the smallest seeded hash of their key; ``n`` may be any number.

    Counts by the first digits of the hash tell up to where it is needed; only the rows up to there are put in order.
    """
    hashed = df.withColumn("_h", seeded_hash(keys, seed))
    digits = F.substring("_h", 1, 4)
    counts = sorted(hashed.groupBy(digits.alias("d")).count().collect())        # 65,536 at most
    upto = list(accumulate(r["count"] for r in counts))
    last = next((r["d"] for r, m in zip(counts, upto) if m >= n), "g")          # beyond all digits
    return ranked(hashed.where(digits <= last), ["_h", *keys], "_i").where(F.col("_i") <= n).drop("_h", "_i")


def seeded_hash(keys: Sequence[str], seed: int) -> Column:
    """MD5 of the key columns as text and the seed, which any engine computes alike."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed))))


def sample_frac(df: DataFrame, keys: Sequence[str], p: float, seed: int = 42) -> DataFrame:
    """Rows whose seeded hash falls in the first ``p`` of its range: the same rows however they are partitioned."""
    part = F.conv(F.substring(seeded_hash(keys, seed), 1, 8), 16, 10).cast("long")
    return df.where(part < int(p * 16**8))


def with_serial_id(df: DataFrame, order: Sequence[str], start: int = 1, name: str = "id",
                   maximum: int = 2**31 - 1) -> DataFrame:
    """Consecutive ids over a unique order, starting again at 1 after ``maximum``."""
    numbered = ranked(df, order, "_rank")
    wrapped = F.pmod(F.col("_rank") + F.lit(start - 2), F.lit(maximum)) + 1
    return numbered.withColumn(name, wrapped).drop("_rank")
