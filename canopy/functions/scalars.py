"""Scalar column expressions: dates, rounding, bins and small conversions. All run in the JVM."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(ts: ColumnLike) -> Column:
    return F.to_date(col(ts))


def day_start(ts: ColumnLike) -> Column:
    return F.date_trunc("day", col(ts))


def month_of(ts: ColumnLike) -> Column:
    return F.month(col(ts))


def last_minute_50(ts: ColumnLike) -> Column:
    """The most recent full hour plus 50 minutes, the time stamp of hourly rain composites."""
    shift = F.expr("interval 50 minutes")
    return F.date_trunc("hour", col(ts) - shift) + shift


def days_between(lo: ColumnLike, hi: ColumnLike) -> Column:
    """Array of days lo..hi, both ends included; explode it for a calendar."""
    return F.sequence(col(lo), col(hi), F.expr("interval 1 day"))


def in_months(c: ColumnLike, lo: int, hi: int) -> Column:
    return F.month(col(c)).between(lo, hi)


def to_zone(ts: ColumnLike, zone: str) -> Column:
    return F.from_utc_timestamp(col(ts), zone)


def from_zone(ts: ColumnLike, zone: str) -> Column:
    return F.to_utc_timestamp(col(ts), zone)


def parse_day(text: ColumnLike, fmt: str) -> Column:
    return F.to_date(col(text), fmt)


def format_day(day: ColumnLike, fmt: str) -> Column:
    return F.date_format(col(day), fmt)


def as_day(c: ColumnLike) -> Column:
    """A date from a date, a timestamp or ISO text; null when the whole text is neither a date nor a time."""
    text = col(c).cast("string")
    time = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?$"), text.try_cast("timestamp"))
    return F.coalesce(F.try_to_date(text, "yyyy-M-d"), F.to_date(time))


def shift_days(day: ColumnLike, n: int) -> Column:
    return F.date_add(col(day), n)


def shift_months(day: ColumnLike, n: int) -> Column:
    """Month arithmetic clamps at the end of the month, as interval arithmetic does."""
    return F.add_months(col(day), n)


def shift_hours(ts: ColumnLike, n: int) -> Column:
    return col(ts) + F.make_interval(hours=F.lit(n))


def earlier(a: ColumnLike, b: ColumnLike) -> Column:
    return F.least(col(a), col(b))


def round_to_int(v: ColumnLike) -> Column:
    """Nearest integer, halves to even; a plain cast would cut the fraction off."""
    return F.rint(col(v)).cast("int")


def round_half_even(v: ColumnLike, digits: int = 2) -> Column:
    """Rounds the scaled double, as array libraries do. ``bround`` would round the printed decimal,
    which differs where the double lies a hair beside a half."""
    scale = 10.0 ** digits
    return F.rint(col(v) * scale) / scale


def round_exact(v: ColumnLike, digits: int = 2) -> Column:
    """Rounds the exact value of the double, halves to even, as the language's scalar rounding does.

    The scaled double is off by less than half a step of its last bit; splitting the factor gives that error
    exactly, and it decides where the scaled double stands on a half.
    """
    v, scale = col(v), 10.0 ** digits
    p = v * scale
    wide = v * 134217729.0                  # Fixed value: 2**27 + 1, splits a double into two halves
    high = wide - (wide - v)
    error = (high * scale - p) + (v - high) * scale
    half = F.abs(p - F.floor(p)) == 0.5
    n = F.when(half & (error > 0), F.ceil(p)).when(half & (error < 0), F.floor(p)).otherwise(F.rint(p))
    return n / scale


def ratio(a: ColumnLike, b: ColumnLike) -> Column:
    return F.try_divide(col(a), col(b))


def log_plus_one(v: ColumnLike) -> Column:
    return F.log1p(col(v))


def classify(v: ColumnLike, bins: Sequence[tuple[float, float, str]]) -> Column:
    """Label of the right-closed bin ``(lo, hi]`` that holds the value, null outside all bins."""
    v = col(v)
    cases = [F.when((v > lo) & (v <= hi), F.lit(label)) for lo, hi, label in bins]
    return F.coalesce(*cases)


def nullable(v: ColumnLike) -> Column:
    """NaN means missing in the sources, so it becomes null."""
    return F.nanvl(col(v), F.lit(None).cast("double"))


def item(arr: ColumnLike, i: int) -> Column:
    """1-based element, null when the array is too short."""
    return F.get(col(arr), F.lit(i - 1))


def number_or_null(text: ColumnLike) -> Column:
    return col(text).try_cast("double")


def int_list(text: ColumnLike) -> Column:
    return F.transform(F.split(col(text), ","), lambda s: F.trim(s).cast("int"))


def lower_case(text: ColumnLike) -> Column:
    return F.lower(col(text))


def label_of(code: ColumnLike, labels: dict[int, str]) -> Column:
    pairs = [x for k, v in labels.items() for x in (F.lit(k), F.lit(v))]
    return F.create_map(*pairs)[col(code)]


def encode_json(*cols: ColumnLike) -> Column:
    return F.to_json(F.struct(*[col(c) for c in cols]))


def decode_json(text: ColumnLike, schema: str) -> Column:
    return F.from_json(col(text), schema)


def null_count(cols: Sequence[ColumnLike]) -> Column:
    """How many of the columns are null in this row."""
    return reduce(lambda a, b: a + b, [col(c).isNull().cast("int") for c in cols])


def literal_day(day: dt.date | str) -> Column:
    return F.lit(day).cast("date")
