"""Feature frames for training and inference."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from canopy.constants import (
    AGE_BINS, BED_BINS, CATEGORICAL, DEPTHS, IMPUTED, MONTHS, NUMERIC, ROLLING_ROWS, SEASON_START,
    SENSOR_SEASON, STATION_WEATHER, TILE_WEATHER, WATERING_SEASON, WEATHER_FORECAST, WEATHER_NOWCAST)
from canopy.functions.scalars import classify, in_months, literal_day
from canopy.operators.aggregates import impute_mode, mean_over_tiles
from canopy.operators.ranking import ranked
from canopy.operators.relational import (
    attach_group_feature, distinct_union, labelled, restrict, seeded_hash, select_present, spine, union_all)
from canopy.operators.windows import (
    add_lags, last_group_mean, mean_yesterday, resample_ffill, rolling_weather)
from canopy.session import cut_lineage


def monthly_long(df: DataFrame, key: str = "tree_id", months: Sequence[str] = MONTHS) -> DataFrame:
    """Twelve month columns to rows (key, month 1..12, shading_index); nulls stay."""
    return (df.select(key, F.posexplode(F.array(*months)).alias("_pos", "shading_index"))
            .select(key, (F.col("_pos") + 1).alias("month"), "shading_index"))


def categorise(df: DataFrame, age: str = "standalter", bed: str | None = None) -> DataFrame:
    cols = {}
    if age in df.columns:
        cols[age] = classify(age, AGE_BINS)
    if bed and bed in df.columns:
        cols[bed] = classify(bed, BED_BINS)
    return df.withColumns(cols)


def _season_position(day: Column, lo: int, hi: int) -> Column:
    """Running number of a day among the season days of all years."""
    first = F.make_date(F.year(day), F.lit(lo), F.lit(1))
    length = F.datediff(F.make_date(F.year(day), F.lit(hi + 1), F.lit(1)), first)
    return F.year(day) * length + F.datediff(day, first)


def watering_features(gdk: DataFrame, sga: DataFrame, lo: dt.date, hi: dt.date, season: bool = True,
                      rows: int = ROLLING_ROWS) -> DataFrame:
    """Trailing sums of both watering sources on a dense tree x day spine.

    Only trees watered by either source are on the spine. With ``season`` the spine keeps the
    watering months and the trailing rows bridge the winter. Inputs hold one row per tree and day.

    Spine rows and watering rows are stacked and summed in one window over the spine position, so
    the frame needs one shuffle by tree and no join. A tree's partition is bounded by its days.
    """
    trees = distinct_union("tree_id", gdk, sga)
    day = F.col("timestamp")
    zero = F.lit(0.0)
    grid = spine(trees, literal_day(lo), literal_day(hi), "timestamp").select(
        "tree_id", "timestamp", zero.alias("water_sga"), zero.alias("water_gdk"), F.lit(True).alias("_grid"))

    def source(df: DataFrame, name: str) -> DataFrame:
        amounts = {c: (F.coalesce(F.col("amount_liters"), zero) if c == name else zero)
                   for c in ("water_sga", "water_gdk")}
        return df.where(F.col("date").between(literal_day(lo), literal_day(hi))).select(
            "tree_id", F.col("date").alias("timestamp"), *[e.alias(c) for c, e in amounts.items()],
            F.lit(False).alias("_grid"))

    rows_all = union_all(grid, source(sga, "water_sga"), source(gdk, "water_gdk"))
    if season:
        rows_all = rows_all.where(in_months("timestamp", *WATERING_SEASON))
        position = _season_position(day, *WATERING_SEASON)
    else:
        position = F.datediff(day, literal_day(lo))
    w = Window.partitionBy("tree_id").orderBy("_p").rangeBetween(1 - rows, 0)
    return (rows_all.withColumn("_p", position)
            .withColumns({c: F.sum(c).over(w) for c in ("water_sga", "water_gdk")})
            .where("_grid").drop("_p", "_grid"))


def watering_features_on(gdk: DataFrame, sga: DataFrame, date: dt.date, rows: int = ROLLING_ROWS) -> DataFrame:
    """The same for inference: a spine of the last ``rows + 2`` days that ends at ``date``."""
    return watering_features(gdk, sga, date - dt.timedelta(days=rows + 1), date, season=False, rows=rows)


def fill_linear(df: DataFrame, cols: Sequence[str], partition: Sequence[str], limit: int = ROLLING_ROWS) -> DataFrame:
    """Linear fill between neighbours by row position, at most ``limit`` rows after a value.

    After the last value it is held. Values before the first stay null.
    """
    w = Window.partitionBy(*partition).orderBy("date")
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    df = df.withColumn("_i", F.row_number().over(w))
    out = {}
    for c in cols:
        known = F.when(F.col(c).isNotNull(), F.struct(F.col("_i").alias("i"), F.col(c).alias("v")))
        a, b = F.last(known, True).over(back), F.first(known, True).over(ahead)
        steps = F.col("_i") - a["i"]
        line = a["v"] + (b["v"] - a["v"]) * steps / F.nullif(b["i"] - a["i"], F.lit(0))
        out[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(steps <= limit, F.coalesce(line, a["v"]))
    return df.withColumns(out).drop("_i")


def weather_features(mode: str, station: DataFrame | None = None, tiles: DataFrame | None = None,
                     fill_gaps: bool = False, rows: int = ROLLING_ROWS) -> DataFrame:
    """Trailing daily weather.

    ``public``: station columns. ``nowcast``: station columns and the irradiance averaged over the
    tiles. ``forecast``: all columns averaged over the tiles, without vapour pressure.
    """
    partition = ["stations_id"] if station is not None and "stations_id" in station.columns else []
    if mode == "public":
        df, cols = station.select(*partition, "date", *STATION_WEATHER), list(STATION_WEATHER)
    elif mode == "nowcast":
        sun = mean_over_tiles(tiles, ["ghi_sum_whm2"])
        df = station.select(*partition, "date", *STATION_WEATHER).join(sun, "date", "left")
        cols = STATION_WEATHER + ["ghi_sum_whm2"]
    elif mode == "forecast":
        partition = []
        df, cols = mean_over_tiles(tiles, TILE_WEATHER), list(TILE_WEATHER)
    else:
        raise ValueError(f"mode must be public, nowcast or forecast, not {mode!r}")
    if fill_gaps:
        df = fill_linear(df, cols, partition)
    # A daily series of one place: the partition is bounded by the calendar.
    return rolling_weather(df, cols, partition, rows)


# --- ordinal codes ----------------------------------------------------------------------------

class OrdinalCodes:
    """Ordinal encoding by a fitted table (column, value, code).

    Values are coded in their natural order per column; an unseen value becomes -1, null stays null.
    The table holds category names only, one row each.
    """

    UNKNOWN = -1.0

    def __init__(self, codes: DataFrame):
        self.codes = codes

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "OrdinalCodes":
        """One pass over the rows for all columns; numbers sort as numbers, text as text."""
        numeric = {f.name for f in df.schema if f.dataType.typeName() not in ("string", "date", "timestamp")}
        values = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                     (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("number"))
            for c in cols]))
        distinct = df.select(values.alias("_v")).select("_v.*").where(F.col("value").isNotNull()).distinct()
        # One partition per column: as many rows as the column has categories.
        w = Window.partitionBy("column").orderBy("number", "value")
        return cls(distinct.select("column", "value", (F.row_number().over(w) - 1).cast("double").alias("code")))

    def transform(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        names = df.columns
        for c in cols:
            table = self.codes.where(F.col("column") == c).select(
                F.col("value").alias("_value"), F.col("code").alias("_code"))
            df = (df.join(table, F.col(c).cast("string") == F.col("_value"), "left")
                  .withColumn(c, F.when(F.col(c).isNotNull(), F.coalesce("_code", F.lit(self.UNKNOWN))))
                  .drop("_value", "_code"))
        return df.select(*names)


# --- base frames ------------------------------------------------------------------------------

@dataclass(frozen=True)
class Tables:
    """The inputs of the feature frames, by role. Unused roles may stay None."""
    trees: DataFrame
    sensors: DataFrame | None = None
    devices: DataFrame | None = None
    trees_private: DataFrame | None = None
    watering_gdk: DataFrame | None = None
    watering_sga: DataFrame | None = None
    shading_monthly: DataFrame | None = None
    weather: DataFrame | None = None
    weather_tiles: DataFrame | None = None


def street_trees(trees: DataFrame) -> DataFrame:
    return categorise(trees.where("street_tree").select(
        F.col("id").alias("tree_id"), "gattung", "standalter"))


def sensor_base(t: Tables, valid_devices_only: bool = False) -> DataFrame:
    """Sensor readings of street trees with tree class, site and month.

    Devices are matched by tree alone, so several devices of a tree multiply its readings, as in the
    original; ``valid_devices_only`` keeps the devices whose validity covers the reading.
    """
    df = t.sensors.select("tree_id", "type_id", "timestamp", "value").join(street_trees(t.trees), "tree_id")
    devices = t.devices.select("tree_id", "site_id",
                               *(["valid_from_date", "valid_to_date"] if valid_devices_only else []))
    df = df.join(devices, "tree_id", "left")
    if valid_devices_only:
        day, lo, hi = F.to_date("timestamp"), F.col("valid_from_date"), F.col("valid_to_date")
        ok = (lo.isNull() | (day >= lo)) & (hi.isNull() | (day <= hi))
        df = df.where(ok).drop("valid_from_date", "valid_to_date")
    return df.withColumn("month", F.month("timestamp"))


def tree_base(t: Tables, date: dt.date | None = None, today: dt.date | None = None,
              extra_days: int = 0) -> DataFrame:
    """Street trees at one day, or on the whole season spine up to ``today + extra_days``."""
    trees = street_trees(t.trees)
    if date is not None:
        df = trees.withColumn("timestamp", literal_day(date))
    else:
        last = today + dt.timedelta(days=extra_days)
        df = spine(trees, literal_day(SEASON_START), literal_day(last), "timestamp")
        df = df.where(in_months("timestamp", *WATERING_SEASON))
    return df.withColumn("month", F.month("timestamp"))


def _assemble(df: DataFrame, t: Tables, forecast: bool, public: bool, watering: DataFrame | None) -> DataFrame:
    """Joins on the tree come first, so the rows are shuffled by tree once for all of them."""
    if not public:
        beds = categorise(t.trees_private.select("tree_id", "baumscheibe_m2", "baumscheibe_surface"),
                          bed="baumscheibe_m2")
        df = df.join(beds, "tree_id", "left")
    # The month's value is picked from the wide row: melting it first would shuffle twelve times the rows.
    of_month = F.get(F.array(*MONTHS), F.col("month") - 1)
    df = (df.join(t.shading_monthly.select("tree_id", *MONTHS), "tree_id", "left")
          .withColumn("shading_index", of_month).drop(*MONTHS))
    if not public and not forecast:
        w = watering.withColumnRenamed("timestamp", "_at")
        df = df.join(w, (df["tree_id"] == w["tree_id"]) & (df["timestamp"] == F.col("_at").cast("timestamp")),
                     "left").drop(w["tree_id"]).drop("_at")
    return df


def _weather_for(t: Tables, forecast: bool, public: bool) -> DataFrame:
    """One row per day: several stations are averaged before the days are rolled."""
    mode = "public" if public else "forecast" if forecast else "nowcast"
    station = t.weather
    if station is not None and "stations_id" in station.columns:
        station = mean_over_tiles(station, STATION_WEATHER, tile="stations_id")
    return weather_features(mode, station, t.weather_tiles)


def _join_weather(df: DataFrame, weather: DataFrame) -> DataFrame:
    w = weather.withColumnRenamed("date", "_at")
    return df.join(w, df["timestamp"] == F.col("_at").cast("timestamp"), "left").drop("_at")


def training_frame(t: Tables, forecast: bool, today: dt.date, public: bool = False) -> DataFrame:
    """Sensor readings with every feature that is known at their day."""
    base = sensor_base(t)
    watering = None
    if not public and not forecast:
        keys = t.sensors.select("tree_id").distinct()   # a tree without sensors needs no spine
        watering = watering_features(restrict(t.watering_gdk, keys, ["tree_id"]),
                                     restrict(t.watering_sga, keys, ["tree_id"]), SEASON_START, today)
    return _join_weather(_assemble(base, t, forecast, public, watering), _weather_for(t, forecast, public))


def inference_frame(t: Tables, forecast: bool, date: dt.date, public: bool = False) -> DataFrame:
    """Street trees at one day; with weather for the nowcast, without it for the forecast."""
    base = tree_base(t, date)
    watering = None
    if not public and not forecast:
        watering = watering_features_on(t.watering_gdk, t.watering_sga, date)
    df = _assemble(base, t, forecast, public, watering)
    if forecast:
        return df
    # The day is a constant, which would leave a join without a key: its one row of weather is a scalar.
    weather = _weather_for(t, forecast, public).where(F.col("date") == literal_day(date))
    names = [c for c in weather.columns if c != "date"]
    of_day = weather.agg(F.first(F.struct(*names)).alias("w")).scalar()
    return df.withColumns({c: of_day[c] for c in names})


# --- preprocessor -----------------------------------------------------------------------------

def _bed_rank() -> dict[str, Column]:
    """Ties between bed classes go to the lower bin, not to the alphabet."""
    rank = F.lit(None).cast("int")
    for i, (_, _, label) in reversed(list(enumerate(BED_BINS))):
        rank = F.when(F.col("baumscheibe_m2") == label, i).otherwise(rank)
    return {"baumscheibe_m2": rank}


class Preprocessor:
    """Imputes, adds ``mean_yesterday``, fills sensor gaps and encodes categories."""

    KEYS = ["type_id", "tree_id", "timestamp"]

    def __init__(self, forecast: bool):
        self.forecast = forecast
        self.weather = WEATHER_FORECAST if forecast else WEATHER_NOWCAST
        self.cat_columns: list[str] = []
        self.num_columns: list[str] = []
        self.codes: OrdinalCodes | None = None
        self.last_mean: DataFrame | None = None

    def fit(self, df: DataFrame) -> "Preprocessor":
        self.cat_columns = [c for c in df.columns if c in CATEGORICAL]
        self.num_columns = [c for c in df.columns if c in NUMERIC + self.weather]
        # Small results that every later plan reads, so they are computed once. The frame itself is read
        # several times as well: hand in a materialised one (see ``cut_lineage``).
        self.codes = OrdinalCodes(cut_lineage(OrdinalCodes.fit(df, self.cat_columns).codes))
        self.last_mean = cut_lineage(last_group_mean(df))
        return self

    def _impute(self, df: DataFrame) -> DataFrame:
        return impute_mode(df, IMPUTED, _bed_rank())

    def transform_train(self, df: DataFrame) -> DataFrame:
        """Filled days carry the whole earlier row, its weather, month and mean included."""
        df = df.select(*self.KEYS, *self.cat_columns, *self.num_columns)
        df = self._impute(df)
        df = attach_group_feature(df, mean_yesterday(df), ["timestamp", "type_id"])
        df = resample_ffill(df.where(F.col("type_id").isin(DEPTHS)), ["type_id", "tree_id"])
        df = df.where(in_months("timestamp", *SENSOR_SEASON))
        df = self.codes.transform(df, self.cat_columns)
        if self.forecast:
            df = add_lags(df, ["tree_id", "type_id"], "timestamp", "value")
        return labelled(df)

    def transform_inference(self, df: DataFrame) -> DataFrame:
        """Imputes with the most frequent value of the given rows, all trees at once."""
        out = [c for c in self.cat_columns + self.num_columns if c not in ("site_id", "value", "mean_yesterday")]
        if self.forecast:
            out = [c for c in out if c not in self.weather]
        df = select_present(df, ["tree_id", "timestamp", *out])
        return self.codes.transform(self._impute(df), self.cat_columns)


# --- evaluation frames ------------------------------------------------------------------------

def site_folds(df: DataFrame, k: int = 4, seed: int = 42, site: str = "site_id") -> DataFrame:
    """Fold number per site: the rank of its seeded hash modulo ``k``, so folds differ by one site at most."""
    sites = df.select(site).distinct().withColumn("_h", seeded_hash([site], seed))
    return ranked(sites, ["_h", site], "_r").select(site, F.pmod(F.col("_r") - 1, F.lit(k)).cast("int").alias("fold"))


def fold_frames(df: DataFrame, folds: DataFrame, fold: int,
                site: str = "site_id") -> tuple[DataFrame, DataFrame]:
    """Train and test rows of one fold; ``mean_yesterday`` comes from the train rows for both."""
    tagged = df.drop("mean_yesterday").join(folds, site)
    train, test = tagged.where(F.col("fold") != fold), tagged.where(F.col("fold") == fold)
    feature = mean_yesterday(train)
    return tuple(attach_group_feature(part, feature, ["timestamp", "type_id"]).drop("fold").na.drop("any")
                 for part in (train, test))
