"""Registered queries: projection, filters, joins, sets, paging, load strategies, scalars, audits, errors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from canopy.functions import scalars as X
from canopy.operators import aggregates as A, quality as Q, relational as R, windows as W
from canopy.plans.registry import query
from canopy.plans.standins import Roles, rd, rounded, text, with_roles
from canopy.sources import sinks as K


# --- projection and filters -------------------------------------------------------------------

@query("rename_and_stamp", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, true AS street_tree, DATE '2024-05-01' AS created_at,
 DATE '2024-05-01' AS updated_at FROM customer""")
def rename_and_stamp(r: Roles) -> DataFrame:
    upper = r.customer.toDF(*[c.upper() for c in r.customer.columns])
    df = R.rename(upper, {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance"},
                  drop=["c_nationkey", "c_mktsegment"], lower=True)
    return R.stamp(df, dt.date(2024, 5, 1), street_tree=True)


@query("lat_lng_present", with_roles("trees") + "SELECT id, lat, lng FROM trees")
def lat_lng_present(r: Roles) -> DataFrame:
    df = R.with_lat_lng(r.trees.drop("lat", "lng"))
    return R.select_present(df, ["id", "no_such_column", "lat", "lng"])


@query("filters", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority = '2-HIGH' AND month(o_orderdate) BETWEEN 4 AND 9
 AND o_orderdate >= DATE '1996-04-30' - INTERVAL 2 MONTH AND o_orderdate < TIMESTAMP '2000-01-01'""")
def filters(r: Roles) -> DataFrame:
    """Equality, membership, season, relative date (30 April less two months is 29 February) and a time slice."""
    df = R.filter_eq(r.orders, o_orderstatus=["F", "O"], o_orderpriority="2-HIGH")
    df = df.select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    df = R.in_season(df, "day", 4, 9)
    df = R.since(df, "day", "2 months", dt.date(1996, 4, 30))
    return R.time_slice(df, "day", hi=dt.date(2000, 1, 1))


@query("complete_labelled", with_roles("shading", "trees") + """
SELECT s.tree_id, s.spring AS target, coalesce(s.summer, 0) AS summer, coalesce(s.fall, 20) AS fall FROM shading s
WHERE s.spring IS NOT NULL AND s.winter IS NOT NULL""")
def complete_labelled(r: Roles) -> DataFrame:
    df = R.labelled(R.drop_incomplete(r.shading, ["winter"]), "spring")
    return R.fill_const(R.fill_const(df, ["summer"], 0.0), ["fall"], 20.0).select("tree_id", "target", "summer", "fall")


@query("row_null_count", with_roles("shading") + """
SELECT tree_id, CAST((spring IS NULL) AS INTEGER) + CAST((summer IS NULL) AS INTEGER) + CAST((fall IS NULL) AS INTEGER)
 + CAST((winter IS NULL) AS INTEGER) AS missing FROM shading""")
def row_null_count(r: Roles) -> DataFrame:
    return r.shading.select("tree_id", X.null_count(["spring", "summer", "fall", "winter"]).alias("missing"))


STARTS, DROPS = [dt.date(2024, 5, 8), dt.date(2024, 5, 22)], [dt.date(2024, 5, 5), dt.date(2024, 5, 19)]


@query("window_split", with_roles("sensors") + """
SELECT 'test' AS part, tree_id, type_id, timestamp FROM sensors WHERE timestamp BETWEEN DATE '2024-05-08' AND DATE '2024-05-12'
 OR timestamp BETWEEN DATE '2024-05-22' AND DATE '2024-05-26'
UNION ALL SELECT 'train', tree_id, type_id, timestamp FROM sensors WHERE NOT (timestamp BETWEEN DATE '2024-05-05' AND DATE '2024-05-13'
 OR timestamp BETWEEN DATE '2024-05-19' AND DATE '2024-05-27')""")
def window_split(r: Roles) -> DataFrame:
    train, test = R.window_split(r.sensors.drop("value"), "timestamp", STARTS, 5, DROPS, 9)
    return R.union_all(train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test")))


@query("week_blocks", """
WITH e AS (SELECT event_id, date_trunc('week', o) AS w FROM (SELECT o_orderkey AS event_id, o_orderdate AS o FROM orders)),
p AS (SELECT w, row_number() OVER (ORDER BY w) - 1 AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT w FROM e))
SELECT e.event_id, CASE WHEN pos - pos % 9 + 5 < n THEN CASE WHEN pos % 9 < 5 THEN 'train' ELSE 'test' END END AS part
FROM e JOIN p USING (w)""")
def week_blocks(r: Roles) -> DataFrame:
    df = r.orders.select(F.col("o_orderkey").alias("event_id"), F.date_trunc("week", "o_orderdate").alias("w"))
    return W.week_block_split(df, "w").drop("w")


# --- joins ------------------------------------------------------------------------------------

@query("inner_join", """
SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def inner_join(r: Roles) -> DataFrame:
    c = r.customer.join(r.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return r.orders.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "n_name")


@query("left_join_composite", with_roles("gdk", "sga") + """
SELECT g.tree_id, g.date, round(g.amount_liters + 1e-9, 4) AS gdk, round(s.amount_liters + 1e-9, 4) AS sga
FROM gdk g LEFT JOIN sga s ON s.tree_id = g.tree_id AND s.date = g.date""")
def left_join_composite(r: Roles) -> DataFrame:
    g, s = (d.withColumnRenamed("amount_liters", n) for d, n in ((r.gdk, "gdk"), (r.sga, "sga")))
    return rounded(g.join(s, ["tree_id", "date"], "left"), "gdk", "sga")


@query("join_on_day", with_roles("sga", e="""
SELECT event_id, CAST(user_id AS VARCHAR) AS tree_id, ts + INTERVAL 4 MONTH AS at FROM events""") + """
SELECT e.event_id, round(s.amount_liters + 1e-9, 4) AS amount_liters FROM e LEFT JOIN sga s
ON s.date = CAST(e.at AS DATE) AND s.tree_id = e.tree_id""")
def join_on_day(r: Roles) -> DataFrame:
    events = r.events.select("event_id", text("user_id").alias("tree_id"), (F.col("ts") + F.expr("interval 4 months")).alias("at"))
    return rounded(R.join_on_day(events, "at", r.sga, "date", ["tree_id"]).select("event_id", "amount_liters"), "amount_liters")


@query("full_outer", with_roles("gdk", "sga") + """
SELECT coalesce(g.tree_id, s.tree_id) AS tree_id, coalesce(g.date, s.date) AS date, round(g.amount_liters + 1e-9, 4) AS gdk,
 round(s.amount_liters + 1e-9, 4) AS sga FROM gdk g FULL OUTER JOIN sga s ON s.tree_id = g.tree_id AND s.date = g.date""")
def full_outer(r: Roles) -> DataFrame:
    g, s = (d.withColumnRenamed("amount_liters", n) for d, n in ((r.gdk, "gdk"), (r.sga, "sga")))
    return rounded(R.full_outer(g, s, ["tree_id", "date"]), "gdk", "sga")


@query("metric_ratio", """
WITH a AS (SELECT o_orderstatus AS k, avg(o_totalprice) AS v, count(*) AS n FROM orders GROUP BY 1),
b AS (SELECT l_linestatus AS k, avg(l_extendedprice) AS v, count(*) AS n FROM lineitem GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, round(a.v / b.v + 1e-9, 4) AS v, round(a.n / b.n + 1e-9, 4) AS n FROM a FULL OUTER JOIN b ON a.k = b.k""")
def metric_ratio(r: Roles) -> DataFrame:
    a = r.orders.groupBy(F.col("o_orderstatus").alias("k")).agg(F.avg("o_totalprice").alias("v"), F.count("*").alias("n"))
    b = r.lineitem.groupBy(F.col("l_linestatus").alias("k")).agg(F.avg("l_extendedprice").alias("v"), F.count("*").alias("n"))
    return rounded(R.ratio(a, b, ["k"]), "v", "n")


@query("reindex_daily", """
WITH d AS (SELECT o_orderstatus AS s, o_orderpriority AS k, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2, 3),
g AS (SELECT s, k, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
 FROM (SELECT s, k, min(day) AS lo, max(day) AS hi FROM d GROUP BY 1, 2))
SELECT g.s, g.k, g.day, round(d.v + 1e-9, 4) AS v FROM g LEFT JOIN d ON d.s = g.s AND d.k = g.k AND d.day = g.day""")
def reindex_daily(r: Roles) -> DataFrame:
    d = (r.orders.groupBy(F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("k"),
                          F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("v")))
    return rounded(W.reindex_daily(d, ["s", "k"], "day"), "v")


@query("spine_types", with_roles("trees") + """
SELECT id, t AS type_id, CAST(d AS DATE) AS date FROM trees, (SELECT unnest([1, 2, 3]) AS t),
 (SELECT unnest(generate_series(DATE '2024-03-28', DATE '2024-04-03', INTERVAL 1 DAY)) AS d)""")
def spine_types(r: Roles) -> DataFrame:
    days = R.spine(r.trees.select("id"), X.literal_day(dt.date(2024, 3, 28)), X.literal_day(dt.date(2024, 4, 3)))
    return R.with_types(days, [1, 2, 3])


@query("only_new", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""")
def only_new(r: Roles) -> DataFrame:
    return R.only_new(r.customer.select("c_custkey", "c_name"), r.events.select(F.col("user_id").alias("c_custkey")), ["c_custkey"])


@query("restrict", "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def restrict(r: Roles) -> DataFrame:
    keys = r.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("user_id"))
    return R.restrict(r.events.select("event_id", "user_id"), keys, ["user_id"])


# --- sets, order, paging ----------------------------------------------------------------------

@query("set_ops", with_roles("gdk", "sga") + """
SELECT 'union' AS what, tree_id FROM gdk UNION ALL SELECT 'union', tree_id FROM sga
UNION ALL SELECT 'either', tree_id FROM (SELECT tree_id FROM gdk UNION SELECT tree_id FROM sga)
UNION ALL SELECT 'both', tree_id FROM (SELECT tree_id FROM gdk INTERSECT SELECT tree_id FROM sga)
UNION ALL SELECT 'less', tree_id FROM (SELECT id AS tree_id FROM (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer) EXCEPT SELECT tree_id FROM gdk)
UNION ALL SELECT DISTINCT 'distinct', tree_id FROM gdk""")
def set_ops(r: Roles) -> DataFrame:
    g, s = r.gdk.select("tree_id"), r.sga.select("tree_id")
    trees = r.customer.select(text("c_custkey").alias("tree_id"))
    parts = {"union": R.union_all(g, s), "either": R.distinct_union("tree_id", g, s), "both": g.intersect(s),
             "less": trees.subtract(g), "distinct": R.distinct_keys(g, "tree_id")}
    return R.union_all(*[d.select(F.lit(n).alias("what"), "tree_id") for n, d in parts.items()])


@query("dedup_first", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
 ORDER BY o_orderpriority, o_orderkey) AS n FROM orders) WHERE n = 1""")
def dedup_first(r: Roles) -> DataFrame:
    return W.dedup_first(r.orders, ["o_custkey"], ["o_orderpriority", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("duplicate_report", """
SELECT o_custkey, count(*) AS n_in_batch, o_custkey IN (SELECT user_id FROM events) AS in_known FROM orders GROUP BY 1
HAVING count(*) > 1 OR o_custkey IN (SELECT user_id FROM events)""")
def duplicate_report(r: Roles) -> DataFrame:
    return R.duplicate_report(r.orders, r.events.select(F.col("user_id").alias("o_custkey")), "o_custkey")


@query("page", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_custkey, o_orderkey LIMIT 500 OFFSET 500")
def page(r: Roles) -> DataFrame:
    return R.page(r.orders.select("o_orderkey", "o_custkey"), ["o_custkey", "o_orderkey"], 500, 1)


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k(r: Roles) -> DataFrame:
    return R.top_k(r.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 25)


@query("slice_ranked", """
SELECT p_brand, s, CAST(rank AS INTEGER) AS rank FROM (SELECT p_brand, s, row_number() OVER (ORDER BY s DESC, p_brand) AS rank
 FROM (SELECT p_brand, round(sum(p_retailprice) + 1e-9, 4) AS s FROM part GROUP BY 1)) WHERE rank BETWEEN 4 AND 7""")
def slice_ranked(r: Roles) -> DataFrame:
    sums = r.part.groupBy("p_brand").agg(rd(F.sum("p_retailprice")).alias("s"))
    return R.slice_ranked(sums, [F.col("s").desc(), F.col("p_brand").asc()], 4, 7)


@query("global_rank", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS rank FROM orders")
def global_rank(r: Roles) -> DataFrame:
    from canopy.operators.ranking import ranked
    return ranked(r.orders.select("o_totalprice", "o_orderkey"), ["o_totalprice", "o_orderkey"]).select("o_orderkey", "rank")


@query("serial_id", """
SELECT CAST((row_number() OVER (ORDER BY c_name, c_custkey) + 1998) % 2000 + 1 AS BIGINT) AS id, c_custkey FROM customer""")
def serial_id(r: Roles) -> DataFrame:
    """Starts at 2000 and wraps after it."""
    return R.with_serial_id(r.customer.select("c_name", "c_custkey"), ["c_name", "c_custkey"], start=2000,
                            maximum=2000).select("id", "c_custkey")


@query("sample_n", "SELECT * FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42'), o_orderkey LIMIT 200")
def sample_n(r: Roles) -> DataFrame:
    return R.sample_n(r.orders, ["o_orderkey"], 200)


@query("sample_frac", "SELECT * FROM orders WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 8) AS BIGINT) < 257698037")
def sample_frac(r: Roles) -> DataFrame:
    return R.sample_frac(r.orders, ["o_orderkey"], 0.06)


# --- load strategies --------------------------------------------------------------------------

@query("resume_point", """
SELECT l_suppkey AS k, coalesce(max(CAST(l_shipdate AS DATE)), DATE '2021-12-31') AS resume FROM lineitem GROUP BY 1""")
def resume_point(r: Roles) -> DataFrame:
    return K.resume_point(r.lineitem.select(F.col("l_suppkey").alias("k"), "l_shipdate"), "l_shipdate", ["k"], dt.date(2021, 12, 31))


@query("incremental", """
WITH last AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS resume FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT o.o_orderkey FROM orders o LEFT JOIN last USING (o_custkey)
WHERE CAST(o.o_orderdate AS DATE) > coalesce(last.resume, DATE '1997-12-31')""")
def incremental(r: Roles) -> DataFrame:
    """Orders after the last finished one of the same customer."""
    done = K.resume_point(r.orders.where("o_orderstatus = 'F'"), "o_orderdate", ["o_custkey"])
    return K.incremental(r.orders, done, "o_orderdate", ["o_custkey"], default=dt.date(1997, 12, 31)).select("o_orderkey")


@query("replace_range", """
WITH fresh AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'P')
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE NOT (o_orderdate >= DATE '1997-01-01'
 AND o_orderdate < DATE '1999-01-01' AND o_custkey IN (SELECT o_custkey FROM fresh)) UNION ALL SELECT * FROM fresh""")
def replace_range(r: Roles) -> DataFrame:
    """Delete two years of the delivered customers, then append what was delivered."""
    old = r.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    new = r.orders.where("o_orderstatus = 'P'").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return K.replaced(old, new, "day", dt.date(1997, 1, 1), dt.date(1999, 1, 1), new, ["o_custkey"])


@query("retention", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 2 DAY")
def retention(r: Roles) -> DataFrame:
    return K.retain(r.events.select("event_id", F.col("ts").cast("timestamp").alias("ts")), "ts", 2,
                    dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)).select("event_id")


# --- scalars ----------------------------------------------------------------------------------

@query("scalar_dates", """
SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('day', ts) AS start, CAST(month(ts) AS INTEGER) AS month,
 date_trunc('hour', ts - INTERVAL 50 MINUTE) + INTERVAL 50 MINUTE AS composite, CAST(ts AS DATE) + 5 AS later,
 CAST(CAST(ts AS DATE) - INTERVAL 2 MONTH AS DATE) AS two_months_before, ts + INTERVAL 36 HOUR AS hours_later,
 least(CAST(ts AS DATE), DATE '2024-01-15') AS earlier, strftime(ts, '%m/%d/%Y') AS us,
 CAST(strptime(strftime(ts, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed, CAST(ts AS DATE) AS mixed, CAST(NULL AS DATE) AS broken
FROM events""")
def scalar_dates(r: Roles) -> DataFrame:
    ts = F.col("ts")
    return r.events.select(
        "event_id", X.day_of("ts").alias("day"), X.day_start("ts").cast("timestamp_ntz").alias("start"),
        X.month_of("ts").alias("month"), X.last_minute_50("ts").cast("timestamp_ntz").alias("composite"),
        X.shift_days(X.day_of("ts"), 5).alias("later"), X.shift_months(X.day_of("ts"), -2).alias("two_months_before"),
        X.shift_hours("ts", 36).cast("timestamp_ntz").alias("hours_later"),
        X.earlier(X.day_of("ts"), X.literal_day(dt.date(2024, 1, 15))).alias("earlier"),
        X.format_day("ts", "MM/dd/yyyy").alias("us"), X.parse_day(X.format_day("ts", "yyyyMMdd"), "yyyyMMdd").alias("parsed"),
        X.as_day(ts.cast("string")).alias("mixed"), X.as_day(F.concat(F.lit("x"), "props")).alias("broken"))


@query("zones", """
SELECT event_id, ts + INTERVAL 2 HOUR AS cet, ts - INTERVAL 2 HOUR AS utc FROM (SELECT event_id, ts + INTERVAL 6 MONTH AS ts FROM events)""")
def zones(r: Roles) -> DataFrame:
    """July, so central European time is two hours ahead."""
    ts = (F.col("ts") + F.expr("interval 6 months")).cast("timestamp")
    return r.events.select("event_id", X.to_zone(ts, "CET").cast("timestamp_ntz").alias("cet"),
                           X.from_zone(ts, "CET").cast("timestamp_ntz").alias("utc"))


@query("scalar_math", """
SELECT event_id, CAST(value AS INTEGER) AS whole, round(ln(value + 1) + 1e-9, 4) AS log1p, round(sqrt(value) + 1e-9, 4) AS root,
 CAST(ceil(value) AS BIGINT) AS up, abs(1 - value) AS gap, round(value / nullif(user_id, 0) + 1e-9, 4) AS part,
 value * value AS square, CASE WHEN value <= 5 AND value > 0 THEN 'klein' WHEN value <= 100 AND value > 5 THEN 'groß' END AS bed,
 CAST(round_even(value / 10, 2) AS DOUBLE) AS even FROM events""")
def scalar_math(r: Roles) -> DataFrame:
    from canopy.constants import BED_BINS
    v = F.col("value")
    return r.events.select("event_id", X.round_to_int("value").alias("whole"), rd(X.log_plus_one("value")).alias("log1p"),
                           rd(F.sqrt(v)).alias("root"), F.ceil(v).alias("up"), F.abs(1 - v).alias("gap"),
                           rd(X.ratio("value", "user_id")).alias("part"), (v * v).alias("square"),
                           X.classify("value", BED_BINS).alias("bed"), X.round_half_even(v / 10, 2).alias("even"))


@query("json_ops", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '{"event_type":"' || event_type || '"}' AS encoded,
 lower(upper(event_type)) AS low, CASE WHEN event_id % 3 > 0 THEN round(value, 1) END AS number, CAST(event_id % 11 AS INTEGER) AS picked,
 CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS INTEGER) END AS beyond,
 CASE event_type WHEN 'view' THEN '30 cm' WHEN 'click' THEN '60 cm' WHEN 'purchase' THEN '90 cm' END AS label FROM events""")
def json_ops(r: Roles) -> DataFrame:
    """Lists of two or three numbers as text, numbers as text of which some are none."""
    from canopy.constants import DEPTH_LABELS
    from canopy.plans.standins import kind
    i = F.col("event_id")
    listed = F.concat_ws(", ", (i % 7).cast("string"), (i % 11).cast("string"), F.when(i % 2 == 0, F.col("user_id").cast("string")))
    told = F.when(i % 3 > 0, F.round("value", 1).cast("string")).otherwise(F.col("event_type"))
    df = r.events.select("*", listed.alias("listed"), told.alias("told"))
    ids = X.int_list("listed")
    return df.select("event_id", X.decode_json("props", "k bigint")["k"].alias("k"),
                     X.encode_json("event_type").alias("encoded"), X.lower_case(F.upper("event_type")).alias("low"),
                     X.number_or_null("told").alias("number"), X.item(ids, 2).alias("picked"),
                     X.item(ids, 3).alias("beyond"), X.label_of(kind(), DEPTH_LABELS).alias("label"))


# --- audits -----------------------------------------------------------------------------------

@query("audit", """
SELECT 'orders' AS "table", 'primary key' AS rule, 'o_orderkey' AS "columns", count(*) - count(DISTINCT o_orderkey) AS violations FROM orders
UNION ALL SELECT 'orders', 'not null', 'o_orderdate', count(*) FILTER (o_orderdate IS NULL) FROM orders
UNION ALL SELECT 'orders', 'foreign key', 'o_custkey', count(*) FILTER (o_custkey NOT IN (SELECT user_id FROM events)) FROM orders
UNION ALL SELECT 'events', 'primary key', 'user_id,event_type', count(*) - count(DISTINCT (user_id, event_type)) FROM events""")
def audit(r: Roles) -> DataFrame:
    rules = {"orders": Q.Rules(("o_orderkey",), ("o_orderdate",), {("o_custkey",): ("events", ("user_id",))}),
             "events": Q.Rules(("user_id", "event_type"))}
    return Q.audit({"orders": r.orders, "events": r.events}, rules)


@query("freshness", with_roles("weather", "sensors") + """
SELECT max(w.date) AS last_weather, (SELECT max(timestamp) FROM sensors) AS last_sensor,
 CASE WHEN max(w.date) < DATE '2024-06-09' OR (SELECT max(timestamp) FROM sensors) < DATE '2024-06-09'
 THEN least(max(w.date), (SELECT max(timestamp) FROM sensors)) ELSE DATE '2024-06-09' END AS nowcast_date FROM weather w""")
def freshness(r: Roles) -> DataFrame:
    return Q.nowcast_date(r.weather, r.sensors, dt.date(2024, 6, 10))


@query("load_summary", """
SELECT count(*) AS n, min(CAST(l_shipdate AS DATE)) AS first_day, max(CAST(l_shipdate AS DATE)) AS last_day FROM lineitem""")
def load_summary(r: Roles) -> DataFrame:
    return A.load_summary(r.lineitem.select(F.to_date("l_shipdate").alias("d")), "d")


# --- errors -----------------------------------------------------------------------------------

_YESTERDAY = """
means AS (SELECT timestamp, type_id, avg(value) AS m FROM sensors GROUP BY 1, 2),
yesterday AS (SELECT timestamp, type_id, lag(m) OVER (PARTITION BY type_id ORDER BY timestamp) AS y FROM means),
p AS (SELECT s.*, y.y, s.value - y.y AS err FROM sensors s JOIN yesterday y USING (timestamp, type_id) WHERE y.y IS NOT NULL)
"""
_P = with_roles("sensors").rstrip() + "," + _YESTERDAY


def predicted(r: Roles) -> DataFrame:
    """Readings with yesterday's group mean as the prediction."""
    s = r.sensors
    return R.attach_group_feature(s, W.mean_yesterday(s), ["timestamp", "type_id"]).where(F.col("mean_yesterday").isNotNull())


@query("benchmark_metrics", _P + """SELECT type_id, round_even(sqrt(avg(err * err)), 2) AS rmse, round_even(avg(abs(err)), 2) AS mae FROM p GROUP BY 1""")
def benchmark_metrics(r: Roles) -> DataFrame:
    from canopy.operators.models import benchmark
    return benchmark(predicted(r))


@query("horizon_metrics", _P + """
SELECT datediff('day', DATE '2024-05-01', timestamp) AS "window", round(sqrt(avg(err * err)) + 1e-9, 4) AS rmse,
 round(avg(abs(err)) + 1e-9, 4) AS mae FROM p GROUP BY 1""")
def horizon_metrics(r: Roles) -> DataFrame:
    df = predicted(r).withColumn("window", F.datediff("timestamp", X.literal_day(dt.date(2024, 5, 1))).cast("bigint"))
    return rounded(A.metrics_by_horizon(df, "value", "mean_yesterday"), "rmse", "mae")


@query("error_summary", _P + """SELECT round(avg(err) + 1e-9, 4) AS bias, round(avg(abs(err)) + 1e-9, 4) AS mae,
 round(stddev_samp(err) + 1e-9, 4) AS error_std, round(stddev_pop(err) + 1e-9, 4) AS sigma FROM p""")
def error_summary(r: Roles) -> DataFrame:
    return rounded(A.error_summary(predicted(r), "value", "mean_yesterday"), "bias", "mae", "error_std", "sigma")


@query("error_quantiles", _P.rstrip() + """,
b AS (SELECT type_id, quantile_cont(abs(err), 0.25) AS q1, quantile_cont(abs(err), 0.5) AS median, quantile_cont(abs(err), 0.75) AS q3 FROM p GROUP BY 1)
SELECT b.type_id, round(q1 + 1e-9, 4) AS q1, round(median + 1e-9, 4) AS median, round(q3 + 1e-9, 4) AS q3,
 round(min(abs(err)) FILTER (abs(err) BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) + 1e-9, 4) AS whisker_low,
 round(max(abs(err)) FILTER (abs(err) BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) + 1e-9, 4) AS whisker_high
FROM b JOIN p USING (type_id) GROUP BY b.type_id, q1, median, q3""")
def error_quantiles(r: Roles) -> DataFrame:
    df = predicted(r).withColumn("e", F.abs(F.col("value") - F.col("mean_yesterday")))
    return rounded(A.error_quantiles(df, "e", ["type_id"]), "q1", "median", "q3", "whisker_low", "whisker_high")


@query("hot_group_percentiles", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1) + 1e-9, 4) AS p10, round(quantile_cont(l_extendedprice, 0.5) + 1e-9, 4) AS p50,
 round(quantile_cont(l_extendedprice, 0.9) + 1e-9, 4) AS p90 FROM lineitem GROUP BY 1""")
def hot_group_percentiles(r: Roles) -> DataFrame:
    """Three groups hold all line items."""
    df = A.exact_percentiles(r.lineitem, ["l_returnflag"], "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    return rounded(df, "p10", "p50", "p90")


@query("fold_summary", _P.rstrip() + """,
f AS (SELECT type_id, timestamp, sqrt(avg(err * err)) AS rmse, avg(abs(err)) AS mae FROM p GROUP BY 1, 2)
SELECT type_id, round(avg(rmse) + 1e-9, 4) AS rmse, round(avg(mae) + 1e-9, 4) AS mae FROM f GROUP BY 1""")
def fold_summary(r: Roles) -> DataFrame:
    per = A.regression_metrics(predicted(r), "value", "mean_yesterday", ["type_id", "timestamp"], digits=None)
    return rounded(A.fold_summary(per, ["type_id"]), "rmse", "mae")


@query("share", """
SELECT event_type, round(sum(abs(value)) / (SELECT sum(abs(value)) FROM events) + 1e-9, 4) AS share FROM events GROUP BY 1""")
def share(r: Roles) -> DataFrame:
    return rounded(A.share(r.events, "event_type", "value"), "share")


@query("extremes", "SELECT max(CAST(o_orderdate AS DATE)) AS day, (SELECT count(*) FROM orders) AS n FROM orders")
def extremes(r: Roles) -> DataFrame:
    day = r.orders.select(F.to_date("o_orderdate").alias("day"))
    return A.max_date(day, "day").withColumn("n", A.count_rows(r.orders).scalar())


@query("mean_metrics", _P.rstrip() + """,
f AS (SELECT type_id, sqrt(avg(err * err)) AS rmse, avg(abs(err)) AS mae FROM p GROUP BY 1)
SELECT round(avg(rmse) + 1e-9, 4) AS rmse, round(avg(mae) + 1e-9, 4) AS mae FROM f""")
def mean_metrics(r: Roles) -> DataFrame:
    per = A.regression_metrics(predicted(r), "value", "mean_yesterday", ["type_id"], digits=None)
    return rounded(A.mean_metrics(per), "rmse", "mae")
