"""Look-back joins, nearest places, lookups, sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.operators.joins import key_difference, lookup, unmatched
from backglance.operators.lookback import lookback_join, with_match_flag
from backglance.operators.nearest import nearest_site
from backglance.operators.windows import first_per_group
from backglance.slate.registry import query
from backglance.sources.tables import load_table


def _purchases(spark, folder):
    events = load_table(spark, folder, "events")
    bought = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    seen = events.where(F.col("event_type") != "purchase").select(
        "user_id",
        F.col("ts").alias("seen_at"),
        F.col("event_id").alias("seen_id"),
        F.col("event_type").alias("seen_type"),
        F.col("value").alias("seen_value"),
    )
    return bought, seen


def _lookback_sql(extra: str = "") -> str:
    return f"""
  SELECT p.event_id, p.user_id, p.ts, o.ts AS seen_at, o.event_id AS seen_id, o.event_type AS seen_type,
         o.value AS seen_value, date_diff('microsecond', o.ts, p.ts) / 3600000000.0 AS gap_hours
  FROM events p
  LEFT JOIN events o
    ON p.user_id = o.user_id AND o.event_type <> 'purchase' {extra}
   AND o.ts <= p.ts - INTERVAL 2 HOUR AND o.ts >= p.ts - INTERVAL 4 HOUR
  WHERE p.event_type = 'purchase'
  QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY o.ts DESC NULLS LAST, o.event_id) = 1"""


def _lookback(spark, folder, **options):
    bought, seen = _purchases(spark, folder)
    return lookback_join(
        bought, seen, ["user_id"], "ts", "seen_at", "seen_id", ["seen_type", "seen_value"], unique_key=True, **options
    )


@query(f"SELECT * REPLACE (round(gap_hours, 6) AS gap_hours) FROM ({_lookback_sql()})")
def lookback_with_copies(spark, folder):
    """Every observation twice, once with other values that must lose: the copies' smallest row counts."""
    bought, seen = _purchases(spark, folder)
    other = seen.withColumns({"seen_type": F.concat(F.lit("~"), "seen_type"), "seen_value": F.col("seen_value") + 1})
    joined = lookback_join(bought, seen.union(other), ["user_id"], "ts", "seen_at", "seen_id", ["seen_type", "seen_value"])
    return joined.withColumn("gap_hours", F.round("gap_hours", 6))


@query(f"SELECT * REPLACE (round(gap_hours, 6) AS gap_hours) FROM ({_lookback_sql()})")
def lookback_nearest(spark, folder):
    return _lookback(spark, folder).withColumn("gap_hours", F.round("gap_hours", 6))


_SAME_DAY = "AND CAST(o.ts AS DATE) = CAST(p.ts AS DATE)"


@query(f"SELECT * REPLACE (round(gap_hours, 6) AS gap_hours) FROM ({_lookback_sql(_SAME_DAY)})")
def lookback_same_day(spark, folder):
    return _lookback(spark, folder, same_day=True).withColumn("gap_hours", F.round("gap_hours", 6))


@query(f"""
SELECT CASE WHEN seen_id IS NULL THEN 0 ELSE 1 END AS matched, count(*) AS n, count(seen_type) AS n_types
FROM ({_lookback_sql()}) GROUP BY 1
""")
def lookback_completeness(spark, folder):
    joined = with_match_flag(_lookback(spark, folder), "seen_id")
    return joined.groupBy("matched").agg(F.count(F.lit(1)).alias("n"), F.count("seen_type").alias("n_types"))


@query("""
SELECT event_id, user_id, day, n_of_day, round(of_day, 4) AS of_day
FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events)
LEFT JOIN (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_of_day, sum(value) AS of_day
           FROM events WHERE event_type <> 'purchase' GROUP BY 1, 2) USING (user_id, day)
""")
def left_join_on_day_and_key(spark, folder):
    events = load_table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    others = events.where(F.col("event_type") != "purchase")
    totals = others.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n_of_day"), F.sum("value").alias("of_day"))
    joined = events.select("event_id", "user_id", "day").join(totals, ["user_id", "day"], "left")
    return joined.withColumn("of_day", F.round("of_day", 4))


@query("""
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')
""")
def unmatched_keys(spark, folder):
    urgent = load_table(spark, folder, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    customer = load_table(spark, folder, "customer").select("c_custkey", "c_name")
    return unmatched(customer, urgent.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


_SITE = """CAST(c_custkey * 37 % 180 - 90 AS DOUBLE) AS lat, CAST(c_custkey * 71 % 360 - 180 AS DOUBLE) AS lon"""
_PLACE = """CAST(n_nationkey * 37 % 180 - 90 AS DOUBLE) AS place_lat, CAST(n_nationkey * 71 % 360 - 180 AS DOUBLE) AS place_lon"""


@query(f"""
WITH c AS (SELECT c_custkey, {_SITE} FROM customer),
     n AS (SELECT n_name, {_PLACE} FROM nation),
     d AS (
  SELECT c_custkey, lat, lon, n_name,
         round(2 * 6372.8 * asin(sqrt(least(1.0,
           pow(sin(radians(place_lat - lat) / 2), 2)
           + cos(radians(lat)) * cos(radians(place_lat)) * pow(sin(radians(place_lon - lon) / 2), 2)))), 6) AS km
  FROM c, n)
SELECT c_custkey, lat, lon, n_name AS nearest, round(km, 4) AS distance_km FROM d
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY km, n_name) = 1
""")
def nearest_place(spark, folder):
    at = lambda key, factor, around, shift: (F.col(key) * factor % around - shift).cast("double")
    sites = load_table(spark, folder, "customer").select(
        "c_custkey", at("c_custkey", 37, 180, 90).alias("lat"), at("c_custkey", 71, 360, 180).alias("lon")
    )
    places = load_table(spark, folder, "nation").select(
        "n_name", at("n_nationkey", 37, 180, 90).alias("place_lat"), at("n_nationkey", 71, 360, 180).alias("place_lon")
    )
    found = nearest_site(sites, places, "lat", "lon", "n_name", "place_lat", "place_lon")
    return found.withColumn("distance_km", F.round("distance_km", 4))


@query("""
SELECT c_custkey, n_name, r_name FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def lookup_join(spark, folder):
    customer = load_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation, region = load_table(spark, folder, "nation"), load_table(spark, folder, "region")
    placed = lookup(customer, nation, {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])
    named = lookup(placed, region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    return named.select("c_custkey", "n_name", "r_name")


@query("""
SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS order_year, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate, o_orderkey) = 1
""")
def dedup_first(spark, folder):
    orders = load_table(spark, folder, "orders").withColumn("order_year", F.year("o_orderdate").cast("bigint"))
    first = first_per_group(orders, ["o_custkey", "order_year"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return first.select("o_custkey", "order_year", "o_orderkey", "o_totalprice")


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows(spark, folder):
    return load_table(spark, folder, "orders").select("o_custkey", "o_orderstatus").distinct()


@query("""
SELECT key, count(*) AS n FROM (
  SELECT c_custkey AS key FROM customer UNION ALL SELECT o_custkey FROM orders UNION ALL SELECT user_id FROM events)
GROUP BY 1
""")
def union_of_keys(spark, folder):
    sides = [("customer", "c_custkey"), ("orders", "o_custkey"), ("events", "user_id")]
    keys = [load_table(spark, folder, table).select(F.col(name).alias("key")) for table, name in sides]
    return reduce(DataFrame.unionByName, keys).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_partkey AS key FROM lineitem EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1")
def set_difference(spark, folder):
    line = load_table(spark, folder, "lineitem")
    returned = line.where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)).select(F.col("l_partkey").alias("key"))
    return key_difference(line.select(F.col("l_partkey").alias("key")), returned, ["key"])
