"""Null shares, packed fields, times and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from backglance.functions.text import after_last, country_code
from backglance.functions.timeops import hhmm_to_timestamp, hours_between, shift_zone, with_time_parts
from backglance.operators import quality
from backglance.operators.fields import apply_sentinels, split_packed, suffix_bucket, type_parts
from backglance.operators.joins import lookup
from backglance.slate.registry import query
from backglance.sources.tables import load_table


@query("""
WITH d AS (
  SELECT event_id,
         CASE WHEN event_type <> 'error' THEN event_type END AS kind,
         CASE WHEN value >= 5 THEN value END AS amount,
         nullif(CASE WHEN event_type = 'click' THEN '' ELSE props END, '') AS note
  FROM events)
SELECT 'event_id' AS column_name, round(avg(CASE WHEN event_id IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_fraction FROM d
UNION ALL SELECT 'kind', round(avg(CASE WHEN kind IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM d
UNION ALL SELECT 'amount', round(avg(CASE WHEN amount IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM d
UNION ALL SELECT 'note', round(avg(CASE WHEN note IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM d
""")
def null_fractions(spark, folder):
    events = load_table(spark, folder, "events")
    derived = events.select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("kind"),
        F.when(F.col("value") >= 5, F.col("value")).alias("amount"),
        F.when(F.col("event_type") == "click", "").otherwise(F.col("props")).alias("note"),
    )
    lines = quality.null_fractions(quality.blank_to_null(derived))
    return lines.withColumn("null_fraction", F.round("null_fraction", 6))


@query("""
WITH d AS (
  SELECT l_orderkey, l_quantity,
         CASE WHEN l_quantity >= 49 THEN l_extendedprice END AS rare_price,
         CASE WHEN l_quantity >= 40 THEN l_extendedprice END AS some_price
  FROM lineitem),
n AS (
  SELECT 'l_orderkey' AS column_name, count(l_orderkey) AS n_values, count(*) AS n FROM d
  UNION ALL SELECT 'l_quantity', count(l_quantity), count(*) FROM d
  UNION ALL SELECT 'rare_price', count(rare_price), count(*) FROM d
  UNION ALL SELECT 'some_price', count(some_price), count(*) FROM d)
SELECT column_name, n_values FROM n WHERE 1 - n_values * 1.0 / n < 0.95
""")
def drop_sparse(spark, folder):
    line = load_table(spark, folder, "lineitem")
    derived = line.select(
        "l_orderkey",
        "l_quantity",
        F.when(F.col("l_quantity") >= 49, F.col("l_extendedprice")).alias("rare_price"),
        F.when(F.col("l_quantity") >= 40, F.col("l_extendedprice")).alias("some_price"),
    )
    kept = quality.drop_sparse(derived, 0.95)
    row = kept.agg(*[F.count(c).alias(f"n_{c}") for c in kept.columns])
    return quality.unpivot_row(row, {"n_values": "n_"})


@query("""
SELECT 'p_partkey' AS column_name, count(DISTINCT p_partkey) AS n_distinct FROM part
UNION ALL SELECT 'p_name', count(DISTINCT p_name) FROM part
UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) FROM part
UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part
UNION ALL SELECT 'p_size', count(DISTINCT p_size) FROM part
UNION ALL SELECT 'p_retailprice', count(DISTINCT p_retailprice) FROM part
""")
def distinct_counts(spark, folder):
    return quality.distinct_counts(load_table(spark, folder, "part"))


@query("""
SELECT CASE WHEN typeof(c) = 'VARCHAR' THEN 'text' ELSE 'numeric' END AS kind, name AS column_name, n AS n_values
FROM (
  SELECT any_value(o_orderstatus) AS c, 'o_orderstatus' AS name, count(o_orderstatus) AS n FROM orders
  UNION ALL SELECT any_value(o_orderpriority), 'o_orderpriority', count(o_orderpriority) FROM orders)
UNION ALL SELECT 'numeric', 'o_orderkey', count(o_orderkey) FROM orders
UNION ALL SELECT 'numeric', 'o_custkey', count(o_custkey) FROM orders
UNION ALL SELECT 'numeric', 'o_totalprice', count(o_totalprice) FROM orders
UNION ALL SELECT 'time', 'o_orderdate', count(o_orderdate) FROM orders
""")
def columns_by_type(spark, folder):
    orders = load_table(spark, folder, "orders")
    kinds = {c: kind for kind in ("text", "numeric", "time") for c in quality.columns_of_type(orders, kind)}
    row = orders.agg(*[F.count(c).alias(f"n_{c}") for c in orders.columns])
    kind = F.lit(None).cast("string")
    for name, value in kinds.items():
        kind = F.when(F.col("column_name") == name, F.lit(value)).otherwise(kind)
    return quality.unpivot_row(row, {"n_values": "n_"}).withColumn("kind", kind)


@query("""
SELECT o_orderkey, o_orderdate,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def null_out_and_drop(spark, folder):
    orders = load_table(spark, folder, "orders")
    emptied = quality.null_out(orders, ["o_totalprice", "o_orderpriority"], F.col("o_orderstatus") == "P")
    return quality.drop_columns(emptied, ["o_custkey", "o_orderstatus"])


_PACKED = """
  SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate,
         CASE WHEN l_returnflag = 'N' THEN concat_ws(',', CAST(l_quantity AS INT), l_returnflag)
              ELSE concat_ws(',', CAST(l_quantity AS INT), l_returnflag, CAST(round(l_discount * 100) AS INT), l_linestatus)
         END AS packed
  FROM lineitem"""


def _packed(spark, folder):
    line = load_table(spark, folder, "lineitem")
    quantity, discount = F.col("l_quantity").cast("int"), F.round(F.col("l_discount") * 100).cast("int")
    short = F.concat_ws(",", quantity.cast("string"), "l_returnflag")
    full = F.concat_ws(",", quantity.cast("string"), "l_returnflag", discount.cast("string"), "l_linestatus")
    packed = F.when(F.col("l_returnflag") == "N", short).otherwise(full).alias("packed")
    return line.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", packed)


@query(f"""
WITH d AS ({_PACKED})
SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate,
       string_split(packed, ',')[1] AS packed1, string_split(packed, ',')[2] AS packed2,
       string_split(packed, ',')[3] AS packed3, string_split(packed, ',')[4] AS packed4
FROM d
""")
def packed_parts(spark, folder):
    return split_packed(_packed(spark, folder), {"packed": 4})


_READINGS = """
  SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, l_returnflag,
         CASE WHEN l_quantity = 50 THEN '+9999' WHEN l_quantity = 49 THEN '9999'
              WHEN l_quantity = 48 THEN 'bad' WHEN l_quantity >= 2 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS reading,
         CASE WHEN l_tax > 0.07 THEN '99' ELSE CAST(CAST(round(l_tax * 100) AS INT) AS VARCHAR) END AS grade
  FROM lineitem"""


def _readings(spark, folder):
    line = load_table(spark, folder, "lineitem")
    q = F.col("l_quantity")
    reading = (
        F.when(q == 50, "+9999").when(q == 49, "9999").when(q == 48, "bad").when(q >= 2, q.cast("int").cast("string"))
    )
    tax = F.round(F.col("l_tax") * 100).cast("int").cast("string")
    return line.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag",
        reading.alias("reading"), F.when(F.col("l_tax") > 0.07, "99").otherwise(tax).alias("grade"),
    )


@query(f"""
WITH d AS ({_READINGS})
SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, l_returnflag,
       TRY_CAST(CASE WHEN reading NOT IN ('9999', '+9999', '-9999') THEN reading END AS DOUBLE) AS reading,
       TRY_CAST(CASE WHEN grade NOT IN ('99', '+99', '-99') THEN grade END AS INT) AS grade
FROM d
""")
def sentinels_to_null(spark, folder):
    cleaned = apply_sentinels(_readings(spark, folder), {"reading": "9999", "grade": "99"})
    return type_parts(cleaned, doubles=["reading"], integers=["grade"])


@query(f"""
WITH d AS ({_READINGS})
SELECT l_returnflag, count(*) AS n, count(TRY_CAST(reading AS DOUBLE)) AS n_readings,
       sum(TRY_CAST(coalesce(reading, '9999') AS DOUBLE)) AS total
FROM d GROUP BY 1
""")
def sentinel_fill(spark, folder):
    readings = _readings(spark, folder)
    filled = apply_sentinels(readings.withColumn("given", F.col("reading")), {"reading": "9999"}, mode="fill")
    typed = type_parts(filled, doubles=["reading", "given"])
    return typed.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("given").alias("n_readings"), F.sum("reading").alias("total")
    )


@query("""
WITH d AS (SELECT o_orderkey, o_orderdate, CAST(o_orderkey * 7 % 2600 AS INT) AS hhmm FROM orders)
SELECT o_orderkey, hhmm,
       CASE WHEN hhmm <= 2400 AND hhmm % 100 < 60
            THEN o_orderdate + to_minutes((hhmm // 100) * 60 + hhmm % 100) END AS departs
FROM d
""")
def clock_times(spark, folder):
    orders = load_table(spark, folder, "orders")
    derived = orders.select("o_orderkey", "o_orderdate", (F.col("o_orderkey") * 7 % 2600).cast("int").alias("hhmm"))
    return derived.select("o_orderkey", "hhmm", hhmm_to_timestamp("o_orderdate", "hhmm").alias("departs"))


_ZONE_SQL = """CASE WHEN n_nationkey < 6 THEN 'America/Chicago' WHEN n_nationkey < 12 THEN 'Europe/Berlin'
              WHEN n_nationkey < 18 THEN 'Asia/Kolkata' END"""


def _zones(spark, folder):
    key = F.col("n_nationkey")
    zone = F.when(key < 6, "America/Chicago").when(key < 12, "Europe/Berlin").when(key < 18, "Asia/Kolkata")
    return load_table(spark, folder, "nation").select("n_nationkey", zone.alias("zone"))


@query(f"""
SELECT event_id, zone,
       (ts AT TIME ZONE zone) AT TIME ZONE 'UTC' AS utc_time,
       (ts AT TIME ZONE 'UTC') AT TIME ZONE zone AS local_time
FROM (SELECT e.*, {_ZONE_SQL} AS zone FROM events e LEFT JOIN nation n ON e.user_id % 30 = n.n_nationkey)
""")
def zone_shift(spark, folder):
    events = load_table(spark, folder, "events").withColumn("place", F.col("user_id") % 30)
    zoned = lookup(events, _zones(spark, folder), {"place": "n_nationkey"}, ["zone"])
    return zoned.select(
        "event_id",
        "zone",
        shift_zone("ts", "zone").alias("utc_time"),
        shift_zone("ts", "zone", to_utc=False).alias("local_time"),
    )


@query("""
SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour, CAST(minute(ts) AS BIGINT) AS minute,
       round(date_diff('microsecond', date_trunc('day', ts), ts) / 3600000000.0, 6) AS hours
FROM events
""")
def time_parts(spark, folder):
    parts = with_time_parts(load_table(spark, folder, "events"), "ts")
    parts = parts.withColumn("midnight", F.to_date("ts").cast("timestamp_ntz"))
    return parts.select(
        "event_id",
        F.col("hour").cast("bigint").alias("hour"),
        F.col("minute").cast("bigint").alias("minute"),
        F.round(hours_between(parts, "ts", "midnight"), 6).alias("hours"),
    )


@query("""
SELECT right(c_name, 2) AS c_name, count(*) AS n, count(DISTINCT c_nationkey) AS n_nations FROM customer GROUP BY 1
""")
def suffix_buckets(spark, folder):
    bucketed = suffix_bucket(load_table(spark, folder, "customer"), "c_name", 2)
    return bucketed.groupBy("c_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("c_nationkey").alias("n_nations")
    )


@query("""
WITH d AS (SELECT c_custkey, c_mktsegment, c_name || ', ' || CASE WHEN c_nationkey < 8 THEN 'u s' ELSE 'ca' END AS station FROM customer)
SELECT c_custkey, c_mktsegment, station FROM d WHERE upper(right(replace(station, ' ', ''), 2)) = 'US'
""")
def country_filter(spark, folder):
    customer = load_table(spark, folder, "customer")
    place = F.when(F.col("c_nationkey") < 8, "u s").otherwise("ca")
    named = customer.select("c_custkey", "c_mktsegment", F.concat("c_name", F.lit(", "), place).alias("station"))
    return named.where(country_code("station") == "US")


@query("""
SELECT string_split(p_brand || '/' || p_type, '/')[-1] AS last_part, upper(p_name) AS label, count(*) AS n
FROM part GROUP BY 1, 2
""")
def text_after_last(spark, folder):
    part = load_table(spark, folder, "part").withColumn("path", F.concat_ws("/", "p_brand", "p_type"))
    return part.groupBy(after_last("path").alias("last_part"), F.upper("p_name").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
