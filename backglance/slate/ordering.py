"""Ranks, running features, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from backglance.functions.timeops import time_levels
from backglance.operators import positions, splits, windows
from backglance.slate.registry import query
from backglance.sources.tables import load_table


@query("""
SELECT event_id, CAST(ts AS DATE)::VARCHAR AS day,
       CAST(rank() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY date_trunc('minute', ts)) AS BIGINT) AS nth
FROM events
""")
def rank_within_day(spark, folder):
    events = load_table(spark, folder, "events").select(
        "event_id", F.to_date("ts").alias("day"), F.date_trunc("minute", "ts").alias("at")
    )
    ranked = positions.rank_within(events, ["day"], ["at"], "nth")
    return ranked.select("event_id", F.col("day").cast("string").alias("day"), "nth")


@query("""
SELECT event_id, round(sum(value) OVER (PARTITION BY CAST(ts AS DATE)), 4) AS day_value FROM events
""")
def total_of_day(spark, folder):
    events = load_table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    totals = windows.group_total(events, ["day"], "value", "day_value")
    return totals.select("event_id", F.round("day_value", 4).alias("day_value"))


@query("""
SELECT event_id, min(value) OVER (PARTITION BY user_id) AS smallest FROM events
""")
def smallest_of_group(spark, folder):
    events = load_table(spark, folder, "events")
    return windows.group_extreme(events, ["user_id"], "value", "smallest").select("event_id", "smallest")


_URGENT_DAYS = """
  SELECT CAST(o_orderdate AS DATE) AS day, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n
  FROM orders GROUP BY 1"""


def _urgent(spark, folder):
    orders = load_table(spark, folder, "orders")
    return orders.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        (F.col("o_orderpriority") == "1-URGENT").cast("bigint").alias("urgent"),
    )


@query(f"""
WITH d AS ({_URGENT_DAYS})
SELECT o_orderkey, CAST(d.n AS BIGINT) AS urgent_before
FROM orders LEFT JOIN d ON CAST(o_orderdate AS DATE) - 1 = d.day
""")
def prior_day_total(spark, folder):
    features = windows.prior_day_total(_urgent(spark, folder), "day", "urgent", "urgent_before")
    return features.select("o_orderkey", "urgent_before")


@query(f"""
WITH d AS ({_URGENT_DAYS}), l AS (SELECT day, lag(n) OVER (ORDER BY day) AS n FROM d)
SELECT o_orderkey, CAST(l.n AS BIGINT) AS urgent_before FROM orders LEFT JOIN l ON CAST(o_orderdate AS DATE) = l.day
""")
def prior_present_day_total(spark, folder):
    features = windows.prior_day_total(_urgent(spark, folder), "day", "urgent", "urgent_before", calendar=False)
    return features.select("o_orderkey", "urgent_before")


@query("""
SELECT o_orderkey, round(percent_rank() OVER (ORDER BY o_orderdate), 9) AS percent_rank FROM orders
""")
def global_percent_rank(spark, folder):
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    ranked = positions.global_percent_rank(orders, ["o_orderdate"])
    return ranked.select("o_orderkey", F.round("percent_rank", 9).alias("percent_rank"))


@query("""
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS "index" FROM orders
""")
def dense_index(spark, folder):
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return positions.dense_index(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "index")


@query("""
SELECT o_custkey, o_orderkey, o_totalprice,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS place
FROM orders QUALIFY place <= 3
""")
def top_k_per_group(spark, folder):
    orders = load_table(spark, folder, "orders")
    top = windows.top_k_per_group(orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)
    return top.select("o_custkey", "o_orderkey", "o_totalprice", F.col("place").cast("bigint").alias("place"))


@query("""
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_orderpriority LIMIT 1
""")
def most_frequent(spark, folder):
    counts = load_table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "o_orderpriority").limit(1)


_UNIT = """CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 13) AS UBIGINT) AS DOUBLE) / 4503599627370496.0"""


@query(f"SELECT o_orderkey, o_totalprice FROM orders WHERE {_UNIT.format(key='o_orderkey', seed=123)} < 0.1")
def repeatable_sample(spark, folder):
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return splits.repeatable_sample(orders, "o_orderkey", 0.1, seed=123)


@query(f"""
SELECT o_custkey, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY {_UNIT.format(key='o_orderkey', seed=48)}, o_orderkey) = 1
""")
def random_pick_per_group(spark, folder):
    orders = load_table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    return windows.pick_per_group(orders, ["o_custkey"], "o_orderkey", seed=48)


@query("""
WITH r AS (SELECT *, percent_rank() OVER (ORDER BY o_orderdate) AS p FROM orders)
SELECT CASE WHEN p <= 0.8 THEN 'train' ELSE 'test' END AS part, count(*) AS n,
       min(o_orderdate) AS first_day, max(o_orderdate) AS last_day, round(sum(o_totalprice), 2) AS total
FROM r GROUP BY 1
""")
def time_split(spark, folder):
    orders = load_table(spark, folder, "orders")
    train, test = splits.time_split(orders, ["o_orderdate"], 0.8, time_levels("o_orderdate"))
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("o_orderdate").alias("first_day"),
        F.max("o_orderdate").alias("last_day"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
    )


@query("""
WITH i AS (SELECT ts, event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM events),
     f AS (SELECT *, least(CAST(floor(i * 3 / n) AS BIGINT), 2) AS fold FROM i),
     b AS (SELECT *, ceil(fold * n / 3) AS b0, ceil((fold + 1) * n / 3) AS b1 FROM f),
     c AS (SELECT *, b0 + floor((b1 - b0) * 0.8) AS cut FROM b)
SELECT CAST(fold AS BIGINT) AS fold, CASE WHEN i >= cut THEN 'test' WHEN i >= cut - 10 THEN 'gap' ELSE 'train' END AS part,
       count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts
FROM c GROUP BY 1, 2
""")
def blocked_folds(spark, folder):
    events = load_table(spark, folder, "events").select("event_id", "ts")
    folded = splits.blocked_folds(
        events, ["ts", "event_id"], folds=3, train_fraction=0.8, gap=10, levels=time_levels("ts")
    )
    return folded.groupBy(F.col("fold").cast("bigint").alias("fold"), "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
