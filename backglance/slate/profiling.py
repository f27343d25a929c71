"""Labels, shares, distributions, correlations, imputation, projections and predicates."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from backglance.functions.timeops import time_levels
from backglance.operators import impute, labels, positions, profile, splits
from backglance.session import ensure_checkpoint_dir
from backglance.slate.registry import query
from backglance.sources.tables import audit_counts, load_table, stage


@query("""
SELECT label, count(*) AS n FROM (
  SELECT coalesce(CASE WHEN o_orderstatus = 'P' THEN 1 END,
                  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice > 300000 AS INT) END, 0) AS label
  FROM orders) GROUP BY 1
""")
def derive_label(spark, folder):
    orders = load_table(spark, folder, "orders").select(
        (F.col("o_orderstatus") == "P").cast("int").alias("cancelled"),
        F.when(F.col("o_orderpriority") != "5-LOW", (F.col("o_totalprice") > 300000).cast("int")).alias("late"),
    )
    return labels.derive_label(orders, "late", "cancelled").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT cause, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM (
  SELECT CASE WHEN event_type = 'error' AND value > 20 THEN 'severe' WHEN event_type = 'error' THEN 'error'
              WHEN value < 1 THEN 'tiny' ELSE 'none' END AS cause FROM events) GROUP BY 1
""")
def cause_shares(spark, folder):
    events = load_table(spark, folder, "events")
    error = F.col("event_type") == "error"
    causes = {"severe": error & (F.col("value") > 20), "error": error, "tiny": F.col("value") < 1}
    return labels.cause_shares(events, causes).withColumn("share", F.round("share", 6))


@query("""
SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, CAST(month(o_orderdate) AS BIGINT) AS order_month, count(*) AS n
FROM orders GROUP BY 1, 2 ORDER BY 1, 2
""")
def counts_by_month(spark, folder):
    orders = load_table(spark, folder, "orders")
    year, month = F.year("o_orderdate").cast("bigint"), F.month("o_orderdate").cast("bigint")
    counts = orders.groupBy(year.alias("order_year"), month.alias("order_month")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("order_year", "order_month")


_STATES = """
SELECT n_name AS state, count(c_acctbal) AS n FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
WHERE n_name IN ('NATION_1', 'NATION_3', 'NATION_5', 'NATION_7', 'NATION_11', 'NATION_13') GROUP BY n_name
"""


@query(_STATES.format(customer="customer", nation="nation"))
def counts_by_state_sql(spark, folder):
    # Spark registers a temporary view for each table it is given by name.
    return spark.sql(
        _STATES, customer=load_table(spark, folder, "customer"), nation=load_table(spark, folder, "nation")
    )


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "net_price"]


def _measures(spark, folder):
    line = load_table(spark, folder, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return line.select("l_quantity", "l_extendedprice", "l_discount", net.alias("net_price"))


_MEASURES_SQL = "SELECT l_quantity, l_extendedprice, l_discount, l_extendedprice * (1 - l_discount) AS net_price FROM lineitem"
_CORR_SQL = f"WITH d AS ({_MEASURES_SQL}) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM d" for a in _MEASURES for b in _MEASURES
)


@query(f"SELECT a, b, round(r, 6) AS r FROM ({_CORR_SQL})")
def correlations(spark, folder):
    matrix = profile.correlations(_measures(spark, folder), _MEASURES, impute=False)
    return matrix.withColumn("r", F.round("r", 6))


_FILLED_SQL = """
  SELECT CASE WHEN l_quantity <= 40 THEN l_quantity END AS l_quantity, CASE WHEN l_tax > 0.02 THEN l_tax END AS l_tax,
         CASE WHEN l_extendedprice > 20000 THEN l_extendedprice END AS l_extendedprice FROM lineitem"""
_FILLED = ["l_quantity", "l_tax", "l_extendedprice"]


@query(
    f"WITH g AS ({_FILLED_SQL}), d AS (SELECT "
    + ", ".join(f"coalesce({c}, quantile_disc({c}, 0.5) OVER ()) AS {c}" for c in _FILLED)
    + " FROM g) "
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM d" for a in _FILLED for b in _FILLED)
)
def correlations_of_filled(spark, folder):
    line = load_table(spark, folder, "lineitem")
    gaps = line.select(
        F.when(F.col("l_quantity") <= 40, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_extendedprice") > 20000, F.col("l_extendedprice")).alias("l_extendedprice"),
    )
    return profile.correlations(gaps, _FILLED, exact=True).withColumn("r", F.round("r", 6))


@query(f"""
SELECT a AS column_name, round(max(abs(r)), 6) AS strongest FROM ({_CORR_SQL})
WHERE a <> b AND abs(r) >= 0.75 GROUP BY 1
""")
def correlated_columns(spark, folder):
    matrix = profile.correlations(_measures(spark, folder), _MEASURES, impute=False)
    return profile.correlated_columns(matrix, 0.75).withColumn("strongest", F.round("strongest", 6))


@query(f"""
WITH d AS ({_MEASURES_SQL})
SELECT 'l_quantity' AS column_name, round(sum(l_quantity), 2) AS total FROM d
UNION ALL SELECT 'l_extendedprice', round(sum(l_extendedprice), 2) FROM d
UNION ALL SELECT 'l_discount', round(sum(l_discount), 2) FROM d
""")
def prune_correlated(spark, folder):
    measures = _measures(spark, folder)
    matrix = profile.correlations(measures, _MEASURES, impute=False)
    dropped = profile.prune_correlated(matrix, _MEASURES, 0.9)
    kept = measures.drop(*dropped)
    sums = F.array(*[F.struct(F.lit(c).alias("column_name"), F.round(F.sum(c), 2).alias("total")) for c in kept.columns])
    return kept.agg(F.explode(sums).alias("line")).select("line.*") if kept.columns else kept


_DISTRIBUTION = """
SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd,
       CAST(min({c}) AS DOUBLE) AS smallest, CAST(max({c}) AS DOUBLE) AS largest,
       round((avg(pow({c}, 3)) - 3 * avg({c}) * avg(pow({c}, 2)) + 2 * pow(avg({c}), 3)) / pow(var_pop({c}), 1.5), 4) AS skewness,
       round(kurtosis_pop({c}), 4) AS kurtosis
FROM events"""


@query(_DISTRIBUTION.format(c="value") + " UNION ALL " + _DISTRIBUTION.format(c="user_id"))
def distribution(spark, folder):
    lines = profile.distribution(load_table(spark, folder, "events"), ["value", "user_id"])
    digits = {"mean": 6, "sd": 6, "skewness": 4, "kurtosis": 4}
    return lines.withColumns({c: F.round(c, n) for c, n in digits.items()})


_GAPS = """
  SELECT o_orderkey, o_orderdate, CASE WHEN o_totalprice > 60000 THEN o_orderpriority END AS priority,
         CASE WHEN o_totalprice < 450000 THEN o_orderstatus END AS status FROM orders"""


def _orders_with_gaps(spark, folder):
    orders = load_table(spark, folder, "orders")
    price = F.col("o_totalprice")
    return orders.select(
        "o_orderkey",
        "o_orderdate",
        F.when(price > 60000, F.col("o_orderpriority")).alias("priority"),
        F.when(price < 450000, F.col("o_orderstatus")).alias("status"),
    )


@query(f"""
WITH d AS ({_GAPS}), c AS (
  SELECT 'priority' AS column_name, priority AS value, count(*) AS n FROM d WHERE priority IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'status', status, count(*) FROM d WHERE status IS NOT NULL GROUP BY 2)
SELECT column_name, value, n FROM c QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) = 1
""")
def modes(spark, folder):
    return impute.mode_rows(_orders_with_gaps(spark, folder), ["priority", "status"])


@query(f"""
WITH d AS ({_GAPS}),
p AS (SELECT priority AS v FROM d WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
s AS (SELECT status AS v FROM d WHERE status IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT o_orderkey, coalesce(priority, (SELECT v FROM p)) AS priority, coalesce(status, (SELECT v FROM s)) AS status FROM d
""")
def mode_imputation(spark, folder):
    orders = _orders_with_gaps(spark, folder)
    filled = impute.apply_values(orders, impute.fit_modes(orders, ["priority", "status"]))
    return filled.select("o_orderkey", "priority", "status")


@query(f"""
WITH d AS (SELECT *, percent_rank() OVER (ORDER BY o_orderdate) AS p FROM ({_GAPS})),
p AS (SELECT priority AS v FROM d WHERE p <= 0.8 AND priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
s AS (SELECT status AS v FROM d WHERE p <= 0.8 AND status IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT o_orderkey, coalesce(priority, (SELECT v FROM p)) AS priority, coalesce(status, (SELECT v FROM s)) AS status FROM d WHERE p > 0.8
""")
def later_rows_filled_from_earlier(spark, folder):
    """Modes of the training rows, filled into the test rows."""
    train, test = splits.time_split(_orders_with_gaps(spark, folder), ["o_orderdate"], 0.8, time_levels("o_orderdate"))
    filled = impute.apply_values(test, impute.fit_modes(train, ["priority", "status"]))
    return filled.select("o_orderkey", "priority", "status")


@query("""
SELECT 'l_quantity' AS column_name, quantile_disc(l_quantity, 0.5) AS value FROM lineitem
UNION ALL SELECT 'l_extendedprice', quantile_disc(l_extendedprice, 0.5) FROM lineitem
UNION ALL SELECT 'l_discount', quantile_disc(l_discount, 0.5) FROM lineitem
UNION ALL SELECT 'kept_price', quantile_disc(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END, 0.5) FROM lineitem
""")
def exact_medians(spark, folder):
    line = load_table(spark, folder, "lineitem")
    line = line.withColumn("kept_price", F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")))
    return positions.quantile_rows(line, ["l_quantity", "l_extendedprice", "l_discount", "kept_price"])


@query("""
WITH d AS (SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS quantity FROM lineitem),
     m AS (SELECT quantile_disc(quantity, 0.5) AS v FROM d)
SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, coalesce(quantity, (SELECT v FROM m)) AS quantity FROM d
""")
def median_imputation(spark, folder):
    line = load_table(spark, folder, "lineitem")
    quantity = F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("quantity")
    gaps = line.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", quantity)
    return impute.apply_values(gaps, impute.fit_medians(gaps, ["quantity"], exact=True))


@query("""
SELECT 'orders' AS step, count(*) AS n_rows FROM orders
UNION ALL SELECT 'staged', count(*) FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'staged_year', count(*) FROM orders WHERE o_orderstatus <> 'P' AND year(o_orderdate) = 1997
""")
def staged_counts(spark, folder):
    orders = load_table(spark, folder, "orders")
    open_orders = orders.where(F.col("o_orderstatus") != "P").withColumn("order_year", F.year("o_orderdate"))
    path = f"{ensure_checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}"
    staged = stage(open_orders, path, partition_by=["order_year"])
    return audit_counts(
        {"orders": orders, "staged": staged, "staged_year": staged.where(F.col("order_year") == 1997)}
    )


@query("""
SELECT l_orderkey || '-' || l_partkey AS line_key, l_quantity AS amount,
       round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge, -l_quantity AS negative
FROM lineitem
""")
def projections(spark, folder):
    line = load_table(spark, folder, "lineitem")
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    wide = line.withColumns(
        {
            "line_key": F.concat_ws("-", "l_orderkey", "l_partkey"),
            "charge": F.round(charge, 6),
            "negative": -F.col("l_quantity"),
        }
    ).withColumnRenamed("l_quantity", "amount")
    return wide.select("line_key", "amount", "charge", "negative")


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
WHERE l_quantity BETWEEN 10 AND 40 AND l_discount <= .05 AND l_returnflag IN ('A', 'R') AND l_shipdate IS NOT NULL
  AND NOT (l_linestatus = 'F' AND l_tax = 0) GROUP BY 1, 2
""")
def predicates(spark, folder):
    line = load_table(spark, folder, "lineitem")
    chosen = (
        line.where(F.col("l_quantity").between(10, 40))
        .where("l_discount <= .05")
        .where(F.col("l_returnflag").isin("A", "R") & F.col("l_shipdate").isNotNull())
        .where(~((F.col("l_linestatus") == "F") & (F.col("l_tax") == 0)))
    )
    return chosen.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )
