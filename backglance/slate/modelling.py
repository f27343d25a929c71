"""Encoding, selection, oversampling, classifiers and their scores."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from backglance.functions.timeops import time_levels
from backglance.functions.vectors import add, as_array, between_points, scale, subtract
from backglance.operators import balance, encode, evaluate, models, neighbours, select, splits
from backglance.operators.joins import lookup
from backglance.slate.registry import query
from backglance.sources.tables import load_table, pin

_SCORED_SQL = """
  SELECT l.doc_id, d.lang, d.source, d.n_chars / 200000.0 AS score, l.toxic AS label,
         CASE WHEN d.n_chars > 1000 THEN 1 ELSE 0 END AS prediction
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def _scored(spark, folder):
    documents = load_table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    labelled = load_table(spark, folder, "labels").select("doc_id", "toxic").join(documents, "doc_id")
    return labelled.select(
        "doc_id",
        "lang",
        "source",
        (F.col("n_chars") / F.lit(200000.0)).alias("score"),
        F.col("toxic").alias("label"),
        (F.col("n_chars") > 1000).cast("int").alias("prediction"),
    )


@query(f"""
SELECT count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END), 6) AS majority_accuracy,
       round(avg(CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END), 6) AS positive_rate
FROM ({_SCORED_SQL})
""")
def accuracy(spark, folder):
    scores = evaluate.accuracy(_scored(spark, folder))
    return scores.withColumns({c: F.round(c, 6) for c in ("accuracy", "majority_accuracy", "positive_rate")})


@query(f"""
SELECT label, prediction, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM ({_SCORED_SQL}) GROUP BY 1, 2
""")
def confusion(spark, folder):
    return evaluate.confusion(_scored(spark, folder)).withColumn("share", F.round("share", 6))


_CURVE_SQL = f"""
  SELECT score, n, hits, CAST(sum(n) OVER w AS BIGINT) AS seen, CAST(sum(hits) OVER w AS BIGINT) AS reached,
         CAST(sum(hits) OVER () AS BIGINT) AS positives
  FROM (SELECT score, count(*) AS n, sum(label) AS hits FROM ({_SCORED_SQL}) GROUP BY 1)
  WINDOW w AS (ORDER BY score DESC)"""


@query(f"""
SELECT round(score, 9) AS score, round(reached / seen, 6) AS precision, round(reached / positives, 6) AS recall FROM ({_CURVE_SQL})
""")
def precision_recall_curve(spark, folder):
    points = evaluate.pr_curve(_scored(spark, folder), "score", "label")
    return points.select(
        F.round("score", 9).alias("score"),
        F.round("precision", 6).alias("precision"),
        F.round("recall", 6).alias("recall"),
    )


@query(f"""
SELECT round(sum(hits / positives * (reached / seen + coalesce((reached - hits) / nullif(seen - n, 0), reached / seen)) / 2), 6) AS area_under_pr
FROM ({_CURVE_SQL})
""")
def area_under_pr(spark, folder):
    area = evaluate.area_under_pr(_scored(spark, folder), "score", "label")
    return area.withColumn("area_under_pr", F.round("area_under_pr", 6))


_GROUP_AP_SQL = f"""
  SELECT lang, CAST(sum(n) AS BIGINT) AS n, CAST(sum(hits) AS BIGINT) AS positives,
         coalesce(sum(hits * reached / seen) / nullif(sum(hits), 0), 0.0) AS ap
  FROM (
    SELECT lang, score, n, hits, sum(n) OVER w AS seen, sum(hits) OVER w AS reached
    FROM (SELECT lang, score, count(*) AS n, sum(label) AS hits FROM ({_SCORED_SQL}) GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY lang ORDER BY score DESC))
  GROUP BY 1"""


@query(f"SELECT lang, n, positives, round(ap, 6) AS average_precision FROM ({_GROUP_AP_SQL})")
def average_precision(spark, folder):
    groups = evaluate.average_precision(_scored(spark, folder), "score", "label", ["lang"])
    return groups.withColumn("average_precision", F.round("average_precision", 6))


@query(f"SELECT round(avg(ap), 6) AS mean_average_precision FROM ({_GROUP_AP_SQL})")
def mean_average_precision(spark, folder):
    groups = evaluate.average_precision(_scored(spark, folder), "score", "label", ["lang"])
    mean = evaluate.mean_average_precision(groups)
    return mean.withColumn("mean_average_precision", F.round("mean_average_precision", 6))


_FOLD_SQL = f"""
  SELECT t AS parameter, source AS fold, avg(CASE WHEN (score > t) = (label = 1) THEN 1.0 ELSE 0.0 END) AS area_under_pr
  FROM ({_SCORED_SQL}), (VALUES (0.002), (0.01), (0.05)) v(t) GROUP BY 1, 2"""


def _fold_scores(spark, folder):
    scored = _scored(spark, folder)
    tried = scored.withColumn("parameter", F.explode(F.array(*[F.lit(t) for t in (0.002, 0.01, 0.05)])))
    right = ((F.col("score") > F.col("parameter")) == (F.col("label") == 1)).cast("double")
    return tried.groupBy("parameter", F.col("source").alias("fold")).agg(F.avg(right).alias("area_under_pr"))


# The probability of a logistic regression on one column rises or falls with it, as the column's
# covariance with the label on the training rows says, whatever the regularisation.
@query("""
WITH i AS (SELECT ts, event_id, value, CAST(event_type = 'purchase' AS INT) AS label,
                  row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM events),
     f AS (SELECT *, least(CAST(floor(i * 3 / n) AS BIGINT), 2) AS fold FROM i),
     c AS (SELECT *, ceil(fold * n / 3) + floor((ceil((fold + 1) * n / 3) - ceil(fold * n / 3)) * 0.8) AS cut FROM f),
     s AS (SELECT fold, sign(covar_pop(value, label)) AS s FROM c WHERE i < cut GROUP BY 1),
     p AS (SELECT fold, value * s AS score, sum(label) AS hits, count(*) AS n FROM c JOIN s USING (fold) WHERE i >= cut GROUP BY 1, 2),
     r AS (SELECT *, sum(hits) OVER w AS reached, sum(n) OVER w AS seen, sum(hits) OVER (PARTITION BY fold) AS positives
           FROM p WINDOW w AS (PARTITION BY fold ORDER BY score DESC)),
     a AS (SELECT CAST(fold AS INT) AS fold,
                  round(sum(hits / positives * (reached / seen + coalesce((reached - hits) / nullif(seen - n, 0), reached / seen)) / 2), 6) AS area_under_pr
           FROM r GROUP BY 1)
SELECT parameter, fold, area_under_pr FROM a, (SELECT unnest([0.0, 0.01]) AS parameter)
""")
def cross_validation(spark, folder):
    """Area under the curve of every parameter on every fold."""
    events = load_table(spark, folder, "events").withColumn("label", (F.col("event_type") == "purchase").cast("double"))
    rows = VectorAssembler(inputCols=["value"], outputCol="features").transform(events)
    folded = splits.blocked_folds(rows, ["ts", "event_id"], folds=3, train_fraction=0.8, levels=time_levels("ts"))
    build = lambda strength: models.logistic().setRegParam(strength)
    return models.cross_validate(folded, build, (0.0, 0.01)).withColumn("area_under_pr", F.round("area_under_pr", 6))


@query(f"SELECT CAST(parameter AS DOUBLE) AS parameter, round(avg(area_under_pr), 6) AS mean_score, count(*) AS n_folds FROM ({_FOLD_SQL}) GROUP BY 1")
def mean_fold_scores(spark, folder):
    means = models.mean_scores(_fold_scores(spark, folder))
    return means.withColumn("mean_score", F.round("mean_score", 6))


@query(f"""
SELECT CAST(parameter AS DOUBLE) AS parameter, round(avg(area_under_pr), 6) AS mean_score FROM ({_FOLD_SQL}) GROUP BY 1
ORDER BY 2 DESC, 1 DESC LIMIT 1
""")
def best_parameter(spark, folder):
    means = models.mean_scores(_fold_scores(spark, folder)).withColumn("mean_score", F.round("mean_score", 6))
    return models.pick_best(means)


_INDEX_SQL = "SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) AS p_type_index, count(*) AS n FROM part GROUP BY 1"


@query(_INDEX_SQL)
def category_index(spark, folder):
    indexed = encode.index_categories(load_table(spark, folder, "part"), ["p_type"])
    return indexed.groupBy("p_type", "p_type_index").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH i AS ({_INDEX_SQL}), s AS (SELECT count(*) AS n_types FROM i)
SELECT p_partkey, n_types + 1 AS n_features, CAST(p_type_index AS BIGINT) AS active, CAST(p_size AS DOUBLE) AS size_value
FROM part JOIN i USING (p_type), s
""")
def one_hot_and_assemble(spark, folder):
    part = load_table(spark, folder, "part")
    vectors = encode.fit_preparation(part, ["p_size"], ["p_type"]).transform(part)
    values = vectors.select("p_partkey", vector_to_array("raw_features").alias("values"))
    return values.select(
        "p_partkey",
        F.size("values").cast("bigint").alias("n_features"),
        (F.array_position("values", F.lit(1.0)) - 1).alias("active"),
        F.element_at("values", -1).alias("size_value"),
    )


# A place for every part: the values come from a table, the vectors hold their one place.
@query("""
WITH t AS (SELECT l_partkey, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS INT) AS active
           FROM lineitem WHERE l_quantity < 40 GROUP BY 1)
SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, active, (SELECT CAST(count(*) AS INT) FROM t) AS n_places
FROM lineitem LEFT JOIN t USING (l_partkey)
""")
def one_hot_of_many_values(spark, folder):
    """Values learned from the smaller orders, vectors for all; a part that only large orders have has no place."""
    line = load_table(spark, folder, "lineitem").withColumn("part", F.col("l_partkey").cast("string"))
    hot = encode.fit_preparation(line.where("l_quantity < 40"), [], ["part"]).transform(line)
    vector = F.unwrap_udt("part_class")
    return hot.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", F.get(vector["indices"], F.lit(0)).alias("active"), vector["size"].alias("n_places")
    )


@query("""
WITH m AS (SELECT avg(l_quantity) AS qm, stddev_samp(l_quantity) AS qs, avg(l_extendedprice) AS pm, stddev_samp(l_extendedprice) AS ps FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, round((l_quantity - qm) / qs, 6) AS quantity, round((l_extendedprice - pm) / ps, 6) AS price
FROM lineitem, m
""")
def standardise(spark, folder):
    line = load_table(spark, folder, "lineitem")
    model = encode.fit_preparation(line, ["l_quantity", "l_extendedprice"], [], centre=True)
    scaled = model.transform(line).withColumn("values", vector_to_array("features"))
    return scaled.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        F.round(F.col("values")[0], 6).alias("quantity"),
        F.round(F.col("values")[1], 6).alias("price"),
    )


def _order_split(spark, folder):
    """Orders cut in time order, each part then joined with its customers."""
    parts = splits.time_split(load_table(spark, folder, "orders"), ["o_orderdate"], 0.8, time_levels("o_orderdate"))
    customer = load_table(spark, folder, "customer")
    return tuple(
        lookup(part, customer, {"o_custkey": "c_custkey"}, ["c_mktsegment", "c_acctbal"]).select(
            "o_orderkey",
            "o_orderdate",
            "o_totalprice",
            "c_acctbal",
            "o_orderpriority",
            "c_mktsegment",
            (F.col("o_orderstatus") == "F").cast("int").alias("finished"),
        )
        for part in parts
    )


def _prepared(spark, folder, centre=False):
    train, test = _order_split(spark, folder)
    # Every stage of the preparation learns from these rows, so the split and the join are worked out once.
    return encode.prepare(
        pin(train), test, ["o_totalprice", "c_acctbal"], ["o_orderpriority", "c_mktsegment"], "finished", centre=centre
    )


@query("""
WITH r AS (SELECT *, percent_rank() OVER (ORDER BY o_orderdate) AS p FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
     s AS (SELECT count(DISTINCT o_orderpriority) + count(DISTINCT c_mktsegment) + 2 AS n_features,
                  stddev_samp(o_totalprice) AS price_sd, stddev_samp(c_acctbal) AS balance_sd FROM r WHERE p <= 0.8)
SELECT CASE WHEN p <= 0.8 THEN 'train' ELSE 'test' END AS part, CAST(o_orderstatus = 'F' AS DOUBLE) AS label,
       any_value(n_features) AS n_features, count(*) AS n,
       round(avg(o_totalprice) / any_value(price_sd), 6) AS mean_price, round(avg(c_acctbal) / any_value(balance_sd), 6) AS mean_balance
FROM r, s GROUP BY 1, 2
""")
def prepare_vectors(spark, folder):
    train, test, _ = _prepared(spark, folder)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    values = both.select("part", "label", vector_to_array("features").alias("values"))
    return values.groupBy("part", "label", F.size("values").cast("bigint").alias("n_features")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.element_at("values", -2)), 6).alias("mean_price"),
        F.round(F.avg(F.element_at("values", -1)), 6).alias("mean_balance"),
    )


_CHI_SQL = """
  SELECT '{c}' AS column_name, round(sum(pow(coalesce(o.n, 0) - a.n * b.n / t.n, 2) / (a.n * b.n / t.n)), 6) AS statistic,
         (count(DISTINCT a.v) - 1) * (count(DISTINCT b.v) - 1) AS degrees
  FROM (SELECT {c} AS v, count(*) AS n FROM lineitem GROUP BY 1) a
  CROSS JOIN (SELECT l_returnflag AS v, count(*) AS n FROM lineitem GROUP BY 1) b
  CROSS JOIN (SELECT count(*) AS n FROM lineitem) t
  LEFT JOIN (SELECT {c} AS v, l_returnflag AS w, count(*) AS n FROM lineitem GROUP BY 1, 2) o ON o.v = a.v AND o.w = b.v"""


@query(_CHI_SQL.format(c="l_linestatus") + " UNION ALL " + _CHI_SQL.format(c="l_linenumber"))
def chi_square_statistics(spark, folder):
    line = load_table(spark, folder, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("string"))
    found = select.chi_square_statistics(line, ["l_linestatus", "l_linenumber"], "l_returnflag")
    return found.select("column_name", F.round("statistic", 6).alias("statistic"), "degrees")


# Three columns share the error of 0.05; with 2 degrees the tail above x is exp(-x / 2).  The part
# column repeats the label and the constant tells nothing.
@query(f"""
SELECT column_name FROM ({_CHI_SQL.format(c="l_linestatus")}) WHERE exp(-statistic / 2) < 0.05 / 3
UNION ALL SELECT 'l_partkey'
""")
def dependent_columns(spark, folder):
    line = load_table(spark, folder, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        F.concat_ws("-", F.pmod("l_partkey", F.lit(7)).cast("string"), "l_returnflag").alias("l_partkey"),
        F.lit("same").alias("constant"),
    )
    chosen = select.dependent_columns(line, ["l_linestatus", "l_partkey", "constant"], "l_returnflag")
    return spark.createDataFrame([(c,) for c in chosen], "column_name string")


_NAMES = [f"v{i:02d}" for i in range(64)]


def _embeddings(spark, folder):
    table = load_table(spark, folder, "embeddings")
    return table.select(
        "vec_id", F.col("label").cast("double").alias("label"), array_to_vector(as_array(table, "embedding")).alias("features")
    )


@query("""
WITH x AS (SELECT label, CAST(embedding[i] AS DOUBLE) AS v, i FROM embeddings, (SELECT unnest(range(1, 65)) AS i)),
     g AS (SELECT i, label, count(*) AS n, avg(v) AS m, sum(v * v) AS ss FROM x GROUP BY 1, 2),
     t AS (SELECT i, sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS gm FROM g GROUP BY 1)
SELECT 'v' || lpad(CAST(g.i - 1 AS VARCHAR), 2, '0') AS column_name,
       round((sum(g.n * pow(g.m - t.gm, 2)) / (any_value(t.k) - 1)) / (sum(g.ss - g.n * g.m * g.m) / (any_value(t.n) - any_value(t.k))), 5) AS statistic,
       CAST(any_value(t.n) - 1 AS BIGINT) AS degrees
FROM g JOIN t ON g.i = t.i GROUP BY g.i
""")
def anova_statistics(spark, folder):
    found = select.anova_statistics(_embeddings(spark, folder), "features", "label", _NAMES)
    return found.select("column_name", F.round("statistic", 5).alias("statistic"), "degrees")


_F_SQL = """
  SELECT '{c}' AS column_name,
         (sum(n) - 2) * sum(n * pow(m - gm, 2)) / sum(n * v) AS statistic
  FROM (SELECT label, count(*) AS n, avg({c}) AS m, var_pop({c}) AS v, any_value(gm) AS gm
        FROM (SELECT *, avg({c}) OVER () AS gm FROM train) GROUP BY 1)"""
_LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def _line_split(spark, folder):
    line = load_table(spark, folder, "lineitem")
    large = (F.col("l_extendedprice") * (1 - F.col("l_discount")) > 60000).cast("double")
    rows = VectorAssembler(inputCols=_LINE_FEATURES, outputCol="features").transform(line)
    rows = rows.select("l_shipdate", "features", large.alias("label"))
    return splits.time_split(rows, ["l_shipdate"], 0.8, time_levels("l_shipdate"))


# With four features, family-wise error 0.05 asks for F above 6.24, the 0.0125 point of F(1, n) for large n.
@query(f"""
WITH r AS (SELECT *, CAST(l_extendedprice * (1 - l_discount) > 60000 AS INT) AS label, percent_rank() OVER (ORDER BY l_shipdate) AS p FROM lineitem),
     train AS (SELECT * FROM r WHERE p <= 0.8),
     f AS ({" UNION ALL ".join(_F_SQL.format(c=c) for c in _LINE_FEATURES)})
SELECT CASE WHEN p <= 0.8 THEN 'train' ELSE 'test' END AS part, (SELECT count(*) FROM f WHERE statistic > 6.24) AS n_features, count(*) AS n
FROM r GROUP BY 1
""")
def selected_features(spark, folder):
    train, test = _line_split(spark, folder)
    train, test, _ = select.select_features(train, test, "continuous", threshold=0.05)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    values = both.select("part", vector_to_array("features").alias("values"))
    return values.groupBy("part", F.size("values").cast("bigint").alias("n_features")).agg(F.count(F.lit(1)).alias("n"))


_COVARIANCE = """
x AS (SELECT vec_id, unnest(range(1, 65)) AS i, unnest(list_transform(embedding, lambda v: CAST(v AS DOUBLE))) AS v FROM embeddings),
c AS (SELECT a.i, b.i AS j, covar_samp(a.v, b.v) AS c FROM x a JOIN x b USING (vec_id) GROUP BY ALL),
m0 AS (SELECT list(line ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS line FROM c GROUP BY i)),
t AS (SELECT sum(c) AS total FROM c WHERE i = j)
"""


def _power_iteration(n: int) -> str:
    """Component n by powers of the covariance without the components before it."""
    step = f"list_transform((SELECT m FROM m{n - 1}), lambda line: list_dot_product(line, v))"
    return f"""
p{n}(step, v) AS (
  SELECT 0, list_transform(range(1, 65), lambda i: 1.0 + i * {n} % 7 / 10.0)
  UNION ALL
  SELECT step + 1, list_transform(w, lambda q: q / sqrt(list_dot_product(w, w))) FROM (SELECT step, {step} AS w FROM p{n} WHERE step < 2500)),
v{n} AS (SELECT v, list_dot_product(v, {step}) AS value FROM p{n} WHERE step = 2500),
m{n} AS (SELECT list_transform(range(1, 65), lambda i: list_transform(range(1, 65), lambda j: m[i][j] - value * v[i] * v[j])) AS m FROM m{n - 1}, v{n})"""


def _components_sql(select: str) -> str:
    parts = [f"SELECT CAST({n} AS BIGINT) AS component, v, value FROM v{n}" for n in (1, 2, 3)]
    steps = ",".join(_power_iteration(n) for n in (1, 2, 3))
    return f"WITH RECURSIVE {_COVARIANCE}, {steps}, found AS ({' UNION ALL '.join(parts)}) {select}"


@query(_components_sql("SELECT component, round(value / total, 6) AS explained FROM found, t"))
def principal_components(spark, folder):
    """Share of the variance that each of the first components explains."""
    _, explained = select.principal_components(_embeddings(spark, folder), 3)
    return explained.withColumn("explained", F.round("explained", 6))


# Signs are free: the largest entry is made positive.
@query(_components_sql("""
SELECT component, i, round(v[i] * CASE WHEN list_max(v) >= -list_min(v) THEN 1 ELSE -1 END, 3) AS weight
FROM found, (SELECT unnest(range(1, 65)) AS i)"""))
def principal_directions(spark, folder):
    """The weight of every column in each of the first components."""
    model, _ = select.principal_components(_embeddings(spark, folder), 3)
    lines = [(n + 1, i + 1, round(float(v), 3) + 0.0) for n, direction in enumerate(model.directions) for i, v in enumerate(direction)]
    return spark.createDataFrame(lines, "component bigint, i bigint, weight double")


@query("""
WITH r AS (SELECT corr(l_quantity, l_extendedprice) AS r FROM lineitem)
SELECT 1 AS component, round((1 + abs(r)) / 2, 6) AS explained FROM r
UNION ALL SELECT 2, round((1 - abs(r)) / 2, 6) FROM r
""")
def components_of_two_measures(spark, folder):
    line = load_table(spark, folder, "lineitem")
    vectors = VectorAssembler(inputCols=["l_quantity", "l_extendedprice"], outputCol="raw").transform(line).select("raw")
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    _, explained = select.principal_components(scaler.fit(vectors).transform(vectors), 2)
    return explained.select(F.col("component").cast("int"), F.round("explained", 6).alias("explained"))


# Leaves of 64: most neighbours lie in another leaf, and every one has to be found.
@query("""
WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e FROM embeddings)
SELECT a.vec_id, b.vec_id AS neighbour, round(list_distance(a.e, b.e), 6) AS distance,
       CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id) AS INT) AS place
FROM x a JOIN x b ON a.vec_id <> b.vec_id AND a.e <> b.e QUALIFY place <= 3
""")
def similar_vectors(spark, folder):
    found = neighbours.nearest_neighbours(load_table(spark, folder, "embeddings"), "vec_id", "embedding", k=3, leaf=64)
    return found.withColumn("distance", F.round("distance", 6))


@query("SELECT vec_id, 3 AS n_found, 3 AS n_true_distances, 1 AS in_order FROM embeddings")
def similar_vectors_in_leaves(spark, folder):
    """Many small leaves: three neighbours for each vector, at the distance that the vectors have, nearest first."""
    table = load_table(spark, folder, "embeddings")
    found = neighbours.nearest_neighbours(table, "vec_id", "embedding", k=3, leaf=128)
    values = table.select("vec_id", as_array(table, "embedding").alias("a"))
    both = found.join(values, "vec_id").join(values.select(F.col("vec_id").alias("neighbour"), F.col("a").alias("b")), "neighbour")
    squares = F.aggregate(F.zip_with("a", "b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x)
    near = F.abs(F.sqrt(squares) - F.col("distance")) < 1e-6
    order = F.transform(F.sort_array(F.collect_list(F.struct("place", "distance"))), lambda p: p["distance"])
    return both.groupBy("vec_id").agg(
        F.count(F.lit(1)).alias("n_found"), F.count_if(near).alias("n_true_distances"), (F.sort_array(order) == order).cast("int").alias("in_order")
    )


_DRAW = "CAST(CAST('0x' || substr(md5(vec_id || '|' || batch || '|{seed}'), 1, 13) AS UBIGINT) AS DOUBLE) / 4503599627370496.0"


# The class fills several leaves of 16.
@query(f"""
WITH x AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e FROM embeddings),
     m AS (SELECT * FROM x WHERE label = 0),
     near AS (
  SELECT a.vec_id, a.e AS a, b.e AS b,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id) AS place
  FROM m a JOIN m b ON a.vec_id <> b.vec_id),
     draw AS (
  SELECT vec_id, batch, floor({_DRAW.format(seed=48)} * 3) + 1 AS place, {_DRAW.format(seed=49)} AS share
  FROM m, (SELECT unnest([1, 2]) AS batch)),
     made AS (
  SELECT d.vec_id, d.batch, list_transform(range(1, 65), lambda i: n.a[i] + (n.b[i] - n.a[i]) * d.share) AS e
  FROM draw d JOIN near n ON n.vec_id = d.vec_id AND n.place = d.place)
SELECT vec_id, CAST(label = 0 AS DOUBLE) AS label, 0 AS synthetic, round(list_sum(e), 6) AS total FROM x
UNION ALL SELECT vec_id, 1.0, batch, round(list_sum(e), 6) FROM made
""")
def oversample_minority(spark, folder):
    rows = _embeddings(spark, folder).withColumn("label", (F.col("label") == 0).cast("double"))
    more = balance.smote(rows, "vec_id", k=3, multiplier=2, seed=48, leaf=16)
    values = more.withColumn("values", vector_to_array("features"))
    return values.select(
        "vec_id", "label", "synthetic", F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 6).alias("total")
    )


@query("""
WITH p AS (SELECT a.vec_id, a.embedding AS a, b.embedding AS b FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 10)
SELECT vec_id, i, round(CAST(a[i] AS DOUBLE) + CAST(b[i] AS DOUBLE), 6) AS total, round(CAST(a[i] AS DOUBLE) - CAST(b[i] AS DOUBLE), 6) AS difference,
       round(CAST(a[i] AS DOUBLE) * 0.25, 6) AS quarter, round(CAST(a[i] AS DOUBLE) + (CAST(b[i] AS DOUBLE) - CAST(a[i] AS DOUBLE)) * 0.25, 6) AS between_both
FROM p, (SELECT unnest(range(1, 65)) AS i)
""")
def vector_arithmetic(spark, folder):
    rows = load_table(spark, folder, "embeddings")
    a = rows.select("vec_id", as_array(rows, "embedding").alias("a"))
    b = rows.select((F.col("vec_id") - 10).alias("vec_id"), as_array(rows, "embedding").alias("b"))
    x, y, share = F.col("a"), F.col("b"), F.lit(0.25)
    pairs = a.join(b, "vec_id")
    made = F.arrays_zip(
        add(x, y).alias("total"),
        subtract(x, y).alias("difference"),
        scale(x, share).alias("quarter"),
        between_points(x, y, share).alias("between_both"),
    )
    lines = pairs.select("vec_id", F.posexplode(made).alias("pos", "v"))
    rounded = [F.round(F.col(f"v.{c}"), 6).alias(c) for c in ("total", "difference", "quarter", "between_both")]
    return lines.select("vec_id", (F.col("pos") + 1).cast("bigint").alias("i"), *rounded)


def _model_rows(spark, folder):
    train, test, _ = _prepared(spark, folder)
    return train, test


def _summary(name, predictions):
    found = evaluate.accuracy(predictions)
    return found.select(
        F.lit(name).alias("model"), "n", F.round("accuracy", 4).alias("accuracy"), F.round("positive_rate", 6).alias("positive_rate")
    )


def _log_likelihood(c: str) -> str:
    terms = [f"-0.5 * ln(2 * pi() * v{c}_{n}) - pow({n} - m{c}_{n}, 2) / (2 * v{c}_{n})" for n in _LINE_FEATURES]
    return f"ln(n{c}) + " + " + ".join(terms)


def _class_moments(c: str) -> str:
    moments = ", ".join(f"avg({n}) AS m{c}_{n}, var_pop({n}) + any_value(e) AS v{c}_{n}" for n in _LINE_FEATURES)
    return f"SELECT count(*) AS n{c}, {moments} FROM r, s WHERE p <= 0.8 AND label = {c}"


# Gaussian naive Bayes widens every variance by a billionth of the largest one, here that of the price.
@query(f"""
WITH r AS (SELECT *, CAST(l_extendedprice * (1 - l_discount) > 60000 AS INT) AS label, percent_rank() OVER (ORDER BY l_shipdate) AS p FROM lineitem),
     s AS (SELECT 1e-9 * var_pop(l_extendedprice) AS e FROM r WHERE p <= 0.8),
     a AS ({_class_moments("0")}), b AS ({_class_moments("1")})
SELECT CAST(label AS DOUBLE) AS label, CAST({_log_likelihood("1")} > {_log_likelihood("0")} AS DOUBLE) AS prediction, count(*) AS n
FROM r, a, b WHERE p > 0.8 GROUP BY 1, 2
""")
def bayes_predictions(spark, folder):
    train, test = _line_split(spark, folder)
    predictions = models.fit_score(models.bayes(1.0), train, test)
    return evaluate.confusion(predictions).select("label", "prediction", "n")


# With one 0/1 column the fitted probabilities are the class shares of its two values.
@query("""
WITH r AS (SELECT CAST(l_extendedprice * (1 - l_discount) > 30000 AS INT) AS label, CAST(l_quantity > 20 AS INT) AS x,
                  percent_rank() OVER (ORDER BY l_shipdate) AS p FROM lineitem),
     s AS (SELECT x, avg(label) AS share FROM r WHERE p <= 0.8 GROUP BY 1)
SELECT CAST(x AS DOUBLE) AS x, round(any_value(share), 3) AS probability, CAST(any_value(share) > 0.5 AS DOUBLE) AS prediction, count(*) AS n
FROM r JOIN s USING (x) WHERE p > 0.8 GROUP BY 1
""")
def logistic_baseline(spark, folder):
    """Logistic regression on a numeric column, run until it has converged."""
    line = load_table(spark, folder, "lineitem").select(
        "l_shipdate",
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) > 30000).cast("double").alias("label"),
        (F.col("l_quantity") > 20).cast("double").alias("x"),
    )
    train, test = splits.time_split(line, ["l_shipdate"], 0.8, time_levels("l_shipdate"))
    train, test, _ = encode.prepare(train, test, ["x"], [], "label")
    scored = models.fit_score(models.logistic().setMaxIter(100), train, test)
    one = scored.select(vector_to_array("features")[0].alias("f"), vector_to_array("probability")[1].alias("probability"), "prediction")
    lines = one.groupBy((F.col("f") > 0).cast("double").alias("x"))
    return lines.agg(F.round(F.max("probability"), 3).alias("probability"), F.max("prediction").alias("prediction"), F.count(F.lit(1)).alias("n"))


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


# Where the gradient of the logistic loss is 0, the probabilities have the labels' mean and the labels'
# mean product with every column.
@query(f"""
WITH r AS (SELECT *, CAST(l_quantity * (1 + l_tax) + l_linenumber > 30 AND l_returnflag <> 'R' AS INT) AS label FROM lineitem)
SELECT 'all rows' AS column_name, round(avg(label), 5) AS expected FROM r
{"".join(f"UNION ALL SELECT '{c}', round(avg(label * (CAST({c} AS DOUBLE) - m) / s), 5) FROM r, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM r) " for c in _NUMERIC)}
""")
def logistic_expectations(spark, folder):
    """Mean probability, and its mean product with every standardised numeric column, at the fitted weights."""
    label = (F.col("l_quantity") * (1 + F.col("l_tax")) + F.col("l_linenumber") > 30) & (F.col("l_returnflag") != "R")
    line = load_table(spark, folder, "lineitem").select(*_NUMERIC, label.cast("double").alias("label"))
    rows = encode.fit_preparation(line, _NUMERIC, [], centre=True).transform(line)
    scored = models.fit_score(models.logistic().setMaxIter(200).setTol(1e-12), rows, rows)
    chance, values = vector_to_array("probability")[1], vector_to_array("features")
    means = {"all rows": F.avg(chance), **{c: F.avg(chance * values[i]) for i, c in enumerate(_NUMERIC)}}
    found = scored.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), F.round(m, 5).alias("expected")) for c, m in means.items()]).alias("m"))
    return found.select(F.explode("m").alias("m")).select("m.*")


# The first tree of depth 1 takes the cut that leaves the least variance of the labels, -1 and 1,
# among the values of all columns; counts by value and label tell it.
@query(f"""
WITH r AS (SELECT *, row_number() OVER () AS row, 2 * CAST(l_extendedprice * (1 - l_discount) > 30000 AS INT) - 1 AS y FROM lineitem),
     u AS ({" UNION ALL ".join(f"SELECT row, '{c}' AS name, CAST({c} AS DOUBLE) AS value, y FROM r" for c in _NUMERIC if c != "l_extendedprice")}),
     b AS (SELECT name, value, count(*) AS n, sum(y) AS y FROM u GROUP BY 1, 2),
     c AS (SELECT name, value, sum(n) OVER w AS n1, sum(y) OVER w AS y1, sum(n) OVER (PARTITION BY name) AS n, sum(y) OVER (PARTITION BY name) AS y
           FROM b WINDOW w AS (PARTITION BY name ORDER BY value)),
     s AS (SELECT *, y1 / n1 AS below, (y - y1) / (n - n1) AS above FROM c WHERE n1 < n
           ORDER BY y1 * y1 / n1 + (y - y1) * (y - y1) / (n - n1) DESC LIMIT 1)
SELECT CAST(u.y > 0 AS DOUBLE) AS label, CAST(CASE WHEN u.value <= s.value THEN below ELSE above END > 0 AS DOUBLE) AS prediction, count(*) AS n
FROM u JOIN s ON u.name = s.name GROUP BY 1, 2
""")
def first_boosted_tree(spark, folder):
    """Labels and predictions of boosted trees with one tree of one cut, over columns with few values."""
    names = [c for c in _NUMERIC if c != "l_extendedprice"]
    label = (F.col("l_extendedprice") * (1 - F.col("l_discount")) > 30000).cast("double").alias("label")
    line = load_table(spark, folder, "lineitem").select(*[F.col(c).cast("double").alias(c) for c in names], label)
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(line)
    predictions = models.fit_score(models.boosted_trees(1).setMaxIter(1).setMaxBins(64), rows, rows)
    return evaluate.confusion(predictions).select("label", "prediction", "n")


# On one 0/1 column the hinge loss is least where the margin is 1 on the side of the more frequent
# label of each value: every other row then loses 2.
@query("""
WITH r AS (SELECT CAST(l_extendedprice * (1 - l_discount) > 30000 AS INT) AS label, CAST(l_quantity > 20 AS INT) AS x FROM lineitem),
     g AS (SELECT x, sum(label) AS late, count(*) AS n FROM r GROUP BY 1)
SELECT CAST(r.x AS DOUBLE) AS x, CAST(any_value(late * 2 > g.n) AS DOUBLE) AS prediction, round(any_value(2.0 * least(late, g.n - late) / g.n), 2) AS hinge, count(*) AS n
FROM r JOIN g USING (x) GROUP BY 1
""")
def svm_hinge_loss(spark, folder):
    """Prediction and mean hinge loss of a linear support vector machine, for both values of a column."""
    line = load_table(spark, folder, "lineitem").select(
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) > 30000).cast("double").alias("label"), (F.col("l_quantity") > 20).cast("double").alias("x")
    )
    vectors = VectorAssembler(inputCols=["x"], outputCol="features")
    # ``x`` and the label are 0 or 1, so a step of the fit reads one weighted row for each pair of them.
    counted = vectors.transform(models.counted_rows(line, ["x", "label"], "weight"))
    scored = models.fit_score(models.svm(0.0).setMaxIter(200).setTol(1e-9).setWeightCol("weight"), counted, vectors.transform(line))
    margin = vector_to_array("rawPrediction")[1] * (2 * F.col("label") - 1)
    hinge = F.round(F.avg(F.greatest(F.lit(0.0), 1 - margin)), 2).alias("hinge")
    return scored.groupBy("x").agg(F.max("prediction").alias("prediction"), hinge, F.count(F.lit(1)).alias("n"))


def _folds(spark, folder):
    train, test = _model_rows(spark, folder)
    train = pin(train)  # read for the bounds of the folds, for the folds and for the last fit
    order = ["o_orderdate", "o_orderkey"]
    folded = splits.blocked_folds(train, order, folds=3, levels=time_levels("o_orderdate"))
    return folded, train, test


def _classifier(name):
    def run(spark, folder):
        build, parameters = models.CLASSIFIERS[name]
        folded, train, test = _folds(spark, folder)
        _, predictions = models.train_best(folded, train, test, build, parameters)
        return _summary(name, predictions)

    return run


@query()
def boosted_trees_on_folds(spark, folder):
    return _classifier("boosted_trees")(spark, folder)


@query()
def bayes_on_folds(spark, folder):
    return _classifier("bayes")(spark, folder)


@query()
def svm_on_folds(spark, folder):
    return _classifier("svm")(spark, folder)
