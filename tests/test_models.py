import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backglance.operators import balance, encode, evaluate, impute, labels, models, neighbours, profile, select, splits


def test_label_rule(spark):
    rows = spark.createDataFrame([(1, None), (1, 0), (0, 1), (0, 0), (0, None), (None, None)], "c int, d int")
    found = [r["label"] for r in labels.derive_label(rows, "d", "c").collect()]
    assert found == [1, 1, 1, 0, 0, 0]


def test_modes_and_medians_come_from_train_only(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 3.0), ("a", None), (None, 10.0)], "s string, v double")
    test = spark.createDataFrame([(None, None), ("z", 99.0)], "s string, v double")
    modes, medians = impute.fit_modes(train, ["s"]), impute.fit_medians(train, ["v"], exact=True)
    assert modes == {"s": "a"} and medians == {"v": 2.0}
    filled = impute.apply_values(impute.apply_values(test, modes), medians)
    assert [tuple(r) for r in filled.collect()] == [("a", 2.0), ("z", 99.0)]


def test_columns_without_values_are_left_alone(spark):
    rows = spark.createDataFrame([(None, None)], "s string, v double")
    assert impute.fit_modes(rows, ["s"]) == {} and impute.fit_medians(rows, ["v"], exact=True) == {}


def test_correlations(spark):
    draw = np.random.default_rng(1)
    a = draw.normal(size=400)
    table = np.column_stack([a, a * 2 + draw.normal(size=400) * 0.01, draw.normal(size=400)])
    rows = spark.createDataFrame([tuple(map(float, line)) for line in table], "a double, b double, c double")
    matrix = profile.correlations(rows, ["a", "b", "c"])
    found = {(r["a"], r["b"]): r["r"] for r in matrix.collect()}
    wanted = np.corrcoef(table.T)
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            assert found[x, y] == pytest.approx(wanted[i, j], abs=1e-9)
    assert sorted(r[0] for r in profile.correlated_columns(matrix).collect()) == ["a", "b"]
    assert profile.prune_correlated(matrix, ["a", "b", "c"]) == ["b"]


def test_prepare_handles_unseen_categories_and_fits_on_train(spark):
    train = spark.createDataFrame([(1, "x", 1.0, 0), (2, "y", 3.0, 1), (3, "x", None, 0)], "id int, c string, v double, t int")
    test = spark.createDataFrame([(4, "new", None, 1), (5, None, 100.0, 0)], "id int, c string, v double, t int")
    numeric, categorical = ["v", "t"], ["c"]
    a, b, _ = encode.prepare(train, test, numeric, categorical, "t")
    assert numeric == ["v", "t"]
    assert a.columns == b.columns == ["id", "features", "label"]
    sizes = {len(r["features"]) for r in a.union(b).collect()}
    assert sizes == {3}
    unseen = b.where("id = 4").first()["features"].toArray()
    assert list(unseen[:2]) == [0.0, 0.0]
    again, _, _ = encode.prepare(train, test.limit(0), numeric, categorical, "t")
    assert [r["features"] for r in again.orderBy("id").collect()] == [r["features"] for r in a.orderBy("id").collect()]


def test_one_class_is_an_error(spark):
    rows = spark.createDataFrame([("x", 1)], "c string, t int")
    with pytest.raises(ValueError, match="2 classes"):
        encode.prepare(rows, rows, [], ["c"], "t")


def test_many_categories(spark):
    """200,000 values: an index for each, and a chi-square test over all of them."""
    rows = spark.range(400_000).select((F.col("id") % 200_000).cast("string").alias("c"), (F.col("id") % 2).alias("t"), (F.col("id") % 3).cast("string").alias("d"))
    indexed = encode.index_categories(rows, ["c"])
    shape = indexed.agg(F.count_distinct("c_index").alias("n"), F.max("c_index").alias("last")).first()
    assert shape["n"] == 200_000 and shape["last"] == 199_999
    found = {r["column_name"]: r for r in select.chi_square_statistics(rows, ["c", "d"], "t").collect()}
    assert found["c"]["degrees"] == 199_999 and found["c"]["statistic"] == pytest.approx(400_000)
    assert select.dependent_columns(rows, ["d", "c"], "t") == ["c"] and found["d"]["p_value"] > 0.9


@pytest.mark.parametrize("x, k, p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (0.5, 3, 0.918891), (18.307, 10, 0.05)])
def test_chi_square_tail(x, k, p):
    assert select.chi_square_tail(x, k) == pytest.approx(p, rel=0.02)


def test_chi_square_tail_of_even_degrees():
    """With an even number of degrees the tail is a finite Poisson sum."""
    for x, k in ((200.0, 100), (90.0, 100), (3.0, 4), (60.0, 8)):
        wanted = sum(math.exp(i * math.log(x / 2) - x / 2 - math.lgamma(i + 1)) for i in range(k // 2))
        assert select.chi_square_tail(x, k) == pytest.approx(wanted, rel=1e-9)


def test_selection_finds_the_feature_that_matters(spark):
    draw = random.Random(2)
    data = [(Vectors.dense([draw.gauss(label, 1), draw.gauss(0, 1)]), float(label)) for label in (0, 1) for _ in range(300)]
    rows = spark.createDataFrame(data, T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType())]))
    train, test, chosen = select.select_features(rows, rows)
    assert chosen == [0] and train.columns == ["label", "features"]


def test_categorical_selection_and_chi_square(spark):
    draw = random.Random(12)
    data = [(draw.choice("ab") if draw.random() < 0.3 else "ab"[y], draw.choice("xyz"), y) for y in (0, 1) for _ in range(400)]
    rows = spark.createDataFrame(data, "c string, d string, t int")
    found = {r["column_name"]: r for r in select.chi_square_statistics(rows, ["c", "d", "t"], "t").collect()}
    assert set(found) == {"c", "d"} and found["c"]["p_value"] < 1e-6 and found["d"]["degrees"] == 2
    table = np.array([[sum(1 for r in data if r[1] == v and r[2] == y) for y in (0, 1)] for v in "xyz"], dtype=float)
    expected = table.sum(axis=1, keepdims=True) * table.sum(axis=0, keepdims=True) / table.sum()
    assert found["d"]["statistic"] == pytest.approx(((table - expected) ** 2 / expected).sum())
    indexed = encode.index_categories(rows, ["c", "d"])
    vectors = VectorAssembler(inputCols=["c_index", "d_index"], outputCol="features").transform(indexed)
    model = select.fit_selector(vectors.withColumn("label", F.col("t").cast("double")), "categorical")
    assert list(model.selectedFeatures) == [0]


def test_f_statistic(spark):
    draw = np.random.default_rng(13)
    table, label = draw.normal(size=(300, 2)), draw.integers(0, 3, 300)
    table[:, 0] += label
    rows = spark.createDataFrame(
        [(Vectors.dense(x), float(y)) for x, y in zip(table, label)],
        T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType())]),
    )
    found = {r["column_name"]: r["statistic"] for r in select.anova_statistics(rows, "features", "label", ["a", "b"]).collect()}
    for i, name in enumerate("ab"):
        groups = [table[label == g, i] for g in range(3)]
        between = sum(len(g) * (g.mean() - table[:, i].mean()) ** 2 for g in groups) / 2
        within = sum(((g - g.mean()) ** 2).sum() for g in groups) / 297
        assert found[name] == pytest.approx(between / within)


def test_principal_components(spark):
    draw = np.random.default_rng(3)
    table = draw.normal(size=(300, 4)) * np.array([10, 1, 1, 0.1])
    rows = spark.createDataFrame([(Vectors.dense(line),) for line in table], T.StructType([T.StructField("features", VectorUDT())]))
    model, explained = select.principal_components(rows, 2)
    shares = [r["explained"] for r in explained.orderBy("component").collect()]
    values = np.sort(np.linalg.eigvalsh(np.cov(table.T)))[::-1]
    assert shares == pytest.approx(list(values[:2] / values.sum()), rel=1e-6)


def test_one_hot_of_200_000_values(spark):
    """Every value has a place of its own; the driver gets their number, and the stages hold no labels."""
    n = 200_000
    rows = spark.range(n + 1000).select(F.concat(F.lit("v"), F.col("id") % n).alias("c"), (F.col("id") % 7).cast("double").alias("x"))
    fitted = encode.fit_preparation(rows, ["x"], ["c"])
    assert fitted.sizes == {"c": n} and not any("labels" in p.name for stage in fitted.stages.stages for p in stage.params)
    vector = F.unwrap_udt("c_class")
    hot = fitted.transform(rows).select("c", vector["size"].alias("size"), F.get(vector["indices"], F.lit(0)).alias("at"))
    found = hot.agg(F.count_distinct("at"), F.min("at"), F.max("at"), F.min("size"), F.max("size")).first()
    assert tuple(found) == (n, 0, n - 1, n, n)
    unseen = spark.createDataFrame([("other", 1.0), (None, 2.0), ("v5", None)], "c string, x double")
    places = {r["c"]: r["i"] for r in fitted.transform(unseen).select("c", vector["indices"].alias("i")).collect()}
    assert places["other"] == places[None] == [] and len(places["v5"]) == 1


def test_components_of_many_columns(spark):
    """2,000 columns that five hidden directions move: shares and directions as the singular values say."""
    draw = np.random.default_rng(13)
    hidden = np.linalg.qr(draw.normal(size=(2000, 5)))[0] * np.array([30, 20, 14, 9, 6])
    table = draw.normal(size=(240, 5)) @ hidden.T + draw.normal(size=(240, 2000)) * 0.05 + 3
    model, explained = select.principal_components(vectors(spark, table).repartition(4), 5)
    _, values, right = np.linalg.svd(table - table.mean(0), full_matrices=False)
    shares = [r["explained"] for r in explained.orderBy("component").collect()]
    assert shares == pytest.approx(list(values[:5] ** 2 / (values**2).sum()), rel=1e-9)
    assert np.abs(np.abs(model.directions @ right[:5].T) - np.eye(5)).max() < 1e-7
    placed = np.array([r["pca_features"] for r in model.transform(vectors(spark, table)).orderBy("id").collect()])
    assert np.allclose(placed, (table - table.mean(0)) @ model.directions.T)


def test_components_of_nothing(spark):
    for table in (np.zeros((0, 3)), np.ones((1, 3)), np.ones((4, 3))):
        frame = vectors(spark, table) if len(table) else vectors(spark, np.ones((1, 3))).limit(0)
        model, explained = select.principal_components(frame, 2)
        assert explained.count() == 0 and len(model.directions) == 0


def vectors(spark, table, **columns):
    names = list(columns)
    rows = [(i, [float(x) for x in line], *[columns[n][i] for n in names]) for i, line in enumerate(table)]
    return spark.createDataFrame(rows, ", ".join(["id int", "features array<double>", *[f"{n} int" for n in names]]))


def exact_neighbours(table, k):
    gaps = np.sqrt(((table[:, None] - table[None]) ** 2).sum(axis=2))
    answers = {}
    for i, line in enumerate(gaps):
        order = [j for j in np.lexsort((np.arange(len(line)), line)) if line[j] > 0]
        answers[i] = [(j, line[j]) for j in order[:k]]
    return answers


def test_neighbours_are_exact_within_a_leaf(spark):
    table = np.random.default_rng(4).normal(size=(120, 6))
    found = neighbours.nearest_neighbours(vectors(spark, table), "id", "features", k=3)
    wanted = exact_neighbours(table, 3)
    for r in found.collect():
        j, gap = wanted[r["id"]][r["place"] - 1]
        assert r["neighbour"] == j and r["distance"] == pytest.approx(gap)
    assert found.count() == 360


def test_neighbours_over_many_leaves_have_good_recall(spark):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(20, 8)) * 5
    table = centres[draw.integers(0, 20, 2000)] + draw.normal(size=(2000, 8))
    found = neighbours.nearest_neighbours(vectors(spark, table), "id", "features", k=3, leaf=128).collect()
    wanted = exact_neighbours(table, 3)
    per_row = {}
    for r in found:
        per_row.setdefault(r["id"], []).append((r["neighbour"], r["distance"]))
    assert len(per_row) == 2000 and all(len(v) == 3 for v in per_row.values())
    hits = sum(len({j for j, _ in per_row[i]} & {j for j, _ in wanted[i]}) for i in per_row)
    assert hits / 6000 > 0.5
    ours, best = (np.mean([v[0][1] for v in per_row.values()]), np.mean([v[0][1] for v in wanted.values()]))
    assert ours < best * 1.3


def recall(spark, table, **search):
    found = neighbours.nearest_neighbours(vectors(spark, table), "id", "features", k=3, **search).collect()
    asked = range(0, len(table), 20)  # every 20th row against all rows
    gaps = ((table[asked][:, None] - table[None]) ** 2).sum(2) if len(table) < 3000 else None
    hits = 0
    per_row = {}
    for r in found:
        per_row.setdefault(r["id"], set()).add(r["neighbour"])
    for n, i in enumerate(asked):
        line = gaps[n] if gaps is not None else ((table - table[i]) ** 2).sum(1)
        hits += len(per_row[i] & set(np.argsort(np.where(np.arange(len(table)) == i, np.inf, line))[:3].tolist()))
    return hits / (3 * len(asked))


def test_recall_of_many_small_leaves(spark):
    """The embeddings of the given tables in leaves of 128, and 6,000 clustered vectors with the defaults."""
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    assert recall(spark, np.array([r["embedding"] for r in rows], dtype=float), leaf=128) >= 0.9
    draw = np.random.default_rng(8)
    clustered = draw.normal(size=(50, 64))[draw.integers(0, 50, 6000)] * 2 + draw.normal(size=(6000, 64)) * 0.3
    assert recall(spark, clustered) >= 0.9


def same_as_brute_force(spark, table, k, **search):
    """Every neighbour of every row, by squared distances in blocks."""
    found = neighbours.nearest_neighbours(vectors(spark, table), "id", "features", k=k, **search).collect()
    ours = {(r["id"], r["place"]): (r["neighbour"], r["distance"]) for r in found}
    assert len(ours) == len(found) == k * len(table)
    for start in range(0, len(table), 500):
        part = table[start : start + 500]
        squares = (part * part).sum(1)[:, None] + (table * table).sum(1) - 2 * part @ table.T
        squares[np.arange(len(part)), np.arange(start, start + len(part))] = np.inf
        for i, line in enumerate(np.argsort(squares, axis=1)[:, :k]):
            for place, j in enumerate(line, 1):
                neighbour, distance = ours[start + i, place]
                assert distance == pytest.approx(np.sqrt(squares[i, j]), rel=1e-6)
                assert neighbour == j


def test_neighbours_are_exact_over_many_leaves(spark):
    """10,000 evenly spread vectors of 64 numbers with the defaults, and clusters in leaves of 100."""
    draw = np.random.default_rng(9)
    same_as_brute_force(spark, draw.normal(size=(10_000, 64)), 3)
    clustered = draw.normal(size=(40, 12))[draw.integers(0, 40, 4000)] * 9 + draw.normal(size=(4000, 12)) * 0.3
    same_as_brute_force(spark, clustered, 5, leaf=100, directions=4)


def test_ties_go_to_the_smaller_key_over_leaves(spark):
    """Points of a grid have up to 8 neighbours at distance 1; the smallest keys win, in whatever leaf they lie."""
    table = np.array([(x, y, z) for x in range(6) for y in range(6) for z in range(6)], float)
    found = neighbours.nearest_neighbours(vectors(spark, table), "id", "features", k=2, leaf=20).collect()
    wanted = exact_neighbours(table, 2)
    assert {(r["id"], r["place"]): r["neighbour"] for r in found} == {(i, p + 1): j for i, near in wanted.items() for p, (j, _) in enumerate(near)}


def test_clusters_meet_few_leaves(spark):
    """Pairs of leaves that are compared, of all pairs: few for clusters that lie apart."""
    draw = np.random.default_rng(10)
    table = draw.normal(size=(30, 10))[draw.integers(0, 30, 3000)] * 20 + draw.normal(size=(3000, 10)) * 0.2
    points = vectors(spark, table).select(F.col("id").alias("key"), F.col("features").alias("values"))
    members = neighbours._in_leaves(points, 50, 6, 1).groupBy("leaf").applyInPandas(
        neighbours._within(3), "leaf bigint, key int, values array<double>, along array<double>, bound double, neighbours array<int>, distances array<double>"
    )
    pairs = neighbours._pairs_of_leaves(members, 6, 60)
    assert pairs.count() < 0.2 * 60 * 60


def test_copies_get_neighbours_at_a_distance(spark):
    table = np.vstack([np.zeros((40, 3)), np.random.default_rng(6).normal(size=(20, 3))])
    found = neighbours.nearest_neighbours(vectors(spark, table), "id", "features", k=2).collect()
    assert {r["id"] for r in found} == set(range(60))
    assert all(r["distance"] > 0 for r in found)


def test_one_vector_has_no_neighbours(spark):
    assert neighbours.nearest_neighbours(vectors(spark, np.ones((3, 2))), "id", "features").count() == 0


def test_new_points_lie_between_minority_rows(spark):
    table = np.random.default_rng(7).normal(size=(90, 4))
    label = [1 if i < 30 else 0 for i in range(90)]
    rows = vectors(spark, table, label=label, other=list(range(90)))
    more = balance.smote(rows, "id", multiplier=2)
    made = more.where("synthetic > 0").collect()
    assert len(made) == 60 and more.where("synthetic = 0").count() == 90
    near = exact_neighbours(table[:30], 3)
    for r in made:
        a, x = table[r["id"]], np.array(r["features"])
        fits = []
        for j, gap in near[r["id"]]:
            b = table[j]
            share = (x - a) @ (b - a) / ((b - a) @ (b - a))
            fits.append(0 <= share <= 1 and np.allclose(a + share * (b - a), x) and r["other"] in (r["id"], j))
        assert any(fits) and r["label"] == 1
    again = balance.smote(rows.repartition(7), "id", multiplier=2)
    text = lambda df: sorted(map(str, df.collect()))
    assert text(more) == text(again)


def scored(spark, n=500, ties=False):
    draw = random.Random(8)
    data = []
    for i in range(n):
        label = int(draw.random() < 0.2)
        score = 1 / (1 + math.exp(-draw.gauss(label - 0.5, 1)))
        data.append((i, f"g{i % 3}", round(score, 1) if ties else score, label))
    return spark.createDataFrame(data, "id int, grp string, score double, label int")


@pytest.mark.parametrize("ties", [False, True])
def test_area_under_pr_equals_the_evaluator(spark, ties):
    rows = scored(spark, ties=ties)
    mine = evaluate.area_under_pr(rows, "score", "label").first()[0]
    given = rows.select(F.col("label").cast("double").alias("label"), F.col("score").alias("rawPrediction"))
    theirs = BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0).evaluate(given)
    assert mine == pytest.approx(theirs, abs=1e-9)


def test_a_constant_score_has_the_positive_rate(spark):
    rows = scored(spark).withColumn("score", F.lit(0.5))
    rate = rows.agg(F.avg("label")).first()[0]
    assert evaluate.area_under_pr(rows, "score", "label").first()[0] == pytest.approx(rate)


def test_average_precision_per_group(spark):
    rows = scored(spark)
    found = {r["grp"]: r["average_precision"] for r in evaluate.average_precision(rows, "score", "label", ["grp"]).collect()}
    lines = rows.collect()
    for grp, value in found.items():
        ranked = sorted((r for r in lines if r["grp"] == grp), key=lambda r: -r["score"])
        hits, total = 0, 0.0
        for place, r in enumerate(ranked, 1):
            if r["label"] == 1:
                hits += 1
                total += hits / place
        assert value == pytest.approx(total / hits)
    nothing = evaluate.average_precision(rows.withColumn("label", F.lit(0)), "score", "label", ["grp"])
    assert {r["average_precision"] for r in nothing.collect()} == {0.0}
    assert evaluate.mean_average_precision(nothing).first()[0] == 0.0


def test_confusion_shares_sum_to_one(spark):
    rows = scored(spark).withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    shares = evaluate.confusion(rows)
    assert shares.agg(F.sum("share")).first()[0] == pytest.approx(1.0)
    right = shares.where("label = prediction").agg(F.sum("share")).first()[0]
    assert evaluate.accuracy(rows).first()["accuracy"] == pytest.approx(right)


def test_every_parameter_sees_every_fold(spark):
    draw = random.Random(9)
    data = [(i, Vectors.dense([draw.gauss(i % 2, 1), draw.gauss(0, 1)]), float(i % 2)) for i in range(600)]
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType())])
    rows = spark.createDataFrame(data, schema)
    train, test = splits.time_split(rows, ["id"], 0.8)
    folded = splits.blocked_folds(train, ["id"])
    scores, predictions = models.train_best(folded, train, test, models.svm, models.SVM_REGULARISATION)
    assert scores.select("parameter", "fold").distinct().count() == 9
    means = models.mean_scores(scores)
    assert means.where("n_folds <> 3").count() == 0
    assert models.pick_best(means).first()["mean_score"] == means.agg(F.max("mean_score")).first()[0]
    assert evaluate.accuracy(predictions).first()["accuracy"] > 0.55


def test_best_parameter_tie_takes_the_later(spark):
    means = spark.createDataFrame([(1.0, 0.5), (2.0, 0.5), (3.0, 0.4)], "parameter double, mean_score double")
    assert models.pick_best(means).first()["parameter"] == 2.0


def test_distribution_moments(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    line = profile.distribution(rows, ["v"]).first()
    values = np.array([1, 2, 3, 10.0])
    assert line["skewness"] == pytest.approx(((values - 4) ** 3).mean() / values.var() ** 1.5)
    assert (line["smallest"], line["largest"], line["n"]) == (1.0, 10.0, 4)


def test_leaves_grow_with_the_table(spark, monkeypatch):
    """Evenly spread vectors meet all leaves, so each is sent once per leaf: their number has to stay small."""
    seen = []
    pairs_of = neighbours._pairs_of_leaves
    monkeypatch.setattr(neighbours, "_pairs_of_leaves", lambda members, many, leaves: seen.append(leaves) or pairs_of(members, many, leaves))
    same_as_brute_force(spark, np.random.default_rng(12).normal(size=(2000, 20)), 3, leaf=16)
    assert seen and seen[0] <= neighbours._LEAVES


def test_chunks_lose_no_neighbour():
    """Grid points, whose distances tie, and clusters far apart: chunks against all distances."""
    draw = np.random.default_rng(13)
    grid = np.array([(x, y, z) for x in range(12) for y in range(12) for z in range(12)], float)[draw.permutation(1728)]
    clusters = draw.normal(size=(15, 5))[draw.integers(0, 15, 1500)] * 20 + draw.normal(size=(1500, 5)) * 0.1
    for table in (grid, clusters):
        along, rank, k = table[:, :3], draw.permutation(len(table)), 4
        i, j, distance = neighbours._nearest_in_chunks(table, along, table, along, k, np.full(len(table), np.inf), rank, True)
        for row, near in exact_of_ranks(table, rank, k):
            assert j[i == row].tolist() == near
        left = table[:300]
        bound = np.array([distance[i == row].max() for row in range(300)])
        i, j, _ = neighbours._nearest_in_chunks(left, left[:, :3], table[300:], along[300:], k, bound, rank[300:], False)
        for row, near in exact_of_ranks(table, rank, k):
            if row < 300:
                assert set(j[i == row] + 300) >= {n for n in near if n >= 300}


def exact_of_ranks(table, rank, k):
    gaps = np.sqrt(((table[:, None] - table[None]) ** 2).sum(2))
    np.fill_diagonal(gaps, np.inf)
    return [(row, np.lexsort((rank, line))[:k].tolist()) for row, line in enumerate(gaps)]


def test_hinge_loss_is_fitted_on_one_row_for_each_pair(spark, tmp_path, monkeypatch):
    """The steps of the fit read as many rows as there are pairs of value and label, with the weight of all."""
    from backglance.slate import modelling

    lines = [(float(q), 100.0 * p, 0.0) for q in range(10, 31) for p in (200, 250, 350, 400, 500)[: 2 + q % 4]]
    spark.createDataFrame(lines, "l_quantity double, l_extendedprice double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    fitted = []
    monkeypatch.setattr(models, "fit_score", lambda e, train, test: fitted.append(train) or e.fit(train).transform(test))
    found = {r["x"]: r for r in modelling.svm_hinge_loss(spark, str(tmp_path)).collect()}
    assert fitted[0].count() == 4 and fitted[0].agg(F.sum("weight")).first()[0] == len(lines)
    for x in (0.0, 1.0):
        late = [p > 30000 for q, p, _ in lines if (q > 20) == (x == 1)]
        least = min(sum(late), len(late) - sum(late))
        assert found[x]["n"] == len(late) and found[x]["hinge"] == pytest.approx(2 * least / len(late), abs=0.011)


def test_folds_read_training_rows_from_files(spark, monkeypatch):
    """The split and the join are worked out once, not again for every stage that learns and for every fold."""
    from backglance.slate import modelling

    seen = []
    prepare, cross_validate = encode.prepare, models.train_best
    monkeypatch.setattr(encode, "prepare", lambda train, *a, **k: seen.append(train) or prepare(train, *a, **k))
    monkeypatch.setattr(models, "train_best", lambda folded, train, *a: seen.extend([folded, train]) or cross_validate(folded, train, *a))
    assert modelling.svm_on_folds(spark, "/root/testdata/sf0.001").count() == 1
    assert len(seen) == 3 and all("pinned-" in path for df in seen for path in df.inputFiles())


def test_support_vector_machine_is_fitted_until_it_converges(spark):
    """With a place for each value the least hinge loss is known: every row with the rarer label of its value loses 2."""
    counts = {0: (36, 4), 1: (30, 120), 2: (25, 15), 3: (90, 170)}
    data = [(Vectors.dense([float(v == k) for k in counts]), float(late)) for v, both in counts.items() for late in (0, 1) for _ in range(both[late])]
    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType())])
    rows = spark.createDataFrame(data, schema).coalesce(1)
    least = 2 * sum(map(min, counts.values())) / len(data)
    for final in (False, True):
        assert models.svm(0.0, final).fit(rows).summary().objectiveHistory[-1] == pytest.approx(least, abs=0.005)


def test_support_vector_machines_on_folds_end_by_their_tolerance(spark, tmp_path, monkeypatch):
    from backglance.slate import modelling

    draw = random.Random(32)
    orders = [
        (i, i % 30, datetime(2001, 1, 1) + timedelta(hours=i), draw.uniform(1, 9), f"{draw.randrange(3)}-PRIORITY", draw.choice("FO")) for i in range(600)
    ]
    names = "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double, o_orderpriority string, o_orderstatus string"
    spark.createDataFrame(orders, names).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    customers = [(i, f"segment {i % 4}", draw.gauss(0, 100)) for i in range(30)]
    spark.createDataFrame(customers, "c_custkey long, c_mktsegment string, c_acctbal double").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    fitted, fit = [], LinearSVC.fit

    def kept(self, df, *rest):
        model = fit(self, df, *rest)
        fitted.append((model.summary().totalIterations, self.getMaxIter()))
        return model

    monkeypatch.setattr(LinearSVC, "fit", kept)
    assert modelling.svm_on_folds(spark, str(tmp_path)).first()["n"] == 120
    assert len(fitted) == 10 and all(5 < ran < most for ran, most in fitted)
