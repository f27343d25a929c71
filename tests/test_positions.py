import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from backglance.functions.timeops import time_levels
from backglance.operators import positions, splits, windows

SCHEMA = "id int, at timestamp_ntz, grp string, value double"


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(3)
    base = dt.datetime(2020, 1, 1)
    # A third of the rows share one time; some times are null.
    times = lambda i: base if i % 3 == 0 else None if i % 50 == 1 else base + dt.timedelta(minutes=draw.randrange(0, 90 * 1440, 30))
    data = [(i, times(i), f"g{i % 4 if i % 5 else 0}", round(draw.gauss(0, 5), 2)) for i in range(1500)]
    return spark.createDataFrame(data, SCHEMA).repartition(5).cache()


def same(ours, theirs, out):
    joined = ours.select("id", F.col(out).alias("a")).join(theirs.select("id", F.col(out).alias("b")), "id")
    assert joined.count() == ours.count() == theirs.count()
    assert joined.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_percent_rank_equals_the_window_function(rows):
    for order in (["at"], ["at", "value"], ["grp"]):
        theirs = rows.withColumn("percent_rank", F.percent_rank().over(Window.orderBy(*order)))
        same(positions.global_percent_rank(rows, order), theirs, "percent_rank")


def test_rank_within_equals_the_window_function(rows):
    theirs = rows.withColumn("rank", F.rank().over(Window.partitionBy("grp").orderBy("at")).cast("bigint"))
    same(positions.rank_within(rows, ["grp"], ["at"]), theirs, "rank")


def test_dense_index_equals_row_number(rows):
    ours = positions.dense_index(rows, ["at", "id"])
    same(ours, rows.withColumn("index", F.row_number().over(Window.orderBy("at", "id")).cast("bigint") - 1), "index")


def test_running_totals_descending_with_groups(spark):
    data = [("x", 3, 10), ("x", 2, 0), ("x", 1, 1), ("y", 9, 7), (None, 4, 2), (None, 3, 2)]
    groups = spark.createDataFrame(data, "g string, k int, n int").repartition(4)
    for form in (positions.running_totals, positions._totals_before):
        found = form(groups, ["k"], ["n"], ["g"], descending=True)
        wanted = {("x", 3): 0, ("x", 2): 10, ("x", 1): 10, ("y", 9): 0, (None, 4): 0, (None, 3): 2}
        assert {(r["g"], r["k"]): r["n_before"] for r in found.collect()} == wanted


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_sizes_decide_the_way_but_not_the_result(rows, monkeypatch, few):
    monkeypatch.setattr(positions, "_FEW_GROUPS", few)
    folded = splits.blocked_folds(rows, ["at", "id"], levels=time_levels("at"))
    counts = {(r["fold"], r["part"]): r["count"] for r in folded.groupBy("fold", "part").count().collect()}
    assert counts == {(f, p): n for f in range(3) for p, n in (("train", 400), ("test", 100))}
    medians = {r[0]: r[1] for r in positions.quantile_rows(rows, ["id", "value"]).collect()}
    values = sorted(r["value"] for r in rows.collect())
    assert medians == {"id": 749.0, "value": values[749]}


@pytest.mark.parametrize("n", [1, 2, 3, 100, 1001])
def test_tiny_tables(spark, n):
    rows = spark.range(n)
    ranks = sorted(r["percent_rank"] for r in positions.global_percent_rank(rows, ["id"]).collect())
    assert ranks == pytest.approx([0.0] if n == 1 else list(np.arange(n) / (n - 1)))
    assert sorted(r["index"] for r in positions.dense_index(rows, ["id"]).collect()) == list(range(n))


def test_exact_quantiles(spark):
    draw = random.Random(4)
    data = [
        (draw.gauss(0, 1), float(draw.randrange(3)), 7.0, None, draw.randrange(10**6) if draw.random() < 0.6 else None)
        for _ in range(5001)
    ]
    rows = spark.createDataFrame(data, "a double, b double, c double, d double, e int").repartition(7)
    for share in (0.5, 0.01, 0.9):
        found = {r[0]: r[1] for r in positions.quantile_rows(rows, list("abcde"), share).collect()}
        for i, name in enumerate("abce"):
            values = sorted(line["abcde".index(name)] for line in data if line["abcde".index(name)] is not None)
            assert found[name] == values[max(0, int(np.ceil(len(values) * share)) - 1)], (name, share)
        assert found["d"] is None


def test_group_features(spark):
    days = [dt.date(2020, 1, d) for d in (1, 1, 2, 4)]
    rows = spark.createDataFrame([(i, d, v) for i, (d, v) in enumerate(zip(days, (1, 2, 10, 7)))], "id int, day date, v int")
    totals = {r["id"]: r["t"] for r in windows.group_total(rows, ["day"], "v", "t").collect()}
    assert totals == {0: 3, 1: 3, 2: 10, 3: 7}
    before = {r["id"]: r["t"] for r in windows.prior_day_total(rows, "day", "v", "t").collect()}
    assert before == {0: None, 1: None, 2: 3, 3: None}
    present = {r["id"]: r["t"] for r in windows.prior_day_total(rows, "day", "v", "t", calendar=False).collect()}
    assert present == {0: None, 1: None, 2: 3, 3: 10}


def test_top_k_cuts_before_the_shuffle(rows):
    top = windows.top_k_per_group(rows, ["grp"], [F.desc("value"), F.col("id")], 3)
    assert top.groupBy("grp").count().where("count <> 3").count() == 0
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_random_pick_is_repeatable(rows):
    pick = lambda seed: sorted(r["id"] for r in windows.pick_per_group(rows, ["grp"], "id", seed).collect())
    assert pick(1) == pick(1) and len(pick(1)) == 4
    assert any(pick(1) != pick(seed) for seed in range(2, 6))


def test_time_split_keeps_equal_times_together(rows):
    for fraction in (0.0, 0.3, 0.8, 1.0):
        train, test = splits.time_split(rows, ["at"], fraction, time_levels("at"))
        ranked = rows.withColumn("p", F.percent_rank().over(Window.orderBy("at")))
        assert sorted(r[0] for r in train.select("id").collect()) == sorted(r[0] for r in ranked.where(F.col("p") <= fraction).select("id").collect())
        assert train.count() + test.count() == rows.count()
    train, test = splits.time_split(rows, ["at", "value"], 0.8, time_levels("at"))
    ranked = rows.withColumn("p", F.percent_rank().over(Window.orderBy("at", "value")))
    assert train.count() == ranked.where("p <= 0.8").count()
    assert train.count() + test.count() == rows.count()


def test_time_split_of_zoned_times_and_other_types(rows):
    zoned = rows.withColumn("at", F.col("at").cast("timestamp"))
    for order, levels in ((["at"], [F.to_date("at"), F.date_trunc("hour", "at")]), (["grp", "value"], []), (["value"], [])):
        train, test = splits.time_split(zoned, order, 0.6, levels)
        ranked = zoned.withColumn("p", F.percent_rank().over(Window.orderBy(*order)))
        assert train.count() == ranked.where("p <= 0.6").count()
        assert train.count() + test.count() == zoned.count()


def test_time_split_of_an_empty_table(spark):
    train, test = splits.time_split(spark.createDataFrame([], "at timestamp_ntz"), ["at"])
    assert train.count() == test.count() == 0


def test_time_split_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    train, _ = splits.time_split(orders, ["o_orderdate"], 0.8, time_levels("o_orderdate"))
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(o_orderdate" in plan


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 1001])
def test_folds_cover_every_row_once(spark, n):
    rows = spark.range(n).repartition(5)
    folded = splits.blocked_folds(rows, ["id"], folds=3, gap=5, levels=[F.floor(F.col("id") / 100)])
    parts = folded.groupBy("fold", "part").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n")).collect()
    assert sum(p["n"] for p in parts) == n
    for p in parts:
        assert p["b"] - p["a"] + 1 == p["n"]
    if n >= 1000:
        for fold in range(3):
            size = {p["part"]: p["n"] for p in parts if p["fold"] == fold}
            assert abs(size["test"] - n / 15) <= 1 and size["gap"] == 5


def test_folds_with_a_hot_time(rows):
    folded = splits.blocked_folds(rows, ["at", "id"], folds=4, train_fraction=0.75, levels=time_levels("at"))
    indexed = positions.dense_index(rows, ["at", "id"]).select("id", "index")
    n = rows.count()
    found = folded.join(indexed, "id").select("index", "fold", "part").collect()
    assert len(found) == n
    bounds = splits.fold_bounds(n, 4, 0.75, 0)
    for r in found:
        fold = max(f for f, (first, _, _) in enumerate(bounds) if r["index"] >= first)
        assert r["fold"] == fold
        assert r["part"] == ("test" if r["index"] >= bounds[fold][2] else "train")


def test_keys_at_places(rows):
    ordered = rows.orderBy("at", "id").collect()
    places = [0, 1, 499, 500, 501, 1499]
    for levels in ([], time_levels("at")):
        found = positions.keys_at(rows, ["at", "id"], places, levels)
        for place in places:
            line = rows.limit(1).select(*[F.lit(None) if k is None else k for k in found[place]]).first()
            assert (line[0], line[1]) == (ordered[place]["at"], ordered[place]["id"])


def test_sample_is_repeatable_and_about_right(spark):
    rows = spark.range(20000)
    a = splits.repeatable_sample(rows, "id", 0.1, seed=123)
    assert abs(a.count() - 2000) < 200
    b = splits.repeatable_sample(rows.repartition(13), "id", 0.1, seed=123)
    assert a.exceptAll(b).count() == 0
    assert splits.repeatable_sample(rows, "id", 0.1, seed=1).intersect(a).count() < 400
