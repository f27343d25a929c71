import datetime as dt
import random

import pytest

from backglance.operators.joins import key_difference, lookup, unmatched
from backglance.operators.lookback import lookback_join, with_match_flag

BASE = dt.datetime(2020, 3, 1)
EVENTS = "id int, place string, at timestamp_ntz"
SEEN = "place string, seen_at timestamp_ntz, seen_id int, temperature double"


def hours(n):
    return BASE + dt.timedelta(hours=n)


def brute_force(events, seen, low=2.0, high=4.0, same_day=False):
    answers = {}
    for key, place, at in events:
        best = None
        for where, seen_at, seen_id, _ in seen:
            if None in (place, at, where, seen_at) or where != place:
                continue
            if same_day and seen_at.date() != at.date():
                continue
            gap = (at - seen_at) / dt.timedelta(hours=1)
            if low <= gap <= high and (best is None or (gap, seen_id) < best):
                best = (gap, seen_id)
        answers[key] = best
    return answers


def run(spark, events, seen, **options):
    joined = lookback_join(
        spark.createDataFrame(events, EVENTS), spark.createDataFrame(seen, SEEN),
        ["place"], "at", "seen_at", "seen_id", ["temperature"], **options,
    )
    rows = joined.collect()
    assert len(rows) == len(events)
    return {r["id"]: None if r["seen_id"] is None else (r["gap_hours"], r["seen_id"]) for r in rows}


def agree(found, wanted):
    assert found.keys() == wanted.keys()
    for key, best in wanted.items():
        if best is None:
            assert found[key] is None
        else:
            assert found[key][1] == best[1]
            assert found[key][0] == pytest.approx(best[0], abs=1e-9)


def test_edges_of_the_window(spark):
    gaps = [1.9997, 2, 2.5, 4, 4.0003]
    events = [(i, f"p{i}", hours(30)) for i in range(len(gaps))]
    seen = [(f"p{i}", hours(30 - g), i, 1.0) for i, g in enumerate(gaps)]
    found = run(spark, events, seen)
    assert [found[i] is not None for i in range(5)] == [False, True, True, True, False]


def test_ties_take_the_smallest_key_and_duplicates_stay(spark):
    events = [(1, "a", hours(10)), (2, "a", hours(10))]
    seen = [("a", hours(7.5), 9, 1.0), ("a", hours(7.5), 3, 2.0), ("a", hours(6.5), 1, 3.0)]
    assert run(spark, events, seen) == {1: (2.5, 3), 2: (2.5, 3)}


def test_copies_of_an_observation_do_not_multiply_events(spark):
    events = [(1, "a", hours(10)), (2, "a", hours(10.5))]
    seen = [("a", hours(7.5), 3, 2.0)] * 50
    assert run(spark, events, seen) == {1: (2.5, 3), 2: (3.0, 3)}


def test_day_edge(spark):
    events, seen = [(1, "a", hours(24.5))], [("a", hours(22), 7, 1.0)]
    assert run(spark, events, seen) == {1: (2.5, 7)}
    assert run(spark, events, seen, same_day=True) == {1: None}


def test_nulls_and_empty_sides(spark):
    events = [(1, None, hours(5)), (2, "a", None), (3, "a", hours(5))]
    seen = [(None, hours(2), 1, 1.0), ("a", None, 2, 1.0), ("b", hours(2), 3, 1.0)]
    assert run(spark, events, seen) == {1: None, 2: None, 3: None}
    assert run(spark, events, []) == {1: None, 2: None, 3: None}
    assert run(spark, [], seen) == {}


@pytest.mark.parametrize("options", [{}, {"unique_key": True}, {"slot_hours": 0.25}, {"slot_hours": 7.0}, {"same_day": True}])
def test_random_tables_with_a_hot_key(spark, options):
    draw = random.Random(5)
    place = lambda: "hot" if draw.random() < 0.4 else f"p{draw.randrange(6)}"
    minute = lambda: BASE + dt.timedelta(minutes=draw.randrange(0, 4 * 24 * 60))
    events = [(i, place(), minute()) for i in range(400)]
    seen = [(place(), minute(), i, draw.random()) for i in range(600)]
    agree(run(spark, events, seen, **options), brute_force(events, seen, same_day=options.get("same_day", False)))


def test_one_key_and_span_over_many_ranges(spark):
    """A third of all times in one key and four hours; its last observation goes on through ranges without one."""
    second = lambda n: BASE + dt.timedelta(seconds=n)
    draw = random.Random(11)
    events = [(i, "hot", second(14400 + 2 * i)) for i in range(3000)] + [(5000 + i, f"p{i % 900}", second(9 * i)) for i in range(6000)]
    seen = [("hot", second(7100), 1, 1.0), ("hot", second(7100), 0, 1.0)]
    seen += [("hot", second(9000 + 7 * i), 10 + i, 1.0) for i in range(300)] + [(f"p{draw.randrange(900)}", second(draw.randrange(40_000)), 1000 + i, 1.0) for i in range(900)]
    by_place = {}
    for row in seen:
        by_place.setdefault(row[0], []).append(row)
    wanted = {}
    for event in events:
        wanted |= brute_force([event], by_place.get(event[1], []))
    agree(run(spark, events, seen), wanted)


def test_other_bounds(spark):
    events = [(1, "a", hours(10))]
    seen = [("a", hours(10), 1, 1.0), ("a", hours(9), 2, 1.0)]
    assert run(spark, events, seen, min_hours=0, max_hours=1) == {1: (0.0, 1)}
    assert run(spark, events, seen, min_hours=1, max_hours=1) == {1: (1.0, 2)}


def test_text_observation_keys_and_match_flag(spark):
    events = spark.createDataFrame([(1, "a", hours(10)), (2, "b", hours(10))], EVENTS)
    seen = spark.createDataFrame([("a", hours(7), "k2"), ("a", hours(7), "k1")], "place string, seen_at timestamp_ntz, seen_id string")
    joined = with_match_flag(lookback_join(events, seen, ["place"], "at", "seen_at", "seen_id"), "seen_id")
    assert sorted(joined.select("id", "seen_id", "matched").collect()) == [(1, "k1", 1), (2, None, 0)]


def test_clashing_names_are_errors(spark):
    events = spark.createDataFrame([], EVENTS)
    with pytest.raises(ValueError, match="at"):
        lookback_join(events, spark.createDataFrame([], "place string, at timestamp_ntz, k int"), ["place"], "at", "at", "k")


def test_a_taken_result_name_is_an_error(spark):
    events = spark.createDataFrame([(1, "a", hours(10), 0.0)], EVENTS + ", gap_hours double")
    seen = spark.createDataFrame([("a", hours(7), 1, 1.0)], SEEN)
    with pytest.raises(ValueError, match="gap_hours"):
        lookback_join(events, seen, ["place"], "at", "seen_at", "seen_id")


def test_no_python_no_cross_join_in_the_plan(spark):
    events = spark.createDataFrame([(1, "a", hours(10))], EVENTS)
    seen = spark.createDataFrame([("a", hours(7), 1, 1.0)], SEEN)
    plan = lookback_join(events, seen, ["place"], "at", "seen_at", "seen_id")._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert bad not in plan


def test_unmatched_and_lookup(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    assert sorted(unmatched(left, right, ["k"]).collect(), key=str) == [(1,), (None,)]
    assert sorted(key_difference(left.dropna(), right, ["k"]).collect()) == [(1,)]
    looked = lookup(left, right.withColumnRenamed("k", "key"), {"k": "key"}, ["v"])
    assert sorted((tuple(r) for r in looked.collect()), key=str) == [(1, None), (2, "x"), (2, "x"), (None, None)]
