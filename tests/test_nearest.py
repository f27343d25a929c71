import math
import random

import pytest

from backglance.operators.nearest import nearest_site


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6372.8 * math.asin(min(1, math.sqrt(h)))


def run(spark, sites, places):
    frame = nearest_site(
        spark.createDataFrame(sites, "id int, lat double, lon double"),
        spark.createDataFrame(places, "city string, plat double, plon double"),
        "lat", "lon", "city", "plat", "plon",
    )
    return {r["id"]: (r["nearest"], r["distance_km"]) for r in frame.collect()}


def brute_force(sites, places):
    answers = {}
    for key, lat, lon in sites:
        best = min((round(km(lat, lon, a, b), 6), city) for city, a, b in places)
        answers[key] = (best[1], best[0])
    return answers


def agree(found, wanted):
    assert found.keys() == wanted.keys()
    for key, (city, distance) in wanted.items():
        assert found[key][0] == city, key
        assert found[key][1] == pytest.approx(distance, abs=1e-5)


def point(draw):
    return math.degrees(math.asin(draw.uniform(-1, 1))), draw.uniform(-180, 180)


def test_few_places_over_the_globe(spark):
    draw = random.Random(1)
    sites = [(i, *point(draw)) for i in range(300)] + [(1000, 90.0, 0.0), (1001, -90.0, 50.0), (1002, 0.0, 180.0), (1003, 0.0, -180.0)]
    places = [(f"c{i:02d}", *point(draw)) for i in range(30)]
    agree(run(spark, sites, places), brute_force(sites, places))


def test_many_places_with_a_dense_cluster(spark):
    draw = random.Random(2)
    places = [(f"c{i:04d}", *point(draw)) for i in range(300)]
    places += [(f"d{i:04d}", 40 + draw.gauss(0, 0.01), -75 + draw.gauss(0, 0.01)) for i in range(400)]
    sites = [(i, *point(draw)) for i in range(200)]
    sites += [(1000 + i, 40 + draw.gauss(0, 0.02), -75 + draw.gauss(0, 0.02)) for i in range(200)]
    sites += [(2000 + i, 42 + draw.gauss(0, 0.5), -75 + draw.gauss(0, 0.5)) for i in range(100)]
    agree(run(spark, sites, places), brute_force(sites, places))


def test_ties_copies_and_nulls(spark):
    places = [("b", 0.0, 10.0), ("a", 0.0, -10.0), ("z", 0.0, 10.0)]
    found = run(spark, [(1, 0.0, 0.0), (2, 0.0, 9.0), (3, None, 1.0)], places)
    assert found[1][0] == "a"
    assert found[2][0] == "b"
    assert found[3] == (None, None)
    copies = [(f"c{i:03d}", 10.0, 10.0) for i in range(200)]
    assert run(spark, [(1, 11.0, 11.0)], copies)[1][0] == "c000"


def test_over_the_date_line(spark):
    found = run(spark, [(1, 0.0, 179.9)], [("east", 0.0, -179.9), ("west", 0.0, 170.0)])
    assert found[1][0] == "east"


def test_no_places(spark):
    assert run(spark, [(1, 0.0, 0.0)], []) == {1: (None, None)}
