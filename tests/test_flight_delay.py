import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from backglance.operators import evaluate
from backglance.plans import fixed_values as fixed
from backglance.plans import flight_delay as plan

CITIES = [("Chicago, IL", 41.9, -87.6, "America/Chicago"), ("Boston, MA", 42.4, -71.1, "America/New_York")]


def test_packed_fields_have_93_parts():
    assert sum(map(len, fixed.PACKED_FIELDS.values())) == 93
    assert len(fixed.part_names(fixed.DOUBLE_PARTS)) == 31
    assert len(fixed.STATES) == 51
    widths = [len(c) for c in fixed.part_codes().values()]
    assert [widths.count(n) for n in range(1, 7)] == [27, 8, 4, 10, 12, 2]


@pytest.fixture(scope="module")
def raw(spark):
    draw = random.Random(11)
    flights, weather = [], []
    for i in range(900):
        day = dt.date(2019, 1, 1) + dt.timedelta(days=i // 30)
        city = CITIES[i % 2]
        late = int(draw.random() < (0.6 if i % 5 == 0 else 0.1))
        cancelled = float(i % 97 == 0)
        flights.append(
            (i, str(day), draw.randrange(6, 23) * 100 + draw.choice([0, 15, 45]), "AA" if i % 5 else "ZZ", f"N{i % 40}{'AB' if i % 5 else 'XY'}",
             city[0], city[0][-2:], None if cancelled or i % 50 == 1 else float(late), cancelled, float(late * 20), float(i % 3 == 0) * late)
        )
    for hour in range(31 * 24):
        at = dt.datetime(2019, 1, 1) + dt.timedelta(hours=hour)
        for station, lat, lon, name in (("S1", 41.8, -87.7, "OHARE, IL US"), ("S2", 42.3, -71.0, "LOGAN, MA US"), ("S3", 48.0, 2.0, "PARIS, FR")):
            temperature = "+9999,9" if hour % 10 == 0 else f"{draw.randrange(-200, 200):+05d},1"
            weather.append((station, at, str(lat), str(lon), name, f"{draw.randrange(1, 360):03d},1,N,{draw.randrange(200):04d},1", temperature, ""))
    return (
        spark.createDataFrame(
            flights,
            "id int, FL_DATE string, CRS_DEP_TIME int, OP_CARRIER string, TAIL_NUM string, ORIGIN_CITY_NAME string, "
            "ORIGIN_STATE_ABR string, DEP_DEL15 double, CANCELLED double, DEP_DELAY double, WEATHER_DELAY double",
        ),
        spark.createDataFrame(
            weather,
            "STATION string, DATE timestamp_ntz, LATITUDE string, LONGITUDE string, NAME string, WND string, TMP string, AW1 string",
        ),
        spark.createDataFrame(CITIES, "city string, lat double, lon double, tz string"),
    )


@pytest.fixture(scope="module")
def joined(raw):
    flights, weather, places = raw
    return plan.join_weather(plan.prepare_flights(flights, places), plan.prepare_observations(weather, places)).cache()


def test_departure_is_in_utc(raw):
    flights, _, places = raw
    first = plan.prepare_flights(flights, places).where("id = 0").first()
    clock = first["CRS_DEP_TIME"]
    expected = dt.datetime(2019, 1, 1, clock // 100, clock % 100) + dt.timedelta(hours=6)
    assert first["DEPARTURE_UTC"] == expected


def test_reports_of_other_countries_are_left_out(raw):
    _, weather, places = raw
    cities = plan.prepare_observations(weather, places).groupBy("STATION", "CLOSEST_CITY").count().collect()
    assert {(r[0], r[1]) for r in cities} == {("S1", "Chicago, IL"), ("S2", "Boston, MA")}


def test_each_flight_once_with_the_latest_report(joined):
    assert joined.count() == 900 and joined.select("id").distinct().count() == 900
    gaps = joined.where("STATION is not null")
    assert gaps.count() > 850
    assert gaps.where("FLIGHT_HOUR_DIFF < 2 or FLIGHT_HOUR_DIFF >= 3").count() == 0
    assert "AW1" not in joined.columns


def test_features_to_scores(joined):
    features = plan.add_features(joined)
    assert features.count() == 900
    for gone in ("DEP_DELAY", "WEATHER_DELAY", "WND", "TMP", "ORIGIN_CITY_NAME", "FL_DATE"):
        assert gone not in features.columns
    assert features.schema["TMP1"].dataType.simpleString() == "double"
    assert features.where("abs(TMP1) = 9999").count() == 0
    literal = plan.add_features(joined, sentinels="fill")
    assert literal.where("TMP1 = 9999").count() > 0
    first_day = features.agg(F.min("DEPARTURE_DAY")).first()[0]
    assert features.where((F.col("DEPARTURE_DAY") == first_day) & F.col("PRIOR_DAY_NUM_DELAY").isNotNull()).count() == 0

    train, test = plan.split_and_label(features)
    assert train.agg(F.max("DEPARTURE_UTC")).first()[0] <= test.agg(F.min("DEPARTURE_UTC")).first()[0]
    assert train.where("DEP_DEL15 is null or (CANCELLED = 1 and DEP_DEL15 <> 1)").count() == 0

    cleaning = plan.fit_cleaning(train, keep=["id"])
    assert "DEP_DEL15" not in cleaning.correlated + cleaning.sparse + cleaning.uninformative
    assert "OP_CARRIER" not in cleaning.uninformative
    a, b = plan.apply_cleaning(train, cleaning), plan.apply_cleaning(test, cleaning)
    assert a.columns == b.columns
    va, vb = plan.to_vectors(a, b, keep=["id"])
    assert {"id", "DEPARTURE_UTC", "features", "label"} <= set(va.columns)
    baseline = evaluate.accuracy(plan.numeric_baseline(a, b, keep=["id"])).first()
    assert baseline["n"] == b.count() and baseline["accuracy"] > 0.5
    more = plan.oversample(va, "id")
    late = va.where("label = 1").count()
    assert more.where("synthetic > 0 and label = 1").count() == 2 * late
    assert more.where("synthetic = 0").count() == va.count()
    shares = plan.explained_by_components(va, "id", 2, fraction=0.5)
    assert 0 < shares.agg(F.sum("explained")).first()[0] <= 1 + 1e-9
    scores = plan.score_models(va, vb, "id", names=("svm",)).collect()
    assert len(scores) == 1 and 0 <= scores[0]["area_under_pr"] <= 1


def test_small_reports(raw, joined):
    flights, _, _ = raw
    shares = flights.withColumns({c: F.lit(0.0) for c in ("SECURITY_DELAY", "NAS_DELAY", "LATE_AIRCRAFT_DELAY")})
    causes = {r["cause"]: r["share"] for r in plan.delay_causes(shares).collect()}
    assert sum(causes.values()) == pytest.approx(1.0) and causes["weather"] < 0.2
    assert sum(r["value"] for r in plan.flights_per_state(joined).collect()) == joined.where("DEP_DEL15 is not null").count()


def test_run_reads_the_raw_tables_a_few_times(spark, raw, tmp_path, monkeypatch):
    flights, weather, places = raw
    paths = {}
    for name, table in (("flights", flights), ("weather", weather), ("places", places)):
        paths[name] = str(tmp_path / name)
        table.coalesce(1).write.parquet(paths[name])
    scans = {name: 0 for name in paths}
    written = []
    from backglance.sources import tables

    def counted(df, path, *args, _stage=tables.stage, **options):
        plan_text = df._jdf.queryExecution().executedPlan().toString()
        for name in paths:
            scans[name] += plan_text.count(f"{paths[name]}]")
        written.append(path.removeprefix("file:"))
        return _stage(df, path, *args, **options)

    monkeypatch.setattr(tables, "stage", counted)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # plans then name the files they scan in full
    lines = plan.run(*[spark.read.parquet(paths[n]) for n in ("flights", "weather", "places")], key="id", names=("svm",)).collect()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert [r["model"] for r in lines] == ["logistic", "svm"]
    for r in lines:
        n = r["true_late"] + r["false_late"] + r["true_early"] + r["false_early"]
        assert n == pytest.approx(180, abs=10) and r["accuracy"] == pytest.approx((r["true_late"] + r["true_early"]) / n)
    assert 1 <= scans["weather"] <= 4 and 1 <= scans["flights"] <= 3
    scratch = [p for p in written if "scratch-" in p]
    assert len(scratch) >= 9 and not any(os.path.exists(p) for p in scratch)


def test_cancellation_reasons(spark):
    rows = spark.createDataFrame([(1.0, "A"), (1.0, "A"), (1.0, "B"), (0.0, None)], "CANCELLED double, CANCELLATION_CODE string")
    assert sorted(r["share"] for r in plan.cancellation_reasons(rows).collect()) == pytest.approx([1 / 3, 2 / 3])


def test_a_misspelt_column_to_drop_is_an_error(spark):
    rows = spark.createDataFrame([(1, 2, 3)], "fl_date int, DEP_DELAY int, x int")
    assert plan.drop_known(rows, ["FL_DATE", "DEP_DELAY", "TAXI_IN"], ["TAXI_IN"]).columns == ["x"]
    with pytest.raises(ValueError, match="DEP_DELLAY"):
        plan.drop_known(rows, ["FL_DATE", "DEP_DELLAY"], ["TAXI_IN"])
    assert set(fixed.MAY_BE_ABSENT) == {*fixed.AFTER_DEPARTURE, *fixed.REPEATED} - {"FL_DATE", "CRS_DEP_TIME"}
