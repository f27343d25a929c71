import datetime as dt

from pyspark.sql import functions as F

from backglance.functions.timeops import epoch_micros, hhmm_to_timestamp, hours_between, shift_zone, with_time_parts

DAY = dt.datetime(2019, 1, 1)


def test_clock_numbers(spark):
    given = [0, 5, 45, 930, 2359, 2400, None, 2401, 1260, -5]
    rows = spark.createDataFrame([(i, dt.date(2019, 1, 1), v) for i, v in enumerate(given)], "i int, day date, hhmm int")
    made = rows.select("i", hhmm_to_timestamp("day", "hhmm").alias("at")).orderBy("i").collect()
    minutes = [0, 5, 45, 570, 1439, 1440, None, None, None, None]
    assert [r["at"] for r in made] == [None if m is None else DAY + dt.timedelta(minutes=m) for m in minutes]


def test_clock_text_that_is_no_number_is_null(spark):
    rows = spark.createDataFrame([("0930",), ("x",), ("",)], "hhmm string").withColumn("day", F.lit("2019-01-01").cast("date"))
    made = [r[0] for r in rows.select(hhmm_to_timestamp("day", "hhmm")).collect()]
    assert made == [DAY + dt.timedelta(minutes=570), None, None]


def test_zone_shift_both_ways_and_over_clock_changes(spark):
    rows = spark.createDataFrame(
        [
            (dt.datetime(2019, 1, 1, 8), "America/Chicago"),
            (dt.datetime(2019, 3, 9, 8), "America/Chicago"),
            (dt.datetime(2019, 3, 11, 8), "America/Chicago"),
            (dt.datetime(2019, 11, 4, 8), "America/Chicago"),
            (dt.datetime(2019, 1, 1, 8), None),
        ],
        "ts timestamp_ntz, zone string",
    )
    made = rows.select("ts", shift_zone("ts", "zone").alias("utc"), "zone").collect()
    assert [r["utc"].hour if r["utc"] else None for r in made] == [14, 14, 13, 14, None]
    back = rows.withColumn("utc", shift_zone("ts", "zone")).select("ts", shift_zone("utc", "zone", to_utc=False).alias("b"))
    assert all(r["b"] in (r["ts"], None) for r in back.collect())


def test_results_do_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame(
        [(dt.datetime(2019, 3, 10, 2, 30, 15, 123456), dt.datetime(2019, 3, 10, 0, 0))], "a timestamp_ntz, b timestamp_ntz"
    )
    expected = (dt.datetime(2019, 3, 10, 2, 30, 15, 123456) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            line = rows.select(epoch_micros(rows, "a"), hours_between(rows, "a", "b")).first()
            assert line[0] == expected
            assert abs(line[1] - 2.504200960) < 1e-8
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_time_parts(spark):
    rows = spark.createDataFrame([(dt.datetime(2019, 1, 1, 23, 59),)], "ts timestamp_ntz")
    assert with_time_parts(rows, "ts").select("hour", "minute").first() == (23, 59)
