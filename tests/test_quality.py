import pytest
from pyspark.sql import functions as F

from backglance.functions.text import after_last, country_code
from backglance.operators import quality
from backglance.operators.fields import apply_sentinels, split_packed, suffix_bucket, type_parts


def test_null_shares_and_the_sparse_edge(spark):
    rows = spark.range(100).select(
        "id",
        F.lit(None).cast("string").alias("empty"),
        F.when(F.col("id") < 5, F.lit("x")).alias("edge"),
        F.when(F.col("id") < 6, F.lit("x")).alias("above"),
        F.when(F.col("id") < 50, "").otherwise("y").alias("blank"),
    )
    shares = {r[0]: r[1] for r in quality.null_fractions(quality.blank_to_null(rows)).collect()}
    assert shares == pytest.approx({"id": 0.0, "empty": 1.0, "edge": 0.95, "above": 0.94, "blank": 0.5})
    assert quality.sparse_columns(rows, 0.95) == ["empty", "edge"]
    assert quality.drop_sparse(rows, 0.95).columns == ["id", "above", "blank"]


def test_empty_table_has_no_sparse_columns(spark):
    assert quality.sparse_columns(spark.createDataFrame([], "a int, b string")) == []


def test_unknown_names_are_errors(spark):
    with pytest.raises(ValueError, match="ORIGIN_SATE"):
        quality.drop_columns(spark.range(1), ["ORIGIN_SATE"])


def test_columns_of_type_include_all_numbers(spark):
    rows = spark.createDataFrame([], "a int, b bigint, c float, d double, e decimal(5,2), f string, g date, h timestamp_ntz")
    assert quality.columns_of_type(rows, "numeric") == list("abcde")
    assert quality.columns_of_type(rows, "text") == ["f"]
    assert quality.columns_of_type(rows, "time") == ["g", "h"]


def test_null_out_keeps_types(spark):
    rows = spark.range(2).withColumn("s", F.lit("x"))
    emptied = quality.null_out(rows, ["id", "s"], F.col("id") == 0)
    assert emptied.schema.simpleString() == "struct<id:bigint,s:string>"
    assert sorted(emptied.collect(), key=str) == [(1, "x"), (None, None)]


def test_distinct_counts_exact_and_approximate(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("a"), "id")
    assert dict(quality.distinct_counts(rows).collect()) == {"a": 7, "id": 1000}
    near = dict(quality.distinct_counts(rows, approximate=True).collect())
    assert near["a"] == 7 and abs(near["id"] - 1000) < 100


def test_packed_parts(spark):
    given = [("1,2,3",), ("1",), ("",), (None,), ("1,2,3,4",)]
    rows = spark.createDataFrame(given, "w string")
    made = [tuple(r) for r in split_packed(rows, {"w": 3}).collect()]
    assert made == [("1", "2", "3"), ("1", None, None), ("", None, None), (None, None, None), ("1", "2", "3")]
    piped = spark.createDataFrame([("a|b",)], "w string")
    assert split_packed(piped, {"w": 2}, "|", keep=True).first() == ("a|b", "a", "b")


def test_sentinels(spark):
    rows = spark.createDataFrame([("9999",), ("+9999",), ("-9999",), ("-0012",), ("x",), (None,)], "t string")
    nulls = type_parts(apply_sentinels(rows, {"t": "9999"}), doubles=["t"])
    assert [r[0] for r in nulls.collect()] == [None, None, None, -12.0, None, None]
    filled = [r[0] for r in apply_sentinels(rows, {"t": "9999"}, mode="fill").collect()]
    assert filled[-1] == "9999" and filled[3] == "-0012"
    with pytest.raises(ValueError):
        apply_sentinels(rows, {"t": "9"}, mode="other")


def test_text_helpers(spark):
    rows = spark.createDataFrame([("Iron Mountain/Kingsfd, MI", "AKRON, OH  u S ", "N123AB")], "city string, name string, tail string")
    line = rows.select(after_last("city"), country_code("name")).first()
    assert line == ("Kingsfd, MI", "US")
    assert suffix_bucket(rows, "tail").first()["tail"] == "AB"
