import pytest
from pyspark.sql import functions as F

from backglance.session import ensure_checkpoint_dir
from backglance.sources.tables import audit_counts, load_tables, pin, stage


def test_tables_are_read_by_name(spark):
    tables = load_tables(spark, "/root/testdata/sf0.001", ["region", "nation"])
    assert tables["region"].count() == 5 and tables["nation"].count() == 25


def test_stage_round_trip_prunes_and_does_not_overwrite(spark, tmp_path):
    rows = spark.range(1000).withColumn("day", F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 5))
    path = str(tmp_path / "stage")
    staged = stage(rows, path, partition_by=["day"])
    assert staged.exceptAll(rows.select(*staged.columns)).count() == 0 and staged.count() == 1000
    plan = staged.where("day = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    with pytest.raises(Exception, match="(?i)exists"):
        stage(rows, path)


def test_pinned_rows_do_not_change(spark):
    pinned = pin(spark.range(100).withColumn("x", F.rand()))
    assert pinned.collect() == pinned.collect()
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)


def test_audit_counts(spark):
    found = audit_counts({"all": spark.range(10), "some": spark.range(10).where("id > 6"), "none": spark.range(0)})
    assert dict(found.collect()) == {"all": 10, "some": 3, "none": 0}


def test_pins_and_scratch_folders_go(spark):
    import os

    from backglance.sources import tables

    kept = tables.pin(spark.range(5))
    folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file:").replace("///", "/"))
    assert kept.count() == 5 and os.path.isdir(folder)
    tables.clear_pins(spark)
    assert not os.path.exists(folder)
    with tables.Scratch(spark) as scratch:
        place = scratch.folder.removeprefix("file:")
        assert scratch.stage(spark.range(3)).count() == 3 and os.path.isdir(place)
    assert not os.path.exists(place)
