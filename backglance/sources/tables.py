"""Parquet tables, stages between steps, and the counts that audit them."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backglance.session import ensure_checkpoint_dir


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: load_table(spark, folder, name) for name in names}


def stage(
    df: DataFrame, path: str, partition_by: Iterable[str] = (), mode: str = "errorifexists", group_rows: int | None = None
) -> DataFrame:
    """Write a step as Parquet and go on from the files.

    Cuts the lineage; partition columns give later steps partition pruning.  The rebalance
    hint gathers each partition value into few files and splits a hot value over tasks.
    ``group_rows`` is the most rows of a row group, for rows of megabytes: a group is held as a whole while
    it is written, and lists of up to 4,096 rows of it at once while it is read.
    """
    partition_by = list(partition_by)
    writer = df.hint("rebalance", *partition_by) if partition_by else df
    groups = {"parquet.block.row.count.limit": group_rows} if group_rows else {}
    writer.write.mode(mode).partitionBy(*partition_by).options(**groups).parquet(path)
    return df.sparkSession.read.parquet(path)


def _pins(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/pinned-{spark.sparkContext.applicationId}"


def pin(df: DataFrame, group_rows: int | None = None) -> DataFrame:
    """The same rows from files in the shared checkpoint folder.

    For rows that several later jobs must see unchanged even when executors are lost.
    Unlike a checkpointed RDD the files keep column pruning.  Results read them lazily, so
    they stay until ``clear_pins``, to be called once all results of a session are written.
    """
    return stage(df, f"{_pins(df.sparkSession)}/{uuid.uuid4().hex}", group_rows=group_rows)


def clear_pins(spark: SparkSession) -> None:
    """Delete what ``pin`` wrote in this application."""
    _delete(spark, _pins(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder in whatever store it lies in."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Stages in a folder of their own under the shared checkpoint folder, deleted at the end."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
        self._stages = 0

    def stage(self, df: DataFrame, partition_by: Iterable[str] = ()) -> DataFrame:
        self._stages += 1
        return stage(df, f"{self.folder}/{self._stages:03d}", partition_by)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        _delete(self._spark, self.folder)


def audit_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """One row per step with its row count, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("step"), "n_rows")
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)
