"""Largest task per operator on a skewed table: ``python bench/skew.py FOLDER [ROWS] [NAME ...]``.

The table is made by Spark in FOLDER (a new scratch folder): one user and one time each hold
a third of all rows.  Numbers come from Spark's event log, written to the same folder.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from backglance.functions.timeops import time_levels  # noqa: E402
from backglance.operators import balance, evaluate, nearest, positions, splits, windows  # noqa: E402
from backglance.operators.lookback import lookback_join  # noqa: E402


def session(log: str) -> SparkSession:
    # Small partitions, so that skew handling shows at this size as it would at 256 MB.
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4m")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", f"file:{log}")
        .getOrCreate()
    )


def events_table(spark: SparkSession, rows: int) -> DataFrame:
    unit = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_000_007)) / 1_000_000_007.0
    micros = F.when(unit(3) < 1 / 3, F.lit(0)).otherwise(F.floor(unit(4) * 30 * 86400 * 1_000_000))
    start = 1_704_067_200_000_000
    return spark.range(rows, numPartitions=16).select(
        F.col("id").alias("event_id"),
        F.when(unit(1) < 1 / 3, F.lit(0)).otherwise(F.floor(unit(2) * 20_000) + 1).cast("bigint").alias("user_id"),
        F.timestamp_micros((F.lit(start) + micros).cast("bigint")).cast("timestamp_ntz").alias("ts"),
        F.when(unit(5) < 0.2, "purchase").otherwise("view").alias("event_type"),
        F.round(unit(6) * 100, 2).alias("value"),
    )


def jobs(spark: SparkSession, events: DataFrame) -> dict:
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    seen = events.where("event_type <> 'purchase'").select(
        "user_id", F.col("ts").alias("seen_at"), F.col("event_id").alias("seen_id"), F.col("value").alias("seen_value")
    )
    near = lambda key: F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.pmod(F.xxhash64(key), F.lit(4 * 3_600_000_000)))
    crowded = lambda at, key: F.when(F.col("user_id") == 0, near(key).cast("timestamp_ntz")).otherwise(F.col(at))
    hours = [*time_levels("ts"), F.date_trunc("hour", "ts")]
    daily = events.withColumn("day", F.to_date("ts"))
    scored = events.select("user_id", (F.col("value") > 80).cast("int").alias("label"), (F.col("value") / 100).alias("score"))
    hot = F.col("user_id") == 0
    sites = events.select(
        F.when(hot, 40.0).otherwise(F.col("user_id") % 1800 / 10 - 90).alias("lat"),
        F.when(hot, -75.0).otherwise(F.col("user_id") % 3600 / 10 - 180).alias("lon"),
    )
    spot = lambda seed, around: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(around)) / 10
    third = F.col("id") % 3 == 0
    places = spark.range(5000).select(
        F.col("id").cast("string").alias("city"),
        F.when(third, 40 + F.col("id") / 1e6).otherwise(spot(1, 1800) - 90).alias("place_lat"),
        F.when(third, -75 + F.col("id") / 2e6).otherwise(spot(2, 3600) - 180).alias("place_lon"),
    )
    numbers = F.array(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000.0 for i in range(8)])
    copies = F.when(third, F.array(*[F.lit(0.0)] * 8)).otherwise(numbers)
    vectors = spark.range(60_000).select("id", copies.alias("features"), F.lit(1).alias("label"))
    return {
        "lookback_join": lambda: lookback_join(
            bought, seen, ["user_id"], "ts", "seen_at", "seen_id", ["seen_value"], unique_key=True
        ),
        # All times of the hot user, each its own, lie within four hours.
        "lookback_hot_span": lambda: lookback_join(
            bought.withColumn("ts", crowded("ts", "event_id")), seen.withColumn("seen_at", crowded("seen_at", "seen_id")),
            ["user_id"], "ts", "seen_at", "seen_id", ["seen_value"], unique_key=True,
        ),
        "global_percent_rank": lambda: positions.global_percent_rank(events, ["ts"]),
        "rank_within": lambda: positions.rank_within(daily, ["day"], ["ts"]),
        "dense_index": lambda: positions.dense_index(events, ["ts", "event_id"]),
        "time_split": lambda: splits.time_split(events, ["ts"], 0.8, hours)[0],
        "blocked_folds": lambda: splits.blocked_folds(events, ["ts", "event_id"], levels=hours),
        "quantile_rows": lambda: positions.quantile_rows(events, ["value", "user_id"]),
        "top_k_per_group": lambda: windows.top_k_per_group(events, ["user_id"], [F.desc("value"), F.col("event_id")], 3),
        "group_total": lambda: windows.group_total(events, ["user_id"], "value", "total"),
        "average_precision": lambda: evaluate.average_precision(scored, "score", "label", ["user_id"]),
        "nearest_site": lambda: nearest.nearest_site(sites, places, "lat", "lon", "city", "place_lat", "place_lon"),
        "smote": lambda: balance.smote(vectors, "id"),
    }


def largest_tasks(log: str) -> dict[str, tuple[int, int, int]]:
    """Per operator: longest task in ms, and the largest share of a stage's shuffled rows one task read."""
    names: dict[int, str] = {}
    tasks: dict[int, list[tuple[int, int]]] = {}
    for path in glob.glob(f"{log}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        for line in open(path, errors="ignore"):
            event = json.loads(line) if line.startswith("{") else {}
            if event.get("Event") == "SparkListenerStageSubmitted":
                description = (event.get("Properties") or {}).get("spark.job.description")
                names[event["Stage Info"]["Stage ID"]] = description
            elif event.get("Event") == "SparkListenerTaskEnd":
                metrics = event.get("Task Metrics") or {}
                read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                tasks.setdefault(event["Stage ID"], []).append((metrics.get("Executor Run Time", 0), read))
    found: dict[str, tuple[int, int, int]] = {}
    for stage, seen in tasks.items():
        name = names.get(stage)
        if name:
            longest, most = max(t for t, _ in seen), max(r for _, r in seen)
            old = found.get(name, (0, 0, 0))
            total = sum(r for _, r in seen)
            found[name] = (max(old[0], longest), *((most, total) if most > old[1] else old[1:]))
    return found


def main() -> None:
    folder, rows, chosen = sys.argv[1], int((sys.argv + ["", "6000000"])[2] or 6_000_000), sys.argv[3:]
    log = f"{folder}/log"
    os.makedirs(log, exist_ok=True)
    spark = session(log)
    spark.sparkContext.setLogLevel("ERROR")
    events_table(spark, rows).write.parquet(f"{folder}/events.parquet")
    events = spark.read.parquet(f"{folder}/events.parquet")
    seconds = {}
    for name, make in jobs(spark, events).items():
        if chosen and name not in chosen:
            continue
        spark.sparkContext.setJobDescription(name)
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        seconds[name] = time.perf_counter() - start
    spark.stop()
    print("| operator | seconds | longest task, ms | most rows read by a task | rows of that stage |\n|---|---|---|---|---|")
    for name, (longest, most, total) in largest_tasks(log).items():
        if name in seconds:
            print(f"| {name} | {seconds[name]:.1f} | {longest:,} | {most:,} | {total:,} |")


if __name__ == "__main__":
    main()
