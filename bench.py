"""Time the headline queries; prints one JSON line.

Every query is built and run into the `noop` sink, all of them once to warm up and then each
RUNS times; the median counts. Building the plan, with the jobs that this takes, is part of the
time and also reported by itself. The derived input tables are defined once.
"""

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import date

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES, Inputs  # noqa: E402
from evrange.plans import job  # noqa: E402
from evrange.plans.run import last_sessions, sessions_to_do  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
NEW_DAY = "2024-01-30"
MEMORY = "8g"
PARTITIONS = os.environ.get("BENCH_PARTITIONS", CPUS)

HEADLINE = ["endurance_pairs", "endurance_pairs_cumulative", "backfill_pairs", "avg_state_resume",
            "avg_state_next", "session_pairs", "session_pairs_day", "history_lookup",
            "mileage_band_match", "battery_dimension", "incremental_sessions", "watermark"]


def last_day_only(t):
    """The job on one new day after 29 stored ones; what those leave behind is a table by then."""
    folder = tempfile.mkdtemp(prefix="bench-")
    sessions = t.charging_sessions
    sessions.where(F.col("sample_date") < F.lit(NEW_DAY)).transform(last_sessions).write.parquet(f"{folder}/last")
    sessions.write.partitionBy("sample_date").parquet(f"{folder}/sessions")
    stored, last = (t.spark.read.parquet(f"{folder}/{name}") for name in ("sessions", "last"))
    new_day = date.fromisoformat(NEW_DAY)

    def one_day(_):
        fresh = sessions_to_do(stored, last, new_day, late_days=1)
        return job.endurance_pairs(fresh, t.tables(), day=NEW_DAY)
    return one_day


def with_hot_vehicle(t, **options):
    """The job with a third of the sessions on one vehicle."""
    hot = F.when(F.col("id").cast("bigint") % 3 == 0, F.lit("1")).otherwise(F.col("vin"))
    return job.endurance_pairs(t.charging_sessions.withColumn("vin", hot), t.tables(), **options)


def main():
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("evrange-bench")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", MEMORY)
             .config("spark.sql.shuffle.partitions", PARTITIONS)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", os.environ.get("BENCH_CHECKPOINTS") or tempfile.mkdtemp(prefix="bench-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: QUERIES[name] for name in HEADLINE}
    inputs = Inputs(spark, SF_DIR)
    queries["last_day_only"] = last_day_only(inputs)
    queries["hot_vehicle_whole"] = with_hot_vehicle
    queries["hot_vehicle_sliced"] = lambda t: with_hot_vehicle(t, slice_rows=10_000)
    seconds, planning = {}, {}
    for query in queries.values():      # every query once before any is timed
        query(inputs).write.format("noop").mode("overwrite").save()
    for name, query in queries.items():
        times, plans = [], []
        for _ in range(RUNS):
            start = time.perf_counter()
            df = query(inputs)
            plans.append(time.perf_counter() - start)
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name], planning[name] = round(statistics.median(times), 3), round(statistics.median(plans), 3)
    pairs = QUERIES["run_summary"](inputs).first()["pairs"]
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "of_that_building_the_plan": planning, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "pairs": pairs, "pairs_per_second": round(pairs / seconds["endurance_pairs"]),
        "cpus": int(CPUS), "driver_memory": MEMORY, "shuffle_partitions": int(PARTITIONS),
        "runs": RUNS, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
