"""Sessions that arrive after later ones of their vehicle were paired.

Such a session splits a stored pair in two and changes the averages after it. Its vehicle is
calculated again from its first session, in the same job as everyone's new sessions, and the
days on which its rows differ are replaced. What is to be replaced is written to a folder
beside the snapshots first and counts from the moment that its last part is complete: a run that is
stopped after that is finished by the next one, a run stopped before has changed nothing.

A snapshot older than a retraction has stale averages of those vehicles. Which they are is
kept per run date, so that a run that starts from an older snapshot calculates them again too.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import incremental
from ..sources import folders
from ..sources.tables import append_new, result_day

DAY = "sample_date"


def _pending(snapshots: str) -> str:
    return f"{snapshots.rstrip('/')}.pending"


def _retracted(snapshots: str) -> str:
    return f"{snapshots.rstrip('/')}.retracted"


def vehicles_again(sessions: DataFrame, last: DataFrame, stored: DataFrame, order, snapshots: str, since) -> DataFrame:
    """Vehicles (vin) to calculate again: with late sessions, or retracted after the snapshot of date `since`.

    `sessions` are those among which late ones are looked for.
    """
    found = incremental.late_vehicles(sessions, last, stored, order)
    spark, path = sessions.sparkSession, _retracted(snapshots)
    if folders.exists(spark, path):
        before = spark.read.parquet(path)
        if since is not None:
            before = before.where(F.col("run") > F.lit(since))
        found = found.union(before.select("vin")).distinct()
    return found


def plan(rows: DataFrame, snapshot: DataFrame, stored: DataFrame, again: DataFrame, run: str, mode: str, snapshots: str) -> None:
    """Write down what a run with the vehicles `again` replaces and adds.

    Every session that was a front stays one, so no day is left without rows.
    """
    rows = result_day(rows)
    mine, was = rows.join(again, "vin", "left_semi").select(rows.columns), None
    if stored is not None:
        was = stored.join(again, "vin", "left_semi").select(rows.columns)
        differing = mine.exceptAll(was).select(DAY).union(was.exceptAll(mine).select(DAY)).distinct()
        # dates of the calendar: as few as the folders of the table
        days = [r[0] for r in differing.collect()]
        others = stored.where(F.col(DAY).isin(days)).join(again, "vin", "left_anti").select(rows.columns)
        mine = mine.where(F.col(DAY).isin(days)).union(others)
    folder = _pending(snapshots)
    mine.write.parquet(f"{folder}/days")
    rows.drop(DAY).write.parquet(f"{folder}/rows")
    again.withColumn("run", F.lit(run).cast("date")).write.parquet(f"{folder}/vehicles")
    # last, since it vouches for the others
    (snapshot.withColumn("run", F.lit(run).cast("date")).withColumn("mode", F.lit(mode))
     .write.parquet(f"{folder}/snapshot"))


def finish(spark: SparkSession, output: str, snapshots: str, since=None) -> None:
    """Carry out what is written down, if it is complete; every step may be repeated."""
    folder = _pending(snapshots)
    if not folders.exists(spark, folder):
        return
    if folders.exists(spark, f"{folder}/snapshot/_SUCCESS"):
        replace = lambda df, path, by: (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                                        .partitionBy(by).parquet(path))
        replace(spark.read.parquet(f"{folder}/days").hint("rebalance", DAY), output, DAY)
        append_new(spark.read.parquet(f"{folder}/rows"), output, spark.read.parquet(output), since)
        replace(spark.read.parquet(f"{folder}/vehicles"), _retracted(snapshots), "run")
        replace(spark.read.parquet(f"{folder}/snapshot"), snapshots, "run")
    folders.remove(spark, folder)
