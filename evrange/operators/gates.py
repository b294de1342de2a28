"""May the job run? Answers come as one-row tables or booleans; the caller decides."""

from pyspark.sql import DataFrame, functions as F

CHARGING = 4  # fixed value: task type of the charging statistics
DONE = 1      # fixed value: status of a finished task


def completion(task_info: DataFrame, run_date: str, force: bool = False) -> DataFrame:
    """One row (finished, ready) for the day before `run_date` (yyyy-mm-dd)."""
    wanted = F.date_format(F.date_sub(F.lit(run_date).cast("date"), 1), "yyyyMMdd")
    finished = task_info.where((F.col("data_time") == wanted)
                               & F.col("data_type").isin(CHARGING)
                               & (F.col("doris_status") == DONE))
    return finished.agg(F.count("*").alias("finished")).select(
        "finished", (F.lit(force) | (F.col("finished") > 0)).alias("ready"))


def ready(task_info: DataFrame, run_date: str, force: bool = False) -> bool:
    return force or completion(task_info, run_date).first()["ready"]


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()
