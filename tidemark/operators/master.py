"""Corrections and lists on master data and job logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import minutes_until, on_days


def most_frequent_code(df: DataFrame, key: str, code: str) -> DataFrame:
    """(key, code, codes): the most frequent code of each key, the smallest one on a tie."""
    counts = df.where(F.col(key).isNotNull() & F.col(code).isNotNull()).groupBy(key, code).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col(code).alias("code")))
    return counts.groupBy(key).agg(best.getField("code").alias(code), F.count("*").alias("codes"))


def mode_correction(df: DataFrame, key: str, code: str) -> DataFrame:
    """Set every code of a key with two or more codes to its most frequent one.

    Only keys that need a correction are joined back. Counting is a partial aggregate, and the
    join back keeps each row once, so a hot key can be split by the skew join.
    """
    found = most_frequent_code(df, key, code).where(F.col("codes") >= 2)
    fixes = found.select(key, F.col(code).alias("right_code"))
    joined = df.join(fixes, key, "left")
    return joined.withColumn(code, F.coalesce("right_code", code)).drop("right_code")


def unresolved_jobs(
    log: DataFrame,
    running: DataFrame,
    scheduled: DataFrame,
    now: Column,
    job: str = "job_name",
    wait_minutes: int = 10,
    minute_field: bool = False,
) -> DataFrame:
    """Jobs that failed or stopped today with no later success, not running and not due later today.

    ``log`` has (job, log_date, status), ``running`` (job), ``scheduled`` (job, next_run_date).
    "Failed and not followed by a success" is the comparison of the last failure with the last
    success, one aggregate per job instead of a join of the log with itself. A job whose next
    run is today and at least ``wait_minutes`` away is left to its schedule; ``minute_field``
    compares the minute field of the waiting time instead of its total.
    """
    today = on_days(F.col("log_date"), now)
    failed = F.col("status").isin("STOPPED", "FAILED")
    succeeded = F.col("status") == "SUCCEEDED"
    last = log.where(today & (failed | succeeded)).groupBy(job).agg(
        F.max(F.when(failed, F.col("log_date"))).alias("last_failure"),
        F.max(F.when(succeeded, F.col("log_date"))).alias("last_success"),
    )
    open_jobs = last.where(
        F.col("last_failure").isNotNull()
        & (F.col("last_success").isNull() | (F.col("last_success") <= F.col("last_failure")))
    )
    wait = minutes_until(F.col("next_run_date"), now, field_only=minute_field)
    waiting = scheduled.where(
        on_days(F.col("next_run_date"), now) & (F.col("next_run_date") > now) & (wait >= wait_minutes)
    )
    return (
        open_jobs.select(job)
        .join(running.select(job), job, "left_anti")
        .join(waiting.select(job), job, "left_anti")
    )


def retry_list(unresolved: DataFrame, now: Column, delay: str = "INTERVAL 1 MINUTE") -> DataFrame:
    """Unresolved jobs with their new start time."""
    return unresolved.withColumn("start_date", now + F.expr(delay))
