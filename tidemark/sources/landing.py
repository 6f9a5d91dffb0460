"""Incremental landing: upsert, daily append, watermarks, state and audit tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the source's rows put in or replacing those of the same key.

    The target is kept by an anti join and never sorted; a key repeated in the source is an
    update of itself and its largest row wins.
    """
    rest = [c for c in source.columns if c not in keys]
    latest = source.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("r")).select(*keys, "r.*")
    kept = target.join(latest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


def rows_of_new_days(target: DataFrame, incoming: DataFrame, day: str) -> DataFrame:
    """Incoming rows whose day is not in the target yet; dates are compared as dates."""
    seen = target.select(F.to_date(day).alias("_seen")).distinct()
    return incoming.join(seen, F.to_date(incoming[day]) == seen["_seen"], "left_anti")


def rows_after_watermark(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], day: str, start: Column
) -> DataFrame:
    """Incoming rows newer than the last day loaded for the same key, else from ``start`` on.

    Each key has its own watermark, so loading one does not hide the others' backlog.
    """
    marks = target.groupBy(*keys).agg(F.max(day).alias("_mark"))
    joined = incoming.join(marks, list(keys), "left")
    newer = F.when(F.col("_mark").isNotNull(), F.col(day) > F.col("_mark")).otherwise(F.col(day) >= start)
    return joined.where(newer).drop("_mark")


def recent_training_rows(df: DataFrame, batch: Column, ts: str, now: Column, hours: int = 2) -> DataFrame:
    """Rows of one batch from the last ``hours`` before ``now``."""
    return df.where(batch & (F.col(ts) >= now - F.make_interval(hours=F.lit(hours))) & (F.col(ts) <= now))


def replace_table(df: DataFrame, name: str) -> None:
    """Drop and create a catalog table with the rows of ``df``."""
    df.write.mode("overwrite").saveAsTable(name)


def audit_rows(df: DataFrame, job: str, message: Column, at: Column) -> DataFrame:
    """Log rows (job, message, logged_at) for the rows of ``df``."""
    return df.select(F.lit(job).alias("job"), message.alias("message"), at.alias("logged_at"))


def save_state(df: DataFrame, path: str, run_date: str) -> None:
    """Write the state of one run date, replacing that date only."""
    dated = df.withColumn("run_date", F.lit(run_date).cast("date"))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def load_state(spark: SparkSession, path: str, run_date: str, new: DataFrame) -> DataFrame:
    """State saved for ``run_date``, or ``new`` when there is none."""
    try:
        saved = spark.read.parquet(path).where(F.col("run_date") == F.lit(run_date).cast("date"))
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return new
    return new if saved.isEmpty() else saved.select(*new.columns)
