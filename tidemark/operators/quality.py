"""Data-quality checks on tables and daily snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import on_days


def null_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of null values per column, in one pass."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return shares.unpivot([], list(columns), "column_name", "null_share")


def temporal_consistency(
    df: DataFrame, keys: Sequence[str], ts: str, low: float, high: float
) -> DataFrame:
    """Rows per day against the day before; status 0 when the ratio leaves [low, high]."""
    daily = df.groupBy(*keys, F.to_date(ts).alias("ds")).agg(F.count("*").alias("cnt"))
    previous = F.lag("cnt", 1).over(Window.partitionBy(*keys).orderBy("ds"))
    ratio = F.try_divide("cnt", "prev_cnt")
    inside = F.coalesce(F.col("ratio").between(low, high), F.lit(True))
    return (
        daily.withColumn("prev_cnt", previous)
        .withColumn("ratio", ratio)
        .withColumn("status", inside.cast("int"))
    )


def range_violations(df: DataFrame, rules: Mapping[str, tuple[str, float, float]]) -> DataFrame:
    """Values outside their allowed range: rule name -> (column, lowest, highest)."""
    bad = [
        F.count_if(~F.col(column).between(low, high)).alias(name)
        for name, (column, low, high) in rules.items()
    ]
    counted = df.agg(F.count("*").alias("checked"), *bad)
    return counted.unpivot(["checked"], list(rules), "rule", "violations")


def snapshot_availability(
    df: DataFrame,
    table_name: str,
    ts: str,
    expected: Sequence[str],
    skip: Column | None = None,
    until: Column | None = None,
) -> DataFrame:
    """Status 1 for every expected table and day with rows, else 0.

    Expected tables are a short list of names; days run from the first one seen to the day
    ``until``, or to the last one seen. With ``until`` that day is judged even if no table has a
    row on it, or any row at all.
    ``skip`` (over ``source_table`` and ``day``) leaves out table-days that need no snapshot.
    """
    day = F.to_date(ts).alias("day")
    counts = df.groupBy(F.col(table_name).alias("source_table"), day).agg(F.count("*").alias("cnt"))
    lo, hi = F.min("day"), F.max("day")
    if until is not None:
        lo, hi = F.least(F.coalesce(lo, until), until), until
    span = counts.agg(lo.alias("lo"), hi.alias("hi"))
    names = F.explode(F.array(*[F.lit(n) for n in expected])).alias("source_table")
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day")).select("day", names)
    if skip is not None:
        days = days.where(~skip)
    found = days.join(counts, ["source_table", "day"], "left").na.fill(0, ["cnt"])
    return found.withColumn("status", (F.col("cnt") > 0).cast("int"))


def lowest_status(df: DataFrame) -> DataFrame:
    """The single overall status: 0 as soon as one table fails."""
    return df.agg(F.min("status").alias("status"))


def snapshot_growth(
    df: DataFrame, table_name: str, ts: str, key: Column, reporting_day: Column | None = None
) -> DataFrame:
    """Compare each day's keys with the day before, per table.

    The counts equal those of a full outer join of both days on the key: a key held a times
    today and b times yesterday counts a * max(b, 1) for ``id`` and b * max(a, 1) for
    ``prev_id``. The join itself is not run. Rows are counted per (table, day, key) first,
    each count serves its own day and the next, and one more aggregate adds them up, so
    repeated keys never multiply rows. ``dup_cnt`` counts today's surplus rows before joining.
    """
    name = F.col(table_name).alias("source_table")
    day = F.to_date(ts)
    wanted = df
    if reporting_day is not None:
        wanted = df.where(on_days(F.col(ts), F.date_sub(reporting_day, 1), reporting_day))
    rows = wanted.select(name, day.alias("d"), key.cast("string").alias("k"))
    counted = rows.where(F.col("k").isNotNull()).groupBy("source_table", "d", "k").agg(F.count("*").alias("n"))
    sides = counted.select(
        "source_table",
        "k",
        F.explode(
            F.array(
                F.struct(F.col("d").alias("day"), F.col("n").alias("cur"), F.lit(0).cast("long").alias("prev")),
                F.struct(F.date_add("d", 1).alias("day"), F.lit(0).cast("long").alias("cur"), F.col("n").alias("prev")),
            )
        ).alias("s"),
    ).select("source_table", "k", "s.*")
    per_key = sides.groupBy("source_table", "day", "k").agg(F.sum("cur").alias("cur"), F.sum("prev").alias("prev"))
    one = F.lit(1).cast("long")
    cur, prev = F.col("cur"), F.col("prev")
    per_day = per_key.groupBy("source_table", "day").agg(
        F.sum(cur * F.greatest(prev, one)).alias("id"),
        F.count_if(cur > 0).alias("unique_id"),
        F.sum(prev * F.greatest(cur, one)).alias("prev_id"),
        F.sum(F.when(cur == 0, prev).otherwise(F.lit(0))).alias("missing_id"),
        F.sum(F.greatest(cur - 1, F.lit(0).cast("long"))).alias("dup_cnt"),
    )
    if reporting_day is not None:
        return per_day.where(F.col("day") == reporting_day)
    return per_day.where(F.col("day") <= df.agg(F.max(day)).scalar())


def snapshot_status(growth: DataFrame, tolerances: Mapping[str, float] | None = None) -> DataFrame:
    """Judge ``snapshot_growth``: status 1 when rows did not shrink, with three flags beside it.

    ``tolerances`` gives tables that may shrink to that share of yesterday's rows.
    """
    tolerance = F.lit(1.0)
    for name, share in (tolerances or {}).items():
        tolerance = F.when(F.col("source_table") == name, F.lit(float(share))).otherwise(tolerance)
    grown = F.col("id") >= F.col("prev_id") * tolerance
    return growth.select(
        "source_table",
        "day",
        (F.col("id") != F.col("unique_id")).cast("int").alias("duplicate_flag"),
        (F.col("missing_id") > 0).cast("int").alias("missing_flag"),
        (~grown).cast("int").alias("no_increase_flag"),
        grown.cast("int").alias("status"),
    )
