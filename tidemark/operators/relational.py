"""Filters, joins, totals and set operations beyond a single DataFrame call."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quantiles import percentiles


def flag(condition: Column) -> Column:
    """Condition as 0/1; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def row_min(df: DataFrame, prefix: str) -> Column:
    """Smallest non-null value over the columns whose name starts with ``prefix``."""
    return F.least(*[F.col(c) for c in df.columns if c.startswith(prefix)])


def different_sources(left: Column, right: Column, prefix_a: str, prefix_b: str) -> Column:
    """True when the two names start with different source prefixes, in any letter case."""
    a, b = prefix_a.upper(), prefix_b.upper()
    up_left, up_right = F.upper(left), F.upper(right)
    return F.coalesce(
        (up_left.startswith(a) & up_right.startswith(b))
        | (up_left.startswith(b) & up_right.startswith(a)),
        F.lit(False),
    )


def keep_listed(df: DataFrame, listed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``listed``; null keys never match."""
    return df.join(listed.select(*on), list(on), "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``listed``; null keys are kept."""
    return df.join(listed.select(*on), list(on), "left_anti")


def left_join_matching(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, right_filter: Column
) -> DataFrame:
    """Left join that takes only right rows passing ``right_filter`` and keeps every left row."""
    return left.join(right.where(right_filter), left[left_key] == right[right_key], "left").drop(
        right[right_key]
    )


def merge_statuses(base: DataFrame, others: dict[str, DataFrame], key: str) -> DataFrame:
    """Left join status frames (``key``, ``status``) onto ``base``; a missing status passes as 1.

    Every frame is first reduced to its lowest status per key, so no row of ``base`` multiplies.
    """
    out = base
    for name, frame in others.items():
        lowest = frame.groupBy(key).agg(F.min("status").alias(f"status_{name}"))
        out = out.join(lowest, key, "left")
    return out.na.fill(1, [f"status_{name}" for name in others])


def reconcile_counts(
    current: DataFrame, previous: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Full outer join of two snapshots on their keys, one row per key with both row counts.

    Each side is counted per key before the join: repeated keys are shuffled once and cannot
    multiply with each other.
    """
    cur = current.groupBy(*keys).agg(F.count("*").alias("cur_cnt"))
    prev = previous.groupBy(*keys).agg(F.count("*").alias("prev_cnt"))
    state = (
        F.when(F.col("cur_cnt").isNull(), "missing")
        .when(F.col("prev_cnt").isNull(), "new")
        .otherwise("kept")
    )
    return cur.join(prev, list(keys), "full").withColumn("state", state)


def share_of_total(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sum per group and its share of the grand total."""
    groups = df.groupBy(*keys).agg(F.sum(value).alias("total"))
    grand = groups.agg(F.sum("total")).scalar()
    return groups.withColumn("share", F.try_divide(F.col("total"), grand))


def pivot_sum(
    df: DataFrame, rows: str, columns: str, value: str, column_values: Sequence[str]
) -> DataFrame:
    """One line per ``rows`` value, one column per named ``columns`` value, 0 where empty."""
    wide = df.groupBy(rows).pivot(columns, list(column_values)).agg(F.sum(value))
    return wide.na.fill(0.0, list(column_values))


def crosstab_totals(df: DataFrame, rows: str, columns: str, value: str) -> DataFrame:
    """Sums by cell, row, column and overall, total lines labelled ``Total``.

    Rows are summed to cells first, so that only cells are expanded to the four levels.
    ``level`` tells cells (0), row totals (1), column totals (2) and the grand total (3) apart,
    so that a data value called "Total" cannot be taken for a total line.
    """
    total = F.lit("Total")
    cells = df.groupBy(rows, columns).agg(F.sum(value).alias("cell"))
    return (
        cells.cube(rows, columns)
        .agg(F.sum("cell").alias("amount"), F.grouping_id().cast("int").alias("level"))
        .withColumn(rows, F.when(F.col("level") >= 2, total).otherwise(F.col(rows)))
        .withColumn(columns, F.when(F.col("level") % 2 == 1, total).otherwise(F.col(columns)))
    )


def totals_agree(crosstab: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Check of a crosstab: row totals, column totals and the grand total must be equal."""

    def at(level: int) -> Column:
        return F.sum(F.when(F.col("level") == level, F.col("amount")))

    sums = crosstab.agg(
        at(1).alias("row_total"), at(2).alias("column_total"), at(3).alias("grand_total")
    )
    scale = F.greatest(F.abs("grand_total"), F.lit(1.0)) * tolerance
    return sums.withColumn(
        "agree",
        (F.abs(F.col("row_total") - F.col("grand_total")) <= scale)
        & (F.abs(F.col("column_total") - F.col("grand_total")) <= scale),
    )


def describe_long(df: DataFrame, columns: Sequence[str], quartiles: bool = True) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles, one line per column."""
    stacked = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
                    for c in columns
                ]
            )
        ).alias("s")
    ).select("s.*")
    summary = stacked.groupBy("column_name").agg(
        F.count("v").alias("cnt"),
        F.avg("v").alias("mean"),
        F.stddev("v").alias("stddev"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    if not quartiles:
        return summary
    points = percentiles(stacked, "v", [0.25, 0.5, 0.75], ["column_name"])
    names = ["p25", "p50", "p75"]
    return summary.join(
        points.select("column_name", *[F.col("percentiles")[i].alias(n) for i, n in enumerate(names)]),
        "column_name",
        "left",
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value, null included."""
    return df.groupBy(column).agg(F.count("*").alias("cnt"))


def value_counts_multi(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency of each label in each of several columns, one column of counts per column."""
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("source"), F.col(c).cast("string").alias("label"))
                    for c in columns
                ]
            )
        ).alias("s")
    ).select("s.*")
    return long.groupBy("label").pivot("source", list(columns)).count().na.fill(0, list(columns))


def row_counts(frames: dict[str, DataFrame], fallback: dict[str, Column] | None = None) -> DataFrame:
    """Row count of each table; a table that cannot be analysed falls back to a filtered count.

    ``frames`` maps names to functions of no argument as well as to frames, so that a missing
    table shows up here as a null count and not as an error.
    """
    parts: list[DataFrame] = []
    missing: list[str] = []
    spark = None
    for name, source in frames.items():
        try:
            frame = source() if callable(source) else source
            if fallback and name in fallback:
                frame = frame.where(fallback[name])
        except Exception:
            missing.append(name)
            continue
        spark = frame.sparkSession
        parts.append(frame.agg(F.count("*").alias("cnt")).select(F.lit(name).alias("table_name"), "cnt"))
    if spark is None:
        raise ValueError("no table could be read")
    out = reduce(DataFrame.unionByName, parts)
    if missing:
        out = out.unionByName(
            spark.createDataFrame([(m, None) for m in missing], "table_name string, cnt long")
        )
    return out


def remaining(required: DataFrame, completed: DataFrame, key: str) -> DataFrame:
    """Distinct required names without a completed (status 1) entry."""
    done = completed.where(F.col("status") == 1).select(key)
    return required.select(key).distinct().join(done, key, "left_anti")


def best_status(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Highest status seen for each key over all frames."""
    stacked = reduce(lambda a, b: a.unionByName(b), [f.select(key, "status") for f in frames])
    return stacked.groupBy(key).agg(F.max("status").alias("status"))


def rows_before_first_failure(df: DataFrame, order: str, ok: Column) -> DataFrame:
    """Rows up to and including the first failing one in ``order``; later ones are not run.

    The position of the first failure is one aggregate over the table, not a running window
    over a single ordered partition.
    """
    first_bad = df.where(~F.coalesce(ok, F.lit(False))).agg(F.min(order)).scalar()
    outcome = F.when(F.coalesce(ok, F.lit(False)), F.lit("done")).otherwise(F.lit("stopped"))
    return df.where(first_bad.isNull() | (F.col(order) <= first_bad)).withColumn("outcome", outcome)


def readiness_class(status: Column, exported: Column) -> Column:
    """completed when exported, else eligible or pending by status; null counts as 0."""
    return (
        F.when(F.coalesce(exported, F.lit(0)) == 1, "completed")
        .when(F.coalesce(status, F.lit(0)) == 1, "eligible")
        .otherwise("pending")
    )
