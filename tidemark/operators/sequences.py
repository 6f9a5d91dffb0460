"""Calendar-filled daily sequences of each key's latest month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import pad_right

TOTAL = "Total"
MONTH_SLOTS = 31


def _latest_month_daily(
    df: DataFrame, keys: Sequence[str], extra: Sequence[str], ts: str, value: str
) -> DataFrame:
    """Daily sums of each key's latest month: (keys, extra, month, day, amount).

    Rows are summed per key and day before anything is gathered by key, so a window partition
    holds at most one row per day and extra column, however many raw rows a key has.
    """
    dated = df.select(*keys, *extra, F.to_date(ts).alias("ds"), F.col(value).alias("amount"))
    known = dated.where(F.col("ds").isNotNull())
    daily = known.groupBy(*keys, *extra, "ds").agg(F.sum("amount").alias("amount"))
    latest = F.max(F.trunc("ds", "MM")).over(Window.partitionBy(*keys))
    recent = daily.withColumn("month", latest).where(F.trunc("ds", "MM") == F.col("month"))
    return recent.select(*keys, *extra, "month", F.dayofmonth("ds").alias("day"), "amount")


def _fill_days(entries: Column, month: Column, amount: str = "amount") -> Column:
    """Array with one slot per day of ``month`` from (day, amount) entries."""
    by_day = F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e.getField("day"), e.getField(amount)))
    )
    days = F.sequence(F.lit(1), F.dayofmonth(F.last_day(month)))
    return F.transform(days, lambda d: F.coalesce(F.try_element_at(by_day, d), F.lit(0.0)))


def daily_sequences(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """(keys, month, amounts): one array per key, one slot per day of its latest month."""
    recent = _latest_month_daily(df, keys, [], ts, value)
    gathered = recent.groupBy(*keys, "month").agg(F.collect_list(F.struct("day", "amount")).alias("entries"))
    return gathered.select(*keys, "month", _fill_days(F.col("entries"), F.col("month")).alias("amounts"))


def category_names(df: DataFrame, category: str, most: int = 1000) -> list[str]:
    """The different names of a category column in order; more than ``most`` are an error, since each is an array of every key."""
    found = df.where(F.col(category).isNotNull()).select(category).distinct().orderBy(category).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} categories in {category}")
    return [r[0] for r in found]


def daily_sequences_by_category(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, category: str, names: Sequence[str]
) -> DataFrame:
    """(keys, month, category, amounts): a 31-slot array for each named category and the total.

    Categories are matched by name. A category that is not named counts in the total only; a
    named one without rows gets zeros.
    """
    named = df.withColumn("category", F.when(F.col(category).isin(list(names)), F.col(category)))
    recent = _latest_month_daily(named, keys, ["category"], ts, value)
    entry = F.struct("category", "day", "amount")
    gathered = recent.groupBy(*keys, "month").agg(F.collect_list(entry).alias("entries"))
    zero = F.array_repeat(F.lit(0.0), MONTH_SLOTS)

    def one(name: str) -> Column:
        mine = F.filter("entries", lambda e: e.getField("category").eqNullSafe(F.lit(name)))
        return pad_right(_fill_days(mine, F.col("month")), MONTH_SLOTS)

    def total() -> Column:
        def add(acc: Column, e: Column) -> Column:
            return F.transform(
                acc, lambda x, i: F.when(i == e.getField("day") - 1, x + e.getField("amount")).otherwise(x)
            )

        return F.aggregate("entries", zero, add)

    arrays = [F.struct(F.lit(n).alias("category"), one(n).alias("amounts")) for n in names]
    arrays.append(F.struct(F.lit(TOTAL).alias("category"), total().alias("amounts")))
    return gathered.select(*keys, "month", F.explode(F.array(*arrays)).alias("s")).select(*keys, "month", "s.*")


def melt_sequences(sequences: DataFrame, amounts: str = "amounts") -> DataFrame:
    """Long form: one row per slot with its day number."""
    rest = [c for c in sequences.columns if c != amounts]
    long = sequences.select(*rest, F.posexplode(amounts).alias("pos", "amount"))
    return long.withColumn("day", F.col("pos") + 1).drop("pos")


def attach_labels(sequences: DataFrame, labels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add cluster labels by key; sequences without a label are kept."""
    return sequences.join(labels, list(keys), "left")


def label_table(labels: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per key with a column ``label_<name>`` from each clustering."""
    out: DataFrame | None = None
    for name, frame in labels.items():
        part = frame.select(*keys, F.col("label").alias(f"label_{name}"))
        out = part if out is None else out.join(part, list(keys), "full")
    if out is None:
        raise ValueError("no labels given")
    return out


def cluster_profile(long: DataFrame, label: str = "label") -> DataFrame:
    """Mean amount per label and day with its central 50 percent interval."""
    half_width = 0.6744897501960817  # fixed value: upper quartile of the standard normal
    stats = long.groupBy(label, "day").agg(
        F.avg("amount").alias("mean"), F.stddev("amount").alias("sd"), F.count("*").alias("cnt")
    )
    margin = F.coalesce("sd", F.lit(0.0)) * half_width / F.sqrt(F.col("cnt"))
    return stats.withColumn("low", F.col("mean") - margin).withColumn("high", F.col("mean") + margin)
