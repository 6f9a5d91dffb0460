"""Daily series: calendars, smoothing windows, splits, events and error measures.

Window operators expect one row per series and day. Aggregate raw rows to days first
(``daily_series``); the longest partition is then the number of days, however many raw rows
one series holds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_series(df: DataFrame, ts: str, keys: Sequence[str], **measures: Column) -> DataFrame:
    """One row per series and day (column ``ds``) with the given aggregates."""
    day = F.to_date(ts).alias("ds")
    return df.groupBy(*keys, day).agg(*[m.alias(name) for name, m in measures.items()])


def working_days(days: DataFrame, day: str, holidays: DataFrame) -> DataFrame:
    """``working`` = 1 for days that are neither weekend nor in ``holidays`` (column ``holiday``)."""
    listed = holidays.select(F.col("holiday").alias(day)).distinct().withColumn("is_holiday", F.lit(True))
    joined = days.join(listed, day, "left")
    working = ~F.dayofweek(day).isin(1, 7) & F.col("is_holiday").isNull()
    return joined.withColumn("working", working.cast("int")).drop("is_holiday")


def calendar_fill(
    daily: DataFrame, keys: Sequence[str], day: str, values: Sequence[str]
) -> DataFrame:
    """Every day between a key's first and last day, 0 where the key has no row; nulls in rows stay."""
    span = daily.groupBy(*keys).agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    days = span.select(*keys, F.explode(F.sequence("lo", "hi")).alias(day))
    found = days.join(daily.withColumn("_known", F.lit(True)), [*keys, day], "left")
    filled = {v: F.when(F.col("_known").isNull(), F.lit(0)).otherwise(F.col(v)).alias(v) for v in values}
    return found.select(*[filled.get(c, c) for c in found.columns if c != "_known"])


def make_future(daily: DataFrame, keys: Sequence[str], day: str, periods: int) -> DataFrame:
    """All days from a series' first day to ``periods`` days after its last one."""
    span = daily.groupBy(*keys).agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return span.select(
        *keys, F.explode(F.sequence("lo", F.date_add("hi", periods))).alias(day), "hi"
    ).select(*keys, day, (F.col(day) > F.col("hi")).cast("int").alias("is_future"))


# ---- windows -----------------------------------------------------------------------------


def by_day(keys: Sequence[str], day: str = "ds"):
    return Window.partitionBy(*keys).orderBy(day)


def crossed_below(value: Column, window, limit: float) -> Column:
    """1 when the previous value was at least ``limit`` and this one is below it, else 0."""
    crossed = (F.lag(value, 1).over(window) >= limit) & (value < limit)
    return F.coalesce(crossed, F.lit(False)).cast("int")


def rolling_mean(value: Column, window, size: int, partial: bool = False) -> Column:
    """Mean of the last ``size`` rows; without ``partial`` null until all of them have a value."""
    frame = window.rowsBetween(1 - size, 0)
    mean = F.avg(value).over(frame)
    return mean if partial else F.when(F.count(value).over(frame) == size, mean)


def gaussian_weights(size: int, sigma: float = 1.0) -> list[float]:
    middle = (size - 1) / 2
    return [math.exp(-0.5 * ((i - middle) / sigma) ** 2) for i in range(size)]


def gaussian_rolling_mean(value: Column, window, size: int, sigma: float = 1.0) -> Column:
    """Gaussian-weighted mean of the last ``size`` rows, null until the window is full."""
    weights = gaussian_weights(size, sigma)
    total = sum(weights)
    terms = [F.lag(value, size - 1 - i).over(window) * (w / total) for i, w in enumerate(weights)]
    out = terms[0]
    for term in terms[1:]:
        out = out + term
    return out


def ewm_reach(span: int) -> int:
    """Rows after which a weight of the exponential mean is below 1e-16."""
    return math.ceil(math.log(1e-16) / math.log(1 - 2 / (span + 1)))


def ewm_mean(value: Column, window, span: int) -> Column:
    """Exponentially weighted mean with decay 1 - 2/(span+1), null before ``span`` values.

    Weights sum to one at every row. A missing value adds nothing, but the older ones still
    decay past it. The frame is bounded at the row where weights vanish in double precision.
    """
    decay = 1 - 2 / (span + 1)
    frame = window.rowsBetween(-ewm_reach(span), 0)
    seen = F.collect_list(F.struct(value.cast("double").alias("v"))).over(frame)
    start = F.struct(F.lit(0.0).alias("num"), F.lit(0.0).alias("den"))

    def step(acc: Column, item: Column) -> Column:
        v = item.getField("v")
        return F.struct(
            (acc.getField("num") * decay + F.coalesce(v, F.lit(0.0))).alias("num"),
            (acc.getField("den") * decay + F.when(v.isNull(), 0.0).otherwise(1.0)).alias("den"),
        )

    mean = F.aggregate(seen, start, step, lambda acc: F.try_divide(acc.getField("num"), acc.getField("den")))
    enough = F.count(value).over(window.rowsBetween(Window.unboundedPreceding, 0)) >= span
    return F.when(enough, mean)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of each key by ``order``, as a partial aggregate instead of a sorted window."""
    rest = [c for c in df.columns if c not in {*keys, *order}]
    last = F.max(F.struct(*order, *rest)).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, "last.*")


def latest_month_rows(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows that fall into their key's latest month (column ``month``).

    The latest month is a partial aggregate joined back, so that a key with very many rows is
    split by the skew join and not sorted in one window partition.
    """
    dated = df.withColumn("month", F.trunc(ts, "MM"))
    latest = dated.groupBy(*keys).agg(F.max("month").alias("month"))
    return dated.join(latest, [*keys, "month"], "left_semi")


def latest_month_summary(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """Sum and row count of each key's latest month.

    Months are aggregated first; picking the latest then works on one row per key and month.
    """
    monthly = df.groupBy(*keys, F.trunc(ts, "MM").alias("month")).agg(
        F.sum(value).alias("amount"), F.count("*").alias("cnt")
    )
    return latest_per_key(monthly, keys, ["month"])


def chronological_split(daily: DataFrame, keys: Sequence[str], day: str, share: float = 0.8) -> DataFrame:
    """``part`` = train for the first ``int(n * share)`` days of each series, else test."""
    window = by_day(keys, day)
    n = F.count("*").over(Window.partitionBy(*keys))
    train = F.row_number().over(window) <= F.floor(n * share)
    return daily.withColumn("part", F.when(train, "train").otherwise("test"))


def running_best(df: DataFrame, keys: Sequence[str], order: str, high: str, low: str) -> DataFrame:
    """Best value so far: running maximum of ``high`` and minimum of ``low``."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(f"max_{high}", F.max(high).over(frame)).withColumn(f"min_{low}", F.min(low).over(frame))


def first_gap(df: DataFrame, column: str, start: int | None = None) -> DataFrame:
    """Smallest missing integer at or above the smallest positive value (or ``start``).

    The gap follows the smallest value that has no successor: an anti join of the distinct
    values with themselves, which stays distributed where an ordered window would not.
    """
    low = F.col("v") > 0 if start is None else F.col("v") >= start
    values = df.select(F.col(column).cast("long").alias("v")).where(low).distinct()
    before = values.select((F.col("v") - 1).alias("v"))
    after_run = values.join(before, "v", "left_anti").agg((F.min("v") + 1).alias("gap"))
    if start is None:
        return after_run
    has_start = values.where(F.col("v") == start).agg(F.count("*")).scalar()
    return after_run.select(F.when(has_start > 0, F.col("gap")).otherwise(F.lit(start).cast("long")).alias("gap"))


# ---- events and errors -------------------------------------------------------------------


def event_table(days: DataFrame, day: str, is_event: Column, name: str, lower: int, upper: int) -> DataFrame:
    """Event days with every offset of their window: (event, day, offset)."""
    offsets = F.explode(F.sequence(F.lit(lower), F.lit(upper))).alias("offset")
    hits = days.where(is_event).select(F.lit(name).alias("event"), F.col(day).alias("event_day"), offsets)
    return hits.select("event", F.date_add("event_day", F.col("offset")).alias(day), "offset")


def regression_metrics(df: DataFrame, keys: Sequence[str], actual: Column, predicted: Column) -> DataFrame:
    """observations, mse, rmse, r2 in one pass; pairs with a missing side are left out.

    The spread of the actual values comes from the mergeable population variance, which stays
    accurate where a difference of raw moments would cancel.
    """
    pairs = df.select(*keys, actual.cast("double").alias("y"), predicted.cast("double").alias("p"))
    error = F.col("y") - F.col("p")
    sums = pairs.where(F.col("y").isNotNull() & F.col("p").isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("observations"),
        F.avg(error * error).alias("mse"),
        F.var_pop("y").alias("spread"),
    )
    return sums.select(
        *keys,
        "observations",
        "mse",
        F.sqrt("mse").alias("rmse"),
        (1 - F.try_divide("mse", "spread")).alias("r2"),
    )


def forecast_metrics(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """RMSE, MAE, MSE and MAPE in long form (metric, value); rows without an actual are left out.

    MAPE, in percent, leaves out actual values of 0.
    """
    error = F.col(actual) - F.col(predicted)
    known = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    wide = known.groupBy(*keys).agg(
        F.avg(error * error).alias("MSE"),
        F.avg(F.abs(error)).alias("MAE"),
        (F.avg(F.abs(F.try_divide(error, F.col(actual)))) * 100).alias("MAPE"),
    ).withColumn("RMSE", F.sqrt("MSE"))
    names = ["RMSE", "MAE", "MSE", "MAPE"]
    if keys:
        return wide.unpivot(list(keys), names, "metric", "value")
    return wide.unpivot([], names, "metric", "value")
