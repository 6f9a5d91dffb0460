"""Additive forecasts of many daily series: trend with change points, seasons, events, regressors.

The design matrix, predictions, components and intervals are column expressions. Only the
ridge solution of each series runs in Python, on that series' daily rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import by_day, forecast_metrics, rolling_mean


@dataclass(frozen=True)
class Season:
    name: str
    period: float
    order: int


# fixed values: default seasons of a daily series
YEARLY = Season("yearly", 365.25, 10)
WEEKLY = Season("weekly", 7.0, 3)


@dataclass(frozen=True)
class ForecastModel:
    """Settings of the additive model; larger prior scales let a part bend more."""

    keys: tuple[str, ...]
    growth: str = "linear"
    changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_prior_scale: float = 0.05
    seasons: tuple[Season, ...] = (YEARLY, WEEKLY)
    seasonality_prior_scale: float = 10.0
    events: tuple[tuple[str, int, int], ...] = ()  # (event, lower offset, upper offset)
    holidays_prior_scale: float = 10.0
    regressors: tuple[str, ...] = ()
    interval_width: float = 0.8

    def blocks(self) -> list[tuple[str, int, float]]:
        """(component, columns, ridge penalty) in the order of the design array."""
        free, season = 1e-8, 1 / self.seasonality_prior_scale**2
        out = [("trend", 1 if self.growth == "flat" else 2, free)]
        if self.growth != "flat" and self.changepoints:
            out.append(("trend_changes", self.changepoints, 1 / self.changepoint_prior_scale**2 / 100))
        out += [(s.name, 2 * s.order, season) for s in self.seasons]
        if self.events:
            width = sum(upper - lower + 1 for _, lower, upper in self.events)
            out.append(("events", width, 1 / self.holidays_prior_scale**2))
        if self.regressors:
            out.append(("regressors", len(self.regressors), season))
        return out


def _event_key(event: Column, offset: Column) -> Column:
    return F.concat_ws("@", event, offset.cast("string"))


def design(frame: DataFrame, model: ForecastModel, events: DataFrame | None = None) -> DataFrame:
    """Add the design array ``x`` and the scale of each series.

    ``frame`` has the keys, ``ds``, ``y`` (null where unknown), ``is_train`` and the regressor
    columns. ``events`` is an event table (event, ds, offset).
    """
    keys = list(model.keys)
    train = F.col("is_train") & F.col("y").isNotNull()
    span = frame.where(train).groupBy(*keys).agg(
        F.min("ds").alias("lo"), F.max("ds").alias("hi"), F.greatest(F.max(F.abs("y")), F.lit(1e-9)).alias("scale")
    )
    rows = frame.join(span, keys)
    if model.events:
        if events is None:
            raise ValueError("the model names events but no event table was given")
        per_day = events.groupBy("ds").agg(F.collect_set(_event_key(F.col("event"), F.col("offset"))).alias("event_keys"))
        rows = rows.join(per_day, "ds", "left")
    t = F.try_divide(F.date_diff("ds", "lo"), F.greatest(F.date_diff("hi", "lo"), F.lit(1)))
    columns = [F.lit(1.0)] + ([] if model.growth == "flat" else [t])
    if model.growth != "flat":
        for c in range(1, model.changepoints + 1):
            at = model.changepoint_range * c / model.changepoints
            columns.append(F.greatest(t - at, F.lit(0.0)))
    day = F.unix_date("ds").cast("double")
    for season in model.seasons:
        for n in range(1, season.order + 1):
            angle = day * (2 * math.pi * n / season.period)
            columns += [F.sin(angle), F.cos(angle)]
    for event, lower, upper in model.events:
        for offset in range(lower, upper + 1):
            hit = F.array_contains("event_keys", f"{event}@{offset}")
            columns.append(F.coalesce(hit, F.lit(False)).cast("double"))
    columns += [F.coalesce(F.col(r).cast("double"), F.lit(0.0)) for r in model.regressors]
    return rows.withColumn("x", F.array(*columns))


def fit(designed: DataFrame, model: ForecastModel) -> DataFrame:
    """(keys, beta): ridge coefficients of each series from its training rows."""
    keys = list(model.keys)
    penalty = np.concatenate([np.full(n, p) for _, n, p in model.blocks()])
    names = [*keys, "beta"]

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = np.stack(rows["x"].to_list()), rows["y"].to_numpy(dtype=float)
        beta = np.linalg.solve(x.T @ x + np.diag(penalty), x.T @ y)
        first = rows.iloc[0]
        return pd.DataFrame([[*(first[k] for k in keys), beta.tolist()]], columns=names)

    train = designed.where(F.col("is_train") & F.col("y").isNotNull())
    scaled = train.select(*keys, "x", (F.col("y") / F.col("scale")).alias("y"))
    kinds = {f.name: f.dataType.simpleString() for f in scaled.schema}
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", beta array<double>"
    return scaled.groupBy(*keys).applyInPandas(solve, schema)


def _dot(x: Column, beta: Column) -> Column:
    return F.aggregate(F.zip_with(x, beta, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def forecast(frame: DataFrame, model: ForecastModel, events: DataFrame | None = None) -> DataFrame:
    """Frame rows with yhat, yhat_lower, yhat_upper and one column per model component.

    The interval adds the quantiles of each series' training residuals.
    """
    keys = list(model.keys)
    designed = design(frame, model, events)
    fitted = designed.join(fit(designed, model), keys).withColumn("yhat", _dot(F.col("x"), F.col("beta")) * F.col("scale"))
    tail = (1 - model.interval_width) / 2
    residual = F.col("y") - F.col("yhat")
    train = fitted.where(F.col("is_train") & F.col("y").isNotNull())
    spread = train.groupBy(*keys).agg(
        F.percentile(residual, F.array(F.lit(tail), F.lit(1 - tail))).alias("residual_range")
    )
    start, parts = 1, []
    for name, size, _ in model.blocks():
        part = _dot(F.slice("x", start, size), F.slice("beta", start, size)) * F.col("scale")
        parts.append(part.alias(f"part_{name}"))
        start += size
    return fitted.join(spread, keys).select(
        *frame.columns,
        "yhat",
        (F.col("yhat") + F.col("residual_range")[0]).alias("yhat_lower"),
        (F.col("yhat") + F.col("residual_range")[1]).alias("yhat_upper"),
        *parts,
    )


def window_backtest(
    daily: DataFrame, keys: Sequence[str], value: str, windows: Sequence[int], share: float = 0.8, **settings
) -> DataFrame:
    """Forecast errors on the test rows of every series for each smoothing window, in one job."""
    order = by_day(keys)
    smooth = daily.select(
        *keys, "ds", *[rolling_mean(F.col(value), order, n).alias(str(n)) for n in windows]
    ).unpivot([*keys, "ds"], [str(n) for n in windows], "window_days", "y")
    known = smooth.where(F.col("y").isNotNull())
    series = [*keys, "window_days"]
    ranks = by_day(series)
    total = F.count("*").over(Window.partitionBy(*series))
    frame = known.withColumn("is_train", F.row_number().over(ranks) <= F.floor(total * share))
    result = forecast(frame, ForecastModel(keys=tuple(series), **settings))
    return forecast_metrics(result.where(~F.col("is_train")), series, "y", "yhat")


def cutoffs(daily: DataFrame, keys: Sequence[str], initial: int = 180, period: int = 30, horizon: int = 30) -> DataFrame:
    """(keys, cutoff): back from the last possible cutoff in steps, keeping ``initial`` days before."""
    span = daily.groupBy(*keys).agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    room = F.floor((F.date_diff("hi", "lo") - horizon - initial) / period).cast("int")
    steps = F.when(room >= 0, F.sequence(F.lit(0), room))
    return span.select(*keys, F.explode(steps).alias("step"), "hi").select(
        *keys, F.date_sub("hi", F.col("step") * period + horizon).alias("cutoff")
    )


def rolling_origin(
    daily: DataFrame, keys: Sequence[str], value: str, initial: int = 180, period: int = 30, horizon: int = 30, **settings
) -> DataFrame:
    """Errors by horizon day of forecasts made at every cutoff with the rows up to it."""
    points = cutoffs(daily, keys, initial, period, horizon)
    listed = points.groupBy(*keys).agg(F.collect_list("cutoff").alias("all_cutoffs"))
    usable = F.filter("all_cutoffs", lambda c: F.col("ds") <= F.date_add(c, horizon))
    rows = daily.join(listed, list(keys)).select(*keys, "ds", F.col(value).alias("y"), F.explode(usable).alias("cutoff"))
    frame = rows.withColumn("is_train", F.col("ds") <= F.col("cutoff"))
    result = forecast(frame, ForecastModel(keys=(*keys, "cutoff"), **settings))
    tested = result.where(~F.col("is_train")).withColumn("horizon", F.date_diff("ds", "cutoff"))
    return forecast_metrics(tested, ["horizon"], "y", "yhat")


def total_of_parts(forecasted: DataFrame) -> Column:
    """Sum of all component columns; equals yhat."""
    return reduce(lambda a, b: a + b, [F.col(c) for c in forecasted.columns if c.startswith("part_")])
