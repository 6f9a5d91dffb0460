from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import forecasting as fc
from tidemark.operators import models, sequences, series
from tidemark.operators.quantiles import approximate_percentiles, percentiles


def daily(spark, values, key="s"):
    start = date(2024, 1, 1)
    data = [(key, start + timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "k string, ds date, v double")


def smoothed(df, column):
    return [r.x for r in df.select("ds", column.alias("x")).orderBy("ds").collect()]


def test_ewm_small(spark):
    out = smoothed(daily(spark, [1.0, 2.0, 3.0]), series.ewm_mean(F.col("v"), series.by_day(["k"]), 3))
    assert out[:2] == [None, None] and out[2] == pytest.approx(2.428571, abs=1e-6)


def test_smoothing_equals_pandas(spark):
    rnd = random.Random(5)
    values = [None if rnd.random() < 0.1 else rnd.uniform(-10, 10) for _ in range(300)]
    df, window = daily(spark, values), series.by_day(["k"])
    p = pd.Series(values, dtype=float)
    for ours, theirs in [
        (series.ewm_mean(F.col("v"), window, 7), p.ewm(span=7, min_periods=7).mean()),
        (series.rolling_mean(F.col("v"), window, 15), p.rolling(15).mean()),
        (series.rolling_mean(F.col("v"), window, 7, partial=True), p.rolling(7, min_periods=1).mean()),
    ]:
        got = np.array([np.nan if x is None else x for x in smoothed(df, ours)])
        np.testing.assert_allclose(got, theirs.to_numpy(), atol=1e-9)


def test_gaussian(spark):
    out = smoothed(daily(spark, [0.0, 0.0, 1.0]), series.gaussian_rolling_mean(F.col("v"), series.by_day(["k"]), 3))
    assert out[:2] == [None, None] and out[2] == pytest.approx(0.274069, abs=1e-6)


def test_daily_sequence_of_the_latest_month(spark):
    data = [("u", datetime(2024, 1, 31, 8), 5.0), ("u", datetime(2024, 2, 1, 9), 2.0), ("u", datetime(2024, 2, 1, 10), 3.0),
            ("u", datetime(2024, 2, 29, 1), 1.0)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v double")
    row = sequences.daily_sequences(df, ["k"], "ts", "v").first()
    assert row.month == date(2024, 2, 1) and len(row.amounts) == 29
    assert row.amounts[0] == 5.0 and row.amounts[28] == 1.0 and sum(row.amounts) == 6.0


def test_categories_are_matched_by_name(spark):
    data = [("u", datetime(2024, 2, 1), 1.0, "Swipe"), ("u", datetime(2024, 2, 2), 2.0, "Chip"), ("u", datetime(2024, 2, 2), 4.0, "Other")]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v double, c string")
    out = sequences.daily_sequences_by_category(df, ["k"], "ts", "v", "c", ["Online", "Chip", "Swipe"])
    got = {r.category: r.amounts for r in out.collect()}
    assert set(got) == {"Online", "Chip", "Swipe", "Total"} and {len(a) for a in got.values()} == {31}
    assert sum(got["Online"]) == 0 and got["Chip"][1] == 2.0 and got["Swipe"][0] == 1.0
    assert got["Total"][:2] == [1.0, 6.0]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False).map(lambda x: round(x, 2)), min_size=1, max_size=60))
def test_percentiles_equal_numpy(spark, values):
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0)], "k string, v double")
    wanted = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {r.k: r.percentiles for r in percentiles(df, "v", wanted, ["k"]).collect()}
    np.testing.assert_allclose(got["a"], np.percentile(values, [100 * p for p in wanted]), rtol=1e-12, atol=1e-9)
    assert got["b"] == [1.0] * 5


def test_percentiles_with_a_hot_value(spark):
    values = [3.0] * 500 + [float(i) for i in range(100)] + [-5.0, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = percentiles(df, "v", [0.05, 0.5, 0.95]).first()["percentiles"]
    np.testing.assert_allclose(got, np.percentile(values, [5, 50, 95]))


def test_approximate_percentiles_are_near(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    for r in approximate_percentiles(df, "v", [0.25, 0.5], ["k"]).collect():
        np.testing.assert_allclose(r.percentiles, [250, 500], atol=3)


def test_working_days(spark):
    days = spark.createDataFrame([(date(2024, 1, 5),), (date(2024, 1, 6),), (date(2024, 1, 8),)], "d date")
    holidays = spark.createDataFrame([(date(2024, 1, 8),)], "holiday date")
    assert rows(series.working_days(days, "d", holidays), "working") == [(0,), (0,), (1,)]


def test_chronological_split(spark):
    out = series.chronological_split(daily(spark, [1.0] * 9), ["k"], "ds")
    assert out.where("part = 'train'").count() == 7  # int(9 * 0.8)


def signal(days):
    t = np.arange(days)
    return 20 + 0.05 * t + 3 * np.sin(2 * np.pi * (t + 3) / 7)


def test_forecast_of_a_known_signal(spark):
    y = signal(300)
    frame = daily(spark, [float(v) for v in y]).select(
        "k", "ds", F.when(F.col("ds") < F.lit("2024-09-01").cast("date"), F.col("v")).alias("y"), "v",
        (F.col("ds") < F.lit("2024-09-01").cast("date")).alias("is_train"),
    )
    model = fc.ForecastModel(keys=("k",), seasons=(fc.WEEKLY,), changepoint_prior_scale=0.05)
    out = fc.forecast(frame, model)
    worst = out.where("not is_train").agg(F.max(F.abs(F.col("v") - F.col("yhat")))).first()[0]
    assert worst < 0.5
    gap = out.agg(F.max(F.abs(F.col("yhat") - fc.total_of_parts(out)))).first()[0]
    assert gap < 1e-9
    assert out.where("yhat_lower > yhat or yhat_upper < yhat").count() == 0


def test_forecast_uses_events_and_regressors(spark):
    values = [10.0 + (5.0 if i % 30 == 0 else 0.0) + 2.0 * (i % 4) for i in range(240)]
    frame = daily(spark, values).select(
        "k", "ds", F.col("v").alias("y"), F.lit(True).alias("is_train"), (F.date_diff("ds", F.lit("2024-01-01").cast("date")) % 4).alias("reg")
    )
    is_event = F.date_diff("ds", F.lit("2024-01-01").cast("date")) % 30 == 0
    events = series.event_table(frame.select("ds"), "ds", is_event, "spike", -1, 0)
    model = fc.ForecastModel(keys=("k",), growth="flat", seasons=(), events=(("spike", -1, 0),), regressors=("reg",))
    out = fc.forecast(frame, model, events)
    assert out.agg(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0] < 0.05
    with pytest.raises(ValueError):
        fc.forecast(frame, model)


def test_cutoffs(spark):
    points = fc.cutoffs(daily(spark, [1.0] * 300), ["k"])
    last = date(2024, 1, 1) + timedelta(days=299)
    expected = [last - timedelta(days=30 + 30 * i) for i in range(4)]
    assert sorted(r.cutoff for r in points.collect()) == sorted(d for d in expected if d >= date(2024, 1, 1) + timedelta(days=180))
    assert fc.cutoffs(daily(spark, [1.0] * 100), ["k"]).count() == 0


def test_drift_rules(spark):
    def judged(history):
        df = spark.createDataFrame(history, "version string, runtime int, r2 double, rmse double")
        return models.drift_flags(df).first()

    worse = judged([("v", 1, 0.95, 100.0), ("v", 2, 0.90, 100.0)])
    assert (worse.retrain, worse.message, worse.ref_r2) == (1, "Need retrain", 0.95)
    same = judged([("v", 1, 0.9, 100.0), ("v", 2, 0.9, 120.0)])
    assert (same.retrain, same.message) == (0, "No need retrain")


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("t", models.is_train(["id"]))
    again = spark.range(1000).repartition(7).withColumn("t", models.is_train(["id"]))
    assert rows(df) == rows(again)
    assert 700 < df.where("t").count() < 900
