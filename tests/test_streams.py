"""Stream jobs whose result must not depend on how rows fall into batches, and stored models."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import models
from tidemark.streaming import jobs

START = datetime(2024, 1, 1)


def land(spark, path, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(path))


def run(spark, stream, tmp_path, name):
    jobs.finish(jobs.append_stream(stream, str(tmp_path / name), str(tmp_path / f"{name}-c")), 240)
    return spark.read.schema(stream.schema).parquet(str(tmp_path / name))


def test_hourly_scores_with_one_file_per_trigger_and_with_all_at_once(spark, tmp_path):
    rng = random.Random(2)
    schema = "id long, ts timestamp_ntz, v string, p double"
    made = [(i, START + timedelta(minutes=11 * i), "ab"[i % 2], rng.uniform(0, 9)) for i in range(120)]
    actual = [(i, ts + timedelta(minutes=rng.randrange(0, 59)), p + rng.uniform(-1, 1)) for i, ts, _, p in made]
    actual += [(3, made[3][1] + timedelta(hours=2), 100.0), (500, START, 1.0)]  # too late, and without a prediction
    for at in range(0, 120, 30):
        land(spark, tmp_path / "p", made[at : at + 30], schema)
    actual.sort(key=lambda r: r[1])
    for at in range(0, 122, 40):
        land(spark, tmp_path / "a", actual[at : at + 40], "id long, at timestamp_ntz, y double")

    def scores(name, files):
        streams = [
            jobs.message_files(spark, str(tmp_path / x), spark.read.parquet(str(tmp_path / x)).schema, files) for x in "pa"
        ]
        joined = jobs.with_actuals(*streams, "id", "ts", "at")
        return rows(run(spark, jobs.hourly_scores(joined, "v", "y", "p"), tmp_path, name))

    together, single = scores("together", None), scores("single", 1)
    assert len(together) > 20 and [r[:2] + r[4:] for r in single] == [r[:2] + r[4:] for r in together]
    for one, two in zip(single, together):
        assert one[2:4] == pytest.approx(two[2:4], abs=1e-9)
    known = {i: y for i, at, y in actual if i < 120 and at <= made[i][1] + timedelta(hours=1)}
    hour = [(p, known[i]) for i, ts, v, p in made if v == "a" and ts < START + timedelta(hours=1)]
    mean = sum(y for _, y in hour) / len(hour)
    r2 = 1 - sum((y - p) ** 2 for p, y in hour) / sum((y - mean) ** 2 for _, y in hour)
    first = next(r for r in together if r[0] == START and r[1] == "a")
    assert first[2] == pytest.approx(r2) and first[4] == len(hour)


def test_repeats_over_batches_and_after_their_time(spark, tmp_path):
    at = START + timedelta(hours=1)
    batches = [
        [(1, at, "k"), (2, at + timedelta(minutes=5), "k"), (3, at - timedelta(minutes=5), "k"), (4, at, None), (5, at, None), (6, None, "k")],
        [(7, at - timedelta(minutes=30), "k"), (8, at, "new")],
        [(9, at + timedelta(days=3), "other")],
        [(10, at + timedelta(days=6), "other")],
        [(11, at + timedelta(days=6), "k"), (12, at + timedelta(days=6), "k")],
    ]
    for data in batches:
        land(spark, tmp_path / "in", data, "id long, ts timestamp_ntz, k string")
    stream = jobs.message_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, 1)
    found = run(spark, jobs.repeats(stream, "ts", "id", ["k"]), tmp_path, "out")
    early = at - timedelta(minutes=5)
    assert rows(found, "k", "id", "first_id", "first_ts") == rows(
        spark.createDataFrame(
            [("k", 1, 3, early), ("k", 2, 3, early), (None, 5, 4, at), ("k", 7, 3, early), ("k", 12, 11, at + timedelta(days=6))],
            "k string, id long, first_id long, first_ts timestamp_ntz",
        )
    )


def test_a_new_model_takes_over_at_a_batch_border(spark, tmp_path):
    stored, out = str(tmp_path / "models"), str(tmp_path / "out")
    rng = random.Random(4)
    data = [(float(i), 2.0 * i + rng.random()) for i in range(50)]
    train = spark.createDataFrame(data, "x double, y double")
    jobs.publish_model(models.train_regressor(train, ["x"], "y", "linear"), stored, 1)

    def arrive():
        stream = jobs.message_files(spark, str(tmp_path / "in"), train.schema, 1)
        jobs.finish(jobs.score_with_stored(stream, stored, "y", out, str(tmp_path / "c")), 240)
        return rows(spark.read.parquet(f"{out}/predictions"), "x", "version", "prediction")

    land(spark, tmp_path / "in", data[:10], train.schema)
    first = arrive()
    jobs.publish_model(models.train_regressor(train.withColumn("y", -F.col("y")), ["x"], "y", "linear"), stored, 2)
    land(spark, tmp_path / "in", data[10:20], train.schema)
    both = arrive()
    assert {r[1] for r in first} == {1} and sorted(r[1] for r in both) == [1] * 10 + [2] * 10
    assert [r for r in both if r[1] == 1] == first and all(r[2] < 0 for r in both if r[1] == 2)
    # a batch that is run again keeps its model, whatever was published since
    jobs.score_batch(spark.createDataFrame(data[:10], train.schema), 0, stored, "y", out)
    assert rows(spark.read.parquet(f"{out}/predictions"), "x", "version", "prediction") == both
    assert rows(spark.read.parquet(f"{out}/metrics"), "version", "observations") == [(1, 10), (2, 10)]
