"""Stream jobs: scoring with stored models, metrics of late actual values, drift alerts, duplicate keys.

Sinks are idempotent: every micro-batch writes a folder of its own, named by the batch id and
overwritten when the batch is run again after a failure. Checkpoints go to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tidemark.operators.models import batch_metrics, best_and_latest, judge_each, merge_best, score

# fixed values: how late rows may come and the length of a monitoring window
LATE = "2 hours"
HOUR = "1 hour"


def message_files(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Landed Parquet messages as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def message_bus(spark: SparkSession, options: Mapping[str, str], schema: str) -> DataFrame:
    """JSON messages of a Kafka topic as typed rows, with key and arrival time."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("timestamp").alias("arrived_at"),
        F.from_json(F.col("value").cast("string"), schema).alias("m"),
    ).select("message_key", "arrived_at", "m.*")


def finish(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for a run over the available data; a run that does not end in time is an error."""
    if not query.awaitTermination(timeout) and timeout is not None:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout} s")


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``handle`` on all available data, batch by batch."""
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the stream's rows to a Parquet folder, exactly once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _batch_folder(path: str, name: str, batch: int) -> str:
    return f"{path}/{name}/batch={batch}"


def score_stream(
    messages: DataFrame, scorer: Callable[[DataFrame], DataFrame], actual: str, version: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Score each batch; write its predictions and one metrics row under ``path``."""

    def handle(batch: DataFrame, number: int) -> None:
        predictions = _batch_folder(path, "predictions", number)
        scorer(batch).write.mode("overwrite").parquet(predictions)
        written = batch.sparkSession.read.parquet(predictions)
        metrics = batch_metrics(written, [], actual).withColumn("version", F.lit(version))
        metrics.write.mode("overwrite").parquet(_batch_folder(path, "metrics", number))

    return run_batches(messages, handle, checkpoint)


# ---- stored models -----------------------------------------------------------------------

CHOSEN = "batch long, version long"


def publish_model(model: PipelineModel, path: str, version: int) -> None:
    """Save a model under its version, then list it, so that streams see whole models only."""
    model.write().overwrite().save(f"{path}/model={version}")
    listed = SparkSession.active().createDataFrame([(version,)], "version long")
    listed.write.mode("append").parquet(f"{path}/listed")


def version_of(spark: SparkSession, number: int, models: str, path: str) -> int:
    """The version that scores a batch: the highest listed when the batch is first seen, the same when it is run again."""
    spark.createDataFrame([], CHOSEN).write.mode("append").parquet(f"{path}/chosen")
    before = spark.read.schema(CHOSEN).parquet(f"{path}/chosen").where(F.col("batch") == number).first()
    if before:
        return before["version"]
    version = spark.read.schema("version long").parquet(f"{models}/listed").agg(F.max("version")).first()[0]
    spark.createDataFrame([(number, version)], CHOSEN).write.mode("append").parquet(f"{path}/chosen")
    return version


def score_batch(batch: DataFrame, number: int, models: str, actual: str, path: str) -> None:
    """Write a batch's predictions with their model version, and one metrics row."""
    spark = batch.sparkSession
    version = version_of(spark, number, models, path)
    scored = score(PipelineModel.load(f"{models}/model={version}"), batch).withColumn("version", F.lit(version).cast("long"))
    predictions = _batch_folder(path, "predictions", number)
    scored.write.mode("overwrite").parquet(predictions)
    metrics = batch_metrics(spark.read.schema(scored.schema).parquet(predictions), ["version"], actual)
    metrics.write.mode("overwrite").parquet(_batch_folder(path, "metrics", number))


def score_with_stored(messages: DataFrame, models: str, actual: str, path: str, checkpoint: str) -> StreamingQuery:
    """Score each batch with the latest model in the folder ``models``; a new one takes over at a batch border."""
    return run_batches(messages, lambda batch, number: score_batch(batch, number, models, actual, path), checkpoint)


# ---- metrics -----------------------------------------------------------------------------


def with_actuals(
    predictions: DataFrame, actuals: DataFrame, key: str, predicted_at: str, actual_at: str, within: str = HOUR, late: str = LATE
) -> DataFrame:
    """Predictions joined with the actual value that arrives for them ``within`` that time, as event_time and the columns of both.

    Both streams have a watermark, so that each side forgets a row once no partner can come any more.
    """
    left = predictions.withColumn("event_time", F.col(predicted_at).cast("timestamp")).withWatermark("event_time", late)
    right = actuals.withColumnsRenamed({key: "_key"}).withColumn("_time", F.col(actual_at).cast("timestamp")).withWatermark("_time", late)
    in_time = (F.col("_time") >= F.col("event_time")) & (F.col("_time") <= F.col("event_time") + F.expr(f"INTERVAL {within}"))
    return left.join(right, (F.col(key) == F.col("_key")) & in_time).drop("_key", "_time")


def hourly_scores(joined: DataFrame, version: str, actual: str, predicted: str) -> DataFrame:
    """(runtime, version, r2, rmse, observations) per version and hour of ``with_actuals``, once an hour is closed."""
    error = F.col(actual) - F.col(predicted)
    grouped = joined.groupBy(F.window("event_time", HOUR).alias("w"), F.col(version).alias("version"))
    sums = grouped.agg(F.avg(error * error).alias("mse"), F.var_pop(actual).alias("spread"), F.count("*").alias("observations"))
    return sums.select(
        F.col("w.start").cast("timestamp_ntz").alias("runtime"),
        "version",
        (1 - F.try_divide("mse", "spread")).alias("r2"),
        F.sqrt("mse").alias("rmse"),
        "observations",
    )


def windowed_metrics(messages: DataFrame, ts: str, version: Column, **measures: Column) -> DataFrame:
    """Measures per version and hour; rows later than two hours are dropped.

    An hour is emitted once the watermark has passed its end.
    """
    timed = messages.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", LATE)
    grouped = timed.groupBy(F.window("event_time", HOUR).alias("w"), version.alias("version"))
    out = grouped.agg(*[m.alias(n) for n, m in measures.items()])
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("runtime"), "version", *measures)


def drift_alerts(metrics_stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Judge every new metrics row against its version's best up to that row.

    All judgements are logged; only those that call for retraining are published, as JSON. The
    best values are carried from batch to batch, so a batch costs its own rows and one row per
    version, not the whole history, and how rows fall into batches does not matter.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = merge_best(best_and_latest(batch.limit(0)))
        if number > 0:
            before = spark.read.schema(before.schema).parquet(_batch_folder(path, "best", number - 1))
        state, log = _batch_folder(path, "best", number), _batch_folder(path, "log", number)
        judge_each(batch, before).write.mode("overwrite").parquet(log)
        merge_best(best_and_latest(batch).unionByName(before)).write.mode("overwrite").parquet(state)
        publish(spark.read.parquet(log), _batch_folder(path, "published", number))

    return run_batches(metrics_stream, handle, checkpoint)


def publish(flags: DataFrame, path: str) -> None:
    """Write the JSON message of every row that needs retraining."""
    message = F.to_json(F.struct(F.col("runtime").alias("event_datetime"), "version", "message", "retrain"))
    flags.where(F.col("retrain") == 1).select(message.alias("value")).write.mode("overwrite").text(path)


def first_arrivals(messages: DataFrame, ts: str, keys: Sequence[str], late: str = "1 day") -> DataFrame:
    """The first row of each key; repeats within ``late`` of it are dropped.

    State is kept per key for that long only, so a day's snapshot keys need ``late`` = one day.
    """
    timed = messages.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", late)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("event_time")


BUCKETS = 4_096  # groups of keys; a call and a state for each key would cost more than its rows


def _in_python(column: str, kind: str) -> Column:
    """A key as it can go to Python beside nulls: whole and floating-point numbers as texts, which are exact."""
    if kind in ("float", "double"):
        return (F.col(column) + F.lit(0.0)).cast("string")  # 0 and -0 are one key
    return F.col(column).cast("string") if kind in ("tinyint", "smallint", "int", "bigint") else F.col(column)


def repeats(messages: DataFrame, ts: str, id: str, keys: Sequence[str], late: timedelta = timedelta(days=1)) -> DataFrame:
    """(keys, id, ts, first_id, first_ts): every row whose key came up to ``late`` before, with the key's first arrival.

    A key's first row is kept in state until the watermark, ``late`` behind the newest row, has passed it by
    ``late``; then a timer removes it. A row that comes later than that is a first one again. Rows of one batch are taken in the order of ``ts``
    and ``id``; batches in the order they come, so that a row that is older but comes in a later batch is a repeat. Null
    times are not rows of any day and are left out. Keys are dealt by hash to ``BUCKETS`` groups, whose rows of one batch meet in a task.
    """
    names, slots = list(keys), [f"_k{n}" for n in range(len(keys))]
    types = [messages.schema[k].dataType.simpleString() for k in names]
    id_kind, ts_kind = (messages.schema[c].dataType.simpleString() for c in (id, ts))
    whole = id_kind in ("tinyint", "smallint", "int", "bigint")
    sent = [_in_python(k, kind) for k, kind in zip(names, types)]
    timed = messages.where(F.col(ts).isNotNull()).select(
        *[c.alias(s) for c, s in zip(sent, slots)],
        F.col(id).isNull().alias("_none"),
        (F.coalesce(id, F.lit(0).cast(id_kind)) if whole else F.col(id)).alias("_id"),
        F.col(ts).cast("timestamp").alias("_ts"),
    )
    timed = timed.withColumn("_bucket", F.pmod(F.xxhash64(*slots), F.lit(BUCKETS)))
    passed = {s: timed.schema[s].dataType.simpleString() for s in slots}
    span = late // timedelta(microseconds=1)

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # state: the parts of the keys, and id, lack of an id and time of each key's first row
        *parts, first_ids, first_none, first_us = state.get if state.exists else [[] for _ in range(len(slots) + 3)]
        firsts = dict(zip(zip(*parts), zip(first_ids, first_none, first_us)))
        if not state.hasTimedOut:
            rows = pd.concat(list(frames)).sort_values(["_ts", "_none", "_id"], kind="stable")
            given = [[None if pd.isna(x) else x for x in rows[s].tolist()] for s in slots]
            times = rows["_ts"].to_numpy().astype("datetime64[us]").astype("int64").tolist()
            again, found = [], []
            for at, (key, name, none, us) in enumerate(zip(zip(*given), rows["_id"].tolist(), rows["_none"].tolist(), times)):
                first = firsts.get(key)
                if first is None or us > first[2] + span:
                    firsts[key] = name, none, us
                else:
                    again.append(at)
                    found.append(first)
            if again:
                out = rows.iloc[again][[*slots, "_none", "_id", "_ts"]].reset_index(drop=True)
                out["first_none"], out["first_id"] = [f[1] for f in found], [f[0] for f in found]
                out["first_ts"] = pd.to_datetime([f[2] for f in found], unit="us")
                yield out
        passed_us = state.getCurrentWatermarkMs() * 1000
        firsts = {key: first for key, first in firsts.items() if first[2] + span >= passed_us}
        if not firsts:
            if state.exists:
                state.remove()
            return
        columns = [list(c) for c in zip(*firsts)] + [list(c) for c in zip(*firsts.values())]
        state.update(tuple(columns))
        end = (min(first[2] for first in firsts.values()) + span) // 1000
        state.setTimeoutTimestamp(max(end, state.getCurrentWatermarkMs() + 1))

    kinds = "".join(f"{s} {kind}, " for s, kind in passed.items())
    lists = "".join(f"{s} array<{kind}>, " for s, kind in passed.items())
    grouped = timed.withWatermark("_ts", f"{int(late.total_seconds())} seconds").groupBy("_bucket")
    found = grouped.applyInPandasWithState(
        step,
        f"{kinds}_none boolean, _id {id_kind}, _ts timestamp, first_none boolean, first_id {id_kind}, first_ts timestamp",
        f"{lists}first_id array<{id_kind}>, first_none array<boolean>, first_us array<long>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return found.select(
        *[F.col(s).cast(kind).alias(k) for k, s, kind in zip(names, slots, types)],
        F.when(~F.col("_none"), F.col("_id")).alias(id),
        F.col("_ts").cast(ts_kind).alias(ts),
        F.when(~F.col("first_none"), F.col("first_id")).alias("first_id"),
        F.col("first_ts").cast(ts_kind).alias("first_ts"),
    )
