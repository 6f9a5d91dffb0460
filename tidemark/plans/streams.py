"""Stream jobs over the given event table, run to the end of the available data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import models
from tidemark.plans.registry import query
from tidemark.session import scratch, table
from tidemark.streaming import jobs


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    # a glob path serves a table that is one file as well as one that is a folder of parts
    return jobs.message_files(spark, f"{sf}/events.parquet*", schema)


def landed(spark, stream, label):
    path = scratch(spark, label)
    jobs.finish(jobs.append_stream(stream, path, scratch(spark, "checkpoint")))
    return spark.read.schema(stream.schema).parquet(path)


@query("a23_message_source", "SELECT event_id, event_type, value FROM events")
def message_source(spark, sf):
    return landed(spark, event_stream(spark, sf).select("event_id", "event_type", "value"), "messages")


SCORED = """WITH e AS (SELECT *, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events),
  m AS (SELECT 1 AS version, regr_slope(value, k) AS a, regr_intercept(value, k) AS b FROM e WHERE event_id % 3 = 0
        UNION ALL SELECT 2, regr_slope(value, k), regr_intercept(value, k) FROM e WHERE event_id % 3 <> 0),
  p AS (SELECT e.*, CAST(m.version AS BIGINT) AS version, a * k + b AS prediction FROM e JOIN m ON m.version = CASE WHEN day(ts) <= 15 THEN 1 ELSE 2 END)"""


def scored_stream(spark, sf):
    """The path of predictions and metrics of two arrivals of events; a new model is published between them."""
    events = table(spark, sf, "events").withColumn("k", F.from_json("props", "k double").getField("k"))
    events = events.select("event_id", "ts", "event_type", "value", "k")
    arrived, stored, path = scratch(spark, "arrived"), scratch(spark, "models"), scratch(spark, "scored")
    checkpoint = scratch(spark, "checkpoint")
    early, third = F.dayofmonth("ts") <= 15, F.col("event_id") % 3 == 0
    for version, (rows, training) in enumerate([(early, third), (~early, ~third)], 1):
        jobs.publish_model(models.train_regressor(events.where(training), ["k"], "value", "linear"), stored, version)
        events.where(rows).write.mode("append").parquet(arrived)
        stream = jobs.message_files(spark, arrived, events.schema)
        jobs.finish(jobs.score_with_stored(stream, stored, "value", path, checkpoint))
    return path


@query(
    "l1_stream_score",
    SCORED
    + """ SELECT version, event_type, count(*) AS cnt, round(avg(prediction), 4) AS mean_prediction,
              round(sqrt(avg((value - prediction) * (value - prediction))), 4) AS rmse FROM p GROUP BY 1, 2""",
)
def stream_score(spark, sf):
    scored = spark.read.parquet(f"{scored_stream(spark, sf)}/predictions")
    error = F.col("value") - F.col("prediction")
    return scored.groupBy("version", "event_type").agg(
        F.count("*").alias("cnt"),
        F.round(F.avg("prediction"), 4).alias("mean_prediction"),
        F.round(F.sqrt(F.avg(error * error)), 4).alias("rmse"),
    )


@query(
    "l1_stream_score_metrics",
    """WITH p AS (SELECT value AS y, CAST(json_extract(props, '$.k') AS DOUBLE) AS p FROM events)
       SELECT 'plain' AS version, round(1 - avg((y - p) * (y - p)) / var_pop(y), 8) AS r2, round(sqrt(avg((y - p) * (y - p))), 8) AS rmse, count(*) AS observations FROM p""",
)
def stream_score_metrics(spark, sf):
    path = scratch(spark, "scored")
    scorer = lambda batch: batch.select("value", F.from_json("props", "k double").getField("k").alias("prediction"))
    jobs.finish(jobs.score_stream(event_stream(spark, sf), scorer, "value", "plain", path, scratch(spark, "checkpoint")))
    metrics = spark.read.parquet(f"{path}/metrics")
    return metrics.select("version", F.round("r2", 8).alias("r2"), F.round("rmse", 8).alias("rmse"), "observations")


# actual values come 0 to 59 minutes after a prediction; both streams may be two hours late, so an
# hour is closed once the newest row of the earlier stream is three hours past its end
CLOSED = """SELECT runtime, event_type AS version, round(1 - avg(d * d) / nullif(var_pop(value), 0), 3) AS r2, round(sqrt(avg(d * d)), 4) AS rmse, count(*) AS observations
    FROM (SELECT date_trunc('hour', ts) AS runtime, event_type, value, value - (0.8 * value + 0.2 * CAST(json_extract(props, '$.k') AS DOUBLE)) AS d FROM events)
    GROUP BY 1, 2 HAVING runtime + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 3 HOUR"""


def hourly(spark, sf):
    events = event_stream(spark, sf)
    k = F.from_json("props", "k double").getField("k")
    predictions = events.select("event_id", "ts", "event_type", (F.col("value") * 0.8 + k * 0.2).alias("prediction"))
    later = F.expr("make_dt_interval(0, 0, int(event_id % 60))")
    actuals = event_stream(spark, sf).select("event_id", (F.col("ts").cast("timestamp") + later).alias("actual_at"), "value")
    joined = jobs.with_actuals(predictions, actuals, "event_id", "ts", "actual_at")
    return jobs.hourly_scores(joined, "event_type", "value", "prediction").withColumns(
        {"r2": F.round("r2", 3), "rmse": F.round("rmse", 4)}
    )


@query("l2_hourly_metrics", CLOSED)
def hourly_metrics(spark, sf):
    return landed(spark, hourly(spark, sf), "hourly")


FLAGS = f"""WITH m AS ({CLOSED}), w AS (SELECT *, max(r2) OVER v AS ref_r2, min(rmse) OVER v AS ref_rmse FROM m WINDOW v AS (PARTITION BY version ORDER BY runtime))"""


def alerts(spark, sf):
    metrics, path = scratch(spark, "hourly"), scratch(spark, "alerts")
    stream = hourly(spark, sf)
    jobs.finish(jobs.append_stream(stream, metrics, scratch(spark, "checkpoint")))
    written = jobs.message_files(spark, metrics, stream.schema)
    jobs.finish(jobs.drift_alerts(written, path, scratch(spark, "checkpoint")))
    return path


@query(
    "l3_stream_drift_alert",
    FLAGS + " SELECT version, runtime, r2, ref_r2, rmse, ref_rmse, CAST(coalesce(ref_r2 > r2 * 1.05 OR rmse > ref_rmse * 1.2, false) AS INTEGER) AS retrain FROM w",
)
def stream_drift_alert(spark, sf):
    log = spark.read.parquet(f"{alerts(spark, sf)}/log")
    return log.select("version", "runtime", "r2", "ref_r2", "rmse", "ref_rmse", "retrain")


@query(
    "a24_conditional_publish",
    FLAGS + " SELECT version, 'Need retrain' AS message FROM w WHERE (ref_r2 > r2 * 1.05 OR rmse > ref_rmse * 1.2)",
)
def conditional_publish(spark, sf):
    published = spark.read.text(f"{alerts(spark, sf)}/published")
    parsed = F.from_json("value", "version string, message string")
    return published.select(parsed.alias("m")).select("m.version", "m.message")


@query("l4_stream_dedup_snapshot", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def stream_dedup_snapshot(spark, sf):
    keys = ["user_id", "event_type", "day"]
    snapshot = event_stream(spark, sf).withColumn("day", F.to_date("ts"))
    return landed(spark, jobs.first_arrivals(snapshot, "ts", keys).select(*keys), "dedup")


@query(
    "l4_stream_repeats",
    """SELECT event_id, user_id, event_type, day, ts, first_id, first_ts FROM (
         SELECT *, CAST(ts AS DATE) AS day, first_value(event_id) OVER w AS first_id, first_value(ts) OVER w AS first_ts, row_number() OVER w AS n
         FROM events WINDOW w AS (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id)) WHERE n > 1""",
)
def stream_repeats(spark, sf):
    """Keys of a day's snapshot that arrive again, with their first arrival."""
    snapshot = event_stream(spark, sf).withColumn("day", F.to_date("ts"))
    found = jobs.repeats(snapshot, "ts", "event_id", ["user_id", "event_type", "day"])
    return landed(spark, found, "repeats")
