"""Forecasts and model jobs on the given tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.functions.scalars import days_since_due
from tidemark.operators import forecasting as fc
from tidemark.operators import models
from tidemark.operators import series as ts
from tidemark.plans.registry import query
from tidemark.plans.series import DAILY, KEY, NUMBERED, WINDOWS, daily_rate
from tidemark.session import cut_lineage, scratch, table
from tidemark.sources import text

BEFORE_DUE = 29  # fixed value: days after the due date that mark a new cycle


def rate_frame(spark, sf, horizon=90):
    """Daily rates with 80 percent training days, test days and future days."""
    daily = ts.chronological_split(daily_rate(spark, sf), [KEY], "ds")
    future = ts.make_future(daily, [KEY], "ds", horizon).drop("is_future")
    joined = future.join(daily, [KEY, "ds"], "left")
    return joined.select(
        KEY,
        "ds",
        F.col("rate").alias("y"),
        F.coalesce(F.col("part") == "train", F.lit(False)).alias("is_train"),
        days_since_due(F.col("ds")).alias("date_diff"),
    )


def due_events(frame):
    days = frame.select("ds").distinct()
    return ts.event_table(days, "ds", days_since_due(F.col("ds")) == BEFORE_DUE, "new_cycle", -1, 0)


@query("k3_forecast")
def forecast(spark, sf):
    frame = rate_frame(spark, sf)
    model = fc.ForecastModel(keys=(KEY,), events=(("new_cycle", -1, 0),), regressors=("date_diff",))
    return fc.forecast(frame, model, due_events(frame)).select(KEY, "ds", "y", "yhat", "yhat_lower", "yhat_upper")


TREND = f"""{NUMBERED}, marked AS (SELECT *, rn <= floor(count(*) OVER (PARTITION BY o_orderpriority) * 0.8) AS train, ds - DATE '1970-01-01' AS day FROM numbered),
  fitted AS (SELECT o_orderpriority, regr_slope(rate, day) AS a, regr_intercept(rate, day) AS b FROM marked WHERE train GROUP BY 1)"""
STRAIGHT = {"changepoints": 0, "seasons": ()}  # a trend without bends, which SQL can state


@query(
    "k3_forecast_trend",
    f"{TREND} SELECT o_orderpriority, ds, round(rate, 6) AS y, round(a * day + b, 4) AS yhat FROM marked JOIN fitted USING (o_orderpriority)",
)
def forecast_trend(spark, sf):
    found = fc.forecast(rate_frame(spark, sf), fc.ForecastModel(keys=(KEY,), **STRAIGHT)).where("y IS NOT NULL")
    return found.select(KEY, "ds", F.round("y", 6).alias("y"), F.round("yhat", 4).alias("yhat"))


@query("k4_components")
def components(spark, sf):
    monthly = fc.Season("monthly", 30.0, 4)
    model = fc.ForecastModel(
        keys=(KEY,), seasons=(fc.WEEKLY, monthly), changepoint_prior_scale=1.0, holidays_prior_scale=1.0, interval_width=0.9
    )
    out = fc.forecast(rate_frame(spark, sf), model)
    return out.withColumn("parts_total", fc.total_of_parts(out)).drop("y", "is_train", "date_diff")


@query("k5_window_choice_backtest")
def window_choice_backtest(spark, sf):
    return fc.window_backtest(daily_rate(spark, sf), [KEY], "rate", WINDOWS, seasons=(fc.WEEKLY,), changepoint_prior_scale=1.0)


@query(
    "k6_cutoffs",
    f"""WITH {DAILY}, span AS (SELECT o_orderpriority, min(ds) AS lo, max(ds) AS hi FROM daily GROUP BY 1)
        SELECT o_orderpriority, CAST(hi - 30 - CAST(i * 30 AS INTEGER) AS DATE) AS cutoff FROM span, range(0, 1000) r(i) WHERE hi - 30 - CAST(i * 30 AS INTEGER) >= lo + 180""",
)
def cutoffs(spark, sf):
    return fc.cutoffs(daily_rate(spark, sf), [KEY])


@query(
    "k6_rolling_origin_trend",
    f"""WITH {DAILY}, span AS (SELECT o_orderpriority, min(ds) AS lo, max(ds) AS hi FROM daily GROUP BY 1),
          cuts AS (SELECT o_orderpriority, CAST(hi - 30 - CAST(i * 30 AS INTEGER) AS DATE) AS cutoff FROM span, range(0, 1000) r(i) WHERE hi - 30 - CAST(i * 30 AS INTEGER) >= lo + 180),
          days AS (SELECT o_orderpriority, cutoff, ds, rate, ds - DATE '1970-01-01' AS day FROM daily JOIN cuts USING (o_orderpriority) WHERE ds <= cutoff + 30),
          fitted AS (SELECT o_orderpriority, cutoff, regr_slope(rate, day) AS a, regr_intercept(rate, day) AS b FROM days WHERE ds <= cutoff GROUP BY 1, 2),
          errors AS (SELECT CAST(ds - cutoff AS INTEGER) AS horizon, rate - (a * day + b) AS e FROM days JOIN fitted USING (o_orderpriority, cutoff) WHERE ds > cutoff)
        SELECT horizon, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae FROM errors GROUP BY 1""",
)
def rolling_origin_trend(spark, sf):
    found = fc.rolling_origin(daily_rate(spark, sf), [KEY], "rate", **STRAIGHT)
    rmse, mae = (F.max(F.when(F.col("metric") == m, F.col("value"))) for m in ("RMSE", "MAE"))
    return found.groupBy("horizon").agg(F.round(rmse, 4).alias("rmse"), F.round(mae, 4).alias("mae"))


@query("k6_rolling_origin_cv")
def rolling_origin_cv(spark, sf):
    return fc.rolling_origin(daily_rate(spark, sf), [KEY], "rate", seasons=(fc.WEEKLY,), changepoints=10)


# ---- model jobs --------------------------------------------------------------------------

ROW = ["l_orderkey", "l_linenumber", "l_partkey"]
FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
TARGET = "l_extendedprice"


def items(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", *FEATURES, TARGET, "l_returnflag")


IN_TRAIN = "('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey)), 1, 8))::BIGINT % 100 < 80"


@query(
    "k8_train_test_split",
    f"SELECT CASE WHEN {IN_TRAIN} THEN 'train' ELSE 'test' END AS part, count(*) AS cnt FROM lineitem GROUP BY 1",
)
def train_test_split(spark, sf):
    part = F.when(models.is_train(ROW), "train").otherwise("test")
    return items(spark, sf).groupBy(part.alias("part")).agg(F.count("*").alias("cnt"))


@query(
    "k9_standard_scale",
    """WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM lineitem WHERE l_returnflag <> 'R')
       SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 8) AS l_quantity, round((l_tax - mt) / st, 8) AS l_tax FROM lineitem, s""",
)
def standard_scale(spark, sf):
    rows = items(spark, sf)
    scaled = models.scale_with(rows, rows.where(F.col("l_returnflag") != "R"), ["l_quantity", "l_tax"])
    return scaled.select(
        "l_orderkey", "l_linenumber", F.round("l_quantity", 8).alias("l_quantity"), F.round("l_tax", 8).alias("l_tax")
    )


@query("k10_train_regressor")
def train_regressor(spark, sf):
    rows = items(spark, sf)
    train = models.is_train(ROW)
    model = models.train_regressor(rows.where(train), FEATURES, TARGET)
    return models.batch_metrics(models.score(model, rows.where(~train)), [], TARGET)


# a target that depends on the quantity, so that one feature is worth more than another
AMOUNT_SQL = f"""SELECT *, l_quantity * 100 + l_extendedprice / 100 AS amount, {IN_TRAIN} AS train FROM lineitem"""
ONE_FEATURE = f"""WITH i AS ({AMOUNT_SQL}),
  q AS (SELECT regr_slope(amount, l_quantity) AS a, regr_intercept(amount, l_quantity) AS b FROM i WHERE train),
  t AS (SELECT regr_slope(amount, l_tax) AS a, regr_intercept(amount, l_tax) AS b FROM i WHERE train),
  s AS (SELECT i.*, q.a * l_quantity + q.b AS new_p, t.a * l_tax + t.b AS old_p FROM i, q, t)"""


def amounts(spark, sf):
    return items(spark, sf).withColumn("amount", F.col("l_quantity") * 100 + F.col("l_extendedprice") / 100)


def one_feature(spark, sf, feature="l_quantity"):
    rows = amounts(spark, sf)
    return rows, models.train_regressor(rows.where(models.is_train(ROW)), [feature], "amount", "linear")


@query(
    "k10_linear_regressor",
    f"{ONE_FEATURE} SELECT round(1 - avg((amount - new_p) * (amount - new_p)) / var_pop(amount), 6) AS r2, round(sqrt(avg((amount - new_p) * (amount - new_p))), 4) AS rmse, count(*) AS observations FROM s WHERE NOT train",
)
def linear_regressor(spark, sf):
    rows, model = one_feature(spark, sf)
    found = models.batch_metrics(models.score(model, rows.where(~models.is_train(ROW))), [], "amount")
    return found.select(F.round("r2", 6).alias("r2"), F.round("rmse", 4).alias("rmse"), "observations")


@query("k12_linear_score", f"{ONE_FEATURE} SELECT l_orderkey, l_linenumber, l_partkey, round(new_p, 4) AS prediction FROM s")
def linear_score(spark, sf):
    rows, model = one_feature(spark, sf)
    path = scratch(spark, "model")
    model.write().save(path)
    return models.score(PipelineModel.load(path), rows).select(*ROW, F.round("prediction", 4).alias("prediction"))


@query(
    "k15_one_feature_contest",
    f"""{ONE_FEATURE}, m AS (SELECT 1 - avg((amount - new_p) ** 2) / var_pop(amount) AS new_r2, 1 - avg((amount - old_p) ** 2) / var_pop(amount) AS old_r2 FROM s WHERE NOT train)
        SELECT round(new_r2, 6) AS new_r2, round(old_r2, 6) AS old_r2, (new_r2 > old_r2 + 0.01)::INT AS promotion_flag FROM m""",
)
def one_feature_contest(spark, sf):
    rows, new = one_feature(spark, sf)
    compared = models.compare_models(new, one_feature(spark, sf, "l_tax")[1], rows.where(~models.is_train(ROW)), "amount")
    return compared.select(F.round("new_r2", 6).alias("new_r2"), F.round("old_r2", 6).alias("old_r2"), "promotion_flag")


@query("k16_promoted_score", f"{ONE_FEATURE} SELECT l_returnflag, round(avg(new_p), 4) AS mean_prediction, count(*) AS cnt FROM s GROUP BY 1")
def promoted_score(spark, sf):
    rows, new = one_feature(spark, sf)
    old = one_feature(spark, sf, "l_tax")[1]
    path = scratch(spark, "production")
    models.promote(old, rows.select(F.lit(1).alias("promotion_flag")).limit(1), path)  # in production so far
    models.promote(new, cut_lineage(models.compare_models(new, old, rows.where(~models.is_train(ROW)), "amount")), path)
    scored = models.score(PipelineModel.load(path), rows)
    return scored.groupBy("l_returnflag").agg(F.round(F.avg("prediction"), 4).alias("mean_prediction"), F.count("*").alias("cnt"))


@query("d18_accuracy_given", "SELECT avg((label = vec_id % 10)::INT) AS accuracy FROM embeddings")
def accuracy_given(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("prediction", F.col("vec_id") % 10)
    return models.accuracy(rows, "label")


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", array_to_vector("embedding").alias("features"))


@query("k11_train_classifier")
def train_classifier(spark, sf):
    rows = vectors(spark, sf)
    train = models.is_train(["vec_id"])
    model = models.train_classifier(rows.where(train), "features", "label")
    return models.score(model, rows).select("vec_id", "label", "prediction", train.alias("is_train"))


@query("d18_accuracy")
def accuracy(spark, sf):
    rows = vectors(spark, sf)
    train = models.is_train(["vec_id"])
    model = models.train_classifier(rows.where(train), "features", "label")
    return models.accuracy(models.score(model, rows.where(~train)), "label")


@query("k12_batch_score")
def batch_score(spark, sf):
    rows = items(spark, sf)
    path, out = scratch(spark, "model"), scratch(spark, "scored")
    models.train_regressor(rows.where(models.is_train(ROW)), FEATURES, TARGET, "linear").write().save(path)
    models.score(PipelineModel.load(path), rows).write.parquet(out)
    return spark.read.parquet(out)


METRICS_SQL = """SELECT event_type AS version, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS runtime, 1 - avg((value - p) * (value - p)) / nullif(var_pop(value), 0) AS r2,
    sqrt(avg((value - p) * (value - p))) AS rmse, count(*) AS observations
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS DOUBLE) AS p FROM events) GROUP BY 1, 2"""


def hourly_metrics(events):
    """Event value against the number in its props, as metrics per type and hour."""
    scored = events.select(
        F.col("event_type").alias("version"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("runtime"),
        "value",
        F.from_json("props", "k double").getField("k").alias("prediction"),
    )
    return models.batch_metrics(scored, ["version", "runtime"], "value")


@query(
    "k13_batch_metrics",
    f"SELECT version, runtime, round(r2, 3) AS r2, round(rmse, 4) AS rmse, observations FROM ({METRICS_SQL})",
)
def batch_metrics(spark, sf):
    out = hourly_metrics(table(spark, sf, "events"))
    return out.withColumn("r2", F.round("r2", 3)).withColumn("rmse", F.round("rmse", 4))


@query(
    "k14_drift_trigger",
    """WITH d AS (SELECT *, value - (0.8 * value + 0.2 * CAST(json_extract(props, '$.k') AS DOUBLE)) AS d FROM events),
            m AS (SELECT event_type AS version, CAST(ts AS DATE) AS runtime, round(1 - avg(d * d) / nullif(var_pop(value), 0), 8) AS r2, round(sqrt(avg(d * d)), 6) AS rmse, count(*) AS observations FROM d GROUP BY 1, 2),
            w AS (SELECT *, max(r2) OVER (PARTITION BY version ORDER BY runtime) AS ref_r2, min(rmse) OVER (PARTITION BY version ORDER BY runtime) AS ref_rmse,
                  row_number() OVER (PARTITION BY version ORDER BY runtime DESC) AS rn FROM m)
       SELECT version, runtime, r2, rmse, observations, ref_r2, ref_rmse, CAST(ref_r2 > r2 * 1.05 OR rmse > ref_rmse * 1.2 AS INTEGER) AS retrain,
              CASE WHEN ref_r2 > r2 * 1.05 OR rmse > ref_rmse * 1.2 THEN 'Need retrain' ELSE 'No need retrain' END AS message FROM w WHERE rn = 1""",
)
def drift_trigger(spark, sf):
    scored = table(spark, sf, "events").select(
        F.col("event_type").alias("version"),
        F.to_date("ts").alias("runtime"),
        "value",
        (F.col("value") * 0.8 + F.from_json("props", "k double").getField("k") * 0.2).alias("prediction"),
    )
    daily = models.batch_metrics(scored, ["version", "runtime"], "value")
    daily = daily.withColumns({"r2": F.round("r2", 8), "rmse": F.round("rmse", 6)})
    return models.drift_flags(daily)


def contest(spark, sf):
    rows = items(spark, sf)
    train, test = rows.where(models.is_train(ROW)), rows.where(~models.is_train(ROW))
    new = models.train_regressor(train, FEATURES, TARGET, "linear")
    old = models.train_regressor(train, ["l_tax", "l_discount"], TARGET, "linear")
    return new, models.compare_models(new, old, test, TARGET)


@query("k15_champion_challenger")
def champion_challenger(spark, sf):
    _, compared = contest(spark, sf)
    day = F.date_format(F.lit("2024-01-31").cast("date"), "yyyy-MM-dd")
    document = text.validation_document(
        F.col("new_r2"), F.col("old_r2"), F.col("new_rmse"), F.col("old_rmse"), F.col("promotion_flag"), day
    )
    return compared.withColumn("document", F.to_json(document))


@query("k16_promote_model")
def promote_model(spark, sf):
    new, compared = contest(spark, sf)
    compared = cut_lineage(compared)
    path = scratch(spark, "production")
    promoted = models.promote(new, compared, path)
    rows = items(spark, sf)
    scored = models.score(PipelineModel.load(path), rows) if promoted else rows.withColumn("prediction", F.lit(None).cast("double"))
    return scored.groupBy("l_returnflag").agg(F.avg("prediction").alias("mean_prediction"), F.count("*").alias("cnt"))


# fixed values: weights and intercept of the response
WEIGHTS = [1.5, -2.0, 1.0, 3.0, -4.0, 2.0]
INTERCEPT = 5.0


@query(
    "k17_drift_features",
    """SELECT l_orderkey, l_linenumber, v1, v2, v3, v4, round(1.5 * v1 - 2.0 * v2 + v3 + 3.0 * v4 - 4.0 * v5 + 2.0 * v6 + 5.0, 4) AS target
       FROM (SELECT l_orderkey, l_linenumber, power(l_linenumber, 4) AS v1, power(l_linenumber - 4, 3) AS v2, power(l_quantity, 2) * l_linenumber AS v3,
                    power(l_quantity, 2) AS v4, l_discount AS v5, l_tax AS v6 FROM lineitem)""",
)
def drift_features(spark, sf):
    n, q = F.col("l_linenumber"), F.col("l_quantity")
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.pow(n, 4).alias("v1"),
        F.pow(n - 4, 3).alias("v2"),
        (F.pow(q, 2) * n).alias("v3"),
        F.pow(q, 2).alias("v4"),
        F.col("l_discount").alias("v5"),
        F.col("l_tax").alias("v6"),
    )
    names = [f"v{i}" for i in range(1, 7)]
    target = models.response(rows, names, WEIGHTS, INTERCEPT)
    return rows.withColumn("target", F.round(target, 4)).drop("v5", "v6")
