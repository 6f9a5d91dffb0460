"""Windows, calendars, metrics and event tables on daily series of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import days_since_due
from tidemark.operators import quality
from tidemark.operators import relational as rel
from tidemark.operators import series as ts
from tidemark.operators.quantiles import percentiles
from tidemark.plans.registry import query
from tidemark.session import table
from tidemark.sources import parquet

KEY = "o_orderpriority"

# Orders per priority and day: cnt and share of late ones in percent, the rate that is smoothed.
DAILY = """daily AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS ds, count(*) AS cnt,
  100.0 * sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*) AS rate FROM orders GROUP BY 1, 2)"""
NUMBERED = f"""WITH {DAILY}, numbered AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY ds) AS rn FROM daily)"""


def daily_rate(spark, sf):
    return ts.daily_series(
        table(spark, sf, "orders"),
        "o_orderdate",
        [KEY],
        cnt=F.count("*"),
        rate=F.avg(F.when(F.col("o_orderstatus") == "F", 100.0).otherwise(0.0)),
    )


@query(
    "c10_calendar_fill",
    """WITH daily AS (SELECT o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS ds, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1, 2, 3),
            span AS (SELECT o_orderpriority, o_orderstatus, min(ds) AS lo, max(ds) AS hi FROM daily GROUP BY 1, 2),
            days AS (SELECT o_orderpriority, o_orderstatus, CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS ds FROM span)
       SELECT o_orderpriority, o_orderstatus, ds, coalesce(amount, 0) AS amount FROM days LEFT JOIN daily USING (o_orderpriority, o_orderstatus, ds)""",
)
def calendar_fill(spark, sf):
    keys = [KEY, "o_orderstatus"]
    amount = F.round(F.sum("o_totalprice"), 2)
    daily = ts.daily_series(table(spark, sf, "orders"), "o_orderdate", keys, amount=amount)
    return ts.calendar_fill(daily, keys, "ds", ["amount"])


@query(
    "c11_future_frame_join",
    f"""WITH {DAILY}, span AS (SELECT o_orderpriority, min(ds) AS lo, max(ds) + 30 AS hi FROM daily GROUP BY 1),
            days AS (SELECT o_orderpriority, CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS ds FROM span)
       SELECT o_orderpriority, ds, cnt, round(rate, 6) AS rate, CAST(day(ds) AS INTEGER) AS day_number
       FROM days LEFT JOIN daily USING (o_orderpriority, ds)""",
)
def future_frame_join(spark, sf):
    daily = daily_rate(spark, sf)
    future = ts.make_future(daily, [KEY], "ds", 30).drop("is_future")
    joined = future.join(daily, [KEY, "ds"], "left")
    return joined.withColumn("rate", F.round("rate", 6)).withColumn("day_number", F.dayofmonth("ds"))


@query(
    "d12_latest_month_summary",
    """WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_totalprice,
                         max(CAST(date_trunc('month', o_orderdate) AS DATE)) OVER (PARTITION BY o_custkey) AS last FROM orders)
       SELECT o_custkey, 'orders.parquet' AS file_path, month, round(sum(o_totalprice), 2) AS amount, count(*) AS cnt FROM m WHERE month = last GROUP BY 1, 2, 3""",
)
def latest_month_summary(spark, sf):
    """The latest month of each customer in each file."""
    rows = parquet.read_with_provenance(spark, f"{sf.rstrip('/')}/orders.parquet")
    rows = rows.withColumn("file_path", F.element_at(F.split("file_path", "/"), -1))
    out = ts.latest_month_summary(rows, ["o_custkey", "file_path"], "o_orderdate", "o_totalprice")
    return out.withColumn("amount", F.round("amount", 2))


@query(
    "d15_percentiles",
    """SELECT l_returnflag, CAST(i AS INTEGER) AS cut, round(q[i + 1], 4) AS value FROM (
         SELECT l_returnflag, quantile_cont(l_extendedprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q
         FROM lineitem GROUP BY 1), range(0, 9) r(i)""",
)
def percentile_cuts(spark, sf):
    cuts = [i / 10 for i in range(1, 10)]
    found = percentiles(table(spark, sf, "lineitem"), "l_extendedprice", cuts, ["l_returnflag"])
    long = found.select("l_returnflag", F.posexplode("percentiles").alias("cut", "value"))
    return long.withColumn("value", F.round("value", 4))


@query(
    "d15_percentiles_overall",
    """SELECT CAST(i AS INTEGER) AS cut, round(q[i + 1], 4) AS value FROM (
         SELECT quantile_cont(l_extendedprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM lineitem), range(0, 9) r(i)""",
)
def percentile_cuts_overall(spark, sf):
    cuts = [i / 10 for i in range(1, 10)]
    found = percentiles(table(spark, sf, "lineitem"), "l_extendedprice", cuts)
    return found.select(F.posexplode("percentiles").alias("cut", "value")).withColumn("value", F.round("value", 4))


@query(
    "d16_regression_metrics",
    """WITH p AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)
       SELECT l_returnflag, count(*) AS observations, round(avg((y - p) * (y - p)), 2) AS mse,
              round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
              round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2 FROM p GROUP BY 1""",
)
def regression_metrics(spark, sf):
    li = table(spark, sf, "lineitem")
    out = ts.regression_metrics(li, ["l_returnflag"], F.col("l_extendedprice"), F.col("l_quantity") * 1500)
    return out.select(
        "l_returnflag", "observations", F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2")
    )


@query(
    "d17_forecast_metrics",
    f"""WITH {DAILY}, f AS (SELECT *, avg(rate) OVER (PARTITION BY o_orderpriority ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS yhat FROM daily),
            m AS (SELECT o_orderpriority, avg((rate - yhat) * (rate - yhat)) AS mse, avg(abs(rate - yhat)) AS mae,
                         100 * avg(CASE WHEN rate <> 0 THEN abs((rate - yhat) / rate) END) AS mape FROM f WHERE yhat IS NOT NULL GROUP BY 1)
       SELECT o_orderpriority, metric, round(CASE metric WHEN 'RMSE' THEN sqrt(mse) WHEN 'MSE' THEN mse WHEN 'MAE' THEN mae ELSE mape END, 5) AS value
       FROM m, (VALUES ('RMSE'), ('MSE'), ('MAE'), ('MAPE')) t(metric)""",
)
def forecast_metrics(spark, sf):
    window = ts.by_day([KEY])
    naive = daily_rate(spark, sf).withColumn("yhat", F.avg("rate").over(window.rowsBetween(-7, -1)))
    out = ts.forecast_metrics(naive, [KEY], "rate", "yhat")
    return out.withColumn("value", F.round("value", 5))


@query(
    "d22_null_column_check",
    """WITH j AS (SELECT c_custkey, o_orderkey, o_orderpriority FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P')
       SELECT 'c_custkey' AS column_name, round(avg(CASE WHEN c_custkey IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_share FROM j
       UNION ALL SELECT 'o_orderkey', round(avg(CASE WHEN o_orderkey IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM j
       UNION ALL SELECT 'o_orderpriority', round(avg(CASE WHEN o_orderpriority IS NULL THEN 1.0 ELSE 0.0 END), 6) FROM j""",
)
def null_column_check(spark, sf):
    orders = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P")
    joined = table(spark, sf, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    out = quality.null_shares(joined, ["c_custkey", "o_orderkey", "o_orderpriority"])
    return out.withColumn("null_share", F.round("null_share", 6))


@query(
    "d22_temporal_consistency",
    """WITH d AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS ds, count(*) AS cnt FROM orders GROUP BY 1, 2),
            p AS (SELECT *, lag(cnt) OVER (PARTITION BY o_orderpriority ORDER BY ds) AS prev_cnt FROM d)
       SELECT o_orderpriority, ds, cnt, prev_cnt, round(cnt / prev_cnt, 6) AS ratio,
              CAST(coalesce(cnt / prev_cnt BETWEEN 0.5 AND 2.0, true) AS INTEGER) AS status FROM p""",
)
def temporal_consistency(spark, sf):
    out = quality.temporal_consistency(table(spark, sf, "orders"), [KEY], "o_orderdate", 0.5, 2.0)
    return out.withColumn("ratio", F.round("ratio", 6))


@query(
    "d22_non_sensical",
    """SELECT 'discount' AS rule, count(*) AS checked, count(*) FILTER (WHERE NOT l_discount BETWEEN 0 AND 0.08) AS violations FROM lineitem
       UNION ALL SELECT 'price', count(*), count(*) FILTER (WHERE NOT l_extendedprice BETWEEN 0 AND 100000) FROM lineitem""",
)
def non_sensical(spark, sf):
    rules = {"discount": ("l_discount", 0.0, 0.08), "price": ("l_extendedprice", 0.0, 100000.0)}
    return quality.range_violations(table(spark, sf, "lineitem"), rules)


@query(
    "e1_latest_per_key",
    """SELECT user_id, event_type, ts, event_id, value FROM (SELECT *, row_number() OVER (
         PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest_per_key(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return ts.latest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "e2_lag",
    f"""WITH {DAILY} SELECT o_orderpriority, ds, round(rate, 6) AS rate,
          round(lag(rate) OVER (PARTITION BY o_orderpriority ORDER BY ds), 6) AS prev_rate FROM daily""",
)
def lag(spark, sf):
    previous = F.lag("rate", 1).over(ts.by_day([KEY]))
    return daily_rate(spark, sf).select(KEY, "ds", F.round("rate", 6).alias("rate"), F.round(previous, 6).alias("prev_rate"))


@query(
    "e3_threshold_cross_flag",
    f"""WITH {DAILY} SELECT o_orderpriority, ds, CAST(coalesce(lag(rate) OVER w >= 85 AND rate < 85, false) AS INTEGER) AS crossed
       FROM daily WINDOW w AS (PARTITION BY o_orderpriority ORDER BY ds)""",
)
def threshold_cross_flag(spark, sf):
    limit = 85  # fixed value: alert level of the rate
    crossed = ts.crossed_below(F.col("rate"), ts.by_day([KEY]), limit)
    return daily_rate(spark, sf).select(KEY, "ds", crossed.alias("crossed"))


@query(
    "e4_rolling_mean_partial",
    f"""WITH {DAILY} SELECT o_orderpriority, ds, round(avg(rate) OVER (PARTITION BY o_orderpriority ORDER BY ds
          ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 5) AS smooth FROM daily""",
)
def rolling_mean_partial(spark, sf):
    mean = ts.rolling_mean(F.col("rate"), ts.by_day([KEY]), 7, partial=True)
    return daily_rate(spark, sf).select(KEY, "ds", F.round(mean, 5).alias("smooth"))


# fixed values: smoothing windows in days
WINDOWS = [7, 15, 21, 30]


@query(
    "e5_rolling_mean_full",
    f"""WITH {DAILY} SELECT o_orderpriority, ds, """
    + ", ".join(
        f"""CASE WHEN count(rate) OVER w{n} = {n} THEN round(avg(rate) OVER w{n}, 5) END AS mean_{n}""" for n in WINDOWS
    )
    + " FROM daily WINDOW "
    + ", ".join(
        f"w{n} AS (PARTITION BY o_orderpriority ORDER BY ds ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in WINDOWS
    ),
)
def rolling_mean_full(spark, sf):
    window = ts.by_day([KEY])
    means = [F.round(ts.rolling_mean(F.col("rate"), window, n), 5).alias(f"mean_{n}") for n in WINDOWS]
    return daily_rate(spark, sf).select(KEY, "ds", *means)


@query(
    "e6_gaussian_rolling_mean",
    NUMBERED
    + """, weights AS (SELECT i, exp(-0.5 * (i - 3.0) * (i - 3.0)) AS w FROM range(0, 7) r(i))
       SELECT a.o_orderpriority, a.ds, CASE WHEN a.rn >= 7 THEN round(sum(b.rate * w) / sum(w), 5) END AS smooth
       FROM numbered a JOIN numbered b ON a.o_orderpriority = b.o_orderpriority AND b.rn BETWEEN a.rn - 6 AND a.rn
       JOIN weights ON i = b.rn - a.rn + 6 GROUP BY a.o_orderpriority, a.ds, a.rn""",
)
def gaussian_rolling_mean(spark, sf):
    smooth = ts.gaussian_rolling_mean(F.col("rate"), ts.by_day([KEY]), 7)
    return daily_rate(spark, sf).select(KEY, "ds", F.round(smooth, 5).alias("smooth"))


@query(
    "e7_ewm_mean",
    NUMBERED
    + """ SELECT a.o_orderpriority, a.ds, CASE WHEN a.rn >= 7 THEN round(sum(b.rate * power(0.75, a.rn - b.rn)) / sum(power(0.75, a.rn - b.rn)), 5) END AS smooth
       FROM numbered a JOIN numbered b ON a.o_orderpriority = b.o_orderpriority AND b.rn BETWEEN a.rn - 129 AND a.rn
       GROUP BY a.o_orderpriority, a.ds, a.rn""",
)
def ewm_mean(spark, sf):
    smooth = ts.ewm_mean(F.col("rate"), ts.by_day([KEY]), 7)
    return daily_rate(spark, sf).select(KEY, "ds", F.round(smooth, 5).alias("smooth"))


@query(
    "e8_latest_month_rows",
    """SELECT o_orderkey, o_custkey, CAST(month AS DATE) AS month FROM (SELECT *, date_trunc('month', o_orderdate) AS month,
         max(date_trunc('month', o_orderdate)) OVER (PARTITION BY o_custkey) AS last FROM orders) WHERE month = last""",
)
def latest_month_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return ts.latest_month_rows(orders, ["o_custkey"], "o_orderdate").drop("o_orderdate")


@query(
    "e9_best_status_per_key",
    """SELECT k, max(status) AS status FROM (
         SELECT user_id AS k, CAST(event_type = 'purchase' AS INTEGER) AS status FROM events
         UNION ALL SELECT o_custkey, CAST(o_orderstatus = 'F' AS INTEGER) FROM orders) GROUP BY 1""",
)
def best_status_per_key(spark, sf):
    seen = table(spark, sf, "events").select(F.col("user_id").alias("k"), rel.flag(F.col("event_type") == "purchase").alias("status"))
    later = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), rel.flag(F.col("o_orderstatus") == "F").alias("status"))
    return rel.best_status([seen, later], "k")


@query(
    "e10_chronological_split",
    f"""WITH {DAILY} SELECT o_orderpriority, ds, CASE WHEN row_number() OVER (PARTITION BY o_orderpriority ORDER BY ds)
          <= floor(count(*) OVER (PARTITION BY o_orderpriority) * 0.8) THEN 'train' ELSE 'test' END AS part FROM daily""",
)
def chronological_split(spark, sf):
    return ts.chronological_split(daily_rate(spark, sf), [KEY], "ds").select(KEY, "ds", "part")


@query(
    "e11_running_best",
    """WITH m AS (SELECT event_type AS version, CAST(ts AS DATE) AS runtime, round(avg(value), 9) AS r2, max(value) AS rmse FROM events GROUP BY 1, 2)
       SELECT version, runtime, r2, rmse, max(r2) OVER w AS max_r2, min(rmse) OVER w AS min_rmse FROM m
       WINDOW w AS (PARTITION BY version ORDER BY runtime)""",
)
def running_best(spark, sf):
    daily = (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("version"), F.to_date("ts").alias("runtime"))
        .agg(F.round(F.avg("value"), 9).alias("r2"), F.max("value").alias("rmse"))
    )
    return ts.running_best(daily, ["version"], "runtime", "r2", "rmse")


@query(
    "e12_first_gap",
    """WITH v AS (SELECT DISTINCT l_partkey AS v FROM lineitem WHERE l_partkey > 0)
       SELECT min(v) + 1 AS gap FROM v a WHERE NOT EXISTS (SELECT 1 FROM v b WHERE b.v = a.v + 1)""",
)
def first_gap(spark, sf):
    return ts.first_gap(table(spark, sf, "lineitem"), "l_partkey")


@query(
    "k1_event_table",
    """WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS ds FROM orders),
            due AS (SELECT ds, date_diff('day', CAST(CASE WHEN day(ds) >= 4 THEN date_trunc('month', ds) ELSE date_trunc('month', ds) - INTERVAL 1 MONTH END
                           + INTERVAL 3 DAY AS DATE), ds) AS diff FROM days)
       SELECT 'before_due' AS event, ds + CAST(i AS INTEGER) AS ds, CAST(i AS INTEGER) AS "offset" FROM due, range(-1, 3) r(i) WHERE diff = 29""",
)
def event_table(spark, sf):
    before_due = 29  # fixed value: days after the due date that mark the event
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("ds")).distinct()
    return ts.event_table(days, "ds", days_since_due(F.col("ds")) == before_due, "before_due", -1, 2)


@query(
    "k2_make_future",
    f"""WITH {DAILY}, span AS (SELECT o_orderpriority, min(ds) AS lo, max(ds) AS hi FROM daily GROUP BY 1),
            days AS (SELECT o_orderpriority, hi, CAST(unnest(generate_series(lo::TIMESTAMP, (hi + 90)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS ds FROM span)
       SELECT o_orderpriority, ds, CAST(ds > hi AS INTEGER) AS is_future FROM days""",
)
def make_future(spark, sf):
    return ts.make_future(daily_rate(spark, sf), [KEY], "ds", 90)


@query(
    "k7_residuals",
    f"""WITH {DAILY}, f AS (SELECT *, avg(rate) OVER (PARTITION BY o_orderpriority ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS yhat FROM daily)
       SELECT o_orderpriority, ds, round(rate - yhat, 5) AS residual,
              CASE WHEN rate <> 0 THEN round(100 * abs((rate - yhat) / rate), 4) END AS ape FROM f""",
)
def residuals(spark, sf):
    window = ts.by_day([KEY])
    naive = daily_rate(spark, sf).withColumn("yhat", F.avg("rate").over(window.rowsBetween(-7, -1)))
    error = F.col("rate") - F.col("yhat")
    return naive.select(
        KEY, "ds", F.round(error, 5).alias("residual"), F.round(F.abs(F.try_divide(error, F.col("rate"))) * 100, 4).alias("ape")
    )
