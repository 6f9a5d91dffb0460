"""Daily sequences, their labels and profiles on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import sequences as seq
from tidemark.plans.registry import query
from tidemark.session import table

LATEST = """daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS ds, o_orderstatus, o_totalprice,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
    max(CAST(date_trunc('month', o_orderdate) AS DATE)) OVER (PARTITION BY o_custkey) AS month FROM orders),
  keyed AS (SELECT DISTINCT o_custkey, month FROM daily)"""
FILLED = f"""{LATEST}, slots AS (SELECT o_custkey, month, CAST(unnest(generate_series(month::TIMESTAMP, last_day(month)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS ds FROM keyed),
  sums AS (SELECT o_custkey, ds, sum(o_totalprice) AS amount FROM daily WHERE m = month GROUP BY 1, 2),
  filled AS (SELECT o_custkey, month, CAST(day(ds) AS INTEGER) AS day, round(coalesce(amount, 0), 2) AS amount FROM slots LEFT JOIN sums USING (o_custkey, ds))"""

STATUSES = ["O", "F", "P"]


def customer_sequences(spark, sf):
    return seq.daily_sequences(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", "o_totalprice")


@query("j1_daily_sequences", f"WITH {FILLED} SELECT o_custkey, month, day, amount FROM filled")
def daily_sequences(spark, sf):
    long = seq.melt_sequences(customer_sequences(spark, sf))
    return long.select("o_custkey", "month", "day", F.round("amount", 2).alias("amount"))


@query(
    "j2_daily_sequences_by_category",
    f"""WITH {LATEST}, cats AS (SELECT unnest(['O', 'F', 'P', 'Total']) AS category), days AS (SELECT CAST(i AS INTEGER) AS day FROM range(1, 32) r(i)),
       sums AS (SELECT o_custkey, o_orderstatus AS category, CAST(day(ds) AS INTEGER) AS day, sum(o_totalprice) AS amount FROM daily WHERE m = month GROUP BY 1, 2, 3
                UNION ALL SELECT o_custkey, 'Total', CAST(day(ds) AS INTEGER), sum(o_totalprice) FROM daily WHERE m = month GROUP BY 1, 3)
       SELECT o_custkey, month, category, day, round(coalesce(amount, 0), 2) AS amount
       FROM keyed CROSS JOIN cats CROSS JOIN days LEFT JOIN sums USING (o_custkey, category, day)""",
)
def daily_sequences_by_category(spark, sf):
    wide = seq.daily_sequences_by_category(
        table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", "o_totalprice", "o_orderstatus", STATUSES
    )
    long = seq.melt_sequences(wide)
    return long.select("o_custkey", "month", "category", "day", F.round("amount", 2).alias("amount"))


def segment_labels(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("label"))


@query(
    "c14_column_label_attach",
    f"""WITH {FILLED} SELECT o_custkey, month, c_mktsegment AS label, count(*) AS slots FROM filled
        LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3""",
)
def column_label_attach(spark, sf):
    labelled = seq.attach_labels(customer_sequences(spark, sf), segment_labels(spark, sf), ["o_custkey"])
    return labelled.select("o_custkey", "month", "label", F.size("amounts").cast("long").alias("slots"))


@query(
    "d21_cluster_profile",
    f"""WITH {FILLED}, p AS (SELECT c_mktsegment AS label, day, avg(amount) AS mean, coalesce(stddev_samp(amount), 0) AS sd, count(*) AS cnt
          FROM filled JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
        SELECT label, day, cnt, round(mean, 3) AS mean, round(mean - 0.6744897501960817 * sd / sqrt(cnt), 3) AS low,
               round(mean + 0.6744897501960817 * sd / sqrt(cnt), 3) AS high FROM p""",
)
def cluster_profile(spark, sf):
    labelled = seq.attach_labels(customer_sequences(spark, sf), segment_labels(spark, sf), ["o_custkey"])
    profile = seq.cluster_profile(seq.melt_sequences(labelled).where(F.col("label").isNotNull()))
    rounded = [F.round(c, 3).alias(c) for c in ["mean", "low", "high"]]
    return profile.select("label", "day", "cnt", *rounded)


@query(
    "j16_label_table",
    """SELECT o_custkey, max(CASE WHEN o_orderstatus = 'O' THEN CAST(c > 3 AS INTEGER) END) AS label_open,
         max(CASE WHEN o_orderstatus = 'F' THEN CAST(c > 3 AS INTEGER) END) AS label_filled,
         CAST(sum(c) > 10 AS INTEGER) AS label_total
       FROM (SELECT o_custkey, o_orderstatus, count(*) AS c FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def label_table(spark, sf):
    orders = table(spark, sf, "orders")

    def labelled(limit, status=None):
        rows = orders if status is None else orders.where(F.col("o_orderstatus") == status)
        return rows.groupBy("o_custkey").agg((F.count("*") > limit).cast("int").alias("label"))

    frames = {"open": labelled(3, "O"), "filled": labelled(3, "F"), "total": labelled(10)}
    return seq.label_table(frames, ["o_custkey"])


@query(
    "j17_melt_sequences",
    """SELECT vec_id, label, CAST(i AS INTEGER) AS day, CAST(embedding[i] AS DOUBLE) AS amount FROM embeddings, range(1, 65) r(i)""",
)
def melt_sequences(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("amounts"))
    return seq.melt_sequences(vectors)
