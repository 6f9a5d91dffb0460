"""Filters, projections, joins, aggregates, ordering and set operations on the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import relational as rel
from tidemark.plans.registry import query
from tidemark.session import broadcast_if_small, table


# ---- filters and projections -------------------------------------------------------------


@query(
    "b1_filter_and",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_returnflag = 'R' AND l_quantity > 30""",
)
def filter_and(spark, sf):
    li = table(spark, sf, "lineitem")
    kept = li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 30))
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "b2_filter_in_between",
    """SELECT o_orderkey, o_orderpriority, CAST(month(o_orderdate) AS INTEGER) AS order_month FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND month(o_orderdate) BETWEEN 7 AND 9""",
)
def filter_in_between(spark, sf):
    orders = table(spark, sf, "orders")
    month = F.month("o_orderdate")
    kept = orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & month.between(7, 9))
    return kept.select("o_orderkey", "o_orderpriority", month.alias("order_month"))


@query(
    "b3_filter_from_date",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'",
)
def filter_from_date(spark, sf):
    orders = table(spark, sf, "orders")
    start = F.lit("2000-01-01").cast("timestamp_ntz")
    return orders.where(F.col("o_orderdate") >= start).select("o_orderkey", "o_orderdate")


@query("b4_filter_equal", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '5-LOW'")
def filter_equal(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where(F.col("o_orderpriority") == "5-LOW").select("o_orderkey", "o_totalprice")


@query(
    "b5_filter_not_null",
    """SELECT c_custkey, (max(o_orderkey) IS NOT NULL) AS has_orders, count(o_orderkey) AS orders_cnt
       FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' GROUP BY c_custkey""",
)
def filter_not_null(spark, sf):
    counts = (
        table(spark, sf, "orders")
        .where(F.col("o_orderstatus") == "P")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("o_orderkey").alias("orders_cnt"))
    )
    joined = table(spark, sf, "customer").select("c_custkey").join(counts, "c_custkey", "left")
    with_orders = joined.where(F.col("orders_cnt").isNotNull()).withColumn("has_orders", F.lit(True))
    without = joined.where(F.col("orders_cnt").isNull()).withColumn("has_orders", F.lit(False))
    return with_orders.unionByName(without.na.fill(0, ["orders_cnt"]))


@query(
    "b6_filter_in_other_table",
    """SELECT c_custkey, 'in' AS side FROM customer c
         WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_orderstatus = 'P')
       UNION ALL SELECT c_custkey, 'out' FROM customer c
         WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_orderstatus = 'P')""",
)
def filter_in_other_table(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey")
    listed = (
        table(spark, sf, "orders")
        .where(F.col("o_orderstatus") == "P")
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    inside = rel.keep_listed(customers, listed, ["c_custkey"]).withColumn("side", F.lit("in"))
    outside = rel.drop_listed(customers, listed, ["c_custkey"]).withColumn("side", F.lit("out"))
    return inside.unionByName(outside)


@query("b7_project_rename", "SELECT o_orderdate AS ds, o_totalprice AS y FROM orders")
def project_rename(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderdate").alias("ds"), F.col("o_totalprice").alias("y"))


@query(
    "b8_derived_ratio",
    """SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS cnt,
         round(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*), 6) AS late_rate,
         round(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)
               / nullif(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END), 0), 6) AS late_per_pending
       FROM orders GROUP BY 1""",
)
def derived_ratio(spark, sf):
    daily = (
        table(spark, sf, "orders")
        .groupBy(F.to_date("o_orderdate").alias("day"))
        .agg(
            F.count("*").alias("cnt"),
            F.count_if(F.col("o_orderstatus") == "F").alias("late"),
            F.count_if(F.col("o_orderstatus") == "P").alias("pending"),
        )
    )
    return daily.select(
        "day",
        "cnt",
        F.round(F.try_divide("late", "cnt"), 6).alias("late_rate"),
        F.round(F.try_divide("late", "pending"), 6).alias("late_per_pending"),
    )


@query(
    "b9_conditional_column",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END AS size_class FROM orders""",
)
def conditional_column(spark, sf):
    size = F.when(F.col("o_totalprice") > 250000, "large").otherwise("small")
    return table(spark, sf, "orders").select("o_orderkey", size.alias("size_class"))


@query(
    "b10_bool_flag",
    """SELECT c_custkey, CAST(coalesce(max(o_totalprice) > 400000, false) AS INTEGER) AS has_large
       FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""",
)
def bool_flag(spark, sf):
    top = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("top"))
    joined = table(spark, sf, "customer").select("c_custkey").join(top, "c_custkey", "left")
    return joined.select("c_custkey", rel.flag(F.col("top") > 400000).alias("has_large"))


@query(
    "b11_fill_null",
    """SELECT c_custkey, c_name, coalesce(cnt, 0) AS cnt, coalesce(status, 1) AS status, note FROM customer
       LEFT JOIN (SELECT o_custkey, count(*) AS cnt, min(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END) AS status,
                         min(o_orderpriority) AS note FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def fill_null(spark, sf):
    per_customer = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count("*").alias("cnt"),
            F.min(F.when(F.col("o_orderstatus") == "F", 0).otherwise(1)).alias("status"),
            F.min("o_orderpriority").alias("note"),
        )
    )
    joined = table(spark, sf, "customer").select("c_custkey", "c_name").join(per_customer, "c_custkey", "left")
    return joined.na.fill({"cnt": 0, "status": 1})


@query(
    "b12_row_min",
    """SELECT o_orderkey, least(CAST(o_totalprice > 1000 AS INTEGER), CAST(o_orderstatus <> 'F' AS INTEGER),
              CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderpriority <> '1-URGENT' AS INTEGER) END) AS status
       FROM orders""",
)
def row_min(spark, sf):
    checks = table(spark, sf, "orders").select(
        "o_orderkey",
        rel.flag(F.col("o_totalprice") > 1000).alias("status_price"),
        rel.flag(F.col("o_orderstatus") != "F").alias("status_open"),
        F.when(F.col("o_orderpriority") != "5-LOW", rel.flag(F.col("o_orderpriority") != "1-URGENT")).alias("status_priority"),
    )
    return checks.select("o_orderkey", rel.row_min(checks, "status_").alias("status"))


@query(
    "b13_prefix_exclusion",
    """SELECT p_partkey, p_name, p_type FROM part WHERE NOT (
         (upper(p_name) LIKE 'RED%' AND upper(p_type) LIKE 'ECO%')
         OR (upper(p_name) LIKE 'ECO%' AND upper(p_type) LIKE 'RED%'))""",
)
def prefix_exclusion(spark, sf):
    part = table(spark, sf, "part")
    mixed = rel.different_sources(F.col("p_name"), F.col("p_type"), "red", "eco")
    return part.where(~mixed).select("p_partkey", "p_name", "p_type")


@query(
    "b14_contains_filter_then_path",
    r"""SELECT page_id, split_part(regexp_replace(url, '^https?://', ''), '/', 1) AS host,
          replace(substr(regexp_replace(url, '^https?://', ''),
                         strpos(regexp_replace(url, '^https?://', ''), '/') + 1), '/*', '') AS path
        FROM pages WHERE contains(url, 'example.com')""",
)
def contains_filter_then_path(spark, sf):
    bare = F.regexp_replace("url", "^https?://", "")
    pages = table(spark, sf, "pages").where(F.col("url").contains("example.com")).withColumn("bare", bare)
    path = F.expr("substr(bare, instr(bare, '/') + 1)")
    return pages.select(
        "page_id",
        F.substring_index("bare", "/", 1).alias("host"),
        F.replace(path, F.lit("/*"), F.lit("")).alias("path"),
    )


# ---- joins -------------------------------------------------------------------------------


@query(
    "c1_inner_using",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def inner_using(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return orders.join(table(spark, sf, "customer"), "c_custkey", "inner").select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "c2_left_using",
    """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey""",
)
def left_using(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").select("c_custkey").join(orders, "c_custkey", "left")


@query(
    "c3_left_multi_condition",
    """SELECT o_orderkey, o_custkey, c_name FROM orders
       LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'""",
)
def left_multi_condition(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    joined = rel.left_join_matching(orders, customers, "o_custkey", "c_custkey", F.col("c_mktsegment") == "BUILDING")
    return joined.drop("c_mktsegment")


@query(
    "c4_broadcast_hint",
    """SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def broadcast_hint(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("n_nationkey"))
    nation = broadcast_if_small(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    return customers.join(nation, "n_nationkey").groupBy("n_name").agg(F.count("*").alias("customers"))


@query(
    "c5_left_merge_multi_key",
    """SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, s.cnt FROM orders o
       LEFT JOIN (SELECT o_custkey, o_orderstatus, count(*) AS cnt FROM orders
                  WHERE o_totalprice > 200000 GROUP BY 1, 2) s
       ON o.o_custkey = s.o_custkey AND o.o_orderstatus = s.o_orderstatus""",
)
def left_merge_multi_key(spark, sf):
    keys = ["o_custkey", "o_orderstatus"]
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", *keys)
    summary = orders.where(F.col("o_totalprice") > 200000).groupBy(*keys).agg(F.count("*").alias("cnt"))
    return orders.drop("o_totalprice").join(summary, keys, "left")


@query(
    "c6_left_merge_diff_keys",
    """SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def left_merge_diff_keys(spark, sf):
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    joined = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
    return joined.select("s_suppkey", "s_name", "n_name")


@query(
    "c7_chained_left_merge",
    """WITH snap AS (SELECT c_custkey AS k, CAST(c_acctbal > 0 AS INTEGER) AS status FROM customer),
            growth AS (SELECT o_custkey AS k, min(CAST(o_totalprice > 1500 AS INTEGER)) AS status FROM orders GROUP BY 1),
            checkpoint AS (SELECT o_custkey AS k, min(CAST(o_orderstatus <> 'P' AS INTEGER)) AS status
                           FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
       SELECT s.k AS c_custkey, s.status AS status_snap, coalesce(g.status, 1) AS status_growth,
              coalesce(c.status, 1) AS status_checkpoint
       FROM snap s LEFT JOIN growth g ON s.k = g.k LEFT JOIN checkpoint c ON s.k = c.k""",
)
def chained_left_merge(spark, sf):
    orders = table(spark, sf, "orders")
    key = F.col("o_custkey").alias("c_custkey")
    snap = table(spark, sf, "customer").select("c_custkey", rel.flag(F.col("c_acctbal") > 0).alias("status_snap"))
    growth = orders.select(key, rel.flag(F.col("o_totalprice") > 1500).alias("status"))
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT")
    checkpoint = urgent.select(key, rel.flag(F.col("o_orderstatus") != "P").alias("status"))
    return rel.merge_statuses(snap, {"growth": growth, "checkpoint": checkpoint}, "c_custkey")


@query(
    "c8_full_outer_reconcile",
    """WITH cur AS (SELECT user_id, event_type, count(*) AS cur_cnt FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1, 2),
            prev AS (SELECT user_id, event_type, count(*) AS prev_cnt FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1, 2)
       SELECT coalesce(cur.user_id, prev.user_id) AS user_id, coalesce(cur.event_type, prev.event_type) AS event_type,
              cur_cnt, prev_cnt,
              CASE WHEN cur_cnt IS NULL THEN 'missing' WHEN prev_cnt IS NULL THEN 'new' ELSE 'kept' END AS state
       FROM cur FULL JOIN prev ON cur.user_id = prev.user_id AND cur.event_type = prev.event_type""",
)
def full_outer_reconcile(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "ts")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    return rel.reconcile_counts(
        events.where(F.col("ts") >= middle), events.where(F.col("ts") < middle), ["user_id", "event_type"]
    )


# ---- aggregates --------------------------------------------------------------------------


@query(
    "d1_group_multi_agg",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(avg(l_quantity), 4) AS avg_qty,
              count(l_quantity) AS cnt, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
       FROM lineitem GROUP BY 1, 2""",
)
def group_multi_agg(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.sum("L_Quantity"), 2).alias("sum_qty"),
            F.round(F.avg("l_quantity"), 4).alias("avg_qty"),
            F.count("l_quantity").alias("cnt"),
            F.min("l_extendedprice").alias("min_price"),
            F.max("l_extendedprice").alias("max_price"),
        )
    )


@query("d2_global_count", "SELECT count(*) AS cnt FROM lineitem")
def global_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count("*").alias("cnt"))


@query(
    "d3_describe",
    """WITH long AS (SELECT 'l_quantity' AS column_name, l_quantity AS v FROM lineitem
                     UNION ALL SELECT 'l_discount', l_discount FROM lineitem
                     UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem)
       SELECT column_name, count(v) AS cnt, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS stddev, min(v) AS min,
              max(v) AS max, round(quantile_cont(v, 0.25), 4) AS p25, round(quantile_cont(v, 0.5), 4) AS p50,
              round(quantile_cont(v, 0.75), 4) AS p75
       FROM long GROUP BY 1""",
)
def describe(spark, sf):
    out = rel.describe_long(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_extendedprice"])
    return out.select(
        "column_name", "cnt", "min", "max", *[F.round(c, 4).alias(c) for c in ["mean", "stddev", "p25", "p50", "p75"]]
    )


@query("d4_value_counts", "SELECT o_orderstatus, count(*) AS cnt FROM orders GROUP BY 1")
def value_counts(spark, sf):
    return rel.value_counts(table(spark, sf, "orders"), "o_orderstatus")


@query(
    "d5_value_counts_multi",
    """SELECT label, count(*) FILTER (WHERE s = 1) AS l_returnflag, count(*) FILTER (WHERE s = 2) AS l_linestatus,
              count(*) FILTER (WHERE s = 3) AS l_linenumber
       FROM (SELECT 1 AS s, l_returnflag AS label FROM lineitem UNION ALL SELECT 2, l_linestatus FROM lineitem
             UNION ALL SELECT 3, CAST(l_linenumber AS VARCHAR) FROM lineitem) GROUP BY 1""",
)
def value_counts_multi(spark, sf):
    return rel.value_counts_multi(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query(
    "d6_distinct_having",
    "SELECT p_name, count(DISTINCT p_brand) AS codes FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) >= 2",
)
def distinct_having(spark, sf):
    codes = table(spark, sf, "part").groupBy("p_name").agg(F.countDistinct("p_brand").alias("codes"))
    return codes.where(F.col("codes") >= 2)


@query(
    "d8_pivot_sum",
    """SELECT o_orderstatus, """
    + ", ".join(
        f"""round(coalesce(sum(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice END), 0), 2) AS "{p}" """
        for p in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    )
    + "FROM orders GROUP BY 1",
)
def pivot_sum(spark, sf):
    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    wide = rel.pivot_sum(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", "o_totalprice", priorities)
    return wide.select("o_orderstatus", *[F.round(F.col(f"`{p}`"), 2).alias(p) for p in priorities])


@query(
    "d9_share_of_total",
    """SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total,
              round(sum(o_totalprice) / (SELECT sum(o_totalprice) FROM orders), 6) AS share FROM orders GROUP BY 1""",
)
def share_of_total(spark, sf):
    out = rel.share_of_total(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice")
    return out.select("o_orderpriority", F.round("total", 2).alias("total"), F.round("share", 6).alias("share"))


@query(
    "d10_crosstab_totals",
    """SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'Total' ELSE o_orderpriority END AS o_orderpriority,
              CASE WHEN grouping(o_orderstatus) = 1 THEN 'Total' ELSE o_orderstatus END AS o_orderstatus,
              round(sum(o_totalprice), 2) AS amount,
              CAST(2 * grouping(o_orderpriority) + grouping(o_orderstatus) AS INTEGER) AS level
       FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""",
)
def crosstab_totals(spark, sf):
    out = rel.crosstab_totals(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", "o_totalprice")
    return out.withColumn("amount", F.round("amount", 2))


@query(
    "d10_crosstab_check",
    """SELECT round(sum(o_totalprice), 2) AS row_total, round(sum(o_totalprice), 2) AS column_total,
              round(sum(o_totalprice), 2) AS grand_total, true AS agree FROM orders""",
)
def crosstab_check(spark, sf):
    cross = rel.crosstab_totals(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", "o_totalprice")
    check = rel.totals_agree(cross)
    totals = ["row_total", "column_total", "grand_total"]
    return check.select(*[F.round(c, 2).alias(c) for c in totals], "agree")


@query(
    "d11_min_rollup",
    """SELECT n_regionkey AS report, min(low) AS status FROM (
         SELECT n_regionkey, s_nationkey, min(CAST(s_acctbal > 0 AS INTEGER)) AS low
         FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2) GROUP BY 1""",
)
def min_rollup(spark, sf):
    pairs = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    by_pair = (
        pairs.where(F.col("n_regionkey").isNotNull() & F.col("s_nationkey").isNotNull())
        .groupBy(F.col("n_regionkey").alias("report"), "s_nationkey")
        .agg(F.min(rel.flag(F.col("s_acctbal") > 0)).alias("low"))
    )
    return by_pair.groupBy("report").agg(F.min("low").alias("status"))


_COUNTED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
_COUNTED += ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@query(
    "d13_row_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS cnt FROM {n}" for n in _COUNTED)
    + " UNION ALL SELECT 'absent', CAST(NULL AS BIGINT)",
)
def row_counts(spark, sf):
    sources = {n: (lambda n=n: table(spark, sf, n)) for n in [*_COUNTED, "absent"]}
    return rel.row_counts(sources)


@query("d14_max_value_watermark", "SELECT event_type, max(ts) AS watermark FROM events GROUP BY 1")
def max_value_watermark(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.max("ts").alias("watermark"))


@query(
    "d19_fill_rate",
    """SELECT c_mktsegment, round(100.0 * count(o) / count(*), 4) AS fill_pct FROM customer
       LEFT JOIN (SELECT DISTINCT o_custkey AS o FROM orders WHERE o_orderstatus = 'P') ON o = c_custkey GROUP BY 1""",
)
def fill_rate(spark, sf):
    matched = (
        table(spark, sf, "orders")
        .where(F.col("o_orderstatus") == "P")
        .select(F.col("o_custkey").alias("c_custkey"))
        .distinct()
        .withColumn("hit", F.lit(True))
    )
    joined = table(spark, sf, "customer").select("c_custkey", "c_mktsegment").join(matched, "c_custkey", "left")
    pct = F.avg(F.col("hit").isNotNull().cast("double")) * 100
    return joined.groupBy("c_mktsegment").agg(F.round(pct, 4).alias("fill_pct"))


# ---- ordering and limits -----------------------------------------------------------------


@query(
    "f1_sort",
    """SELECT o_orderstatus, day, cnt, row_number() OVER (PARTITION BY o_orderstatus ORDER BY cnt DESC, day) AS pos
       FROM (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS day, count(*) AS cnt FROM orders GROUP BY 1, 2)""",
)
def sort(spark, sf):
    daily = table(spark, sf, "orders").groupBy("o_orderstatus", F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("cnt"))
    order = Window.partitionBy("o_orderstatus").orderBy(F.desc("cnt"), "day")
    ranked = daily.withColumn("pos", F.row_number().over(order).cast("long"))
    return ranked.orderBy("o_orderstatus", "pos")


@query(
    "f2_limit",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 1",
)
def limit(spark, sf):
    ordered = table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return ordered.offset(1).limit(10)


@query(
    "f4_stop_at_first_failure",
    """WITH runs AS (SELECT user_id AS seq, count(*) FILTER (WHERE event_type = 'signup') AS row_cnt FROM events GROUP BY 1),
            first_bad AS (SELECT min(seq) AS s FROM runs WHERE row_cnt < 5)
       SELECT seq, row_cnt, CASE WHEN row_cnt >= 5 THEN 'done' ELSE 'stopped' END AS outcome
       FROM runs, first_bad WHERE s IS NULL OR seq <= s""",
)
def stop_at_first_failure(spark, sf):
    runs = (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("seq"))
        .agg(F.count_if(F.col("event_type") == "signup").alias("row_cnt"))
    )
    return rel.rows_before_first_failure(runs, "seq", F.col("row_cnt") >= 5)


# ---- set operations ----------------------------------------------------------------------


@query(
    "s1_union",
    """SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def union(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("s2_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def distinct(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type").dropDuplicates()


@query(
    "s3_remaining",
    """SELECT DISTINCT c_custkey AS k FROM customer c WHERE NOT EXISTS (
         SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_totalprice > 450000)""",
)
def remaining(spark, sf):
    required = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    completed = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("k"), rel.flag(F.col("o_totalprice") > 450000).alias("status")
    )
    return rel.remaining(required, completed, "k")


@query(
    "s4_force_complete",
    """SELECT DISTINCT c_custkey AS k FROM customer c
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_totalprice > 450000)
         AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_orderstatus = 'P')""",
)
def force_complete(spark, sf):
    orders = table(spark, sf, "orders")
    key = F.col("o_custkey").alias("k")
    seen = orders.select(key, rel.flag(F.col("o_totalprice") > 450000).alias("status"))
    prefixed = orders.where(F.col("o_orderstatus") == "P").select(F.concat(F.lit("forced_"), "o_custkey").alias("name"))
    forced = prefixed.select(F.regexp_replace("name", "^forced_", "").cast("long").alias("k"), F.lit(1).alias("status"))
    required = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return rel.remaining(required, rel.best_status([seen, forced], "k"), "k")


@query(
    "s5_three_way_partition",
    """SELECT CASE WHEN o_orderstatus = 'P' THEN 'completed' WHEN o_totalprice > 200000 THEN 'eligible' ELSE 'pending' END AS class,
              count(*) AS cnt FROM orders GROUP BY 1""",
)
def three_way_partition(spark, sf):
    status = rel.flag(F.col("o_totalprice") > 200000)
    exported = rel.flag(F.col("o_orderstatus") == "P")
    classed = table(spark, sf, "orders").withColumn("class", rel.readiness_class(status, exported))
    return classed.groupBy("class").agg(F.count("*").alias("cnt"))
