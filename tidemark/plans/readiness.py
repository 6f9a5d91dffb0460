"""Snapshot checks, readiness, job retries, corrections and binning on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import master, quality, readiness
from tidemark.operators import relational as rel
from tidemark.operators.nearest import standardise_products
from tidemark.operators.scorecard import optimal_binning as best_bins
from tidemark.operators.scorecard import woe_iv as evidence
from tidemark.plans.registry import query
from tidemark.session import table

# ---- snapshot checks ---------------------------------------------------------------------

EXPECTED = ["click", "error", "purchase", "signup", "view", "refund"]

Q1_SQL = """WITH cnt AS (SELECT event_type AS source_table, CAST(ts AS DATE) AS day, count(*) AS cnt FROM events GROUP BY 1, 2),
  days AS (SELECT CAST(unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM cnt),
  names AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view', 'refund']) AS source_table)
  SELECT source_table, day, coalesce(cnt, 0) AS cnt, CAST(coalesce(cnt, 0) > 0 AS INTEGER) AS status
  FROM days CROSS JOIN names LEFT JOIN cnt USING (source_table, day)
  WHERE NOT (source_table = 'purchase' AND dayofweek(day - 1) IN (0, 6)) AND NOT (source_table = 'signup' AND dayname(day) <> 'Monday')"""


def availability(spark, sf):
    name, day = F.col("source_table"), F.col("day")
    skip = ((name == "purchase") & F.dayofweek(F.date_sub(day, 1)).isin(1, 7)) | (
        (name == "signup") & (F.date_format(day, "EEEE") != "Monday")
    )
    return quality.snapshot_availability(table(spark, sf, "events"), "event_type", "ts", EXPECTED, skip)


@query("q1_snapshot_availability", Q1_SQL)
def snapshot_availability(spark, sf):
    return availability(spark, sf)


@query("q1_lowest_status", f"SELECT min(status) AS status FROM ({Q1_SQL})")
def lowest_status(spark, sf):
    return quality.lowest_status(availability(spark, sf))


Q2_SQL = """WITH d AS (SELECT DISTINCT event_type AS source_table, CAST(ts AS DATE) AS day FROM events),
  lastday AS (SELECT max(day) AS last FROM d),
  rep AS (SELECT source_table, day FROM d UNION SELECT source_table, day + 1 FROM d, lastday WHERE day + 1 <= last),
  cur AS (SELECT event_type AS source_table, CAST(ts AS DATE) AS day, user_id AS k FROM events),
  prev AS (SELECT event_type AS source_table, CAST(ts AS DATE) + 1 AS day, user_id AS k FROM events),
  j AS (SELECT coalesce(cur.source_table, prev.source_table) AS source_table, coalesce(cur.day, prev.day) AS day, cur.k AS ck, prev.k AS pk
        FROM cur FULL JOIN prev ON cur.source_table = prev.source_table AND cur.day = prev.day AND cur.k = prev.k),
  agg AS (SELECT source_table, day, count(ck) AS id, count(DISTINCT ck) AS unique_id, count(pk) AS prev_id,
                 count(CASE WHEN ck IS NULL AND pk IS NOT NULL THEN 1 END) AS missing_id FROM j GROUP BY 1, 2),
  dup AS (SELECT source_table, day, count(*) - count(DISTINCT k) AS dup_cnt FROM cur GROUP BY 1, 2)
  SELECT source_table, day, id, unique_id, prev_id, missing_id, coalesce(dup_cnt, 0) AS dup_cnt
  FROM rep JOIN agg USING (source_table, day) LEFT JOIN dup USING (source_table, day)"""


def growth(spark, sf):
    return quality.snapshot_growth(table(spark, sf, "events"), "event_type", "ts", F.col("user_id"))


@query("q2_duplicate_growth_check", Q2_SQL)
def duplicate_growth_check(spark, sf):
    return growth(spark, sf)


@query(
    "q3_compare_daily",
    f"""SELECT source_table, day, CAST(id <> unique_id AS INTEGER) AS duplicate_flag, CAST(missing_id > 0 AS INTEGER) AS missing_flag,
          CAST(NOT ok AS INTEGER) AS no_increase_flag, CAST(ok AS INTEGER) AS status
        FROM (SELECT *, id >= prev_id * CASE source_table WHEN 'view' THEN 0.999 WHEN 'click' THEN 0.999 ELSE 1 END AS ok FROM ({Q2_SQL}))""",
)
def compare_daily(spark, sf):
    tolerance = 0.999  # fixed value: share of yesterday's rows two tables may fall to
    return quality.snapshot_status(growth(spark, sf), {"view": tolerance, "click": tolerance})


@query(
    "q4_table_readiness",
    f"""WITH snap AS (SELECT source_table, min(status) AS s FROM ({Q1_SQL}) GROUP BY 1),
          grow AS (SELECT source_table, min(CAST(id >= prev_id AS INTEGER)) AS s FROM ({Q2_SQL}) GROUP BY 1),
          chk AS (SELECT event_type AS source_table, min(CAST(value < 480 AS INTEGER)) AS s FROM events GROUP BY 1)
        SELECT snap.source_table, least(snap.s, coalesce(grow.s, 1), coalesce(chk.s, 1)) AS status
        FROM snap LEFT JOIN grow USING (source_table) LEFT JOIN chk USING (source_table)""",
)
def table_readiness(spark, sf):
    snap = availability(spark, sf).select(F.concat(F.lit("dwh."), "source_table").alias("source_table"), "status")
    grown = quality.snapshot_status(growth(spark, sf)).select("source_table", "status")
    checkpoint = table(spark, sf, "events").select(
        F.col("event_type").alias("source_table"), rel.flag(F.col("value") < 480).alias("status")
    )
    return readiness.table_readiness(snap, {"growth": grown, "checkpoint": checkpoint}, [r"^dwh\."])


# ---- reports -----------------------------------------------------------------------------

REPORT = "CASE WHEN s_suppkey % 3 = 0 THEN 'branch_data_source_' ELSE 'core_data_source_' END || s_suppkey"
REPORT_OF = "CASE WHEN {k} % 3 = 0 THEN 'branch_data_source_' ELSE 'core_data_source_' END || {k}"

Q5_SQL = f"""WITH RECURSIVE base AS (
    SELECT s_suppkey AS k, {REPORT} AS report, 's' || s_nationkey AS source_table,
           CASE WHEN s_suppkey >= 2 THEN s_suppkey // 2 END AS dep FROM supplier),
  tstat AS (SELECT 's' || n_nationkey AS source_table, CAST(n_regionkey <> 2 AS INTEGER) AS status FROM nation WHERE n_nationkey <> 7),
  kept AS (SELECT b.k, b.report, b.dep, coalesce(t.status, 1) AS status FROM base b LEFT JOIN tstat t USING (source_table)
           WHERE dep IS NULL OR (k % 3 = 0) = (dep % 3 = 0)),
  reach AS (SELECT k, k AS cur FROM kept UNION SELECT r.k, kept.dep FROM reach r JOIN kept ON kept.k = r.cur WHERE kept.dep IS NOT NULL),
  carried AS (SELECT reach.k, min(kept.status) AS status FROM reach JOIN kept ON kept.k = reach.cur GROUP BY 1)
  SELECT kept.report, CASE WHEN s.s_acctbal > 9000 THEN 1 ELSE c.status END AS status,
         CAST(s.s_acctbal > 9000 AS INTEGER) AS export_status,
         CASE WHEN s.s_acctbal > 9000 THEN 'completed' WHEN c.status = 1 THEN 'eligible' ELSE 'pending' END AS class
  FROM kept JOIN carried c USING (k) JOIN supplier s ON s.s_suppkey = kept.k"""


def reports(spark, sf, mode="min"):
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")

    def name(k):
        prefix = F.when(k % 3 == 0, "branch_data_source_").otherwise("core_data_source_")
        return F.concat(prefix, k.cast("string"))

    key = F.col("s_suppkey")
    dep = F.when(key >= 2, F.floor(key / 2))
    tracing = supplier.select(
        name(key).alias("report"),
        F.concat(F.lit("raw_s"), F.col("s_nationkey").cast("string")).alias("source_table"),
        F.concat(F.lit("path/"), dep.cast("string")).alias("secondary_path"),
    )
    paths = supplier.select(F.concat(F.lit("path/"), key.cast("string")).alias("path"), name(key).alias("secondary_report"))
    exports = supplier.where(F.col("s_acctbal") > 9000).select(name(key).alias("report"), F.lit(1).alias("export_status"))
    status = nation.where(F.col("n_nationkey") != 7).select(
        F.concat(F.lit("s"), F.col("n_nationkey").cast("string")).alias("source_table"),
        rel.flag(F.col("n_regionkey") != 2).alias("status"),
    )
    return readiness.report_readiness(
        tracing, paths, exports, status, ("core_data_source", "branch_data_source"), ["^raw_"], mode
    )


@query("q5_report_readiness", Q5_SQL)
def report_readiness(spark, sf):
    return reports(spark, sf)


@query(
    "q6_readiness_cycle",
    f"""WITH rep AS ({Q5_SQL}), counts AS (SELECT {REPORT} AS report, s_suppkey AS seq, CAST(s_suppkey % 40 AS BIGINT) AS row_cnt FROM supplier),
        elig AS (SELECT report, seq, row_cnt FROM rep JOIN counts USING (report) WHERE class = 'eligible'),
        bad AS (SELECT min(seq) AS s FROM elig WHERE row_cnt <= 0)
        SELECT 'report' AS subject, report AS name, class AS message FROM rep
        UNION ALL SELECT 'run', report, CASE WHEN row_cnt > 0 THEN 'done' ELSE 'stopped' END FROM elig, bad WHERE s IS NULL OR seq <= s
        UNION ALL SELECT 'table', 's' || n_nationkey, 'remain data' FROM nation WHERE n_regionkey IN (2, 3)""",
)
def readiness_cycle(spark, sf):
    nation = table(spark, sf, "nation")
    name = F.concat(F.lit("s"), F.col("n_nationkey").cast("string")).alias("source_table")
    number = F.substring_index("report", "_", -1).cast("long")
    result = reports(spark, sf)
    key = F.col("s_suppkey")
    counts = table(spark, sf, "supplier").select(
        F.concat(F.when(key % 3 == 0, "branch_data_source_").otherwise("core_data_source_"), key.cast("string")).alias("report"),
        (key % 40).alias("row_cnt"),
    )
    return readiness.readiness_cycle(
        nation.select(name),
        nation.select(name, rel.flag(F.col("n_regionkey") < 2).alias("status")),
        nation.select(name, rel.flag(F.col("n_regionkey") == 4).alias("status")),
        result,
        counts,
        number,
    )


C13_SQL = """WITH RECURSIVE base AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey >= 2 THEN s_suppkey // 2 END AS dep,
    CAST(s_acctbal > 500 AS INTEGER) AS status FROM supplier),
  reach AS (SELECT k, k AS cur FROM base UNION SELECT r.k, b.dep FROM reach r JOIN base b ON b.k = r.cur WHERE b.dep IS NOT NULL)"""


def supplier_tree(spark, sf):
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        key.alias("k"), F.when(key >= 2, F.floor(key / 2)).alias("dep"), rel.flag(F.col("s_acctbal") > 500).alias("status")
    )


@query(
    "c13_dependency_fixpoint",
    C13_SQL + " SELECT reach.k, min(b.status) AS status, CAST(0 AS INTEGER) AS cycle FROM reach JOIN base b ON b.k = reach.cur GROUP BY 1",
)
def dependency_fixpoint(spark, sf):
    return readiness.dependency_fixpoint(supplier_tree(spark, sf), "k", "dep")


@query(
    "c13_dependency_replace",
    C13_SQL
    + """ SELECT reach.k, min(b.status) AS status, CAST(0 AS INTEGER) AS cycle FROM reach JOIN base b ON b.k = reach.cur
          WHERE b.dep IS NULL GROUP BY 1""",
)
def dependency_replace(spark, sf):
    return readiness.dependency_fixpoint(supplier_tree(spark, sf), "k", "dep", mode="replace")


# ---- jobs --------------------------------------------------------------------------------

# Job log: one job per user, error = FAILED, signup = STOPPED, purchase = SUCCEEDED. Running
# jobs and next runs come from the clicks and views around the last day's noon.
JOBS_SQL = """WITH n AS (SELECT date_trunc('day', max(ts)) + INTERVAL 12 HOUR AS now FROM events),
  log AS (SELECT user_id AS job_name, ts AS log_date, event_type FROM events, n WHERE CAST(ts AS DATE) = CAST(now AS DATE)),
  open AS (SELECT DISTINCT a.job_name FROM log a LEFT JOIN log b ON a.job_name = b.job_name AND b.event_type = 'purchase' AND b.log_date > a.log_date
           WHERE a.event_type IN ('error', 'signup') AND b.job_name IS NULL),
  running AS (SELECT DISTINCT user_id AS job_name FROM events, n WHERE event_type = 'click' AND ts BETWEEN now - INTERVAL 3 HOUR AND now),
  waiting AS (SELECT DISTINCT user_id AS job_name FROM events, n WHERE event_type = 'view' AND CAST(ts AS DATE) = CAST(now AS DATE) AND ts > now
              AND {wait} >= 10),
  todo AS (SELECT job_name FROM open WHERE job_name NOT IN (SELECT job_name FROM running) AND job_name NOT IN (SELECT job_name FROM waiting))"""
TOTAL_WAIT = "date_diff('microsecond', now, ts) // 60000000"
FIELD_WAIT = "(date_diff('microsecond', now, ts) // 60000000) % 60"


def unresolved(spark, sf, minute_field=False):
    events = table(spark, sf, "events")
    now = (F.date_trunc("day", events.agg(F.max("ts")).scalar()).cast("timestamp_ntz") + F.expr("INTERVAL 12 HOUR"))
    job, ts = F.col("user_id").alias("job_name"), F.col("ts")
    status = (
        F.when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "signup", "STOPPED")
        .when(F.col("event_type") == "purchase", "SUCCEEDED")
    )
    log = events.select(job, ts.alias("log_date"), status.alias("status"))
    clicks = events.where((F.col("event_type") == "click") & ts.between(now - F.expr("INTERVAL 3 HOUR"), now)).select(job)
    views = events.where(F.col("event_type") == "view").select(job, ts.alias("next_run_date"))
    return master.unresolved_jobs(log, clicks, views, now, minute_field=minute_field), now


@query("c9_unresolved_jobs", JOBS_SQL.format(wait=TOTAL_WAIT) + " SELECT job_name FROM todo")
def unresolved_jobs(spark, sf):
    return unresolved(spark, sf)[0]


@query("c9_unresolved_jobs_minute_field", JOBS_SQL.format(wait=FIELD_WAIT) + " SELECT job_name FROM todo")
def unresolved_jobs_minute_field(spark, sf):
    return unresolved(spark, sf, minute_field=True)[0]


@query(
    "g1_retry_list",
    JOBS_SQL.format(wait=TOTAL_WAIT) + " SELECT job_name, now + INTERVAL 1 MINUTE AS start_date FROM todo, n",
)
def retry_list(spark, sf):
    jobs, now = unresolved(spark, sf)
    return master.retry_list(jobs, now)


# ---- master data and scorecard -----------------------------------------------------------

MODE_SQL = """WITH best AS (SELECT p_name, p_brand AS right_code, codes FROM (SELECT p_name, p_brand,
    row_number() OVER (PARTITION BY p_name ORDER BY count(*) DESC, p_brand) AS rn, count(*) OVER (PARTITION BY p_name) AS codes
    FROM part GROUP BY 1, 2) WHERE rn = 1)"""


@query(
    "d7_mode_correction",
    MODE_SQL + " SELECT p_partkey, p_name, CASE WHEN codes >= 2 THEN right_code ELSE p_brand END AS p_brand FROM part JOIN best USING (p_name)",
)
def mode_correction(spark, sf):
    return master.mode_correction(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), "p_name", "p_brand")


@query("f3_top1_by_frequency", MODE_SQL + " SELECT p_name, right_code AS p_brand, codes FROM best")
def top1_by_frequency(spark, sf):
    return master.most_frequent_code(table(spark, sf, "part"), "p_name", "p_brand")


TARGETS = """WITH targets AS (SELECT l_orderkey, l_linenumber, l_partkey, 'Brand#' || (l_suppkey % 30) AS p_brand,
    l_extendedprice / l_quantity AS price FROM lineitem), wanted AS (SELECT DISTINCT p_brand, CAST(trunc(price) AS BIGINT) AS price_key FROM targets)"""
MATCHED = """, pairs AS (SELECT w.*, p_name, p_type, p_partkey, abs(price_key - CAST(trunc(p_retailprice) AS BIGINT)) AS gap
    FROM wanted w JOIN part USING (p_brand)),
  best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, price_key ORDER BY gap, length(p_name) DESC, p_name, p_type, p_partkey) AS rn FROM pairs) WHERE rn = 1)"""


def standardised(spark, sf):
    targets = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 30).cast("string")).alias("p_brand"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
    )
    products = table(spark, sf, "part").select("p_brand", F.col("p_retailprice").alias("price"), "p_name", "p_type", "p_partkey")
    return standardise_products(targets, products, "p_brand", "price", "p_name", ["p_type", "p_partkey"])


@query(
    "g2_product_standardise",
    TARGETS
    + MATCHED
    + """ SELECT t.l_orderkey, t.l_linenumber, t.p_brand, b.p_name AS std_name, b.gap AS price_gap, b.p_type AS std_p_type, b.p_partkey AS std_p_partkey
          FROM targets t LEFT JOIN best b ON t.p_brand = b.p_brand AND CAST(trunc(t.price) AS BIGINT) = b.price_key""",
)
def product_standardise(spark, sf):
    return standardised(spark, sf).drop("price")


@query(
    "c12_best_match_lookup",
    TARGETS + MATCHED + " SELECT p_brand, count(*) AS prices, min(gap) AS min_gap, max(gap) AS max_gap FROM best GROUP BY 1",
)
def best_match_lookup(spark, sf):
    found = standardised(spark, sf).where(F.col("std_name").isNotNull())
    prices = found.select("p_brand", F.col("price").cast("long").alias("price_key"), "price_gap").distinct()
    return prices.groupBy("p_brand").agg(
        F.count("*").alias("prices"), F.min("price_gap").alias("min_gap"), F.max("price_gap").alias("max_gap")
    )


@query(
    "f5_longest_string_pick",
    """SELECT p_brand, p_name, length FROM (SELECT p_brand, p_name, CAST(length(p_name) AS INTEGER) AS length,
         row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name) DESC, p_name) AS rn FROM part) WHERE rn = 1""",
)
def longest_string_pick(spark, sf):
    pick = F.min(F.struct((-F.length("p_name")).alias("neg"), F.col("p_name"))).alias("pick")
    best = table(spark, sf, "part").groupBy("p_brand").agg(pick)
    return best.select("p_brand", "pick.p_name", (-F.col("pick.neg")).alias("length"))


@query(
    "d20_woe_iv",
    """WITH b AS (SELECT CAST((l_quantity > 10) AS INTEGER) + CAST((l_quantity > 25) AS INTEGER) + CAST((l_quantity > 40) AS INTEGER) AS bin,
              CAST(sum(CAST(l_returnflag = 'R' AS INTEGER)) AS BIGINT) AS good, CAST(sum(CAST(l_returnflag <> 'R' AS INTEGER)) AS BIGINT) AS bad FROM lineitem GROUP BY 1),
            s AS (SELECT *, good / sum(good) OVER () AS g, bad / sum(bad) OVER () AS d FROM b)
       SELECT bin, good, bad, round(ln(g / d), 9) AS woe, round((g - d) * ln(g / d), 12) AS iv, round(good / (good + bad), 9) AS rate,
              round(sum((g - d) * ln(g / d)) OVER (), 12) AS total_iv FROM s""",
)
def woe_iv(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", rel.flag(F.col("l_returnflag") == "R").alias("returned"))
    out = evidence(li, "l_quantity", "returned", [10, 25, 40])
    digits = {"woe": 9, "iv": 12, "rate": 9, "total_iv": 12}
    return out.select("bin", "good", "bad", *[F.round(c, n).alias(c) for c, n in digits.items()])


@query(
    "g3_optimal_binning",
    """WITH cut AS (SELECT quantile_cont(l_quantity, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS c FROM lineitem),
         fine AS (SELECT len(list_filter(c, lambda e: e < l_quantity)) AS f, sum(CAST(l_returnflag = 'R' AS INTEGER)) AS good,
                         sum(CAST(l_returnflag <> 'R' AS INTEGER)) AS bad FROM lineitem, cut GROUP BY 1),
         splits AS (SELECT [a.i, b.i, c.i, d.i] AS picks, row_number() OVER (ORDER BY a.i, b.i, c.i, d.i) AS split
                    FROM range(0, 10) a(i), range(0, 10) b(i), range(0, 10) c(i), range(0, 10) d(i) WHERE a.i < b.i AND b.i < c.i AND c.i < d.i),
         merged AS (SELECT split, any_value(picks) AS picks, len(list_filter(picks, lambda i: i > 0 AND i <= f)) AS g, sum(good) AS good, sum(bad) AS bad
                    FROM splits, fine GROUP BY split, len(list_filter(picks, lambda i: i > 0 AND i <= f))),
         shares AS (SELECT *, good / sum(good) OVER (PARTITION BY split) AS gs, bad / sum(bad) OVER (PARTITION BY split) AS bs,
                    (good + bad) / sum(good + bad) OVER (PARTITION BY split) AS pct FROM merged),
         scored AS (SELECT split, sum((gs - bs) * ln(gs / bs)) AS total_iv, any_value(picks) AS picks, count(*) AS n FROM shares GROUP BY 1
                    HAVING min(pct) >= 0.05 AND min(good) > 0 AND min(bad) > 0),
         edged AS (SELECT split, total_iv, n, list_sort(list_distinct(list_transform(list_filter(picks, lambda i: i > 0), lambda i: c[i]))) AS edges FROM scored, cut),
         best AS (SELECT * FROM edged WHERE n = len(edges) + 1 ORDER BY total_iv DESC, split LIMIT 1)
       SELECT CAST(row_number() OVER (ORDER BY g) AS INTEGER) AS bin, edges[row_number() OVER (ORDER BY g)] AS upper_edge, CAST(good AS BIGINT) AS good, CAST(bad AS BIGINT) AS bad,
              round(ln(gs / bs), 9) AS woe, round((gs - bs) * ln(gs / bs), 12) AS iv, round(good / (good + bad), 9) AS rate, round(pct, 9) AS pct,
              round(total_iv, 12) AS total_iv FROM shares JOIN best USING (split)""",
)
def optimal_binning(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", rel.flag(F.col("l_returnflag") == "R").alias("returned"))
    out = best_bins(li, "l_quantity", "returned")
    digits = {"woe": 9, "iv": 12, "rate": 9, "pct": 9, "total_iv": 12}
    return out.select("bin", "upper_edge", "good", "bad", *[F.round(c, n).alias(c) for c, n in digits.items()])
