"""Scalar functions on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as fn
from tidemark.operators import series
from tidemark.plans.registry import query
from tidemark.session import table


@query(
    "h1_build_timestamp",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL
              ELSE o_orderdate + to_hours(o_orderkey % 24) + INTERVAL 5 MINUTE END AS built FROM orders""",
)
def build_timestamp(spark, sf):
    d = F.col("o_orderdate")
    hour = F.when(F.col("o_orderkey") % 7 == 0, F.lit("noon")).otherwise(
        F.concat((F.col("o_orderkey") % 24).cast("string"), F.lit(":05"))
    )
    parts = fn.build_timestamp(*[f(d).cast("string") for f in (F.year, F.month, F.dayofmonth)], hour)
    return table(spark, sf, "orders").select("o_orderkey", parts.alias("built"))


@query(
    "h2_month_and_day",
    """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(day(o_orderdate) AS INTEGER) AS day FROM orders""",
)
def month_and_day(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", fn.month_of(d).alias("month"), fn.day_of(d).alias("day"))


@query(
    "h3_nearest_due_day",
    """SELECT o_orderkey, CAST(due AS DATE) AS due, CAST(date_diff('day', due, CAST(o_orderdate AS DATE)) AS INTEGER) AS days_since
       FROM (SELECT *, CAST(CASE WHEN day(o_orderdate) >= 4 THEN date_trunc('month', o_orderdate)
                       ELSE date_trunc('month', o_orderdate) - INTERVAL 1 MONTH END + INTERVAL 3 DAY AS DATE) AS due FROM orders)""",
)
def nearest_due_day(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", fn.nearest_due_date(d).alias("due"), fn.days_since_due(d).alias("days_since")
    )


@query(
    "h4_month_and_days",
    """SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month_number,
              CAST(day(last_day(o_orderdate)) AS INTEGER) AS days_in_month FROM orders""",
)
def month_and_days(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.month(d).alias("month_number"), fn.days_in_month(d).alias("days_in_month")
    )


@query(
    "h5_today_string",
    "SELECT DISTINCT strftime(o_orderdate, '%d%b%Y') AS short_text, strftime(o_orderdate, '%d%m%Y') AS digits FROM orders",
)
def today_string(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        F.date_format(d, "ddMMMyyyy").alias("short_text"), F.date_format(d, "ddMMyyyy").alias("digits")
    ).distinct()


@query(
    "h6_text_to_local_time",
    """SELECT event_id, date_trunc('second', ts) + INTERVAL 7 HOUR AS local_time,
              CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) ELSE NULL END AS one_format FROM events""",
)
def text_to_local_time(spark, sf):
    # fixed values: accepted text formats and target zone
    formats = ["yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss"]
    zone = "Asia/Ho_Chi_Minh"
    text = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", formats[0])).otherwise(F.date_format("ts", formats[1]))
    events = table(spark, sf, "events").select("event_id", text.alias("text"))
    return events.select(
        "event_id",
        fn.text_to_local_time(F.col("text"), formats, zone).alias("local_time"),
        fn.text_to_local_time(F.col("text"), formats[:1]).alias("one_format"),
    )


_HOLIDAYS = "SELECT CAST(o_orderdate AS DATE) AS holiday FROM orders GROUP BY 1 HAVING count(*) >= 12"


@query(
    "h7_is_workingday",
    f"""SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(dayofweek(o_orderdate) NOT IN (0, 6)
          AND CAST(o_orderdate AS DATE) NOT IN ({_HOLIDAYS}) AS INTEGER) AS working FROM orders""",
)
def is_workingday(spark, sf):
    days = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("cnt"))
    holidays = days.where(F.col("cnt") >= 12).select(F.col("day").alias("holiday"))
    return series.working_days(days.select("day"), "day", holidays)


@query("h8_strip_prefix", "SELECT p_partkey, regexp_replace(p_name, 'small |red ', '', 'g') AS short_name FROM part")
def strip_prefix(spark, sf):
    short = fn.strip_prefixes(F.col("p_name"), ["small ", "red "])
    return table(spark, sf, "part").select("p_partkey", short.alias("short_name"))


@query("h9_parse_number", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price FROM orders")
def parse_number(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.format_number("o_totalprice", 2))
    return table(spark, sf, "orders").select("o_orderkey", fn.parse_number(text).alias("price"))


@query(
    "h10_json_array_text",
    """SELECT event_id, '[' || k || ',' || (k + 1) || ']' AS features, CAST(2 * k + 1 AS DOUBLE) AS total
       FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def json_array_text(spark, sf):
    k = F.from_json("props", "k long").getField("k")
    events = table(spark, sf, "events").select("event_id", F.to_json(F.array(k, k + 1)).alias("features"))
    total = F.aggregate(fn.json_to_doubles(F.col("features")), F.lit(0.0), lambda a, x: a + x)
    return events.select("event_id", "features", total.alias("total"))


@query(
    "h11_truncate_day_minute",
    """SELECT event_id, date_trunc('day', ts) AS day, CAST(extract(minute FROM ts) AS INTEGER) AS minute_field,
              CAST(floor(date_diff('microsecond', date_trunc('day', ts), ts) / 60000000) AS BIGINT) AS minutes FROM events""",
)
def truncate_day_minute(spark, sf):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    events = table(spark, sf, "events").withColumn("day", day)
    ts, start = F.col("ts"), F.col("day")
    return events.select(
        "event_id",
        "day",
        fn.minutes_until(ts, start, field_only=True).alias("minute_field"),
        fn.minutes_until(ts, start).alias("minutes"),
    )


@query(
    "h12_null_or_default",
    """SELECT c_custkey, coalesce(last_day, DATE '2001-08-01') AS last_day FROM customer
       LEFT JOIN (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def null_or_default(spark, sf):
    last = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.to_date(F.max("o_orderdate")).alias("last_day"))
    joined = table(spark, sf, "customer").select("c_custkey").join(last, "c_custkey", "left")
    return joined.select("c_custkey", F.coalesce("last_day", F.lit("2001-08-01").cast("date")).alias("last_day"))


@query(
    "h13_fuzzy_ratio",
    """WITH common AS (SELECT p_brand, p_name AS common_name FROM (SELECT p_brand, p_name, row_number() OVER (
              PARTITION BY p_brand ORDER BY count(*) DESC, p_name) AS rn FROM part GROUP BY 1, 2) WHERE rn = 1)
       SELECT p_partkey, common_name, round(100.0 * (greatest(length(p_name), length(common_name))
              - levenshtein(p_name, common_name)) / greatest(length(p_name), length(common_name)), 4) AS ratio
       FROM part JOIN common USING (p_brand)""",
)
def fuzzy_ratio(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    counts = part.groupBy("p_brand", "p_name").agg(F.count("*").alias("n"))
    common = counts.groupBy("p_brand").agg(F.min(F.struct(-F.col("n"), F.col("p_name"))).getField("p_name").alias("common_name"))
    ratio = fn.fuzzy_ratio(F.col("p_name"), F.col("common_name"))
    return part.join(common, "p_brand").select("p_partkey", "common_name", F.round(ratio, 4).alias("ratio"))


@query(
    "h14_explode_predictions",
    """SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS position, CAST(embedding[i] AS DOUBLE) AS prediction
       FROM embeddings, range(1, 65) r(i)""",
)
def explode_predictions(spark, sf):
    response = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    rows = response.select("vec_id", "label", F.posexplode("embedding").alias("position", "prediction"))
    return rows.withColumn("prediction", F.col("prediction").cast("double"))


@query(
    "h15_class_name_map",
    """SELECT vec_id, CASE label WHEN 0 THEN 'setosa' WHEN 1 THEN 'versicolor' WHEN 2 THEN 'virginica' END AS class_name FROM embeddings""",
)
def class_name_map(spark, sf):
    # fixed values: class names by index
    names = {0: "setosa", 1: "versicolor", 2: "virginica"}
    named = fn.name_from_index(F.col("label"), names)
    return table(spark, sf, "embeddings").select("vec_id", named.alias("class_name"))


@query("h16_case_fold_prefix", "SELECT p_partkey, starts_with(upper(p_name), 'RED') AS is_red FROM part")
def case_fold_prefix(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.upper("p_name").startswith("RED").alias("is_red"))


@query(
    "h17_required_field",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
              CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'accepted' END AS outcome FROM events""",
)
def required_field(spark, sf):
    text = F.when(F.col("event_type") == "error", "{}").otherwise(F.col("props"))
    events = table(spark, sf, "events").select("event_id", fn.required_field(text, "k long", "k").alias("k"))
    outcome = F.when(F.col("k").isNotNull(), "accepted").otherwise("rejected")
    return events.withColumn("outcome", outcome)


@query(
    "h18_math",
    """SELECT l_orderkey, l_linenumber, abs(l_quantity - 25) AS gap, CAST(floor(l_extendedprice) AS BIGINT) AS whole,
              round(ln(l_quantity), 6) AS log_qty, round(sqrt(l_extendedprice), 6) AS root,
              power(l_quantity, 2) AS squared, round(l_discount * 10, 1) AS tenths FROM lineitem""",
)
def math(spark, sf):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.abs(q - 25).alias("gap"),
        p.cast("long").alias("whole"),
        F.round(F.ln(q), 6).alias("log_qty"),
        F.round(F.sqrt(p), 6).alias("root"),
        F.pow(q, 2).alias("squared"),
        F.round(F.col("l_discount") * 10, 1).alias("tenths"),
    )


@query(
    "h19_array_pad_get",
    """WITH d AS (SELECT user_id, CAST(day(ts) AS INTEGER) AS day, sum(value) AS v FROM events GROUP BY 1, 2)
       SELECT u.user_id, CAST(31 AS INTEGER) AS size, round(coalesce(first(d3.v), 0) * 2, 2) AS third_doubled,
              round(coalesce(first(d31.v), 0) * 2, 2) AS last_item
       FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN (SELECT * FROM d WHERE day = 3) d3 ON d3.user_id = u.user_id
       LEFT JOIN (SELECT * FROM d WHERE day = 31) d31 ON d31.user_id = u.user_id
       GROUP BY u.user_id""",
)
def array_pad_get(spark, sf):
    days = F.sequence(F.lit(1), F.greatest(F.lit(1), F.array_max(F.map_keys("by_day"))))  # a month's arrays differ in length
    daily = (
        table(spark, sf, "events")
        .groupBy("user_id", F.dayofmonth("ts").alias("day"))
        .agg(F.sum("value").alias("v"))
        .groupBy("user_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("day", "v"))).alias("by_day"))
    )
    dense = F.transform(days, lambda i: F.coalesce(F.try_element_at("by_day", i), F.lit(0.0)))
    padded = daily.withColumn("padded", fn.pad_right(dense, 31))
    total = padded.withColumn("total", fn.add_arrays(F.col("padded"), F.col("padded")))
    return total.select(
        "user_id",
        F.size("total").alias("size"),
        F.round(F.element_at("total", 3), 2).alias("third_doubled"),
        F.round(F.element_at("total", -1), 2).alias("last_item"),
    )


@query(
    "h20_weekday_name",
    """SELECT event_id, dayname(ts) AS weekday, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text,
              CAST(dayname(ts) = 'Monday' AS INTEGER) AS is_monday FROM events""",
)
def weekday_name(spark, sf):
    name = fn.weekday_name(F.col("ts"))
    return table(spark, sf, "events").select(
        "event_id",
        name.alias("weekday"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"),
        (name == "Monday").cast("int").alias("is_monday"),
    )
