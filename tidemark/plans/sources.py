"""Sources and sinks, fed with the given tables through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import series as ts
from tidemark.plans.registry import query
from tidemark.session import scratch, table
from tidemark.sources import landing, parquet, text


@query("a1_parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def parquet_scan(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_totalprice") > 100000).select("o_orderkey", "o_totalprice")


@query(
    "a2_read_parquet_folder",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_shipdate END AS l_shipdate FROM lineitem""",
)
def read_parquet_folder(spark, sf):
    li = table(spark, sf, "lineitem")
    folder = scratch(spark, "mixed")
    golden = li.where(F.col("l_returnflag") != "R").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    other = li.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").cast("int"), "l_linenumber", F.col("l_quantity").cast("long"), "l_returnflag"
    )
    golden.write.parquet(f"{folder}/a")
    other.write.parquet(f"{folder}/b")
    return parquet.read_parquet_folder(spark, [f"{folder}/a", f"{folder}/b"], f"{folder}/a")


@query("a3_schema_repair_rewrite", "SELECT o_orderkey, o_totalprice FROM orders")
def schema_repair_rewrite(spark, sf):
    source, target = scratch(spark, "broken"), scratch(spark, "repaired")
    broken = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("string"))
    broken.write.parquet(source)
    return parquet.repair_and_rewrite(spark, source, target, {"o_totalprice": "double"}, file_bytes=128 << 20)


@query(
    "a4_inline_table",
    """SELECT status_name, count(*) AS cnt FROM orders JOIN (VALUES ('O', 'open'), ('F', 'filled'), ('P', 'pending')) t(code, status_name)
       ON o_orderstatus = code GROUP BY 1""",
)
def inline_table(spark, sf):
    names = spark.createDataFrame([("O", "open"), ("F", "filled"), ("P", "pending")], ["o_orderstatus", "status_name"])
    joined = table(spark, sf, "orders").select("o_orderstatus").join(names, "o_orderstatus")
    return joined.groupBy("status_name").agg(F.count("*").alias("cnt"))


@query(
    "a5_csv_scan",
    "SELECT c_custkey AS id, c_name AS full_name, c_acctbal AS balance FROM customer",
)
def csv_scan(spark, sf):
    folder = scratch(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).csv(folder)
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    names = {"c_custkey": "id", "c_name": "full_name", "c_acctbal": "balance"}
    return text.read_csv(spark, folder, schema, drop=["c_nationkey", "c_mktsegment"], rename=names)


@query(
    "a6_folder_scan_with_provenance",
    "SELECT 'o_orderstatus=' || o_orderstatus AS folder, count(*) AS cnt, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1",
)
def folder_scan_with_provenance(spark, sf):
    folder = scratch(spark, "parts")
    parquet.write_parquet(table(spark, sf, "orders"), folder, "overwrite", ["o_orderstatus"])
    rows = parquet.read_with_provenance(spark, folder)
    name = F.element_at(F.split("file_path", "/"), -2)
    return rows.groupBy(name.alias("folder")).agg(
        F.count("*").alias("cnt"), F.round(F.sum("o_totalprice"), 2).alias("amount")
    )


@query("a7_parquet_sink", "SELECT event_id, value FROM events")
def parquet_sink(spark, sf):
    folder = scratch(spark, "sink")
    events = table(spark, sf, "events").select("event_id", "value")
    parquet.write_parquet(events.where(F.col("value") < 50), folder, "overwrite")
    parquet.write_parquet(events.where(F.col("value") >= 50), folder)
    return spark.read.parquet(folder)


@query(
    "a10_upsert_on_key",
    """SELECT event_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value + 1 ELSE value END AS value FROM events""",
)
def upsert_on_key(spark, sf):
    events = table(spark, sf, "events")
    columns = ["event_id", "event_type", "value"]
    target = events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")).select(*columns)
    source = events.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).select(
        "event_id", "event_type", (F.col("value") + 1).alias("value")
    )
    return landing.upsert(target, source, ["event_id"])


def daily_prices(spark, sf):
    """Average value per instrument (event type) and day."""
    daily = ts.daily_series(table(spark, sf, "events"), "ts", ["event_type"], price=F.round(F.avg("value"), 9))
    return daily.withColumnRenamed("ds", "base_date")


DAILY_PRICES = "SELECT event_type, CAST(ts AS DATE) AS base_date, round(avg(value), 9) AS price FROM events GROUP BY 1, 2"


@query("a11_append_if_new_day", f"SELECT * FROM ({DAILY_PRICES}) WHERE base_date >= DATE '2024-01-20'")
def append_if_new_day(spark, sf):
    prices = daily_prices(spark, sf)
    target = prices.where(F.col("base_date") < F.lit("2024-01-20").cast("date"))
    return landing.rows_of_new_days(target, prices, "base_date")


@query(
    "a12_incremental_append",
    f"""SELECT * FROM ({DAILY_PRICES}) WHERE base_date > CASE event_type WHEN 'click' THEN DATE '2024-01-09' WHEN 'error' THEN DATE '2024-01-19'
          WHEN 'view' THEN DATE '2024-01-04' WHEN 'purchase' THEN DATE '2024-01-14' ELSE DATE '2024-01-07' END""",
)
def incremental_append(spark, sf):
    prices = daily_prices(spark, sf)
    loaded = {"click": "2024-01-10", "error": "2024-01-20", "view": "2024-01-05", "purchase": "2024-01-15"}
    until = F.lit(None)
    for name, day in loaded.items():
        until = F.when(F.col("event_type") == name, day).otherwise(until)
    target = prices.where(F.col("base_date") < until.cast("date"))
    start = F.lit("2024-01-08").cast("date")
    return landing.rows_after_watermark(target, prices, ["event_type"], "base_date", start)


@query(
    "a13_xml_rates",
    """SELECT o_orderpriority AS code, o_orderstatus AS name, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS buy,
              CAST(NULL AS DOUBLE) AS transfer, round(o_totalprice + 1, 2) AS sell, CAST(o_orderdate AS DATE) AS base_date FROM orders
       UNION ALL SELECT 'USD', 'dollar', 1, 2, CAST(o_orderkey AS DOUBLE), CAST(o_orderdate AS DATE) FROM orders""",
)
def xml_rates(spark, sf):
    def rate(code, name, buy, transfer, sell):
        pairs = zip(["CurrencyCode", "CurrencyName", "Buy", "Transfer", "Sell"], [code, name, buy, transfer, sell])
        return F.concat(F.lit("<Exrate"), *[x for n, v in pairs for x in (F.lit(f' {n}="'), v, F.lit('"'))], F.lit("/>"))

    buy = F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.format_number("o_totalprice", 2))
    first = rate(
        F.col("o_orderpriority"), F.col("o_orderstatus"), buy, F.lit("-"), F.format_number(F.col("o_totalprice") + 1, 2)
    )
    second = rate(F.lit(" USD "), F.lit("dollar"), F.lit("1.00"), F.lit("2"), F.format_number("o_orderkey", 2))
    document = F.concat(F.lit("<ExrateList>"), first, second, F.lit("</ExrateList>"))
    documents = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("base_date"), document.alias("xml"))
    return text.exchange_rates(documents, "xml", "base_date")


@query(
    "a14_html_table_rows",
    r"""SELECT page_id, CAST(i - 1 AS INTEGER) AS row_index, regexp_extract(r[i], '(?is)<a[^>]*>(.*?)</a>', 1) AS name
        FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>(.*?)</li>', 1) AS r FROM pages), range(1, 1000) t(i) WHERE i <= len(r)""",
)
def html_table_rows(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "html")
    return text.html_table_rows(pages, "html", ["name"], row_tag="li", cell_tag="a")


@query(
    "a15_html_class_extract",
    r"""SELECT page_id, CAST(i - 1 AS INTEGER) AS row_index, trim(a[i]) AS ad, CAST(NULL AS VARCHAR) AS salary
        FROM (SELECT page_id, regexp_extract_all(html, '(?is)<[a-z]+ class="ad"[^>]*>([^<]*)', 1) AS a FROM pages), range(1, 1000) t(i) WHERE i <= len(a)""",
)
def html_class_extract(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "html")
    return text.html_class_rows(pages, "html", ["ad", "salary"])


@query(
    "a16_recent_training_table",
    """SELECT event_id, ts, value FROM events WHERE event_type = 'purchase'
       AND ts >= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR AND ts <= (SELECT max(ts) FROM events)""",
)
def recent_training_table(spark, sf):
    events = table(spark, sf, "events")
    now = events.agg(F.max("ts")).scalar()
    recent = landing.recent_training_rows(events, F.col("event_type") == "purchase", "ts", now)
    folder = scratch(spark, "training")
    parquet.write_parquet(recent.select("event_id", "ts", "value"), folder, "overwrite")
    return spark.read.parquet(folder)


@query(
    "a17_audit_log",
    """SELECT 'snapshot' AS job, event_type || ' rows ' || count(*) AS message, max(ts) AS logged_at FROM events GROUP BY event_type, CAST(ts AS DATE)""",
)
def audit_log(spark, sf):
    daily = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("cnt"), F.max("ts").alias("last")
    )
    message = F.concat("event_type", F.lit(" rows "), F.col("cnt").cast("string"))
    folder = scratch(spark, "audit")
    parquet.write_parquet(landing.audit_rows(daily, "snapshot", message, F.col("last")), folder)
    return spark.read.parquet(folder)


A18 = "SELECT o_orderpriority, count(*) AS cnt, max(o_totalprice) AS top FROM {orders} WHERE o_orderstatus = 'F' GROUP BY o_orderpriority"


@query("a18_warehouse_query", A18.replace("{orders}", "orders"))
def warehouse_query(spark, sf):
    return spark.sql(A18, orders=table(spark, sf, "orders"))


def metric_documents(spark, sf):
    """One nested validation document per user from the user's event values."""
    users = table(spark, sf, "events").groupBy("user_id").agg(
        F.round(F.avg("value"), 9).alias("a"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    promote = (F.col("a") > 50).cast("int")
    day = F.lit("2024-01-31")
    document = text.validation_document(F.col("a"), F.col("lo"), F.col("hi"), F.col("lo"), promote, day)
    return users.select("user_id", "a", "hi", document.alias("document"))


@query(
    "a19_json_doc_sink",
    """SELECT user_id, CAST(a > 50 AS BIGINT) AS promotion_flag, a AS new_r2,
              CASE WHEN a > 50 THEN 'new model is better' ELSE 'old model is kept' END AS decision, '2024-01-31' AS run_at
       FROM (SELECT user_id, round(avg(value), 9) AS a FROM events GROUP BY 1)""",
)
def json_doc_sink(spark, sf):
    folder = scratch(spark, "json")
    text.write_json_documents(metric_documents(spark, sf).select("user_id", "document.*"), folder)
    back = spark.read.json(folder)
    return back.select(
        "user_id",
        "promotion_flag",
        F.col("new_model_metrics.r2_score").alias("new_r2"),
        F.col("decision_details.decision").alias("decision"),
        F.col("metadata.run_at").alias("run_at"),
    )


@query(
    "a20_json_doc_read",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 0.0 ELSE value END AS r2, value AS rmse, 'accepted' AS outcome FROM events WHERE event_type <> 'error'
       UNION ALL SELECT event_id, NULL, NULL, 'rejected' FROM events WHERE event_type = 'error'""",
)
def json_doc_read(spark, sf):
    value, kind = F.col("value"), F.col("event_type")
    metrics = F.struct(F.when(kind != "view", value).alias("r2_score"), value.alias("rmse"))
    good = F.to_json(F.struct(metrics.alias("new_model_metrics")))
    document = F.when(kind == "error", F.lit('{"metadata": {}}')).otherwise(good)
    documents = table(spark, sf, "events").select("event_id", document.alias("text"))
    accepted, rejected = text.read_metrics(documents, "text")
    return (
        accepted.withColumn("outcome", F.lit("accepted"))
        .unionByName(rejected.withColumn("outcome", F.lit("rejected")), allowMissingColumns=True)
        .drop("text")
    )


@query(
    "a21_multi_source_append",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer",
)
def multi_source_append(spark, sf):
    folder = scratch(spark, "sheets")
    customers = table(spark, sf, "customer")
    sheet = F.floor(F.col("c_custkey") / 1000).alias("sheet")
    # six title lines above the data and a blank line below it, in one text part per sheet
    data = customers.select(
        sheet, F.col("c_custkey").alias("at"), F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("value")
    )
    sheets = customers.select(sheet).distinct()
    title = sheets.select("sheet", F.explode(F.sequence(F.lit(-6).cast("long"), F.lit(-1).cast("long"))).alias("at"), F.lit("title,block").alias("value"))
    blank = sheets.select("sheet", F.lit(2**62).alias("at"), F.lit(",").alias("value"))
    ordered = data.unionByName(title).unionByName(blank).repartition("sheet").sortWithinPartitions("sheet", "at")
    ordered.select("sheet", "value").write.partitionBy("sheet").text(folder)
    return text.append_sheets(spark, [folder], ["id", "name"]).select("id", "name")


@query(
    "a22_prediction_sink",
    """SELECT vec_id, CAST(64 AS INTEGER) AS features, '["' || label || '"]' AS prediction FROM embeddings""",
)
def prediction_sink(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        "vec_id",
        F.to_json("embedding").alias("features"),
        F.to_json(F.array(F.col("label").cast("string"))).alias("prediction"),
    )
    folder = scratch(spark, "predictions")
    parquet.write_parquet(rows, folder)
    back = spark.read.parquet(folder)
    return back.withColumn("features", F.size(F.from_json("features", "array<double>")))


@query(
    "a25_state_snapshot",
    """SELECT event_type AS source_table, CAST(count(*) > 1000 AS INTEGER) AS status FROM events GROUP BY 1""",
)
def state_snapshot(spark, sf):
    path = scratch(spark, "state")
    counts = table(spark, sf, "events").groupBy(F.col("event_type").alias("source_table")).agg(F.count("*").alias("cnt"))
    today = counts.select("source_table", (F.col("cnt") > 1000).cast("int").alias("status"))
    empty = today.withColumn("status", F.lit(0))
    landing.save_state(landing.load_state(spark, path, "2024-01-30", empty), path, "2024-01-30")
    landing.save_state(empty, path, "2024-01-31")
    landing.save_state(today, path, "2024-01-31")
    return landing.load_state(spark, path, "2024-01-31", empty)


@query("a26_inspect", "SELECT 'lineitem' AS table_name, count(*) AS cnt, CAST(11 AS INTEGER) AS columns FROM lineitem")
def inspect(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.agg(F.count("*").alias("cnt")).select(F.lit("lineitem").alias("table_name"), "cnt", F.lit(len(li.columns)).alias("columns"))
