from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import session
from tidemark.sources import jdbc, landing, parquet, text
from tidemark.streaming import jobs


def test_golden_schema_over_mixed_files(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, 1.5)], "id long, d double").coalesce(1).write.parquet(a)
    spark.createDataFrame([(2, 7)], "id int, d long").coalesce(1).write.parquet(b)
    out = parquet.read_parquet_folder(spark, [a, b], a)
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "double"]
    assert rows(out) == [(1, 1.5), (2, 7.0)]
    assert parquet.read_parquet_folder(spark, b).dtypes == [("id", "int"), ("d", "bigint")]
    with pytest.raises(ValueError):
        parquet.read_parquet_folder(spark, [])


def test_rewrite_refuses_its_own_source(spark, tmp_path):
    with pytest.raises(ValueError):
        parquet.repair_and_rewrite(spark, str(tmp_path), f"{tmp_path}/", {})


def test_rewrite_compacts(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.range(100).repartition(5).withColumn("x", F.col("id").cast("string")).write.parquet(source)
    out = parquet.repair_and_rewrite(spark, source, target, {"x": "double"}, file_bytes=1 << 30)
    assert dict(out.dtypes)["x"] == "double" and len(out.inputFiles()) == 1 and out.count() == 100


def test_sheets(spark, tmp_path):
    for name, body in {"a": "1,x\n2,y\n,\n", "b": "3,z\n\n"}.items():
        (tmp_path / f"{name}.csv").write_text("title,\n" * 6 + body)
    (tmp_path / "target.csv").write_text("title,\n" * 6 + "9,no\n")
    paths = [str(tmp_path / f"{n}.csv") for n in ("a", "b", "target")]
    out = text.append_sheets(spark, paths, ["id", "name"], target=paths[2])
    assert rows(out, "id", "name") == [("1", "x"), ("2", "y"), ("3", "z")]


def test_xml_files(spark, tmp_path):
    (tmp_path / "r.xml").write_text(
        '<ExrateList><DateTime>x</DateTime><Exrate CurrencyCode="USD" CurrencyName="US DOLLAR " Buy="25,100.5" Transfer="-" Sell="25,300"/>'
        '<Exrate CurrencyCode="EUR" CurrencyName="EURO" Buy="-" Transfer="27,000" Sell="28,000"/></ExrateList>'
    )
    out = text.read_exchange_rate_files(spark, str(tmp_path / "r.xml"))
    assert rows(out, "code", "name", "buy", "transfer", "sell") == [
        ("EUR", "EURO", None, 27000.0, 28000.0), ("USD", "US DOLLAR", 25100.5, None, 25300.0)
    ]


def test_html(spark):
    page = (
        "<table><tr><th>Type</th></tr><tr><td>gold <b>9999</b></td><td>1,2</td></tr><TR class='x'><td>ring</td></TR></table>"
        '<a class="job big" href="#">dev</a><p class="salary">10</p><a class="job">ops</a><p class="jobless">no</p>'
    )
    df = spark.createDataFrame([(1, page)], "page int, html string")
    assert rows(text.html_table_rows(df, "html", ["type", "buy"]), "type", "buy") == [("gold 9999", "1,2"), ("ring", None)]
    assert rows(text.html_class_rows(df, "html", ["job", "salary"]), "job", "salary") == [("dev", "10"), ("ops", None)]


def test_upsert_and_idempotent_appends(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "c"), (2, "d"), (3, "e")], "k int, v string")
    once = landing.upsert(target, source, ["k"])
    assert rows(once) == [(1, "a"), (2, "d"), (3, "e")]
    assert rows(landing.upsert(once, source, ["k"])) == rows(once)
    days = spark.createDataFrame([("a", date(2024, 1, 2)), ("a", date(2024, 1, 3)), ("b", date(2024, 1, 1))], "k string, d date")
    loaded = spark.createDataFrame([("a", date(2024, 1, 2))], "k string, d date")
    start = F.lit("2024-01-01").cast("date")
    fresh = landing.rows_after_watermark(loaded, days, ["k"], "d", start)
    assert rows(fresh, "k", "d") == [("a", date(2024, 1, 3)), ("b", date(2024, 1, 1))]
    again = landing.rows_after_watermark(loaded.unionByName(fresh), days, ["k"], "d", start)
    assert again.count() == 0
    assert landing.rows_of_new_days(days, days, "d").count() == 0


def test_state_is_kept_per_day(spark, tmp_path):
    path = str(tmp_path / "state")
    new = spark.createDataFrame([("t", 0)], "source_table string, status int")
    done = spark.createDataFrame([("t", 1)], "source_table string, status int")
    assert rows(landing.load_state(spark, path, "2024-01-01", new)) == [("t", 0)]
    landing.save_state(done, path, "2024-01-01")
    landing.save_state(new, path, "2024-01-02")
    assert rows(landing.load_state(spark, path, "2024-01-01", new)) == [("t", 1)]
    assert rows(landing.load_state(spark, path, "2024-01-03", new)) == [("t", 0)]


def test_catalog_table_is_replaced(spark):
    spark.sql("DROP TABLE IF EXISTS recent_rows")
    landing.replace_table(spark.range(5), "recent_rows")
    landing.replace_table(spark.range(2), "recent_rows")
    assert spark.table("recent_rows").count() == 2
    spark.sql("DROP TABLE recent_rows")


def test_metrics_documents(spark):
    docs = spark.createDataFrame(
        [(1, '{"new_model_metrics": {"r2_score": 0.9}}'), (2, '{"metadata": {}}')], "id int, text string"
    )
    accepted, rejected = text.read_metrics(docs, "text")
    assert rows(accepted, "id", "r2", "rmse") == [(1, 0.9, 0.0)] and rows(rejected, "id") == [(2,)]


def test_shared_dir_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named and session.scratch(spark, "x").startswith(named)
    assert rows(session.cut_lineage(spark.range(3))) == [(0,), (1,), (2,)]


def test_broadcast_only_below_the_limit(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(session.broadcast_if_small(spark.range(10), 100))
    assert not hinted(session.broadcast_if_small(spark.range(1000), 100))


def test_jdbc_options(spark):
    # no database is started here: only the refusal of an unknown driver is seen
    with pytest.raises(Exception, match="driver|Driver"):
        jdbc.read_jdbc(spark, "t", {"url": "jdbc:none:x"}, "id", (0, 10), 2)


def messages(spark, path, batches):
    for i, data in enumerate(batches):
        spark.createDataFrame(data, "k int, ts timestamp_ntz, v double").coalesce(1).write.mode("append").parquet(str(path))


def test_stream_drops_repeated_keys_over_batches(spark, tmp_path):
    at = datetime(2024, 1, 1, 10)
    source = tmp_path / "in"
    messages(spark, source, [[(1, at, 1.0), (1, at, 2.0)], [(1, at, 3.0), (2, at, 4.0)]])
    schema = spark.read.parquet(str(source)).schema
    stream = jobs.message_files(spark, str(source), schema, files_per_batch=1)
    out = str(tmp_path / "out")
    jobs.finish(jobs.append_stream(jobs.first_arrivals(stream, "ts", ["k"]), out, str(tmp_path / "c")), 120)
    assert rows(spark.read.schema(schema).parquet(out), "k") == [(1,), (2,)]


def test_scored_batches_equal_the_batch_job(spark, tmp_path):
    at = datetime(2024, 1, 1, 10)
    source, out = tmp_path / "in", str(tmp_path / "out")
    messages(spark, source, [[(1, at, 1.0), (2, at, 2.0)], [(3, at, 4.0)]])
    stream = jobs.message_files(spark, str(source), spark.read.parquet(str(source)).schema, files_per_batch=1)
    scorer = lambda df: df.withColumn("prediction", F.col("v") + 1)
    jobs.finish(jobs.score_stream(stream, scorer, "v", "m1", out, str(tmp_path / "c")), 120)
    assert rows(spark.read.parquet(f"{out}/predictions"), "k", "prediction") == [(1, 2.0), (2, 3.0), (3, 5.0)]
    assert spark.read.parquet(f"{out}/metrics").agg(F.sum("observations")).first()[0] == 3


def test_late_rows_are_dropped_from_closed_hours(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    early, later = datetime(2024, 1, 1, 10, 5), datetime(2024, 1, 1, 15)
    messages(spark, source, [[(1, early, 1.0)], [(1, later, 1.0)]])
    schema = spark.read.parquet(str(source)).schema

    def run():
        stream = jobs.message_files(spark, str(source), schema, files_per_batch=1)
        hourly = jobs.windowed_metrics(stream, "ts", F.col("k"), n=F.count("*"))
        jobs.finish(jobs.append_stream(hourly, out, str(tmp_path / "c")), 120)
        return rows(spark.read.schema(hourly.schema).parquet(out), "runtime", "n")

    assert run() == [(datetime(2024, 1, 1, 10), 1)]
    messages(spark, source, [[(1, early, 5.0)]])
    assert run() == [(datetime(2024, 1, 1, 10), 1)]


def test_alerts_carry_the_best_values_over_batches(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    batches = [
        [("m", datetime(2024, 1, 1, 1), 0.95, 100.0), ("n", datetime(2024, 1, 1, 1), 0.5, 10.0)],
        [("m", datetime(2024, 1, 1, 2), 0.90, 100.0)],
        [("n", datetime(2024, 1, 1, 3), 0.5, 11.0)],
    ]
    for data in batches:
        part = spark.createDataFrame(data, "version string, runtime timestamp_ntz, r2 double, rmse double")
        part.coalesce(1).write.mode("append").parquet(str(source))
    stream = jobs.message_files(spark, str(source), part.schema, files_per_batch=1)
    jobs.finish(jobs.drift_alerts(stream, out, str(tmp_path / "c")), 120)
    log = spark.read.parquet(f"{out}/log")
    together = jobs.message_files(spark, str(source), part.schema)
    jobs.finish(jobs.drift_alerts(together, str(tmp_path / "one"), str(tmp_path / "d")), 120)
    judged = [c for c in log.columns if c != "batch"]
    assert rows(spark.read.parquet(str(tmp_path / "one/log")), *judged) == rows(log, *judged)
    assert rows(log, "version", "runtime", "ref_r2", "retrain") == [
        ("m", datetime(2024, 1, 1, 1), 0.95, 0), ("m", datetime(2024, 1, 1, 2), 0.95, 1),
        ("n", datetime(2024, 1, 1, 1), 0.5, 0), ("n", datetime(2024, 1, 1, 3), 0.5, 0),
    ]
    published = spark.read.text(f"{out}/published").select(F.from_json("value", "version string, retrain int").alias("m"))
    assert rows(published.select("m.*")) == [("m", 1)]
