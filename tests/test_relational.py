from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import scalars as fn
from tidemark.operators import master, quality, readiness, series
from tidemark.operators import relational as rel
from tidemark.operators.nearest import standardise_products
from tidemark.operators.scorecard import optimal_binning, woe_iv


@pytest.fixture
def people(spark):
    employees = spark.createDataFrame(
        [(1, "Alice", 10), (2, "Bob", 20), (3, "Charlie", 10), (4, "David", None), (5, "Eve", 20)],
        "emp_id int, emp_name string, dept_id int",
    )
    departments = spark.createDataFrame(
        [(10, "Engineering"), (20, "Marketing"), (30, "HR")], "dept_id int, dept_name string"
    )
    return employees, departments


def test_joins_and_null_keys(people):
    employees, departments = people
    assert employees.join(departments, "dept_id", "inner").count() == 4
    left = employees.join(departments, "dept_id", "left")
    assert left.count() == 5
    assert left.where(F.col("emp_name") == "David").first()["dept_name"] is None
    on_marketing = rel.left_join_matching(employees, departments, "dept_id", "dept_id", F.col("dept_name") == "Marketing")
    assert rows(on_marketing, "emp_name", "dept_name") == [
        ("Alice", None), ("Bob", "Marketing"), ("Charlie", None), ("David", None), ("Eve", "Marketing")
    ]
    assert rel.drop_listed(employees, departments, ["dept_id"]).count() == 1
    assert rel.keep_listed(employees, departments, ["dept_id"]).count() == 4


def test_due_day(spark):
    days = spark.createDataFrame(
        [(date(2024, 3, 4),), (date(2024, 3, 3),), (date(2023, 3, 3),), (date(2024, 1, 3),)], "d date"
    )
    out = days.select("d", fn.nearest_due_date(F.col("d")).alias("due"), fn.days_since_due(F.col("d")).alias("n"))
    assert {r.d: (r.due, r.n) for r in out.collect()} == {
        date(2024, 3, 4): (date(2024, 3, 4), 0),
        date(2024, 3, 3): (date(2024, 2, 4), 28),
        date(2023, 3, 3): (date(2023, 2, 4), 27),
        date(2024, 1, 3): (date(2023, 12, 4), 30),
    }


@pytest.mark.parametrize("values, gap", [([3, 4, 4, 6, -1], 5), ([1, 2, 3], 4)])
def test_first_gap(spark, values, gap):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert series.first_gap(df, "v").first()["gap"] == gap


def test_first_gap_from_one(spark):
    df = spark.createDataFrame([(3,), (4,)], "v long")
    assert series.first_gap(df, "v", start=1).first()["gap"] == 1


def test_mode_correction(spark):
    df = spark.createDataFrame(
        [("m1", "A"), ("m1", "A"), ("m1", "B"), ("m2", "C"), ("m3", "D"), ("m3", "E"), (None, "Z")], "m string, c string"
    )
    assert rows(master.mode_correction(df, "m", "c"), "m", "c") == [
        ("m1", "A"), ("m1", "A"), ("m1", "A"), ("m2", "C"), ("m3", "D"), ("m3", "D"), (None, "Z")
    ]


def test_woe_iv(spark):
    data = [(1.0, 1)] * 30 + [(1.0, 0)] * 10 + [(2.0, 1)] * 20 + [(2.0, 0)] * 40
    out = woe_iv(spark.createDataFrame(data, "x double, y int"), "x", "y", [1.5]).orderBy("bin").collect()
    assert [(r.good, r.bad) for r in out] == [(30, 10), (20, 40)]
    assert [round(r.woe, 6) for r in out] == [1.098612, -0.693147]
    assert [round(r.iv, 6) for r in out] == [0.439445, 0.277259]
    assert round(out[0].total_iv, 6) == 0.716704
    assert [round(r.rate, 6) for r in out] == [0.75, 0.333333]


def test_woe_without_goods_is_null_unless_smoothed(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (2.0, 0)], "x double, y int")
    assert woe_iv(df, "x", "y", [1.5]).where("bin = 0").first()["woe"] is None
    assert woe_iv(df, "x", "y", [1.5], smoothing=0.5).where("bin = 0").first()["woe"] is not None


def test_optimal_binning_equals_trying_all_splits(spark):
    from itertools import combinations

    import numpy as np

    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=400), 3)
    y = (rng.random(400) < 1 / (1 + np.exp(-x))).astype(int)
    cuts = np.percentile(x, np.linspace(0, 100, 11)[1:-1])
    best = None
    for picks in combinations(range(10), 4):
        edges = np.unique([cuts[i - 1] for i in picks if i > 0])
        place = np.searchsorted(edges, x, side="left")
        good = np.bincount(place, weights=y, minlength=len(edges) + 1)
        bad = np.bincount(place, weights=1 - y, minlength=len(edges) + 1)
        if ((good + bad) / 400 < 0.05).any() or (good == 0).any() or (bad == 0).any():
            continue
        g, b = good / good.sum(), bad / bad.sum()
        iv = ((g - b) * np.log(g / b)).sum()
        if best is None or iv > best[0] + 1e-12:
            best = (iv, edges)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, y int")
    out = optimal_binning(df, "x", "y").orderBy("bin").collect()
    assert out[0].total_iv == pytest.approx(best[0], abs=1e-9)
    assert [r.upper_edge for r in out[:-1]] == pytest.approx(list(best[1]))
    assert out[-1].upper_edge is None and sum(r.pct for r in out) == pytest.approx(1)


def test_snapshot_growth_counts_like_the_full_join(spark):
    yesterday, today = datetime(2024, 1, 1, 9), datetime(2024, 1, 2, 9)
    data = [("t", today, 1), ("t", today, 1), ("t", today, 2), ("t", yesterday, 1), ("t", yesterday, 3)]
    df = spark.createDataFrame(data, "tab string, ts timestamp_ntz, k int")
    growth = quality.snapshot_growth(df, "tab", "ts", F.col("k"), F.lit("2024-01-02").cast("date"))
    row = growth.first()
    assert (row.id, row.unique_id, row.prev_id, row.missing_id, row.dup_cnt) == (3, 2, 3, 1, 1)
    judged = quality.snapshot_status(growth).first()
    assert (judged.status, judged.duplicate_flag, judged.missing_flag) == (1, 1, 1)
    assert growth.count() == 1


def test_tolerance_of_shrinking_tables(spark):
    growth = spark.createDataFrame(
        [("a", 999, 1000), ("b", 999, 1000)], "source_table string, id long, prev_id long"
    ).selectExpr("*", "date'2024-01-02' day", "id unique_id", "0L missing_id")
    out = quality.snapshot_status(growth, {"a": 0.999})
    assert rows(out, "source_table", "status") == [("a", 1), ("b", 0)]


def test_error_measures(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 5.0), (None, 9.0)], "y double, p double")
    m = series.regression_metrics(df, [], F.col("y"), F.col("p")).first()
    assert (round(m.mse, 6), round(m.rmse, 6), m.r2, m.observations) == (1.333333, 1.154701, -1.0, 3)
    long = {r.metric: r.value for r in series.forecast_metrics(df, [], "y", "p").collect()}
    assert {k: round(v, 6) for k, v in long.items()} == {"RMSE": 1.154701, "MAE": 0.666667, "MSE": 1.333333, "MAPE": 22.222222}


def test_dependencies(spark):
    chain = spark.createDataFrame([("A", "B", 1), ("B", "C", 1), ("C", None, 0)], "r string, s string, status int")
    for mode in ("min", "replace"):
        assert {r.status for r in readiness.dependency_fixpoint(chain, "r", "s", mode).collect()} == {0}
    loop = spark.createDataFrame([("X", "Y", 0), ("Y", "X", 1)], "r string, s string, status int")
    assert {r.status for r in readiness.dependency_fixpoint(loop, "r", "s").collect()} == {0}
    assert {r.cycle for r in readiness.dependency_fixpoint(loop, "r", "s", "replace").collect()} == {1}
    with pytest.raises(ValueError):
        readiness.dependency_fixpoint(loop, "r", "s", "other")


def test_replace_forgets_the_own_status(spark):
    chain = spark.createDataFrame([("A", "B", 0), ("B", None, 1)], "r string, s string, status int")
    assert rows(readiness.dependency_fixpoint(chain, "r", "s", "replace"), "r", "status") == [("A", 1), ("B", 1)]
    assert rows(readiness.dependency_fixpoint(chain, "r", "s", "min"), "r", "status") == [("A", 0), ("B", 1)]


def test_product_match(spark):
    master_rows = spark.createDataFrame(
        [("V1", 10.0, "X", "a"), ("V1", 20.0, "Y", "b"), ("V2", 10.0, "ab", "c"), ("V2", 14.0, "abcd", "d"), ("V3", 5.0, "Z", "e")],
        "visa string, price double, name string, form string",
    )
    targets = spark.createDataFrame(
        [(1, "V1", 18.0), (2, "V2", 12.0), (3, "V3", 500.0), (4, "V9", 1.0), (5, None, 1.0)], "id int, visa string, price double"
    )
    out = standardise_products(targets, master_rows, "visa", "price", "name", ["form"])
    assert rows(out, "id", "std_name", "std_form") == [
        (1, "Y", "b"), (2, "abcd", "d"), (3, "Z", "e"), (4, None, None), (5, None, None)
    ]


def test_product_match_equals_brute_force_on_a_hot_key(spark):
    import random

    rnd = random.Random(3)
    products = [("hot", float(rnd.randrange(5000)), f"n{rnd.randrange(30):x}" * rnd.randrange(1, 3), i) for i in range(300)]
    wanted = [(i, "hot", float(rnd.randrange(-50, 5100))) for i in range(800)]
    out = standardise_products(
        spark.createDataFrame(wanted, "id int, k string, price double"),
        spark.createDataFrame(products, "k string, price double, name string, pid int"),
        "k", "price", "name", ["pid"],
    )
    best = {
        i: min((abs(int(p) - int(q)), -len(n), n, pid) for _, q, n, pid in products) for i, _, p in wanted
    }
    assert {r.id: (r.price_gap, r.std_name, r.std_pid) for r in out.collect()} == {
        i: (b[0], b[2], b[3]) for i, b in best.items()
    }


def test_retry_list(spark):
    def at(h, m=0):
        return datetime(2024, 1, 5, h, m)

    log = spark.createDataFrame(
        [
            ("recovered", at(9), "FAILED"), ("recovered", at(10), "SUCCEEDED"), ("broken", at(10), "SUCCEEDED"),
            ("broken", at(11), "FAILED"), ("running", at(9), "STOPPED"), ("in30", at(9), "FAILED"),
            ("in5", at(9), "FAILED"), ("in65", at(9), "FAILED"), ("old", datetime(2024, 1, 4, 9), "FAILED"),
        ],
        "job_name string, log_date timestamp_ntz, status string",
    )
    running = spark.createDataFrame([("running",)], "job_name string")
    due = spark.createDataFrame(
        [("in30", at(12, 30)), ("in5", at(12, 5)), ("in65", at(13, 5))], "job_name string, next_run_date timestamp_ntz"
    )
    now = F.lit("2024-01-05 12:00:00").cast("timestamp_ntz")
    jobs = master.unresolved_jobs(log, running, due, now)
    assert rows(jobs) == [("broken",), ("in5",)]
    assert rows(master.unresolved_jobs(log, running, due, now, minute_field=True)) == [("broken",), ("in5",), ("in65",)]
    assert {r.start_date for r in master.retry_list(jobs, now).collect()} == {datetime(2024, 1, 5, 12, 1)}


def test_prefix_exclusion_ignores_case(spark):
    df = spark.createDataFrame([("Core_a", "branch_b"), ("core_a", "core_b"), ("core_a", None)], "a string, b string")
    kept = df.where(~rel.different_sources(F.col("a"), F.col("b"), "core", "branch"))
    assert rows(kept) == [("core_a", "core_b"), ("core_a", None)]


def test_status_merge_keeps_text_columns(spark):
    base = spark.createDataFrame([("a", 1, None), ("b", 1, "x")], "k string, status_snap int, note string")
    other = spark.createDataFrame([("a", 0), ("a", 1)], "k string, status int")
    out = rel.merge_statuses(base, {"x": other}, "k")
    assert rows(out, "k", "status_x", "note") == [("a", 0, None), ("b", 1, "x")]


def test_crosstab_totals_agree(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 4.0)], "r string, c string, v double")
    check = rel.totals_agree(rel.crosstab_totals(df, "r", "c", "v")).first()
    assert check.agree and check.grand_total == 7.0


def test_stop_at_first_failure(spark):
    df = spark.createDataFrame([(1, 5), (2, 0), (3, 7)], "seq int, n int")
    out = rel.rows_before_first_failure(df, "seq", F.col("n") > 0)
    assert rows(out, "seq", "outcome") == [(1, "done"), (2, "stopped")]
    fine = rel.rows_before_first_failure(df.where("n > 0"), "seq", F.col("n") > 0)
    assert fine.count() == 2


def test_row_counts_of_missing_tables(spark):
    def absent():
        return spark.read.parquet("/nowhere/at/all")

    out = rel.row_counts({"here": spark.range(3), "gone": absent})
    assert rows(out) == [("gone", None), ("here", 3)]


def test_numbers_and_similarity(spark):
    df = spark.createDataFrame([("1,234.5", "abc", "abd"), ("-", "", ""), ("x", "a", None)], "t string, a string, b string")
    out = df.select(fn.parse_number(F.col("t")).alias("n"), fn.fuzzy_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r.n for r in out] == [1234.5, None, None]
    assert out[0].r == pytest.approx(200 / 3) and out[1].r == 100.0 and out[2].r is None
