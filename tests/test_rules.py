"""Rules that must not depend on sizes, lengths or the days that happen to have rows."""

from __future__ import annotations

import bisect
import datetime as dt
import math
import random
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import models, nearest, quality, quantiles, scorecard, series
from tidemark.sources import jdbc, parquet, text

DAY = dt.date(2024, 5, 3)


def test_a_day_without_rows_is_judged(spark):
    none = spark.createDataFrame([], "t string, ts timestamp_ntz")
    found = quality.snapshot_availability(none, "t", "ts", ["a", "b"], until=F.lit(DAY))
    assert rows(found, "source_table", "day", "status") == [("a", DAY, 0), ("b", DAY, 0)]
    early = spark.createDataFrame([("a", dt.datetime(2024, 5, 1, 9))], "t string, ts timestamp_ntz")
    found = quality.snapshot_availability(early, "t", "ts", ["a"], until=F.lit(DAY))
    assert rows(found, "day", "status") == [(dt.date(2024, 5, 1), 1), (dt.date(2024, 5, 2), 0), (DAY, 0)]


def test_calendar_fill_keeps_nulls_of_known_days(spark):
    daily = spark.createDataFrame([("a", dt.date(2024, 5, 1), None), ("a", DAY, 2.0)], "k string, d date, v double")
    assert rows(series.calendar_fill(daily, ["k"], "d", ["v"]), "d", "v") == [(dt.date(2024, 5, 1), None), (dt.date(2024, 5, 2), 0.0), (DAY, 2.0)]


def all_splits(counts, cuts, num_bins, fine, least):
    """The definition: every choice of edges, first one of the largest value."""
    goods, bads = sum(g for g, _ in counts.values()), sum(b for _, b in counts.values())
    best = None
    for picks in combinations(range(fine), num_bins - 1):
        merged: dict[int, list[int]] = {}
        for f, (g, b) in counts.items():
            at = merged.setdefault(sum(0 < i <= f for i in picks), [0, 0])
            at[0] += g
            at[1] += b
        edges = {cuts[i - 1] for i in picks if i > 0}
        if len(merged) != len(edges) + 1 or any(g == 0 or b == 0 or (g + b) / (goods + bads) < least for g, b in merged.values()):
            continue
        value = sum((g / goods - b / bads) * math.log((g / goods) / (b / bads)) for g, b in merged.values())
        if best is None or value > best[0] + 1e-12:
            best = (value, picks)
    return best and best[1]


@pytest.mark.parametrize("seed", range(12))
def test_binning_equals_a_search_of_all_splits(seed):
    rng = random.Random(seed)
    fine = 9
    cuts = sorted(rng.choice([1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]) if seed % 2 else float(i) for i in range(fine - 1))
    counts = {i: (rng.randrange(0, 40), rng.randrange(0, 40)) for i in range(fine)}
    for i in range(1, fine - 1):
        if cuts[i] == cuts[i - 1]:
            del counts[i]  # no value lies between equal edges
    counts = {i: c for i, c in counts.items() if sum(c)}
    for bins in (1, 2, 4):
        assert scorecard.best_picks(counts, cuts, bins, fine, 0.05) == all_splits(counts, cuts, bins, fine, 0.05)


def test_many_bins_are_found():
    rng = random.Random(1)
    counts = {i: (rng.randrange(20, 60), rng.randrange(20, 60)) for i in range(60)}
    assert len(scorecard.best_picks(counts, [float(i) for i in range(59)], 20, 60, 0.01)) == 19


def test_a_database_table_needs_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        jdbc.read_jdbc(spark, "t", {"url": "jdbc:none:x"})


def test_partition_values_of_a_mixed_folder_are_kept(spark, tmp_path):
    folder = str(tmp_path / "mixed")
    spark.range(3).selectExpr("id AS x", "id % 2 AS k").write.partitionBy("k").parquet(folder)
    spark.range(3, 5).selectExpr("cast(id AS int) AS x").write.parquet(f"{folder}/k=7")
    found = parquet.read_parquet_folder(spark, folder)
    assert rows(found, "x", "k") == [(0, 0), (1, 1), (2, 0), (3, 7), (4, 7)]
    again = parquet.read_parquet_folder(spark, folder, found.schema)
    assert rows(again, "x", "k") == rows(found, "x", "k")


def test_class_texts_hold_nested_elements(spark):
    html = "<div class=\"job\"><b>Data</b> engineer</div><p class='job x'>R&amp;D<br>two</p><i class=pay>5</i><div class='jobs'>no</div>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>none</p>")], "id int, html string")
    found = text.html_class_rows(pages, "html", ["job", "pay", "absent"])
    assert rows(found, "id", "row_index", "job", "pay", "absent") == [(1, 0, "Data engineer", "5", None), (1, 1, "R&Dtwo", None, None)]


def test_boosting_stops_early(spark):
    df = spark.range(400).selectExpr("cast(id % 20 AS double) AS x", "cast(id % 20 > 9 AS double) + rand(1) * 0.01 AS y")
    model = models.train_regressor(df, ["x"], "y", rounds=30)
    assert model.stages[-1].getNumTrees < 30
    assert models.train_regressor(df.limit(1), ["x"], "y", rounds=2).stages[-1].getNumTrees >= 1


def test_an_outlier_does_not_crowd_the_percentiles(spark):
    """Epoch seconds beside one huge value: exact ranks, and small windows."""
    values = [1_700_000_000.0 + (i * 7919) % 20_000 for i in range(20_000)] + [1e18]
    df = spark.createDataFrame([("k", v) for v in values] + [("k", None), ("one", 5.0)], "k string, v double")
    got = {r.k: r.percentiles for r in quantiles.percentiles(df, "v", [0.0, 0.25, 0.5, 0.999, 1.0], ["k"]).collect()}
    assert got["one"] == [5.0] * 5
    assert got["k"] == pytest.approx(np.percentile(values, [0, 25, 50, 99.9, 100]).tolist(), rel=1e-12)


def test_percentiles_of_any_group_size(spark):
    """Ties, odd sizes and sizes around the border between whole ranges and sketch brackets."""
    sizes, wanted = [1, 2, 3, 100, 101, 999, 9_999, 30_001], [0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.999, 1.0]
    values = {n: np.random.default_rng(n).integers(0, max(2, 2 * n // 3), n) / 8 for n in sizes}
    df = spark.createDataFrame(pd.DataFrame([(n, v) for n in sizes for v in values[n]], columns=["k", "v"]))
    got = {r.k: r.percentiles for r in quantiles.percentiles(df, "v", wanted, ["k"]).collect()}
    assert sorted(got) == sizes
    for n in sizes:
        np.testing.assert_allclose(got[n], np.percentile(values[n], [100 * p for p in wanted]), rtol=1e-12, err_msg=str(n))


@pytest.mark.parametrize("n", [101, 999])
def test_binning_of_small_tables(spark, n):
    df = spark.range(n).selectExpr("cast(id AS double) AS x", "CASE WHEN (id * 7) % 10 < 3 + 4 * id / {0} THEN 1 ELSE 0 END AS y".format(n))
    bins = scorecard.optimal_binning(df, "x", "y").collect()
    assert len(bins) >= 2 and sum(r.good + r.bad for r in bins) == n


def test_nearest_values_beside_an_outlier(spark):
    """One price of 1e12 leaves the ranges of the others as they are, and ties and gaps are as in a plain search."""
    rng = random.Random(5)
    have = sorted({rng.randrange(0, 40_000) for _ in range(3_000)} | {10**12})
    want = sorted({rng.randrange(-100, 41_000) for _ in range(3_000)} | {10**13})
    row = F.struct(F.col("v").alias("name")).alias("row")
    candidates = spark.createDataFrame([("hot", v) for v in have] + [("few", 7)], "k string, v long").select("k", "v", row)
    targets = spark.createDataFrame([("hot", v) for v in want] + [("few", 9), ("few", 9), ("none", 1)], "k string, v long")
    placed = nearest.in_slices(targets.select("k", "v").unionByName(candidates.select("k", "v")), "k", "v")
    sizes = [r["count"] for r in placed.where("k = 'hot'").groupBy("slice").count().collect()]
    assert len(sizes) >= 100 and max(sizes) < 200
    got = {(r.k, r.v): (r.below and r.below["at"], r.above and r.above["at"]) for r in nearest.neighbours(targets, candidates, "k", "v", "row").collect()}
    assert got.pop(("few", 9)) == (7, None) and got.pop(("none", 1)) == (None, None)
    for (_, v), (below, above) in got.items():
        at = bisect.bisect_right(have, v)
        assert below == (have[at - 1] if at else None)
        after = bisect.bisect_left(have, v)
        assert above == (have[after] if after < len(have) else None)
    assert len(got) == len(want)
