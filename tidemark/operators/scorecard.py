"""Weight of evidence, information value and the best binning of a score feature."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quantiles import percentiles
from tidemark.session import cut_lineage


def bin_index(value: Column, edges: Column) -> Column:
    """Number of edges below ``value``: right-closed bins, the first and last one open-ended."""
    return F.size(F.filter(edges, lambda e: e < value))


def _evidence(bins: DataFrame, good: Column, bad: Column, smoothing: float) -> DataFrame:
    good_share = F.try_divide(F.col("good") + smoothing, good)
    bad_share = F.try_divide(F.col("bad") + smoothing, bad)
    woe = F.ln(F.try_divide(good_share, bad_share))
    return (
        bins.withColumn("woe", woe)
        .withColumn("iv", (good_share - bad_share) * F.col("woe"))
        .withColumn("rate", F.try_divide("good", F.col("good") + F.col("bad")))
    )


def woe_iv(
    df: DataFrame, feature: str, target: str, edges: Sequence[float], smoothing: float = 0.0
) -> DataFrame:
    """(bin, good, bad, woe, iv, rate, total_iv) for bins cut at ``edges``.

    A bin without goods or without bads has no finite weight: woe and iv are null there unless
    ``smoothing`` is added to its counts.
    """
    cuts = F.array(*[F.lit(float(e)) for e in sorted(set(edges))])
    y = F.col(target).cast("long")
    bins = df.where(F.col(feature).isNotNull()).groupBy(bin_index(F.col(feature), cuts).alias("bin")).agg(
        F.sum(y).alias("good"), F.sum(1 - y).alias("bad")
    )
    totals = bins.agg(F.struct(F.sum("good").alias("good"), F.sum("bad").alias("bad"))).scalar()
    scored = _evidence(bins, totals.getField("good"), totals.getField("bad"), smoothing)
    return scored.withColumn("total_iv", scored.agg(F.sum("iv")).scalar())


def best_picks(
    counts: Mapping[int, tuple[int, int]], cuts: Sequence[float], num_bins: int, fine_bins: int, min_pct: float
) -> tuple[int, ...] | None:
    """The choice of ``num_bins - 1`` fine edges with the largest information value; None if none is eligible.

    Information values add up over bins, so the best way to cut the fine bins up to an edge into a
    number of bins extends the best ways up to earlier edges: the number of steps is the square of
    the fine bins times ``num_bins``. Of equal values the first choice in order wins.
    """
    good = [counts.get(i, (0, 0))[0] or 0 for i in range(fine_bins)]
    bad = [counts.get(i, (0, 0))[1] or 0 for i in range(fine_bins)]
    goods, bads = [0], [0]
    for g, b in zip(good, bad):
        goods.append(goods[-1] + g)
        bads.append(bads[-1] + b)
    all_good, all_bad = goods[-1], bads[-1]

    def value(start: int, end: int) -> float | None:
        g, b = goods[end] - goods[start], bads[end] - bads[start]
        if g + b == 0:  # equal edges leave no bin between them
            return 0.0 if 0 < start and end < fine_bins and cuts[start - 1] == cuts[end - 1] else None
        if g == 0 or b == 0 or (g + b) / (all_good + all_bad) < min_pct:
            return None
        return (g / all_good - b / all_bad) * math.log((g / all_good) / (b / all_bad))

    def better(a, b):
        return b if a is None or (b is not None and (-b[0], b[1]) < (-a[0], a[1])) else a

    if num_bins < 2:
        whole = value(0, fine_bins)
        return None if whole is None else ()
    # best[j]: (value, picks) of the choices so far whose last edge is j; the edge 0 is no edge
    best = {0: (0.0, (0,))}
    for j in range(1, fine_bins):
        first = value(0, j)
        if first is not None:
            best[j] = (first, (j,))
    for _ in range(num_bins - 2):
        longer: dict[int, tuple[float, tuple[int, ...]]] = {}
        for i, (so_far, picks) in best.items():
            for j in range(i + 1, fine_bins):
                step = value(i, j)
                if step is not None:
                    longer[j] = better(longer.get(j), (so_far + step, (*picks, j)))
        best = longer
    found = None
    for i, (so_far, picks) in best.items():
        last = value(i, fine_bins)
        if last is not None:
            found = better(found, (so_far + last, picks))
    return found[1] if found else None


def optimal_binning(
    df: DataFrame,
    feature: str,
    target: str,
    num_bins: int = 5,
    bin_multiplier: int = 2,
    min_bin_pct: float = 0.05,
) -> DataFrame:
    """Best merge of fine percentile bins by information value, one row per resulting bin.

    The table is counted once into ``num_bins * bin_multiplier`` fine bins. The best merge of
    that handful of counts is found by a dynamic programme. A choice of the index 0 stands for "no edge", so
    merges with fewer bins take part too. Splits with a bin below ``min_bin_pct`` or without
    goods or bads are not eligible; of equal values the first split wins.
    """
    fine_bins = num_bins * bin_multiplier
    known = df.where(F.col(feature).isNotNull())
    points = cut_lineage(percentiles(known, feature, [i / fine_bins for i in range(1, fine_bins)]))  # one row
    cuts = points.select("percentiles").scalar()
    y = F.col(target).cast("long")
    placed = known.select(feature, target).withColumn("cuts", cuts)
    fine = placed.groupBy(bin_index(F.col(feature), F.col("cuts")).alias("fine")).agg(
        F.sum(y).alias("good"), F.sum(1 - y).alias("bad")
    )
    fine = cut_lineage(fine)
    # num_bins * bin_multiplier rows and cut points at most
    seen = {r["fine"]: (r["good"], r["bad"]) for r in fine.collect()}
    at = points.select("percentiles").first()
    picks = best_picks(seen, at[0] if at else [], num_bins, fine_bins, min_bin_pct)
    # one row: the counts of all fine bins, their totals and the cut points
    counts = fine.agg(
        F.collect_list(F.struct("fine", "good", "bad")).alias("bins"),
        F.sum("good").alias("all_good"),
        F.sum("bad").alias("all_bad"),
    ).withColumn("cuts", cuts)
    one_row = counts.select(F.struct(*counts.columns)).scalar()
    splits = [(0, list(picks))] if picks is not None else []
    chosen = df.sparkSession.createDataFrame(splits, "split int, picks array<int>").withColumn("all", one_row)
    edges = F.array_distinct(
        F.transform(F.filter("picks", lambda i: i > 0), lambda i: F.element_at("all.cuts", i))
    )
    merged = (
        chosen.select("split", "picks", edges.alias("edges"), "all.all_good", "all.all_bad", F.explode("all.bins").alias("b"))
        .withColumn("bin", F.size(F.filter("picks", lambda i: (i > 0) & (i <= F.col("b.fine")))))
        .groupBy("split", "bin")
        .agg(
            F.sum("b.good").alias("good"),
            F.sum("b.bad").alias("bad"),
            F.first("edges").alias("edges"),
            F.first("all_good").alias("all_good"),
            F.first("all_bad").alias("all_bad"),
        )
    )
    scored = _evidence(merged, F.col("all_good"), F.col("all_bad"), 0.0)
    pct = (F.col("good") + F.col("bad")) / (F.col("all_good") + F.col("all_bad"))
    scored = scored.withColumn("pct", pct)
    fits = (
        (F.min("pct") >= min_bin_pct)
        & (F.min("good") > 0)
        & (F.min("bad") > 0)
        & (F.count("*") == F.size(F.first("edges")) + 1)
    )
    rows = F.collect_list(F.struct("bin", "good", "bad", "woe", "iv", "rate", "pct")).alias("rows")
    per_split = scored.groupBy("split").agg(
        F.sum("iv").alias("total_iv"), fits.alias("fits"), rows, F.first("edges").alias("edges")
    )
    best = per_split.where("fits").orderBy(F.desc("total_iv"), "split").limit(1)
    long = best.select("total_iv", F.array_sort("edges").alias("edges"), F.posexplode(F.array_sort("rows")).alias("position", "r"))
    return long.select(
        (F.col("position") + 1).alias("bin"),
        F.try_element_at("edges", F.col("position") + 1).alias("upper_edge"),
        "r.good",
        "r.bad",
        "r.woe",
        "r.iv",
        "r.rate",
        "r.pct",
        "total_iv",
    )
