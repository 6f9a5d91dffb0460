"""Nearest-value lookup by key, without pairing targets and candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

SLICES = 128  # value ranges of a key with more than FEW values, each with about as many of them
FEW = 2_000


def in_slices(points: DataFrame, key: str, value: str) -> DataFrame:
    """``points`` with ``slice``, the number of the range its value falls into.

    Ranges are cut per key at the quantiles of a mergeable sketch, so that an outlier or a dense
    stretch of values leaves them equally full. Equal values are never cut apart.
    """
    shares = [i / SLICES for i in range(1, SLICES)]
    sketch = points.groupBy(key).agg(F.percentile_approx(value, shares, 10 * SLICES).alias("cuts"), F.count("*").alias("n"))
    cuts = sketch.where(F.col("n") > FEW).select(key, F.array_distinct("cuts").alias("cuts"))
    below = F.size(F.filter("cuts", lambda c: c < F.col(value)))
    return points.join(cuts, key, "left").withColumn("slice", F.coalesce(below, F.lit(0))).drop("cuts")


def neighbours(
    targets: DataFrame, candidates: DataFrame, key: str, value: str, payload: str
) -> DataFrame:
    """For each distinct (key, value) of ``targets``: the nearest candidate below and above.

    ``candidates`` has one row per (key, value) with a ``payload`` struct. Targets are reduced
    to distinct values first. Values are then cut into slices: the search runs inside each
    slice, and slices hand their edge candidates on through a table with one row per slice.
    A key that holds most of the data is so spread over many windows. Looking up is a running
    window in descending order, because a frame that reaches forward to the end costs the
    square of its rows.
    """
    wanted = targets.select(key, value).distinct().withColumn("is_target", F.lit(True))
    offered = candidates.select(key, value, F.struct(F.col(value).alias("at"), F.col(payload).alias("row")).alias("cand"))
    # written once: the sketch, the slices' edges and the search read it
    points = in_slices(cut_lineage(wanted.unionByName(offered, allowMissingColumns=True)), key, value)
    edges = points.groupBy(key, "slice").agg(F.min("cand").alias("first_cand"), F.max("cand").alias("last_cand"))
    along = Window.partitionBy(key)
    before = along.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    after = along.orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        key,
        "slice",
        F.last("last_cand", ignorenulls=True).over(before).alias("carry_below"),
        F.last("first_cand", ignorenulls=True).over(after).alias("carry_above"),
    )

    inside = Window.partitionBy(key, "slice")
    reach = (Window.unboundedPreceding, Window.currentRow)
    up = inside.orderBy(value).rangeBetween(*reach)
    down = inside.orderBy(F.desc(value)).rangeBetween(*reach)
    local = points.select(
        key,
        value,
        "slice",
        "is_target",
        F.last("cand", ignorenulls=True).over(up).alias("below"),
        F.last("cand", ignorenulls=True).over(down).alias("above"),
    ).where("is_target")
    return local.join(carried, [key, "slice"]).select(
        key,
        value,
        F.coalesce("below", "carry_below").alias("below"),
        F.coalesce("above", "carry_above").alias("above"),
    )


def standardise_products(
    targets: DataFrame,
    master: DataFrame,
    key: str,
    price: str,
    name: str,
    attributes: Sequence[str],
) -> DataFrame:
    """Give every target the master row of its key with the nearest price.

    Prices are compared as whole numbers. Among equally near rows the longest name wins, then
    the alphabetically first one and the smallest attributes; all attributes come from that
    one row. Targets without a candidate are kept with blanks (null).
    """
    rank = F.struct((-F.length(name)).alias("neg_len"), F.col(name).alias("name"), *attributes)
    whole = F.col(price).cast("long")
    best_at_price = (
        master.where(F.col(key).isNotNull() & F.col(price).isNotNull())
        .select(key, whole.alias("price_key"), rank.alias("row"))
        .groupBy(key, "price_key")
        .agg(F.min("row").alias("row"))
    )
    wanted = targets.withColumn("price_key", whole)
    near = neighbours(
        wanted.where(F.col(key).isNotNull() & F.col("price_key").isNotNull()), best_at_price, key, "price_key", "row"
    )

    def scored(side: str):
        gap = F.abs(F.col("price_key") - F.col(f"{side}.at"))
        return F.when(F.col(side).isNotNull(), F.struct(gap.alias("gap"), F.col(f"{side}.row").alias("row")))

    chosen = near.withColumn("chosen", F.least(scored("below"), scored("above"))).select(key, "price_key", "chosen")
    out = wanted.join(chosen, [key, "price_key"], "left")
    return out.select(
        *targets.columns,
        F.col("chosen.row.name").alias("std_name"),
        F.col("chosen.gap").alias("price_gap"),
        *[F.col(f"chosen.row.{a}").alias(f"std_{a}") for a in attributes],
    )
