"""Which tables and reports are ready, and the state kept between runs."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import strip_prefixes
from tidemark.operators.relational import (
    best_status,
    different_sources,
    merge_statuses,
    readiness_class,
    remaining,
    row_min,
    rows_before_first_failure,
)
from tidemark.session import cut_lineage


def lowest_reachable_status(rows: DataFrame, node: str, depends_on: str) -> DataFrame:
    """(node, status): the lowest status among a node and everything it depends on.

    Only nodes whose status fell in the last round pass it on, and a round writes only the nodes
    that fell in it; their earlier statuses are looked up for the nodes that were offered one. The loop
    ends when nothing falls any more; cycles are no obstacle. Every round is written to the
    shared folder.
    """
    edges = cut_lineage(rows.where(F.col(depends_on).isNotNull()).select(node, depends_on).distinct())
    fell = cut_lineage(rows.groupBy(node).agg(F.min("status").alias("status")))
    known = fell
    while not fell.isEmpty():
        heard = fell.select(F.col(node).alias(depends_on), F.col("status").alias("heard"))
        offered = cut_lineage(edges.join(heard, depends_on).groupBy(node).agg(F.min("heard").alias("heard")))
        before = known.join(offered, node).groupBy(node).agg(F.min("status").alias("before"), F.min("heard").alias("heard"))
        lower = F.col("before").isNull() | (F.col("heard") < F.col("before"))
        fell = cut_lineage(before.where(F.col("heard").isNotNull() & lower).select(node, F.col("heard").alias("status")))
        known = known.unionByName(fell)
    return known.groupBy(node).agg(F.min("status").alias("status"))


def last_dependency_status(rows: DataFrame, node: str, depends_on: str) -> DataFrame:
    """(node, status, cycle): the status at the end of a node's chain of first dependencies.

    The first dependency of a node is its smallest one. Chains are followed by pointer
    doubling, so the number of rounds is the logarithm of the longest chain. Chains that never
    end are cycles: ``cycle`` = 1 and no status.
    """
    first = rows.groupBy(node).agg(F.min(F.struct(F.col(depends_on).alias("to"), "status")).alias("f"))
    nodes = first.select(node, F.col("f.to").alias("to"), F.col("f.status").alias("status"))
    known = nodes.select(F.col(node).alias("to"), F.lit(True).alias("known"))
    linked = nodes.join(known, "to", "left").select(node, F.when(F.col("known"), F.col("to")).alias("to"), "status")
    current = cut_lineage(linked)
    rounds = math.ceil(math.log2(max(current.count(), 2))) + 1
    for _ in range(rounds):
        if current.where(F.col("to").isNotNull()).isEmpty():
            break
        ahead = current.select(F.col(node).alias("to"), F.col("to").alias("next"), F.col("status").alias("next_status"))
        joined = current.join(ahead, "to", "left")
        moved = F.col("to").isNotNull()
        current = cut_lineage(
            joined.select(
                node,
                F.col("next").alias("to"),
                F.when(moved, F.col("next_status")).otherwise(F.col("status")).alias("status"),
            )
        )
    cycle = F.col("to").isNotNull()
    return current.select(node, F.when(~cycle, F.col("status")).alias("status"), cycle.cast("int").alias("cycle"))


def dependency_fixpoint(rows: DataFrame, node: str, depends_on: str, mode: str = "min") -> DataFrame:
    """Carry statuses along dependencies until stable.

    ``min``: a node is as good as the worst it depends on. ``replace``: a node takes the status
    its chain of dependencies ends with, its own is forgotten; cycles are reported.
    """
    if mode == "min":
        return lowest_reachable_status(rows, node, depends_on).withColumn("cycle", F.lit(0))
    if mode == "replace":
        return last_dependency_status(rows, node, depends_on)
    raise ValueError(f"mode must be 'min' or 'replace', not {mode!r}")


def table_readiness(snap: DataFrame, checks: dict[str, DataFrame], prefixes: Sequence[str] = ()) -> DataFrame:
    """(source_table, status): lowest of the snapshot status and all further checks."""

    def named(df: DataFrame) -> DataFrame:
        name = F.col("source_table")
        return df.withColumn("source_table", strip_prefixes(name, prefixes) if prefixes else name)

    base = named(snap).groupBy("source_table").agg(F.min("status").alias("status_snap"))
    merged = merge_statuses(base, {k: named(v) for k, v in checks.items()}, "source_table")
    return merged.select("source_table", row_min(merged, "status_").alias("status"))


def report_readiness(
    tracing: DataFrame,
    paths: DataFrame,
    exports: DataFrame,
    table_status: DataFrame,
    source_prefixes: tuple[str, str],
    strip: Sequence[str] = (),
    mode: str = "min",
) -> DataFrame:
    """(report, status, export_status, class) for every traced report.

    ``tracing`` (report, source_table, secondary_path), ``paths`` (path, secondary_report),
    ``exports`` (report, export_status), ``table_status`` (source_table, status). A dependency
    between reports of different source prefixes is not counted.
    """
    traced = tracing.join(paths, tracing["secondary_path"] == paths["path"], "left")
    mixed = different_sources(F.col("report"), F.col("secondary_report"), *source_prefixes)
    name = strip_prefixes(F.col("source_table"), strip) if strip else F.col("source_table")
    kept = traced.where(~mixed).select("report", name.alias("source_table"), "secondary_report")
    scored = kept.join(table_status, "source_table", "left").na.fill(1, ["status"])
    pairs = scored.groupBy("report", "secondary_report").agg(F.min("status").alias("status"))
    carried = dependency_fixpoint(pairs, "report", "secondary_report", mode)
    exported = exports.groupBy("report").agg(F.max("export_status").alias("export_status"))
    merged = carried.select("report", "status").join(exported, "report", "left").na.fill(0, ["export_status"])
    status = F.when(F.col("export_status") == 1, 1).otherwise(F.coalesce("status", F.lit(0)))
    return merged.select(
        "report",
        status.alias("status"),
        "export_status",
        readiness_class(status, F.col("export_status")).alias("class"),
    )


def readiness_cycle(
    required: DataFrame,
    known_status: DataFrame,
    fresh_status: DataFrame,
    reports: DataFrame,
    report_counts: DataFrame,
    run_order: Column,
) -> DataFrame:
    """One run: merge table statuses, take the eligible reports in order, stop at an empty one.

    ``reports`` is the result of ``report_readiness``; ``report_counts`` has (report, row_cnt).
    Returns the log (subject, name, message).
    """
    merged = best_status([known_status, fresh_status], "source_table")
    missing = remaining(required, merged, "source_table")
    eligible = reports.where(F.col("class") == "eligible").join(report_counts, "report", "left")
    ran = rows_before_first_failure(eligible.withColumn("seq", run_order), "seq", F.col("row_cnt") > 0)

    def log(df: DataFrame, subject: str, name: str, message: Column) -> DataFrame:
        return df.select(F.lit(subject).alias("subject"), F.col(name).cast("string").alias("name"), message.alias("message"))

    return (
        log(missing, "table", "source_table", F.lit("remain data"))
        .unionByName(log(reports, "report", "report", F.col("class")))
        .unionByName(log(ran, "run", "report", F.col("outcome")))
    )
