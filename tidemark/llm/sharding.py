"""Rendezvous hashing of record keys over weighted shards.

Every shard scores a key by itself and the best score wins, so another shard takes rows only into
itself, and no table of placements is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_length
from tidemark.session import cut_lineage


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard (int, from 0) of a key: the smallest exponential draw with the shard's weight as rate.

    The draw depends on the key and the shard's number only. Equal weights get equal shares.
    Null keys share one place. A shard of weight 0 takes nothing.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be above 0")
    text = F.coalesce(key.cast("string"), F.lit("\x00"))
    draws = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            uniform = (F.shiftrightunsigned(F.xxhash64(text, F.lit(shard)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
            draws.append(F.struct((-F.ln(uniform) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard")))
    return F.array_min(F.array(*draws))["shard"]


def _with_slots(placed: DataFrame) -> DataFrame:
    """Add ``slot``, gapless from 0 within each shard, without bringing a shard into one task.

    Rows are numbered within the part of a shard that one task wrote; a part starts where the
    parts before it end. ``part`` is stored, so both readings agree.
    """
    parts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "part").orderBy("id", "text_crc32", "size")
    numbered = placed.withColumn("at", F.row_number().over(within))
    return numbered.join(starts, ["shard", "part"]).withColumn("slot", F.col("start") + F.col("at") - 1)


def shard_rows(
    docs: DataFrame, weights: Sequence[float], id: str = "doc_id", text: str = "text", added: float = 1.0
) -> DataFrame:
    """(id, size, text_crc32, shard, slot, grown_shard) for every row of ``docs``.

    ``size`` is the UTF-8 length of the text plus 8, ``grown_shard`` the place with one more shard
    of weight ``added``. Null texts count as empty. Rows with the same id, also a null one, are in
    one shard; repeated rows get a slot each. No rows give no rows. Other columns are not read.
    """
    key, content = F.col(id), F.coalesce(F.col(text), F.lit(""))
    placed = docs.select(
        key.alias("id"),
        (byte_length(content) + 8).alias("size"),
        F.crc32(content).alias("text_crc32"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, [*weights, added]).alias("grown_shard"),
        F.spark_partition_id().alias("part"),
    )
    numbered = _with_slots(cut_lineage(placed))
    return numbered.select(F.col("id").alias(id), "size", "text_crc32", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], id: str = "doc_id", folder: str = "shard") -> None:
    """Write all columns of ``docs`` below ``path``, one folder ``shard=N`` for each shard.

    If ``docs`` has a column of that name, the folders get the name with underscores added.
    """
    while folder in docs.columns:
        folder += "_"
    docs.withColumn(folder, rendezvous(F.col(id), weights)).write.partitionBy(folder).parquet(path)
