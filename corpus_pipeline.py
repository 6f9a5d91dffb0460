"""A training corpus from the table documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the docs of the next; all but the last return the columns of documents. Texts whose
language stays open go, one document of each class of near duplicates stays, documents that copy
a benchmark item go, sources are mixed to their target shares in training order, and the copies
that the mix takes are put into shards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language_id, mixing, sharding, similar
from tidemark.llm.common import word_count
from tidemark.llm.queries import LEAST_CONFIDENCE, MIX_TILTS, MIX_WEIGHTS, SHARDS
from tidemark.session import cut_lineage, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text in a known language go; the other columns decide nothing alone.

    No documents give none; repeated rows are kept or go together.
    """
    model = language_id.fit(docs)
    return language_id.keep_identified(docs, model, declared="lang", address="source", least=LEAST_CONFIDENCE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class that shares 80 % of its five-word shingles stays, repeated rows once."""
    return similar.keep_one_similar(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that copy a benchmark item go. Null and empty texts stay."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, in training order; what it does not take goes."""
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        "source",
        word_count(F.col("text")).alias("words"),
        mixing.marked(docs, "doc_id", "text").alias("mark"),
    )
    schedule = mixing.ranked_schedule(docs, "source", MIX_WEIGHTS, MIX_TILTS)
    return mixing.training_order(mixing.mix(rows, schedule, "words", "mark"), "mix").select("row.*")


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) of every copy."""
    return sharding.shard_rows(docs, [1.0] * SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Trained models, fingerprints and byte hashes are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
