"""Language of documents by fusing evidence with Bayes' rule.

Four kinds of evidence are combined for each language: the likelihood of the text's byte
trigrams, the language that its markup declares, the suffix of its address, and how often its
host, the domain above the host and the suffix above that have carried the language. Trigram
tables are fitted on a bounded sample of labelled rows; all other tables are grouped aggregates
over every document.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name
from tidemark.session import cut_lineage

BUCKETS = 1 << 14  # trigrams are hashed to so many counters
SAMPLE_ROWS = 500  # labelled rows per language that the trigram tables are fitted on, at most
_TEMPER = 0.25  # neighbouring trigrams overlap, so their log-likelihoods count for less
_PIECE = 1 << 20


def trigram_counts(text: str | None) -> np.ndarray:
    """Counts of the hashed byte trigrams of a lower-cased text that hold two letters at least."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "replace"), dtype=np.uint8)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for start in range(0, len(data) - 2, _PIECE):
        part = data[start : start + _PIECE + 2].astype(np.uint32)
        letter = ((part >= 97) & (part <= 122)) | (part >= 128)
        some = (letter[:-2].astype(np.int8) + letter[1:-1] + letter[2:]) >= 2
        folded = np.where(letter, part, 32)
        h = (folded[:-2] * np.uint32(0x9E3779B1)) ^ (folded[1:-1] * np.uint32(0x85EBCA77)) ^ (folded[2:] * np.uint32(0xC2B2AE3D))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        counts += np.bincount((h >> np.uint32(18))[some], minlength=BUCKETS)
    return counts


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    logs: np.ndarray  # (languages, BUCKETS)

    def log_likelihoods(self, text: str | None) -> np.ndarray | None:
        """Tempered log-likelihood per language, the best one 0; None for a text without trigrams."""
        counts = trigram_counts(text)
        at = np.flatnonzero(counts)
        if not len(at):
            return None
        scores = self.logs[:, at] @ counts[at] * _TEMPER
        return scores - scores.max()


def fit(labelled: DataFrame, text: str = "text", language: str = "lang", sample_rows: int = SAMPLE_ROWS) -> TextModel:
    """Trigram tables from at most ``sample_rows`` rows of each language, those with the smallest text hashes.

    Rows without language, and empty or null texts, are not used. The tables, of a fixed size for
    each language, come to the driver and go to the tasks.
    """
    known = labelled.where(F.col(language).isNotNull() & (F.length(text) > 0))
    known = known.select(F.col(language).cast("string").alias("language"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    part = F.pmod("h", F.lit(64))  # the smallest of each part first, so that no language is in one task
    first = known.select("language", "h").distinct()
    few = first.withColumn("n", F.row_number().over(Window.partitionBy("language", part).orderBy("h"))).where(F.col("n") <= sample_rows)
    few = few.withColumn("n", F.row_number().over(Window.partitionBy("language").orderBy("h"))).where(F.col("n") <= sample_rows)
    few = cut_lineage(few.select("language", "h"))  # its size is then known, so the texts are not shuffled to find it
    sample = known.join(few, ["language", "h"], "left_semi").dropDuplicates(["language", "h"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch.column("language").to_pylist(), batch.column("text")):
                sums[name] = sums.get(name, 0) + trigram_counts(value.as_py())
        arrays = [pa.array(list(sums), pa.string()), pa.array([c.tobytes() for c in sums.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["language", "counts"])

    totals: dict[str, np.ndarray] = {}
    for name, counts in sample.select("language", "text").mapInArrow(count, "language string, counts binary").toLocalIterator():
        totals[name] = totals.get(name, 0) + np.frombuffer(counts, dtype=np.int64)
    languages = tuple(sorted(totals))
    table = np.array([totals[name] for name in languages], dtype=float).reshape(len(languages), BUCKETS) + 0.5
    return TextModel(languages, np.log(table / table.sum(axis=1, keepdims=True)))


def _with_scores(docs: DataFrame, model: TextModel) -> DataFrame:
    """(key, declared, host, domain, suffix, scores): tempered log-likelihoods, null without trigrams."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.log_likelihoods(value.as_py()) for value in batch.column("text")]
            kept = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(scores, pa.list_(pa.float64()))], [*kept.schema.names, "scores"])

    rest = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(read, f"{rest}, scores array<double>")


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    parts = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)
    return F.transform(parts, lambda p: p / total)


def _mass(names: Sequence[str], column: str) -> list[Column]:
    return [F.coalesce(F.sum(F.col(column)[i]), F.lit(0.0)).alias(f"m{i}") for i in range(len(names))]


def _smoothed(counts: DataFrame, key: str, above: DataFrame, up: str, n: int, strength: float) -> DataFrame:
    """(key, up, prior): shares of each language in a level, drawn towards the level above."""
    joined = counts.join(above.select(F.col(up).alias("_up"), F.col("prior").alias("_above")), counts[up].eqNullSafe(F.col("_up")))
    total = sum((F.col(f"m{i}") for i in range(n)), F.lit(0.0)) + F.lit(strength)
    prior = F.array(*[(F.col(f"m{i}") + F.lit(strength) * F.col("_above")[i]) / total for i in range(n)])
    return joined.select(*dict.fromkeys((key, up)), prior.alias("prior"))


def host_parts(address: Column) -> tuple[Column, Column, Column]:
    """Host, the domain above it and the suffix of an address or a bare host name; empty for null."""
    bare = F.regexp_replace(F.lower(F.coalesce(address.cast("string"), F.lit(""))), r"^[a-z][a-z0-9+.\-]*://", "")
    host = F.regexp_extract(bare, r"^(?:[^/?#@]*@)?([^/?#:]*)", 1)
    domain = F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1)
    return host, F.when(domain == "", host).otherwise(domain), F.regexp_extract(host, r"\.([^.]*)$", 1)


def identify(
    docs: DataFrame, model: TextModel, id: str = "doc_id", text: str = "text", declared: str | None = None, address: str | None = None,
    strength: float = 10.0,
) -> DataFrame:
    """(key, id, language, confidence, has_text) for every row of ``docs``.

    ``declared`` names the column of the language that the markup declares, ``address`` one of
    addresses or host names. ``key`` is a hash of what is read of a row. A text without letters
    has no likelihood; it gets the language of the other evidence, or null if there is none:
    no declared language that the model knows and no host. Null, empty and unknown values are
    evidence of nothing. A model without languages gives null everywhere. Repeated rows give
    repeated rows. No rows give no rows.
    """
    names, n = model.languages, len(model.languages)
    said = F.lower(F.trim(F.col(declared).cast("string"))) if declared else F.lit(None).cast("string")
    said = F.regexp_extract(said, r"^([a-z]+)", 1)
    host, domain, suffix = host_parts(F.col(address) if address else F.lit(None))
    parts = [said.alias("declared"), host.alias("host"), domain.alias("domain"), suffix.alias("suffix")]
    known = docs.select(row_key(text, declared, address).alias("key"), F.col(id).alias("id"), F.col(text).alias("text"), *parts)
    if not names:
        unknown = [F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("has_text")]
        return known.select("key", F.col("id").alias(id), *unknown)
    known = known.withColumn("declared", F.when(F.col("declared").isin(*names), F.col("declared")))
    scored = cut_lineage(_with_scores(known, model).withColumn("share", _softmax(F.col("scores"))))

    # every table below has a row for each host, domain, suffix or declared language, summed over all documents
    by_host = cut_lineage(scored.groupBy("host", "domain", "suffix").agg(*_mass(names, "share")))
    sums = [F.sum(f"m{i}").alias(f"m{i}") for i in range(n)]
    by_domain, by_suffix = by_host.groupBy("domain", "suffix").agg(*sums), by_host.groupBy("suffix").agg(*sums)
    everything = by_host.agg(*[F.coalesce(F.sum(f"m{i}"), F.lit(0.0)).alias(f"m{i}") for i in range(n)])
    total = sum((F.col(f"m{i}") for i in range(n)), F.lit(0.0)) + F.lit(float(n))
    top = everything.select(F.lit(0).alias("all"), F.array(*[(F.col(f"m{i}") + 1) / total for i in range(n)]).alias("prior"))
    suffixes = _smoothed(by_suffix.withColumn("all", F.lit(0)), "suffix", top, "all", n, strength)
    domains = _smoothed(by_domain, "domain", suffixes, "suffix", n, strength)
    hosts = _smoothed(by_host.drop("suffix"), "host", domains, "domain", n, strength)
    hosts = hosts.select(F.col("host").alias("_host"), F.col("prior").alias("host_prior"))

    # how often documents of each language declare each language
    claims = scored.where("declared is not null").groupBy("declared").agg(*_mass(names, "share"))
    per_language = claims.agg(*[F.sum(f"m{i}").alias(f"t{i}") for i in range(n)])
    rate = F.array(*[(F.col(f"m{i}") + 0.5) / (F.col(f"t{i}") + 0.5 * n) for i in range(n)])
    claims = claims.crossJoin(F.broadcast(per_language)).select(F.col("declared").alias("_said"), rate.alias("said_rate"))

    joined = scored.join(hosts, F.col("host") == F.col("_host"), "left").join(claims, F.col("declared") == F.col("_said"), "left")
    zero = F.array(*[F.lit(0.0)] * n)
    prior = F.transform(F.when(F.col("host") != "", F.col("host_prior")), F.ln)
    said_log = F.transform("said_rate", F.ln)
    evidence = [F.coalesce(e, zero) for e in (F.col("scores"), prior, said_log)]
    fused = _softmax(F.zip_with(F.zip_with(evidence[0], evidence[1], lambda a, b: a + b), evidence[2], lambda a, b: a + b))
    found = joined.withColumn("fused", fused).withColumn("confidence", F.array_max("fused"))
    best = F.element_at(F.array(*map(F.lit, names)), F.array_position("fused", F.col("confidence")).cast("int"))
    some = F.col("scores").isNotNull() | F.col("declared").isNotNull() | (F.col("host") != "")
    return found.select(
        "key", F.col("id").alias(id), F.when(some, best).alias("language"), F.when(some, F.col("confidence")).otherwise(0.0).alias("confidence"),
        F.col("scores").isNotNull().alias("has_text"),
    )


def row_key(text: str, declared: str | None, address: str | None) -> Column:
    """What ``identify`` reads of a row, as a struct of two hashes; rows equal in it get the same result."""
    read = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in (text, declared, address) if c]
    return F.struct(F.xxhash64(*read).alias("a"), F.xxhash64(F.lit(1), *read).alias("b"))


def keep_identified(
    docs: DataFrame, model: TextModel, id: str = "doc_id", text: str = "text", declared: str | None = None, address: str | None = None,
    least: float = 0.5,
) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text is in a known language with a confidence of ``least``.

    Rejected are texts without letters, null and empty ones among them, and texts whose language stays open.
    """
    found = identify(docs, model, id, text, declared, address)
    name = free_name(docs, "key")
    bad = found.where(~accepted(least)).select(F.col("key").alias(name)).distinct()
    return docs.join(bad, row_key(text, declared, address) == F.col(name), "left_anti")


def accepted(least: float) -> Column:
    return F.coalesce(F.col("has_text") & F.col("language").isNotNull() & (F.col("confidence") >= least), F.lit(False))
