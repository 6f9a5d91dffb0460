"""Token counts through a cache keyed by content and tokenizer digests.

A text is encoded only if no stored row has its digest and the digest of the tokenizer file;
copies are encoded once. New counts are appended to the cache table, then all rows read theirs
from it. Content is normalised only as far as counts cannot change: null becomes the empty text.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, byte_length, give_back

#: Fixed value: the split pattern of byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_MEMO = 250_000  # pieces a worker remembers before it starts anew
_SCHEMA = "digest string, version string, n_tokens long"


def piece_counter(tokenizer) -> Callable[[list[str]], list[int]]:
    """Counts of texts for a byte-level tokenizer without normaliser.

    Its merges never cross the pieces of the split pattern, so a text's count is the sum over its
    pieces; a piece is encoded by the library once and remembered.
    """
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
    find = regex.compile(SPLIT).findall
    known: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        if len(known) > _MEMO:
            known.clear()
        split = []
        for text in texts:
            parts = cut.split(text) if cut else [text]
            split.append((len(parts) - 1, [piece for part in parts for piece in find(part)]))
        missing = list({piece for _, pieces in split for piece in pieces if piece not in known})
        encoded = tokenizer.encode_batch_fast(missing, add_special_tokens=False)
        known.update(zip(missing, (len(e.ids) for e in encoded)))
        return [n + sum(map(known.__getitem__, pieces)) for n, pieces in split]

    return count


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts of texts without added tokens, for a .json (tokenizers) or .model (sentencepiece) file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    import json

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    kind = rules.get("pre_tokenizer") or {}
    plain = not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in rules["added_tokens"])
    by_piece = kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space")
    if by_piece and plain and rules.get("normalizer") is None:
        return piece_counter(tokenizer)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _encode(misses: DataFrame, tokenizer: str, version: str) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core; threads would each keep memory
        count = counter(tokenizer)
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                n = count(part.column("text").to_pylist())
                same = pa.array([version] * part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("digest"), same, pa.array(n, pa.int64())], ["digest", "version", "n_tokens"])
        del count
        give_back()

    return misses.mapInArrow(encode, _SCHEMA)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def tokenizer_version(tokenizer: str) -> str:
    with open(tokenizer, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; one row a digest, also after appends that overlap."""
    if not _exists(spark, cache):
        return spark.createDataFrame([], "digest string, n_tokens long")
    found = spark.read.schema(_SCHEMA).parquet(cache).where(F.col("version") == version)
    return found.groupBy("digest").agg(F.first("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for every row of ``docs``; the cache at path ``cache`` grows.

    ``tokenizer`` is a vocabulary file that every executor has. Null and empty texts have no
    tokens. Repeated rows give repeated rows. No rows give no rows and append nothing. Other
    columns are not read.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    content = F.coalesce(F.col(text), F.lit(""))
    known = docs.select(F.col(id).alias("id"), content.alias("text"), F.sha2(content, 256).alias("digest"))
    distinct = known.groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(stored_counts(spark, cache, version), "digest", "left_anti")
    with batches_of(spark, 500):
        _encode(misses.select("digest", "text"), tokenizer, version).write.mode("append").parquet(cache)
    counted = known.select("id", byte_length(F.col("text")).alias("n_bytes"), "digest")
    found = counted.join(stored_counts(spark, cache, version), "digest")
    return found.select(F.col("id").alias(id), "n_bytes", "n_tokens")
