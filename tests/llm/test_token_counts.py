"""Token counts against the library, and the cache's behaviour."""

from __future__ import annotations

import os
import sys

import pytest
from tokenizers import Tokenizer

from tidemark.llm.queries import TOKENIZER
from tidemark.llm.token_counts import count_tokens, counter, stored_counts, tokenizer_version

JSON = TOKENIZER
TEXTS = [
    None, "", "hello world", "a<|endoftext|>b <|endoftext|>", "<|endoftext|", "it's  we'll\n\n  x\t \n", "   ", "日本語 १२३ ½ é́",
    "x" * 3000, "\u0085   ​﻿\x00\x1c\x1f", "'s't'S ''ll", "Ünï-cödé, " * 50, "\r\n" * 40, "a   b",
]


def library(texts):
    tokenizer = Tokenizer.from_file(JSON)
    return [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts_and_cache(spark, tmp_path):
    rows = [(i, t, 1) for i, t in enumerate([*TEXTS, "hello world", None])] + [(None, "hello world", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    cache = str(tmp_path / "cache")
    got = sorted((tuple(r) for r in count_tokens(df, JSON, cache).collect()), key=str)
    want = [(i, len((t or "").encode()), n) for (i, t, _), n in zip(rows, library([t for _, t, _ in rows]))]
    assert got == sorted(want, key=str)
    version = tokenizer_version(JSON)
    assert stored_counts(spark, cache, version).count() == len(set(t or "" for t in TEXTS))
    assert stored_counts(spark, cache, "other").count() == 0
    # a stored count is used as it is, and only new texts are appended
    spark.createDataFrame([("0" * 64, version, 5)], "digest string, version string, n_tokens long").write.mode("append").parquet(cache)
    before = spark.read.parquet(cache).count()
    more = spark.createDataFrame([(1, "hello world"), (2, "brand new"), (3, "brand new")], "doc_id long, text string")
    assert count_tokens(more, JSON, cache).count() == 3
    assert spark.read.parquet(cache).count() == before + 1
    assert count_tokens(more.limit(0), JSON, cache).count() == 0
    # appends that overlap, as after a lost job, count once
    spark.read.parquet(cache).write.mode("append").parquet(str(tmp_path / "twice"))
    spark.read.parquet(cache).write.mode("append").parquet(str(tmp_path / "twice"))
    assert count_tokens(more, JSON, str(tmp_path / "twice")).count() == 3


def test_pieces_equal_the_library_for_every_character():
    """Each character of Unicode between letters, digits and spaces, so that classes of both agree."""
    characters = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(f"a{c}1{c} {c}{c}!{c}\n" for c in characters[i : i + 500]) for i in range(0, len(characters), 500)]
    count, tokenizer = counter(JSON), Tokenizer.from_file(JSON)
    for text in texts:
        assert count([text])[0] == len(tokenizer.encode(text, add_special_tokens=False).ids), hex(ord(text[1]))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies(name):
    path = os.path.join(os.path.dirname(TOKENIZER), name)
    texts = [t or "" for t in TEXTS]
    if name.endswith(".model"):
        import sentencepiece

        want = [len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t)) for t in texts]
    else:
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        want = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter(path)(texts) == want
