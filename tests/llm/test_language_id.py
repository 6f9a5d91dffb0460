"""Held-out accuracy of language ID and the weight of each kind of evidence."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id
from tidemark.llm.language_id import BUCKETS, TextModel, identify, keep_identified, trigram_counts

SCHEMA = "doc_id long, text string, lang string, host string, language string, key int"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_held_out_accuracy(spark, given):
    half = F.xxhash64("text") % 2 == 0
    model = language_id.fit(given.where(half))
    assert model.languages == ("de", "en", "es", "fr")
    held = given.where(~half)
    found = identify(held, model).join(held.select("doc_id", "lang"), "doc_id")
    total, right = found.count(), found.where("language = lang").count()
    assert total > 80 and right / total > 0.97


def test_sample_is_bounded(spark, given):
    few = language_id.fit(given, sample_rows=3)
    again = language_id.fit(given.repartition(5), sample_rows=3)
    assert few.languages == again.languages and np.array_equal(few.logs, again.logs)


def small_model():
    """Two languages: one of a and b, one of c and d."""
    table = np.full((2, BUCKETS), 1e-6)
    for row, text in enumerate(("ab" * 40, "cd" * 40)):
        counts = trigram_counts(text)
        table[row] += counts / counts.sum()
    return TextModel(("aa", "cc"), np.log(table / table.sum(axis=1, keepdims=True)))


def test_evidence_is_fused(spark):
    rows = [(i, "abab", "aa", "http://www.one.aa/x", "", 0) for i in range(40)]
    rows += [(100 + i, "cdcd", "cc", "two.cc", "", 0) for i in range(40)]
    rows += [
        (200, "xyz xyz", None, "www.one.aa", "", 0),  # text open, host decides
        (201, "xyz xyz", "CC-cc", None, "", 0),  # declared decides
        (202, "xyz xyz", None, "new.two.cc", "", 0),  # domain and suffix decide
        (203, "cdcdcdcdcdcdcd", "aa", "one.aa", "", 0),  # a long text beats both
        (204, None, None, None, "", 0),
        (205, "", "aa", None, "", 0),
        (206, "12 34 !!", "zz", "", "", 0),
    ]
    df = spark.createDataFrame([*rows, rows[0]], SCHEMA)
    got = {r.doc_id: (r.language, r.confidence) for r in identify(df, small_model(), declared="lang", address="host").collect()}
    assert [got[i][0] for i in (0, 100, 200, 201, 202, 203, 204, 205, 206)] == ["aa", "cc", "aa", "cc", "cc", "cc", None, "aa", None]
    assert got[204][1] == 0.0 and 0.5 < got[202][1] < got[100][1] <= 1
    kept = keep_identified(df, small_model(), declared="lang", address="host")
    assert kept.columns == df.columns and kept.count() == len(rows) + 1 - 3
    assert {204, 205, 206}.isdisjoint(r.doc_id for r in kept.collect())


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert language_id.fit(none).languages == ()
    assert identify(none, small_model(), declared="lang", address="host").count() == 0
    some = spark.createDataFrame([(1, "abab", None, None, "", 0)], SCHEMA)
    unknown = identify(some, language_id.fit(none), declared="lang", address="host").collect()
    assert [(r.doc_id, r.language, r.confidence) for r in unknown] == [(1, None, 0.0)]
    assert keep_identified(some, language_id.fit(none)).count() == 0


def test_long_texts_are_counted_whole(monkeypatch):
    whole = trigram_counts("abc déf " * 500)
    monkeypatch.setattr(language_id, "_PIECE", 97)
    assert np.array_equal(trigram_counts("abc déf " * 500), whole) and trigram_counts("1 2").sum() == 0
