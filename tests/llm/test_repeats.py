"""Repeated byte strings against a plain count of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import repeats
from tidemark.llm.repeats import Anchors, repeated_spans


def brute(texts: list[str | None], length: int):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, texts, length):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, k1 int")
    found = repeated_spans(docs, length).collect()
    assert len(found) == len(texts)
    by_id = {r.doc_id: r for r in found}
    return [
        (r.n_bytes, r.n_removed, [(s.start, s.end) for s in r.spans], r.kept_sha256) for r in (by_id[i] for i in range(len(texts)))
    ]


def corpus(seed: int, n: int, length: int) -> list[str | None]:
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefghij é") for _ in range(k))
    shared = [word(k) for k in (length - 1, length, length + 1, 3 * length, 3 * length)]
    texts: list[str | None] = []
    for _ in range(n):
        parts = [rng.choice([word(rng.randrange(1, 2 * length)), rng.choice(shared)]) for _ in range(rng.randrange(1, 6))]
        texts.append("".join(parts))
    near = list(word(8 * length))
    for i in range(n // 2):
        copy = near.copy()
        for _ in range(3):
            copy[rng.randrange(len(copy))] = "#%d" % i
        texts.append("".join(copy))
    return texts + [texts[0], texts[0], None, "", "a" * (4 * length), "ab" * (2 * length), shared[1], shared[0]]


@pytest.mark.parametrize("small", [2, 512])
def test_equals_a_count_of_all_windows(spark, monkeypatch, small):
    monkeypatch.setattr(repeats, "SMALL_GROUP", small)
    texts = corpus(7, 40, 24)
    assert run(spark, texts, 24) == brute(texts, 24)


def test_odd_length_and_long_texts(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcd") for _ in range(60_000))
    texts = [long, long[20_000:20_700], "x" + long[100:130], "q"]
    assert run(spark, texts, 31) == brute(texts, 31)


def test_empty_tables_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert repeated_spans(empty, 10).count() == 0
    same = spark.createDataFrame([(1, "abcdefghijklmno"), (1, "abcdefghijklmno"), (None, "zyxwvutsrqponm")], "doc_id long, text string")
    found = sorted((str(r.doc_id), r.n_removed, len(r.spans)) for r in repeated_spans(same, 10).collect())
    assert found == [("1", 15, 1), ("1", 15, 1), ("None", 0, 0)]


def test_anchors_of_equal_windows_agree_across_pieces(monkeypatch):
    monkeypatch.setattr(repeats, "_PIECE", 64)
    rng = random.Random(5)
    text = bytes(rng.choice(b"abcdef") for _ in range(2000))
    whole = set(Anchors(40, 20).of(text)[0].tolist())
    part = {p + 500 for p in Anchors(40, 20).of(text[500:900])[0].tolist()}
    assert part <= whole
    assert all(any(p <= a <= p + 20 for a in whole) for p in range(len(text) - 40 + 1))
