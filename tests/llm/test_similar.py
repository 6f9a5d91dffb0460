"""Near duplicates of the pipeline against the exact similarity of all pairs."""

from __future__ import annotations

import random
from collections import Counter

import pytest

import corpus_pipeline
from tidemark.llm import similar

WORDS = [f"w{i}" for i in range(3000)]


def sets(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_stage_keeps_one_of_each_class_by_exact_similarity(spark):
    """Copies with 80 to 95 % of their five-word shingles go, those with less stay."""
    rng = random.Random(3)
    texts = []
    for _ in range(60):
        base = [rng.choice(WORDS) for _ in range(rng.randrange(60, 400))]
        texts.append(" ".join(base))
        for share in (0.004, 0.008, 0.015, 0.02, 0.03):
            texts.append(" ".join("new" if rng.random() < share else w for w in base))
    texts += ["a b", "A  b", "a c", "", " "]
    ids = list(range(len(texts)))

    def root(i):
        while ids[i] != i:
            i = ids[i]
        return i

    known, close = [sets(t) for t in texts], 0
    for i in range(len(texts)):
        for j in range(i):
            both = len(known[i] & known[j])
            if 5 * both >= 4 * (len(known[i]) + len(known[j]) - both):
                close += 10 * both < 9 * (len(known[i]) + len(known[j]) - both)
                a, b = sorted((root(i), root(j)))
                ids[b] = a
    docs = spark.createDataFrame([*enumerate(texts), (0, texts[0])], "doc_id long, text string")
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert close > 60 and kept == sorted({root(i) for i in ids})
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").count() == 0


def least_of_classes(texts):
    """Smallest index of every class of texts that share 80 % of their shingles, by all pairs that share one."""
    known, holders, ids = [sets(t) for t in texts], {}, list(range(len(texts)))

    def root(i):
        while ids[i] != i:
            ids[i] = ids[ids[i]]
            i = ids[i]
        return i

    for i, own in enumerate(known):
        for shingle in own:
            holders.setdefault(shingle, []).append(i)
    for i, own in enumerate(known):
        shared = Counter(j for shingle in own for j in holders[shingle] if j < i)
        for j, both in shared.items():
            if 5 * both >= 4 * (len(own) + len(known[j]) - both):
                a, b = sorted((root(i), root(j)))
                ids[b] = a
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("crowd", [4, 64])
def test_a_large_group_of_mutated_copies(spark, monkeypatch, crowd):
    """Copies of one text with 0 to 12 % of the words changed, and copies of some of those: crowded buckets of several classes."""
    monkeypatch.setattr(similar, "CROWD", crowd)
    rng = random.Random(8)
    base = [rng.choice(WORDS) for _ in range(150)]

    def mutated(words, share):
        return [rng.choice(WORDS) if rng.random() < share else w for w in words]

    firsts = [mutated(base, rng.choice((0.01, 0.03, 0.05, 0.12))) for _ in range(700)]
    texts = [" ".join(w) for w in [base, *firsts, *(mutated(rng.choice(firsts), 0.01) for _ in range(200))]]
    rng.shuffle(texts)
    want = sorted(set(least_of_classes(texts)))
    extra = [(i, t, 0, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(extra, "doc_id long, text string, node int, root string, key int")
    kept = similar.keep_one_similar(docs)
    got = sorted(r.doc_id for r in kept.collect())
    assert kept.columns == docs.columns and len(want) > 100
    # MinHash bands and values lose a pair in 20,000 or less
    assert set(want) <= set(got) and len(got) - len(want) <= 1
