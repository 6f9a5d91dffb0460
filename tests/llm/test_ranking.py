"""Ranked search against a plain scoring of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(docs, items, k):
    tfs = [Counter(t.translate(LOWER) for t in TERM.findall(text or "")) for _, text in docs]
    lengths = [sum(tf.values()) for tf in tfs]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for tf in tfs for t in tf)
    out = []
    for item, text in sorted(set(items), key=str):
        asked = Counter(t.translate(LOWER) for t in TERM.findall(text or ""))
        scored = []
        for (doc, _), tf, length in zip(docs, tfs, lengths):
            score = 0
            for t, times in asked.items():
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 75 + 25 * length * n // total
                    score += times * w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank + 1, None if none else doc, -s) for rank, (s, none, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def corpus():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["Äpfel", "x1", "日本", "naïve"]

    def text(n):
        return " ".join(rng.choice(words[: rng.choice((5, 20, 64))]) for _ in range(n))

    docs = [(i, text(rng.randrange(1, 60))) for i in range(300)]
    docs += [(300 + i, docs[7][1]) for i in range(150)]  # a large group of copies: equal scores
    docs += [(450, None), (451, ""), (452, " .,- "), (453, docs[3][1].upper()), (None, docs[5][1]), (None, "w1"), docs[9], docs[9]]
    docs += [(460, "W1-w2_w3" * 3000), (461, "w0 " * 20_000)]
    items = [(i, text(rng.randrange(1, 12))) for i in range(30)] + [(30, None), (31, "absent"), (32, "W1 w1 w1, w2"), (33, docs[7][1]), (33, "w5"), (5, "w9"), (None, "w4")]
    return docs, [*items, items[0]]


@pytest.mark.parametrize("tree, leaf, terms", [(1 << 14, 32, 1 << 17), (40, 4, 20)])
def test_equals_scoring_of_all(spark, monkeypatch, tree, leaf, terms):
    monkeypatch.setattr(ranking, "TREE", tree)
    monkeypatch.setattr(ranking, "LEAF", leaf)
    monkeypatch.setattr(ranking, "TERMS", terms)
    docs, items = corpus()
    table = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in docs], "doc_id long, text string, score int, rank int, item_id string")
    asked = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id int, text string, doc_id string")
    found = ranking.search(table, asked, 20)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(docs, items, 20)


def test_empty_sides(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b")], "item_id long, text string")
    assert ranking.search(docs.limit(0), items).count() == 0 and ranking.search(docs, items.limit(0)).count() == 0
    assert ranking.search(docs, items).count() == 1


def test_bounds_hold_and_leave_documents_out():
    """No document scores above the bound of any node over it, and rare terms visit few documents."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(3000):
        terms = np.unique(np.minimum(rng.geometric(0.03, rng.integers(1, 30)) - 1, 199))
        rows.append((i, int(rng.integers(76, 400)), terms, rng.integers(1, 9, len(terms))))
    tree = ranking.Tree(ranking.Vectors.of(rows))
    v = tree.v
    asked = np.array([2, 60, 150])
    weights = np.array([100, 3000, 6000])
    dense = np.zeros(200, dtype=np.int64)
    dense[asked] = weights
    scores = np.add.reduceat(dense[v.terms] * tree.scores, v.starts[:-1])
    bound = tree.bounds(asked, weights)
    for node, (start, end) in enumerate(tree.ranges):
        assert scores[start:end].max() <= bound[node] and v.norms[start:end].min() == tree.norms[node] and v.ids[start:end].min() == tree.least[node]
        assert not tree.children[node] or [tree.ranges[c] for c in sorted(tree.children[node])][-1][0] == start
    best: list = []
    visited = tree.search(asked, weights, dense, best, 20)
    want = sorted(((int(s), -int(i)) for s, i in zip(scores, v.ids) if s > 0), reverse=True)[:20]
    assert sorted(best, reverse=True) == want and visited < 1800
