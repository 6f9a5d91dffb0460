"""The mix against a plain version, and training positions against the schedule."""

from __future__ import annotations

import hashlib
import math
import random

from pyspark.sql import functions as F

from tidemark.llm import mixing

SCHEMA = "doc_id long, source string, words long, mark string, target int, source_size string"


def plain_targets(sizes, weights, most=3.0):
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        weight = sum(weights[s] for s in sizes if s not in full)
        shares = {s: left * weights[s] / weight for s in sizes if s not in full and weight}
        above = {s for s, t in shares.items() if t > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else shares.get(s, 0.0) for s in sizes}
        full |= above


def docs(spark, rows):
    marked = [(i, s, n, hashlib.md5(f"{i}|{j}".encode()).hexdigest(), 1, "x") for j, (i, s, n) in enumerate(rows)]
    return spark.createDataFrame(marked, SCHEMA)


def schedule(spark, rows):
    return spark.createDataFrame(rows, "source string, t double, weight double")


def test_targets_and_taken_words(spark):
    rng = random.Random(3)
    scale = {"a": 2, "b": 40, "c": 300, "d": 5, None: 20, "z": 0}
    rows = [(i, s, rng.randrange(0, 2 * k + 1)) for i, (s, k) in enumerate(x for x in scale.items() for _ in range(40))]
    rows += [(5, "a", 0), (None, "b", 3), (None, "b", 3)]
    weights = {"a": 1.0, "b": 2.0, "c": 3.0, "d": 1.0, None: 2.0, "z": 3.0}
    plan = schedule(spark, [(s, t, w * (1 + 0.5 * (2 * t - 1))) for s, w in weights.items() for t in (1.0, 0.0)])
    got = mixing.mix(docs(spark, rows), plan, "words", "mark").collect()
    assert len(got) == len(rows)
    sizes = {s: sum(n for _, x, n in rows if x == s) for s in scale}
    want = plain_targets(sizes, weights)
    assert sum(want.values()) == sum(sizes.values()) and any(math.isclose(want[s], 3 * sizes[s]) for s in sizes)
    for s in scale:
        own = [r for r in got if r.source == s]
        assert all(math.isclose(r.mix.target, want[s], abs_tol=1e-6) and r.mix.source_size == sizes[s] for r in own)
        assert sum(r.mix.taken for r in own) == math.floor(own[0].mix.target + 0.5)
        assert all(0 <= r.mix.taken <= 3 * r.words for r in own)
        cut = [r for r in own if r.words and r.mix.taken % r.words]
        assert len(cut) <= 1 and all(len(r.mix.positions) == math.ceil(r.mix.taken / r.words) for r in own if r.words)
        positions = [p for r in own for p in r.mix.positions]
        assert all(0 <= p <= 1 for p in positions)
    again = mixing.mix(docs(spark, rows).repartition(7), plan, "words", "mark").collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_positions_follow_the_schedule(spark):
    """Words placed before time t are the integral of the weights up to t."""
    rows = [(i, s, 1) for i, s in enumerate(["early"] * 4000 + ["late"] * 4000)]
    knots = [("early", 0.0, 2.0), ("early", 0.5, 1.0), ("early", 1.0, 0.0), ("late", 0.0, 0.0), ("late", 1.0, 2.0)]
    mixed = mixing.mix(docs(spark, rows), schedule(spark, knots), "words", "mark")
    for source, upto in (("early", lambda t: 2 * t - t * t), ("late", lambda t: t * t)):
        own = [p for r in mixed.where(F.col("source") == source).collect() for p in r.mix.positions]
        for t in (0.1, 0.5, 0.9):
            assert abs(sum(p <= t for p in own) / len(own) - upto(t)) < 0.002
    ordered = [r.source for r in mixing.training_order(mixed).select("source").collect()]
    assert len(ordered) == 8000 and ordered[:400].count("early") > 350 and ordered[-400:].count("late") > 350


def test_edges(spark):
    plan = schedule(spark, [("a", 0.0, 1.0), ("a", 1.0, 1.0)])
    none = docs(spark, [(1, "a", 1)]).limit(0)
    assert mixing.mix(none, plan, "words", "mark").count() == 0
    unknown = mixing.mix(docs(spark, [(1, "q", 10), (2, None, 5), (3, "a", 4)]), plan, "words", "mark").collect()
    assert {(r.doc_id, r.mix.taken) for r in unknown} == {(1, 0), (2, 0), (3, 12)}
    empty = mixing.mix(docs(spark, [(1, "a", 0), (2, "a", 0)]), plan, "words", "mark").collect()
    assert {(r.mix.taken, r.mix.target, r.mix.copies) for r in empty} == {(0, 0.0, 0)}
    nothing = mixing.mix(docs(spark, [(1, "a", 3)]), plan.limit(0), "words", "mark").collect()
    assert nothing[0].mix.taken == 0 and nothing[0].mix.positions == []
