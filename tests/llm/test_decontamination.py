"""Spaced-seed decontamination against planted passages and a check of all alignments."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np

from tidemark.llm.decontamination import MASKS, MIN_TOKENS, Tokens, clean, leaks, overlap, seeds

WORDS = [f"w{i}" for i in range(4000)]


def passage(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def brute(docs, items):
    """(doc, item) of all alignments that are copies."""
    known, out = Tokens(), set()
    hashed = {i: known.of(t) for i, t in items}
    for d, text in docs:
        own = known.of(text)
        for i, tokens in hashed.items():
            if len(tokens) < MIN_TOKENS:
                continue
            for shift in range(-len(tokens) + 1, len(own)):
                a, b = max(-shift, 0), max(shift, 0)
                n = min(len(tokens) - a, len(own) - b)
                if n > 0 and overlap(tokens[a : a + n], own[b : b + n], len(tokens)):
                    out.add((d, i))
    return out


def test_planted_passages_and_brute_force(spark):
    rng = random.Random(11)
    items = [(i, passage(rng, rng.randrange(8, 50))) for i in range(12)]
    docs = []
    for d in range(60):
        words, item = passage(rng, rng.randrange(20, 120)), rng.choice(items)[1]
        if d % 3 == 0:  # whole item, one token in nine changed, other case and marks
            copy = [w if k % 9 != 4 else "changed" for k, w in enumerate(item)]
            words[10:10] = [w.upper() + rng.choice([",", ".", ""]) for w in copy]
        elif d % 3 == 1 and len(item) > 25:  # part of an item
            words[5:5] = item[3:21]
        docs.append((d, " ".join(words)))
    docs += [(60, None), (61, ""), (62, " ".join(items[0][1])), (62, " ".join(items[0][1]))]
    items = [(i, " ".join(w)) for i, w in items] + [(90, "too short"), (91, None), (0, " ".join(items[0][1]))]
    table = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, k1 int, item string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in leaks(table, bench).collect()]
    want = brute(docs, items)
    assert len(want) > 25 and set(got) == want
    assert got.count((62, 0)) == 2 and got.count((0, next(i for d, i in want if d == 0))) == 1
    kept = clean(table, bench)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in {x for x, _ in want})


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    assert leaks(docs.limit(0), bench).count() == 0
    assert leaks(docs, bench.limit(0)).count() == 0
    assert clean(docs, bench.limit(0)).count() == 1


def test_tokens_and_seeds():
    known = Tokens()
    same = [known.of("Der Äpfel — 3x, ja!"), known.of("der äpfel 3X ja")]
    assert np.array_equal(*same) and len(same[0]) == 4
    assert len(known.of(None)) == 0 and len(known.of(" .,")) == 0
    a, b = known.of("a b c d e f g h"), known.of("a b c X e f g h")
    common = set(seeds(a)[1].tolist()) & set(seeds(b)[1].tolist())
    assert common and all(len(m) <= MIN_TOKENS for m in MASKS)


def is_copy(same, n_item):
    """The rule itself, over every stretch: a whole item or 13 tokens and more, with 80 %."""
    spans = [(i, j) for i in range(len(same)) for j in range(i + 13, len(same) + 1)]
    return 5 * sum(same) >= 4 * n_item or any(5 * sum(same[i:j]) >= 4 * (j - i) for i, j in spans)


def test_overlap_finds_every_stretch_of_the_rule():
    """Maximal-sum stretches are shorter than the longest with 80 %: 12 matching, 1 changed, 4 matching tokens were lost."""
    rng = random.Random(5)
    cases = [[1] * 12 + [0] + [1] * 4, [1] * 4 + [0] + [1] * 12, ([1] * 4 + [0]) * 3 + [1] * 4]
    cases += [[int(rng.random() < p) for _ in range(rng.randrange(1, 45))] for p in (0.6, 0.7, 0.75, 0.8, 0.85) for _ in range(300)]
    for same in cases:
        around = [0] * rng.randrange(9) + same + [0] * rng.randrange(9)
        found = overlap(np.ones(len(around)), np.array(around), 60)
        assert (found is not None) == is_copy(around, 60), around
        if found:
            whole = 5 * sum(around) >= 4 * 60
            lengths = [j - i for i in range(len(around)) for j in range(i + 1, len(around) + 1) if 5 * sum(around[i:j]) >= 4 * (j - i)]
            assert found[1] == (60 if whole else max(lengths)) and 5 * found[0] >= 4 * found[1]


def test_changed_parts_of_items_are_found(spark):
    """Parts of long items with changed tokens, against a check of all alignments by the rule itself."""
    rng = random.Random(6)
    items = [(i, passage(rng, 60)) for i in range(8)]
    docs = []
    for d in range(48):
        part = list(rng.choice(items)[1][20 : 20 + rng.choice([14, 16, 17, 18, 20])])
        for k in [12] if len(part) == 17 else rng.sample(range(len(part)), len(part) // 8):
            part[k] = "changed"
        words = passage(rng, 40)
        words[9:9] = part
        docs.append((d, words))
    want = set()
    for d, words in docs:
        for i, item in items:
            for shift in range(-len(item) + 1, len(words)):
                a, b = max(-shift, 0), max(shift, 0)
                same = [x == y for x, y in zip(item[a:], words[b:])]
                if sum(same) > 9 and is_copy(same, len(item)):
                    want.add((d, i))
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    assert len(want) == len(docs) and {(r.doc_id, r.item_id) for r in leaks(table, bench).collect()} == want


def test_seeds_hit_every_pattern_of_the_rule():
    """All ways of changing 20 % of 8 to 25 tokens leave a common seed with the same shift."""
    for n in range(8, 26):
        own = np.arange(1, n + 1, dtype=np.uint64)
        known = {}
        for at, h in zip(*seeds(own)):
            known.setdefault((int(at), int(h)), len(known))
        kept = {}  # seed -> positions it reads, found by changing one token at a time
        for k in range(n):
            other = own.copy()
            other[k] = 1000
            left = set(zip(*(x.tolist() for x in seeds(other))))
            for s in known:
                if s not in left:
                    kept[s] = kept.get(s, 0) | 1 << k
        reads = set(kept.values())
        for changed in combinations(range(n), n // 5):
            bits = sum(1 << k for k in changed)
            assert any(not r & bits for r in reads), (n, changed)


def test_short_items_and_texts_without_spaces(spark):
    known = Tokens()
    assert np.array_equal(known.of("中文，测试"), known.of("中 文 测 试")) and len(known.of("ก็ดี, カナ　漢々")) == 6
    zh = "今天天气很好，我们一起去公园散步吧。"
    items = [(1, "Capital of France?"), (2, zh), (3, "!?"), (4, None), (5, "是什么"), (6, "one two three four five six seven"), (7, "a b c d e f g h i j")]
    docs = [
        (1, "the capital, of France is"), (2, "capital of Spain"), (3, "前面的话" + zh.replace("，", "") + "后面"), (4, zh.replace("公园", "学校")),
        (5, "这是什么呢"), (6, "x one two three four five six seven"), (7, "one two three four five six 7"), (8, "!?"), (9, None), (10, ""),
        (11, "capital of France capital of France"), (12, "a b X d e f Y h i j"), (13, "a b c X e f Y h i j"),
    ]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.matched, r.length) for r in leaks(table, bench).collect()}
    assert got == {(1, 1, 3, 3), (3, 2, 16, 16), (4, 2, 14, 16), (5, 5, 3, 3), (6, 6, 7, 7), (11, 1, 3, 3), (12, 7, 8, 10), (13, 7, 8, 10)}
    assert sorted(r.doc_id for r in clean(table, bench).collect()) == [2, 7, 8, 9, 10]
