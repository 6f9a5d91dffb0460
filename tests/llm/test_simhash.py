"""Fingerprints and classes against a plain all-pairs version."""

from __future__ import annotations

import random
import re

import xxhash

from tidemark.llm.components import components
from tidemark.llm.simhash import fingerprints_of, keep_one, links, near_duplicates


def plain_fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(rows):
    """[(id, fingerprint)] to the smallest id reachable over links of 2 bits."""
    ids = list(range(len(rows)))

    def root(i):
        while ids[i] != i:
            i = ids[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
                ids[root(i)] = root(j)
    out = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            out[root(i)] = min(d, out.get(root(i), d))
    return [out.get(root(i)) for i in range(len(rows))]


TEXTS = [None, "", " \t", "One", "one two", "ONE two", "a b c d", "a b c\x1fd É é", "Ünï cödé " * 30, "x " * 200_000]


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = list(TEXTS)
    for _ in range(12):
        base = [word() for _ in range(400)]
        texts.append(" ".join(base))
        for _ in range(6):
            base[rng.randrange(len(base))] = word()
            texts.append(" ".join(base))
    return texts


def test_fingerprints():
    for text in corpus()[:40]:
        assert fingerprints_of(text, 3, 42, 1)[0] % (1 << 64) == plain_fingerprint(text)


def test_classes_equal_all_pairs(spark):
    texts = corpus()
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[20]), (None, "only without id")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fingerprint string, component_id int")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(df).collect()), key=str)
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    want = [(i, f"{f:016x}", c) for (i, f), c in zip(prints, plain_classes(prints))]
    assert got == sorted(want, key=str)
    assert 12 < len({c for _, _, c in want}) < len(want) - 20
    kept = keep_one(df)
    assert kept.columns == df.columns
    alone = {c for _, _, c in want if c is not None}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*alone, None], key=str)


def test_views_add_links(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    views = [[f % (1 << 64) for f in fingerprints_of(t, 3, 42, 3)] for t in texts]
    assert [v[0] for v in views] == [plain_fingerprint(t) for t in texts] and len({len(set(v)) for v in views[3:]}) >= 1
    ids = list(range(len(texts)))

    def root(i):
        while ids[i] != i:
            i = ids[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if any((a ^ b).bit_count() <= 2 for a, b in zip(views[i], views[j])):
                a, b = sorted((root(i), root(j)))
                ids[b] = a
    want = sorted({root(i) for i in ids})
    assert sorted(r.doc_id for r in keep_one(df, views=3).collect()) == want
    assert len(want) < keep_one(df).count()


def test_links_reach_all_pairs_in_a_crowd(spark):
    """Thousands of fingerprints around one: links stay linear and connect exactly the near ones."""
    rng = random.Random(1)
    middle = rng.getrandbits(64)
    values = {middle ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (0, 1, 1, 2, 2, 3, 6) for _ in range(60)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    edges = links(df).collect()
    assert len(edges) <= 64 * len(values)
    root = {r.node: r.root for r in components(links(df)).collect()}
    want = plain_classes([(v, v % (1 << 64)) for v in signed])
    assert [root.get(v, v) for v in signed] == want


def test_components_of_chains_and_empty_tables(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000), (2000, 1000), (5, 5), (3000, 2000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 1000: 1000, 2000: 1000, 3000: 1000}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0 and keep_one(empty).count() == 0
