"""Shared lines against a plain reading of all lines."""

from __future__ import annotations

import random

from tidemark.llm.lines import drop_shared_lines

SPACE = " \t\n\x0b\f\r"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(docs, length=40, least=5):
    holders: dict = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            key = line.strip(SPACE).translate(LOWER)
            if len(key) >= length:
                holders.setdefault(key, set()).add(doc)
    out = []
    for doc, text in docs:
        lines, stay = (text or "").split("\n"), []
        for line in lines:
            own = holders.get(line.strip(SPACE).translate(LOWER), set())
            known = [x for x in own if x is not None]
            if len(own) < least or (doc is not None and doc == max(known)):
                stay.append(line)
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def test_equals_a_plain_reading(spark):
    rng = random.Random(4)
    shared = [f"Shared line number {i} with enough characters in it" for i in range(20)]
    shared += ["Ä" * 40, "Ä" * 39, "x" * 40, "short", "", "İ" + "i" * 45]

    def line():
        one = rng.choice(shared)
        return rng.choice((one, one.upper() if one.isascii() else one, f" \t{one}\r", f"\x0b{one}\f", f" {one}", f"own {rng.random()} " * 3))

    docs = [(i, "\n".join(line() for _ in range(rng.randrange(1, 12)))) for i in range(120)]
    docs += [(200, None), (201, ""), (202, "\n\n"), (203, shared[0]), (400, shared[1]), (204, "\n".join([shared[1]] * 5000)), (205, shared[2] + "\n")]
    docs += [(None, shared[3]), (None, shared[3] + "\nrest"), docs[5], docs[5], (5, "other text of the same id\n" + shared[4])]
    docs += [(300 + i, shared[5] + "\n" + "ten only in four documents, with enough characters") for i in range(4)]
    df = spark.createDataFrame(
        [(d, t, 1, "a", 2, "b") for d, t in docs], "doc_id long, text string, n_lines int, hash string, positions int, mark string"
    )
    found = drop_shared_lines(df)
    assert found.columns == [*df.columns, "_n_lines", "n_dropped"]
    got = sorted(map(tuple, found.select("doc_id", "_n_lines", "n_dropped", "text").collect()), key=str)
    assert got == plain(docs) and sum(r[2] for r in got) > 5000
    assert drop_shared_lines(df.limit(0)).count() == 0


def test_few_documents_repeat_lines(spark):
    """Five times in four documents is not in five documents."""
    line = "a line of forty code points or even more of them"
    docs = [(i, f"{line}\n{line}\n{line}") for i in range(4)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.n_dropped for r in drop_shared_lines(df).collect()} == {0}
    assert sorted((r.doc_id, r.n_dropped) for r in drop_shared_lines(df, least_documents=4).collect()) == [(0, 3), (1, 3), (2, 3), (3, 0)]
