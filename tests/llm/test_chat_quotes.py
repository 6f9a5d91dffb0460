"""Quotation linking against hand-worked threads and a plain Python version."""

from __future__ import annotations

import random
import re

from tidemark.llm import chat_quotes
from tidemark.llm.chat_quotes import conversations

SCHEMA = "conv_id long, turn int, role string, text string, branch int, row string"


def norm(text):
    return re.sub(r"\s+", " ", text).strip(" ").lower()


def plain(messages):
    """{(conv, turn, role, text)}: own text, parent, branch, quotes, linked."""
    parsed = {}
    for m in messages:
        own, passages, level = [], [], 0
        lines = re.split(r"\r?\n", m[3] or "")
        kinds = [re.match(chat_quotes.MARKS, line) for line in lines]
        depth = [k.group(1).count(">") if k else 0 for k in kinds]
        for i, line in enumerate(lines):
            body = re.sub(chat_quotes.MARKS + r"[ \t]?", "", line) if depth[i] else line
            if not depth[i] and i + 1 < len(lines) and depth[i + 1] and re.match(chat_quotes.INTRODUCTION, line):
                level = 0
                continue
            if depth[i] == 0:
                own.append(body)
            elif i and depth[i - 1] == depth[i]:
                passages[-1][1].append(body)
            else:
                passages.append((depth[i], [body]))
        text = "\n".join(own).strip(" ") if any(depth) else (m[3] or "")
        parsed[m] = (text, passages)
    index = {}
    for (conv, turn, _, _), (text, _) in parsed.items():
        if turn is None:
            continue
        for unit in [text, *re.split(r"\n[ \t]*\n", text), *re.split(r"\r?\n", text)]:
            if norm(unit):
                key = (conv, norm(unit))
                index[key] = min(index.get(key, turn), turn)
    parents, stats = {}, {}
    for m, (_, passages) in parsed.items():
        found = []
        for level, lines in passages:
            def origin(t):
                at = index.get((m[0], norm(t)))
                return at if at is not None and m[1] is not None and at < m[1] else None
            at = origin("\n".join(lines))
            if at is None:
                some = [origin(t) for t in lines if norm(t)]
                counts = sorted(((some.count(o), o) for o in set(some) if o is not None), reverse=True)
                at = counts[0][1] if counts and counts[0][0] * 2 > len(some) else None
            found.append((level, at))
        good = [(level, -at) for level, at in found if at is not None]
        parents[m] = -min(good)[1] if good else None
        stats[m] = (len(found), len(good))
    out = {}
    for conv in {m[0] for m in parsed}:
        turns = sorted({m[1] for m in parsed if m[0] == conv and m[1] is not None})
        branch = None
        for i, turn in enumerate(turns):
            before = turns[i - 1] if i else None
            explicit = [parents[m] for m in parsed if m[:2] == (conv, turn) and parents[m] is not None]
            if before is None or (explicit and max(explicit) != before):
                branch = turn
            for m in parsed:
                if m[:2] == (conv, turn):
                    out[m] = (parsed[m][0], parents[m] if parents[m] is not None else before, branch, *stats[m])
        for m in parsed:
            if m[0] == conv and m[1] is None:
                out[m] = (parsed[m][0], parents[m], None, *stats[m])
    return out


def run(spark, messages):
    df = spark.createDataFrame([(*m, 7, "x") for m in messages], SCHEMA)
    return conversations(df).collect()


def test_threads_by_hand(spark):
    a = "First question.\nWith two lines."
    b = "An answer to it."
    messages = [
        (1, 0, "user", a),
        (1, 1, "assistant", b),
        (1, 2, "user", "On Monday A wrote:\n> first   QUESTION.\n> With two lines.\nI meant another thing."),
        (1, 3, "assistant", "> > First question.\n> > With two lines.\n> I meant another thing.\nI see."),
        (1, 4, "user", ">An answer to it.\nThanks.\n>> never written\n"),
        (2, 0, "user", "> First question.\nno such thing here"),
    ]
    got = [(r.conv_id, r.turn, r.text, r.parent_turn, r.branch, r.n_quotes, r.n_linked) for r in run(spark, messages)]
    assert got == [
        (1, 0, a, None, 0, 0, 0),
        (1, 1, b, 0, 0, 0, 0),
        (1, 2, "I meant another thing.", 0, 2, 1, 1),
        (1, 3, "I see.", 2, 2, 2, 2),
        (1, 4, "Thanks.\n", 1, 4, 2, 1),
        (2, 0, "no such thing here", None, 0, 1, 0),
    ]


def test_equals_plain_version(spark, monkeypatch):
    monkeypatch.setattr(chat_quotes, "SPAN", 4)
    rng = random.Random(2)
    words = "red green blue one two three On wrote: four".split()
    messages = []
    for conv in (1, 2, 3, None):
        texts = []
        for turn in range(14):
            lines = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 4))]
            if texts and rng.random() < 0.6:
                quoted = rng.choice(texts).split("\n")
                lines = [rng.choice(["> ", ">", " > "]) + x for x in quoted[: rng.randrange(1, 4)]] + lines
            texts.append("\n".join(lines))
            messages.append((conv, turn, rng.choice(["user", "assistant"]), texts[-1]))
    messages += [(1, 5, "user", "again"), (1, None, "user", "> red"), (5, 0, None, None), (5, 1, "user", ""), (5, 900, "user", ">")]
    want = plain(messages)
    got = run(spark, messages + [(5, 1, "user", "")])
    assert len(got) == len(messages) + 1
    rows = sorted(((r.conv_id, r.turn, r.role, r.text, r.parent_turn, r.branch, r.n_quotes, r.n_linked) for r in set(got)), key=str)
    assert rows == sorted({(*m[:3], v[0], *v[1:]) for m, v in want.items()}, key=str)
    order = [(r.conv_id, r.branch, r.turn) for r in got if r.conv_id == 2]
    assert order == sorted(order)
    seen = set()
    for r in (r for r in got if r.conv_id == 2):
        assert r.parent_turn is None or r.parent_turn in seen
        seen.add(r.turn)


def test_empty_table(spark):
    assert conversations(spark.createDataFrame([], SCHEMA)).count() == 0
