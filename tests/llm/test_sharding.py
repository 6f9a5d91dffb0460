"""Rendezvous shards: laws, digests and weights."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm.sharding import rendezvous, shard_rows, write_shards

SCHEMA = "doc_id long, text string, shard int, part string, id int"


def test_rows_of_shards(spark):
    rows = [(i, f"text {i}" * (i % 5), 9, "x", 1) for i in range(600)]
    rows += [(None, None, 9, "x", 1)] * 3 + [rows[7]] * 4 + [(700, "é" * 100_000, 9, "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = shard_rows(df, [1.0] * 24).collect()
    assert len(got) == len(rows)
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    slots, places = defaultdict(list), defaultdict(set)
    for r in got:
        assert r.size == len(texts[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
        places[r.doc_id].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(p) == 1 for p in places.values())
    moved = sum(r.grown_shard == 24 for r in got)
    assert 5 < moved < 60
    again = {(r.doc_id, r.shard) for r in shard_rows(df.coalesce(1), [1.0] * 24).collect()}
    assert again == {(r.doc_id, r.shard) for r in got}
    assert shard_rows(df.limit(0), [1.0]).count() == 0


def test_weights_and_one_more_shard(spark):
    keys = spark.range(20_000)
    share = Counter(r[0] for r in keys.select(rendezvous(F.col("id"), [1.0, 3.0, 0.0, 4.0])).collect())
    assert abs(share[0] / 20_000 - 1 / 8) < 0.01 and abs(share[1] / 20_000 - 3 / 8) < 0.015 and 2 not in share
    heavier = keys.select(rendezvous(F.col("id"), [1.0, 3.0]).alias("a"), rendezvous(F.col("id"), [1.0, 6.0]).alias("b"))
    assert heavier.where("a <> b AND b <> 1").count() == 0
    with pytest.raises(ValueError):
        rendezvous(F.col("id"), [])


def test_written_folders(spark, tmp_path):
    df = spark.createDataFrame([(i, "t", 5, "p", i) for i in range(50)], SCHEMA)
    write_shards(df, str(tmp_path / "out"), [1.0, 1.0])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == sorted([*df.columns, "shard_"]) and back.count() == 50
