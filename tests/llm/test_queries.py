"""The registered queries on the smallest tables, and the pipeline's stages on a made corpus."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from oracle import compare, connect

import corpus_pipeline
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.session import cut_lineage

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ["doc_id", "fingerprint", "component_id"],
    "op2": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op3": ["doc_id", "size", "source_size", "target", "taken", "n_copies", "first_position"],
    "op4": ["doc_id", "language", "confidence", "keep"],
    "op6": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op7": ["query_id", "rank", "vec_id", "score"],
    "op8": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op10": ["page_id", "url", "text", "n_chars"],
    "op11": ["item_id", "rank", "doc_id", "score"],
    "op12": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
    "op13": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
}
TABLES = {"op7": None, "op9": None, "op5": "conversations", "op10": "pages"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_rows_of_a_query(spark, name):
    op = name.split("_")[0]
    found = QUERIES[name](spark, FOLDER)
    assert op not in COLUMNS or found.columns == COLUMNS[op]
    read = TABLES.get(op, "documents")
    assert found.count() == (spark.read.parquet(f"{FOLDER}/{read}.parquet").count() if read else found.count())


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(FOLDER), QUERIES[name], ORACLES[name], FOLDER) is None
    assert QUERIES[name](spark, FOLDER).columns == COLUMNS[name.split("_")[0]]


def corpus(spark, benchmark):
    rng = random.Random(6)
    given = [(r.text, r.lang) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    texts = [t for t, _ in given]
    rows = [(i, t, lang, f"src{i % 4}", len(t)) for i, (t, lang) in enumerate(given)]
    copies = [(100 + i, texts[i].upper() if i % 2 else texts[i].replace(" ", "\n"), "xx", None, 1) for i in range(5)]
    leaks = [(200 + i, f"{texts[i + 10][:200]} {benchmark[i]} {texts[i + 20][:200]}", None, "src1", 1) for i in range(5)]
    empty = [(300, None, "en", "src0", 0), (301, "", None, None, 0), (302, "12 -- 34", "de", "src2", 8)]
    rows += [*copies, *leaks, *empty, rows[0], rows[0]]
    rng.shuffle(rows)
    extra = [(*r, "x", 5, "k") for r in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars int, mix string, shard int, kept string")


def test_stages_of_the_pipeline(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "sharding",
    ]
    benchmark = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").limit(5).collect()]
    docs = corpus(spark, benchmark)
    stages = dict(corpus_pipeline.STAGES)
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, cut_lineage(stage(spark, docs, FOLDER))
        after[name] = [r.asDict() for r in docs.collect()]
        assert name == "sharding" or docs.columns == before.columns
        assert stage(spark, before.limit(0), FOLDER).count() == 0
    ids = {name: Counter(r["doc_id"] for r in rows) for name, rows in after.items()}
    assert {300, 301, 302}.isdisjoint(ids["language_id"]) and ids["language_id"][0] == 3
    one = ids["simhash_near_dedup"]
    assert set(one.values()) == {1} and {100, 101, 102, 103, 104}.isdisjoint(one) and one[0] == 1
    assert {200 + i for i in range(5)} <= set(one) and {200 + i for i in range(5)}.isdisjoint(ids["benchmark_decontamination"])
    assert set(ids["benchmark_decontamination"]) <= set(one)
    mixed = after["source_mixing"]
    words = Counter()
    for r in mixed:
        words[r["source"]] += len(r["text"].split())
    assert max(ids["source_mixing"].values()) <= 3 and set(ids["source_mixing"]) <= set(ids["benchmark_decontamination"])
    shares = [words[s] for s in sorted(words)]
    assert shares[1] > shares[0] and sum(shares) == pytest.approx(sum(len(r["text"].split()) for r in after["benchmark_decontamination"]), rel=0.35)
    shards = after["sharding"]
    assert Counter(r["doc_id"] for r in shards) == ids["source_mixing"] and all(0 <= r["shard"] < 24 for r in shards)
    assert len(stages) == 5 and corpus_pipeline.ORACLE_SQL is None
