"""The training-data operators applied to the given tables, with their SQL equivalents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    centroids,
    chat_quotes,
    decontamination,
    language_id,
    lines,
    main_text,
    mixing,
    neighbours,
    ranking,
    repeats,
    sharding,
    simhash,
    token_counts,
)
from tidemark.llm.common import word_count
from tidemark.session import scratch, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 1024
LEAST_CONFIDENCE = 0.5
SHARDS = 24
REPEATED_BYTES = 400
QUERY_STEP, NEIGHBOURS = 100, 10
BEST_DOCUMENTS = 20
CENTROIDS, ROUNDS, CENTROID_SEED = 40, 5, "2"
LINE_LENGTH, LINE_DOCUMENTS = 40, 5
MIX_WEIGHTS, MIX_TILTS = (1.0, 2.0, 3.0), (0.5, -0.5, 0.25)


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts through a cache of this run, so that every distinct text is encoded."""
    counts = token_counts.count_tokens(table(spark, folder, "documents"), TOKENIZER, scratch(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op3_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in the order of the training position of their first copy; a last copy may be cut."""
    docs = table(spark, folder, "documents")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mixing.marked(docs, "doc_id", "text").alias("mark"))
    schedule = mixing.ranked_schedule(docs, "source", MIX_WEIGHTS, MIX_TILTS)
    mixed = mixing.mix(sized, schedule, "size", "mark")
    first = F.round(F.get("mix.positions", F.lit(0)), 9).alias("first_position")
    placed = mixed.select("doc_id", "size", "mix.source_size", "mix.target", "mix.taken", F.size("mix.positions").alias("n_copies"), first)
    return placed.orderBy("first_position")


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS mark
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, ([1.0, 2.0, 3.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         ([0.5, -0.5, 0.25])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS tilt,
         source_size * 3.0::DOUBLE AS cap FROM sources),
levels AS (
  SELECT *, cap / weight AS full_at,
         ((SELECT sum(source_size) FROM sources)::DOUBLE - (sum(cap) OVER w - cap))
           / (sum(weight) OVER () - sum(weight) OVER w + weight) AS level
  FROM weighted WINDOW w AS (ORDER BY cap / weight, source NULLS LAST
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
chosen AS (SELECT max(level) AS level FROM levels WHERE full_at > level),
priced AS (
  SELECT source, source_size, weight, tilt, least(cap, coalesce((SELECT level FROM chosen) * weight, cap)) AS target FROM weighted),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.weight, p.tilt, p.target, floor(p.target + 0.5)::BIGINT AS wanted,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.mark, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS placed_at
  FROM sized s JOIN priced p ON s.source IS NOT DISTINCT FROM p.source),
dealt AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE wanted // source_size END AS epochs,
         CASE WHEN source_size = 0 THEN 0 ELSE least(greatest(wanted % source_size - placed_at, 0), size) END AS cut FROM placed),
-- the share of the source's words before the middle of the first copy, as area under its weight from (1 - tilt) to (1 + tilt)
areas AS (
  SELECT *, (placed_at + CASE WHEN epochs > 0 THEN size ELSE cut END / 2) / wanted * weight AS area,
         weight * (1 - tilt) AS w0, 2 * weight * tilt AS slope FROM dealt)
SELECT doc_id, size, source_size, target, (epochs * size + cut)::BIGINT AS taken, (epochs + (cut > 0)::INT)::INT AS n_copies,
       CASE WHEN epochs + cut > 0 THEN
         round(least(2 * area / (w0 + sqrt(greatest(w0 * w0 + 2 * slope * area, 0))), 1), 9) END AS first_position
FROM areas
"""


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The declared language of a document is its lang, its host is its source."""
    docs = table(spark, folder, "documents")
    model = language_id.fit(docs)
    found = language_id.identify(docs, model, declared="lang", address="source")
    return found.select("doc_id", "language", "confidence", language_id.accepted(LEAST_CONFIDENCE).alias("keep"))


def op5_chat_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return chat_quotes.conversations(table(spark, folder, "conversations"))


def op6_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.repeated_spans(table(spark, folder, "documents"), REPEATED_BYTES)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0), NEIGHBOURS)


OP7_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(q.e, lambda x, i: (x - c.e[i]) * (x - c.e[i]))), lambda a, b: a + b)) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op8_rendezvous_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, folder, "documents"), [1.0] * SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(table(spark, folder, "pages"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), BEST_DOCUMENTS)


OP11_SQL = r"""
WITH words AS (
  SELECT r, doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT row_number() OVER () AS r, doc_id,
               unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM documents)),
tfs AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT r, sum(tf)::BIGINT AS n FROM tfs GROUP BY 1),
totals AS (SELECT count(*) AS documents, sum(n)::BIGINT AS terms FROM lengths),
norms AS (SELECT r, 75 + (25 * n * documents) // terms AS m FROM lengths, totals),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs, totals GROUP BY term),
asked AS (
  SELECT i, item_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT row_number() OVER () AS i, item_id,
               unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w
        FROM (SELECT DISTINCT item_id, text FROM benchmark))),
scored AS (
  SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN norms USING (r) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found = centroids.cluster(table(spark, folder, "embeddings"), CENTROIDS, ROUNDS, CENTROID_SEED)
    return found.drop("centroid")


def _op12_sql() -> str:
    """The rounds one after the other: ``a`` assigns vectors, ``c`` moves centroids."""
    parts = [
        """kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), r) - 1 AS c, v FROM kept ORDER BY sha256('2:' || vec_id), r LIMIT 40)""",
    ]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} AS (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min(d) AS d, arg_min(c, d * 64 + c) AS c FROM (
    SELECT r, vec_id, kept.v, c, list_sum(list_transform(kept.v, lambda x, j: (x - c{i}.v[j]) * (x - c{i}.v[j])))::BIGINT AS d
    FROM kept, c{i}) GROUP BY r)""")
        if i < ROUNDS:
            parts.append(f"""s{i} AS (SELECT c, j, sum(v[j])::BIGINT AS s, count(*) AS n FROM a{i}, range(1, 65) t(j) GROUP BY c, j)""")
            parts.append(f"""m{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM s{i} GROUP BY c)""")
            parts.append(f"""c{i + 1} AS (SELECT c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, c::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c{ROUNDS}.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (c)
"""


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = lines.drop_shared_lines(table(spark, folder, "documents"), least_length=LINE_LENGTH, least_documents=LINE_DOCUMENTS)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP13_SQL = """
WITH lines AS (
  SELECT r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS spot
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key
  HAVING count(DISTINCT doc_id) + (count(*) > count(doc_id))::INT >= 5),
judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.keeper AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY spot) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_source_mixing": op3_source_mixing,
    "op4_language_id": op4_language_id,
    "op5_chat_quotes": op5_chat_quotes,
    "op6_repeated_bytes": op6_repeated_bytes,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_rendezvous_sharding": op8_rendezvous_sharding,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_html_main_text": op10_html_main_text,
    "op11_ranked_search": op11_ranked_search,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_line_dedup": op13_line_dedup,
}
ORACLES = {
    "op3_source_mixing": OP3_SQL,
    "op7_nearest_neighbours": OP7_SQL,
    "op11_ranked_search": OP11_SQL,
    "op12_centroid_clusters": _op12_sql(),
    "op13_line_dedup": OP13_SQL,
}
