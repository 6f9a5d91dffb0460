"""Distances, clusterings and their scores on sequences and vectors of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import clustering, dtw, tree
from tidemark.operators import sequences as seq
from tidemark.plans.registry import query
from tidemark.session import cut_lineage, table

RADIUS = 3  # fixed value: width of the warping band in days
K = 4  # fixed value: number of clusters

USERS = """daily AS (SELECT user_id, day(ts) AS day, date_trunc('month', ts) AS m, sum(value) AS v,
    max(date_trunc('month', ts)) OVER (PARTITION BY user_id) AS last FROM events GROUP BY user_id, day(ts), date_trunc('month', ts), ts),
  sums AS (SELECT user_id, day, sum(v) AS v FROM daily WHERE m = last GROUP BY 1, 2),
  seqs AS (SELECT u.user_id, r.i AS day, round(coalesce(s.v, 0), 2) AS v FROM (SELECT DISTINCT user_id FROM daily) u
    CROSS JOIN range(1, 32) r(i) LEFT JOIN sums s ON s.user_id = u.user_id AND s.day = r.i),
  pairs AS (SELECT a.user_id AS i, b.user_id AS j, sqrt(sum((a.v - b.v) * (a.v - b.v))) AS dist
    FROM seqs a JOIN seqs b ON a.day = b.day AND a.user_id <> b.user_id GROUP BY 1, 2)"""


def users(spark, sf):
    """Distinct daily value arrays of the users' latest month, cents rounded, and the array of each user."""
    daily = seq.daily_sequences(table(spark, sf, "events"), ["user_id"], "ts", "value")
    cents = cut_lineage(daily.withColumn("amounts", F.transform("amounts", lambda x: F.round(x, 2))))
    distinct = cut_lineage(dtw.distinct_sequences(cents, "user_id", "amounts"))
    return distinct, dtw.members(cents, "user_id", "amounts", distinct)


def user_sequences(spark, sf):
    return users(spark, sf)[0]


def for_users(labelled, belongs):
    return dtw.label_members(labelled, belongs, "user_id")


@query("j3_dtw_pairs")
def dtw_pairs(spark, sf):
    return dtw.pairs_within(user_sequences(spark, sf), 350.0, RADIUS)


@query(
    "j3_dtw_pairs_radius_0",
    f"WITH {USERS} SELECT i, j, round(dist, 6) AS dist FROM pairs WHERE i < j AND dist <= 500",
)
def dtw_pairs_radius_0(spark, sf):
    # without warping the distance is the Euclidean one, which SQL can state
    return dtw.pairs_within(user_sequences(spark, sf), 500.0, 0).withColumn("dist", F.round("dist", 6))


def user_categories(spark, sf):
    """The users' latest month for every event type and the total, and the names of both."""
    events = table(spark, sf, "events")
    names = seq.category_names(events, "event_type")
    return seq.daily_sequences_by_category(events, ["user_id"], "ts", "value", "event_type", names), [*names, seq.TOTAL]


def category_sequences(spark, sf):
    """Distinct arrays of the users' latest month for every event type and the total, cents rounded."""
    wide, _ = user_categories(spark, sf)
    cents = wide.withColumn("amounts", F.transform("amounts", lambda x: F.round(x, 2)))
    return cut_lineage(dtw.distinct_sequences(cents, "user_id", "amounts", ["category"]))


@query("j4_dtw_by_category")
def dtw_by_category(spark, sf):
    return dtw.pairs_within(category_sequences(spark, sf), 150.0, RADIUS, ["category"])


@query(
    "j4_by_category_radius_0",
    """WITH base AS (SELECT user_id, event_type, ts, value, max(date_trunc('month', ts)) OVER (PARTITION BY user_id) AS last FROM events),
         latest AS (SELECT user_id, event_type, day(ts) AS day, value FROM base WHERE date_trunc('month', ts) = last),
         sums AS (SELECT user_id, event_type AS category, day, sum(value) AS v FROM latest GROUP BY 1, 2, 3
                  UNION ALL SELECT user_id, 'Total', day, sum(value) FROM latest GROUP BY 1, 3),
         grid AS (SELECT user_id, category, i AS day FROM (SELECT DISTINCT user_id FROM events), (SELECT DISTINCT event_type AS category FROM events WHERE event_type IS NOT NULL UNION ALL SELECT 'Total'), range(1, 32) r(i)),
         seqs AS (SELECT user_id, category, list(round(coalesce(v, 0), 2) ORDER BY day) AS l FROM grid LEFT JOIN sums USING (user_id, category, day) GROUP BY 1, 2),
         firsts AS (SELECT category, l, min(user_id) AS id FROM seqs GROUP BY 1, 2)
       SELECT a.category, a.id AS i, b.id AS j, round(list_distance(a.l, b.l), 6) AS dist FROM firsts a JOIN firsts b ON a.category = b.category AND a.id < b.id
       WHERE list_distance(a.l, b.l) <= 250""",
)
def by_category_radius_0(spark, sf):
    found = dtw.pairs_within(category_sequences(spark, sf), 250.0, 0, ["category"])
    return found.withColumn("dist", F.round("dist", 6))


@query("j5_dtw_topk")
def dtw_topk(spark, sf):
    nodes, belongs = users(spark, sf)
    return dtw.nearest_members(dtw.nearest_sequences(nodes, 5, RADIUS), belongs, "user_id", 5)


@query(
    "j5_topk_radius_0",
    f"""WITH {USERS} SELECT i, j, round(dist, 6) AS dist, CAST(pos AS INTEGER) AS pos FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY dist, j) AS pos FROM pairs) WHERE pos <= 5""",
)
def topk_radius_0(spark, sf):
    nodes, belongs = users(spark, sf)
    return dtw.nearest_members(dtw.nearest_sequences(nodes, 5, 0), belongs, "user_id", 5).withColumn("dist", F.round("dist", 6))


def landmark_features(nodes):
    """Written distances of the sequences to landmarks, and the number of landmarks."""
    marks = clustering.landmark_count(nodes)
    return cut_lineage(clustering.landmark_features(nodes, marks, RADIUS, ("seq_id", "copies"))), min(marks, nodes.count())


def kmeans_labels(features):
    return clustering.kmeans(features, "distances", K, weight="copies").select("seq_id", "label")


def scaled_labels(nodes, weight=None):
    """(seq_id, label, position) from ten standardised dimensions of classical scaling."""
    keep = ("seq_id", "copies") if weight else ("seq_id",)
    placed = cut_lineage(clustering.landmark_scaling(nodes, 10, clustering.landmark_count(nodes), RADIUS, keep))
    return clustering.kmeans(clustering.standardise(placed, "position", 10), "position", K, weight=weight)


@query("j6_kmeans_on_distances")
def kmeans_on_distances(spark, sf):
    nodes, belongs = users(spark, sf)
    return for_users(kmeans_labels(landmark_features(nodes)[0]), belongs)


@query("j7_mds_scale_kmeans")
def mds_scale_kmeans(spark, sf):
    wide, categories = user_categories(spark, sf)
    wide, out = cut_lineage(wide), None
    for category in categories:
        one = wide.where(F.col("category") == category).select(F.col("user_id").alias("seq_id"), F.col("amounts").alias("values"))
        part = clustering.kmeans_centres(scaled_labels(one), "position").withColumn("category", F.lit(category))
        out = part if out is None else out.unionByName(part)
    return out


@query("j8_dbscan")
def dbscan(spark, sf):
    nodes, belongs = users(spark, sf)
    return for_users(clustering.dbscan(nodes, 350.0, 5, RADIUS), belongs)


@query(
    "j8_dbscan_radius_0",
    f"""WITH RECURSIVE {USERS}, near AS (SELECT i, j FROM pairs WHERE dist <= 520),
          nodes AS (SELECT user_id AS seq_id, (SELECT count(*) FROM near WHERE i = user_id) + 1 >= 5 AS is_core FROM (SELECT DISTINCT user_id FROM seqs)),
          links AS (SELECT i, j FROM near JOIN nodes a ON a.seq_id = i AND a.is_core JOIN nodes b ON b.seq_id = j AND b.is_core),
          reach AS (SELECT seq_id AS a, seq_id AS b FROM nodes WHERE is_core UNION SELECT r.a, l.j FROM reach r JOIN links l ON l.i = r.b),
          cores AS (SELECT a AS seq_id, min(b) AS label FROM reach GROUP BY 1),
          border AS (SELECT i AS seq_id, min(label) AS label FROM near JOIN cores ON cores.seq_id = j GROUP BY 1)
        SELECT n.seq_id, coalesce(c.label, b.label, -1) AS label, n.is_core FROM nodes n LEFT JOIN cores c USING (seq_id) LEFT JOIN border b USING (seq_id)""",
)
def dbscan_radius_0(spark, sf):
    nodes, belongs = users(spark, sf)
    return for_users(clustering.dbscan(nodes, 520.0, 5, 0), belongs)


@query("j9_density_cut")
def density_cut(spark, sf):
    nodes, belongs = users(spark, sf)
    nearest = cut_lineage(dtw.nearest_sequences(nodes, 4, RADIUS))
    return for_users(clustering.density_cut(nodes, dtw.pairs_within(nodes, 380.0, RADIUS), nearest, 380.0, 5), belongs)


@query(
    "j9_density_cut_radius_0",
    f"""WITH RECURSIVE {USERS}, core AS (SELECT i, max(dist) AS core FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY dist, j) AS pos FROM pairs) WHERE pos <= 4 GROUP BY 1),
          links AS (SELECT p.i, p.j FROM pairs p JOIN core a ON a.i = p.i JOIN core b ON b.i = p.j WHERE greatest(p.dist, a.core, b.core) <= 540),
          reach AS (SELECT i AS a, i AS b FROM core UNION SELECT r.a, l.j FROM reach r JOIN links l ON l.i = r.b),
          comp AS (SELECT a AS seq_id, min(b) AS component FROM reach GROUP BY 1),
          sizes AS (SELECT component, count(*) AS n FROM comp GROUP BY 1)
        SELECT seq_id, CASE WHEN n >= 5 THEN component ELSE -1 END AS label FROM comp JOIN sizes USING (component)""",
)
def density_cut_radius_0(spark, sf):
    nodes, belongs = users(spark, sf)
    nearest = cut_lineage(dtw.nearest_sequences(nodes, 4, 0))
    return for_users(clustering.density_cut(nodes, dtw.pairs_within(nodes, 540.0, 0), nearest, 540.0, 5), belongs)


def tree_labels(nodes, nearest, features):
    """(seq_id, label) of the density tree; neighbours and distances to landmarks bound the search for its edges."""
    marks = dtw.pick_landmarks(nodes, clustering.landmark_count(nodes))
    known = features.select(F.col("seq_id").alias("i"), F.posexplode("distances").alias("at", "dist"))
    known = known.withColumn("j", F.get(F.array(*[F.lit(m) for m, _ in marks]), F.col("at"))).where("i <> j").select("i", "j", "dist")
    cores = cut_lineage(clustering.core_distances(nodes, nearest))
    edges = tree.spanning_tree(nodes, cores, nearest.select("i", "j", "dist").unionByName(known), RADIUS)
    vertices = cut_lineage(nodes.join(cores.withColumnRenamed("i", "seq_id"), "seq_id").select("seq_id", "copies", "core"))
    return tree.density_tree(vertices, edges, 5)


@query("j9_density_tree")
def density_tree(spark, sf):
    nodes, belongs = users(spark, sf)
    nearest = cut_lineage(dtw.nearest_sequences(nodes, 4, RADIUS))
    return for_users(tree_labels(nodes, nearest, landmark_features(nodes)[0]), belongs)


@query("j10_hierarchical")
def hierarchical(spark, sf):
    nodes, belongs = users(spark, sf)
    return for_users(clustering.hierarchical(*landmark_features(nodes), K), belongs)


@query("j11_spectral")
def spectral(spark, sf):
    nodes, belongs = users(spark, sf)
    found = clustering.affinity_of_blocks(*dtw.pairs_in_blocks(nodes, 400.0, RADIUS), K)
    return dtw.label_members(found, belongs, "user_id", "id")


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", "embedding")


VECTORS = """x AS (SELECT vec_id, label, i AS pos, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) r(i)),
  c AS (SELECT label, pos, avg(v) AS mean, count(*) AS n FROM x GROUP BY 1, 2)"""


SILHOUETTE_SQL = f"""WITH {VECTORS}, d AS (SELECT a.vec_id AS i, a.label AS li, b.label AS lj, b.vec_id AS j, sum((a.v - b.v) * (a.v - b.v)) AS dist
              FROM x a JOIN x b ON a.pos = b.pos AND a.vec_id <> b.vec_id GROUP BY 1, 2, 3, 4),
          m AS (SELECT i, li, lj, avg(dist) AS mean FROM d GROUP BY 1, 2, 3),
          s AS (SELECT i, max(CASE WHEN li = lj THEN mean END) AS a, min(CASE WHEN li <> lj THEN mean END) AS b FROM m GROUP BY 1)
        SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s"""


@query("j12_silhouette", SILHOUETTE_SQL)
def silhouette(spark, sf):
    out = clustering.silhouette(vectors(spark, sf), "embedding", "label")
    return out.select(F.round("silhouette", 6).alias("silhouette"))


CH_SQL = f"""WITH {VECTORS}, g AS (SELECT pos, avg(v) AS mean FROM x GROUP BY 1),
  b AS (SELECT sum(n * (c.mean - g.mean) * (c.mean - g.mean)) AS v FROM c JOIN g USING (pos)),
  w AS (SELECT sum((v - mean) * (v - mean)) AS v FROM x JOIN c USING (label, pos)),
  k AS (SELECT count(DISTINCT label) AS k, count(*) AS n FROM embeddings)
  SELECT round((b.v / (k - 1)) / (w.v / (n - k)), 6) AS calinski_harabasz FROM b, w, k"""


@query("j13_calinski_harabasz", CH_SQL)
def calinski_harabasz(spark, sf):
    out = clustering.calinski_harabasz(vectors(spark, sf), "embedding", "label")
    return out.select(F.round("calinski_harabasz", 6).alias("calinski_harabasz"))


DB_SQL = f"""WITH {VECTORS}, gap AS (SELECT vec_id, label, sqrt(sum((v - mean) * (v - mean))) AS g FROM x JOIN c USING (label, pos) GROUP BY 1, 2),
  s AS (SELECT label, avg(g) AS s FROM gap GROUP BY 1),
  m AS (SELECT a.label AS a, b.label AS b, sqrt(sum((a.mean - b.mean) * (a.mean - b.mean))) AS m FROM c a JOIN c b ON a.pos = b.pos AND a.label <> b.label GROUP BY 1, 2),
  r AS (SELECT m.a, max((sa.s + sb.s) / m.m) AS worst FROM m JOIN s sa ON sa.label = m.a JOIN s sb ON sb.label = m.b GROUP BY 1)
  SELECT round(avg(worst), 6) AS davies_bouldin FROM r"""


@query("j14_davies_bouldin", DB_SQL)
def davies_bouldin(spark, sf):
    out = clustering.davies_bouldin(vectors(spark, sf), "embedding", "label")
    return out.select(F.round("davies_bouldin", 6).alias("davies_bouldin"))


@query("j15_evaluate_clustering")
def evaluate_clustering(spark, sf):
    """Scores of J6 to J11 on the users' sequences: silhouettes on warping distances, the others on distances to landmarks."""
    nodes, belongs = users(spark, sf)
    features, marks = landmark_features(nodes)
    nearest = cut_lineage(dtw.nearest_sequences(nodes, 4, RADIUS))
    near = dtw.pairs_in_blocks(nodes, 400.0, RADIUS)
    labelled = {
        "kmeans": kmeans_labels(features),
        "scaled_kmeans": scaled_labels(nodes, "copies").select("seq_id", "label"),
        "dbscan": clustering.dbscan(nodes, 350.0, 5, RADIUS).select("seq_id", "label"),
        "density_cut": clustering.density_cut(nodes, dtw.pairs_of_blocks(*near, 380.0), nearest, 380.0, 5),
        "hierarchical": clustering.hierarchical(features, marks, K),
        "spectral": clustering.affinity_of_blocks(*near, K).withColumnRenamed("id", "seq_id"),
    }
    labelled = {name: cut_lineage(found.withColumn("label", F.col("label").cast("long"))) for name, found in labelled.items()}
    rows = features.select("seq_id", "distances").join(belongs, "seq_id")  # a row for each user
    scored = {name: rows.join(found, "seq_id").select("distances", "label") for name, found in labelled.items()}
    others = clustering.evaluate_clusterings(scored, "distances").drop("silhouette")
    return clustering.warping_silhouettes(nodes, labelled, RADIUS).join(others, "algorithm")


@query(
    "j15_scores_of_labels",
    f"""WITH s AS (SELECT * FROM ({SILHOUETTE_SQL})), h AS ({CH_SQL}), b AS ({DB_SQL})
        SELECT 'labels' AS algorithm, silhouette, calinski_harabasz, davies_bouldin FROM s, h, b
        UNION ALL SELECT 'with_noise', 'nan'::DOUBLE, 'nan'::DOUBLE, 'nan'::DOUBLE""",
)
def scores_of_labels(spark, sf):
    given = vectors(spark, sf)
    noisy = given.withColumn("label", F.col("label") - 1)
    found = clustering.evaluate_clusterings({"labels": given, "with_noise": noisy}, "embedding")
    return found.select("algorithm", *[F.round(c, 6).alias(c) for c in ("silhouette", "calinski_harabasz", "davies_bouldin")])
