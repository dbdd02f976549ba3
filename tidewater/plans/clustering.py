"""Neighbours and clusters over the embeddings."""

import numpy as np
from pyspark.sql import functions as F

from tidewater.operators import agglomerate as A
from tidewater.operators import clusters as C
from tidewater.operators import density as D
from tidewater.operators import indices as I
from tidewater.operators import metrics as M
from tidewater.operators import neighbors as N
from tidewater.operators.sampling import fold_of
from tidewater.plans.bayesian import GNB_SCORES, gnb_predictions
from tidewater.plans.evaluation import rounded
from tidewater.plans.ordering import hash_sql
from tidewater.plans.registry import query
from tidewater.session import settle, table

K = 4


def embeddings(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "embedding", "label")


def space(spark, d):
    """The 3-d cluster set: the first three coordinates of every row."""
    return embeddings(spark, d).select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate("xyz")])


DIST = "sqrt(list_sum(list_transform(list_zip(q.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) ** 2)))"


def knn_sql(k: int, extra: str = "") -> str:
    return f"""m AS (SELECT q.vec_id AS q_id, b.vec_id AS b_id, q.label AS q_label, b.label AS b_label, {DIST} AS dist
      FROM embeddings q, embeddings b WHERE q.vec_id <> b.vec_id {extra}),
      h AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY dist, b_id) AS rank FROM m QUALIFY rank <= {k})"""


def own_neighbours(spark, d, k):
    e = embeddings(spark, d)
    return N.knn(e, e, k, "vec_id", "embedding", exclude_self=True)


@query("knn_exact", f"WITH {knn_sql(K)} SELECT q_id, b_id, rank, round(dist, 6) AS dist FROM h")
def knn_exact(spark, d):
    return own_neighbours(spark, d, K).select("q_id", "b_id", F.col("rank").cast("bigint").alias("rank"), F.round("dist", 6).alias("dist"))


@query("knn_distance", f"WITH {knn_sql(8)} SELECT q_id, round(max(dist), 6) AS k_dist FROM h GROUP BY 1")
def knn_distance(spark, d):
    k = own_neighbours(spark, d, 8).groupBy("q_id").agg(F.round(F.max("dist"), 6).alias("k_dist"))
    return k.orderBy("k_dist", "q_id")


VOTE_SQL = """t AS (SELECT q_id, b_label, count(*) AS n, round(sum(dist), 9) AS far FROM h GROUP BY 1, 2),
  w AS (SELECT q_id, b_label AS predicted, row_number() OVER (PARTITION BY q_id ORDER BY n DESC, far, b_label) AS r FROM t)"""


@query("knn_classify", f"WITH {knn_sql(K)}, {VOTE_SQL} SELECT q_id, predicted FROM w WHERE r = 1")
def knn_classify(spark, d):
    return N.vote(own_neighbours(spark, d, K), embeddings(spark, d), "vec_id", "label")


@query(
    "knn_errors",
    f"""WITH {knn_sql(K)}, {VOTE_SQL}
        SELECT h.q_id, q_label AS label, predicted, b_id, b_label, rank FROM h JOIN w USING (q_id) WHERE r = 1 AND predicted <> q_label""",
)
def knn_errors(spark, d):
    e = embeddings(spark, d)
    hits = settle(own_neighbours(spark, d, K), "hits")
    said = N.vote(hits, e, "vec_id", "label")
    wrong = said.join(e.select(F.col("vec_id").alias("q_id"), "label"), "q_id").filter(F.col("predicted") != F.col("label"))
    near = hits.join(e.select(F.col("vec_id").alias("b_id"), F.col("label").alias("b_label")), "b_id")
    return near.join(wrong, "q_id").select(
        "q_id", "label", "predicted", "b_id", "b_label", F.col("rank").cast("bigint").alias("rank")
    )


GRID = 25
FOLD_SQL = "floor({} * 5 / 4294967296.0)"


@query(
    "cv_knn_grid",
    f"""WITH {knn_sql(GRID, f"AND {FOLD_SQL.format(hash_sql('q.vec_id', 9))} <> {FOLD_SQL.format(hash_sql('b.vec_id', 9))}")},
       g AS (SELECT unnest(range(1, {GRID + 1}))::INTEGER AS k),
       t AS (SELECT q_id, q_label, k, b_label, count(*) AS n, round(sum(dist), 9) AS far FROM h JOIN g ON rank <= k GROUP BY 1, 2, 3, 4),
       w AS (SELECT *, row_number() OVER (PARTITION BY q_id, k ORDER BY n DESC, far, b_label) AS r FROM t)
       SELECT k, round(avg((b_label = q_label)::INTEGER), 6) AS accuracy, count(*) AS n FROM w WHERE r = 1 GROUP BY 1""",
)
def cv_knn_grid(spark, d):
    e = embeddings(spark, d).withColumn("fold", fold_of(F.col("vec_id"), 9, 5))
    hits = None
    for fold in range(5):
        found = N.knn(e.filter(F.col("fold") != fold), e.filter(F.col("fold") == fold), GRID, "vec_id", "embedding")
        hits = found if hits is None else hits.unionByName(found)
    said = N.vote_grid(hits, e, "vec_id", "label", GRID)
    truth = e.select(F.col("vec_id").alias("q_id"), "label")
    hit = (F.col("predicted") == F.col("label")).cast("int")
    return said.join(truth, "q_id").groupBy("k").agg(F.round(F.avg(hit), 6).alias("accuracy"), F.count("*").alias("n"))


# ------------------------------------------------------------------ density

EPS, MIN_PTS = 0.05, 6


@query(
    "dbscan",
    f"""WITH RECURSIVE p AS (SELECT vec_id AS id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
      n AS (SELECT a.id AS a, b.id AS b FROM p a, p b
            WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) <= {EPS * EPS + 1e-12!r}),
      c AS (SELECT a AS id FROM n GROUP BY 1 HAVING count(*) >= {MIN_PTS}),
      e AS (SELECT a, b FROM n WHERE a IN (FROM c) AND b IN (FROM c)),
      r(id, root) AS (SELECT id, id FROM c UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
      k AS (SELECT id, min(root) AS cluster FROM r GROUP BY 1),
      o AS (SELECT n.a AS id, min(k.cluster) AS cluster FROM n JOIN k ON k.id = n.b GROUP BY 1)
      SELECT p.id, p.id IN (FROM c) AS is_core, coalesce(k.cluster, o.cluster) AS cluster
      FROM p LEFT JOIN k ON k.id = p.id LEFT JOIN o ON o.id = p.id""",
)
def dbscan(spark, d):
    return D.dbscan(space(spark, d), "vec_id", ["x", "y", "z"], EPS, MIN_PTS)


SNN_K, SNN_SHARED, SNN_MIN = 8, 2, 7


@query(
    "snn_cluster",
    f"""WITH RECURSIVE {knn_sql(SNN_K)},
      l AS (SELECT q_id, list(b_id) AS near FROM h GROUP BY 1),
      s AS (SELECT h.q_id, h.b_id FROM h JOIN l a ON a.q_id = h.q_id JOIN l b ON b.q_id = h.b_id
            WHERE len(list_intersect(a.near, b.near)) >= {SNN_SHARED}),
      c AS (SELECT q_id AS id FROM s GROUP BY 1 HAVING count(*) + 1 >= {SNN_MIN}),
      f AS (SELECT q_id, b_id FROM s WHERE q_id IN (FROM c)),
      e AS (SELECT q_id AS a, b_id AS b FROM f WHERE b_id IN (FROM c) UNION SELECT b_id, q_id FROM f WHERE b_id IN (FROM c)),
      r(id, root) AS (SELECT id, id FROM c UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
      k AS (SELECT id, min(root) AS cluster FROM r GROUP BY 1),
      o AS (SELECT b_id AS id, min(cluster) AS cluster FROM f JOIN k ON k.id = f.q_id GROUP BY 1)
      SELECT vec_id AS id, k.id IS NOT NULL AS is_core, coalesce(k.cluster, o.cluster) AS cluster
      FROM embeddings LEFT JOIN k ON k.id = vec_id LEFT JOIN o ON o.id = vec_id""",
)
def snn_cluster(spark, d):
    hits = settle(own_neighbours(spark, d, SNN_K), "hits")
    ids = embeddings(spark, d).select(F.col("vec_id").alias("id"))
    return D.snn_clusters(hits, ids, SNN_SHARED, SNN_MIN)


# ----------------------------------------------------------------- centroids


def features(spark, d):
    return C.as_features(embeddings(spark, d), "embedding")


@query("kmeans")
def kmeans(spark, d):
    rows = embeddings(spark, d)
    centres = C.kmeans_best(rows, "embedding", 8, starts=25, iterations=100)
    return rows.select("vec_id", "label", C.nearest_centre(centres, F.col("embedding"))["cluster"].alias("cluster"))


def label_centres(spark, d):
    cells = embeddings(spark, d).select("label", F.posexplode("embedding"))
    means = cells.groupBy("label", "pos").agg(F.avg(F.col("col").cast("double")).alias("m")).orderBy("label", "pos").toPandas()
    return np.asarray([g["m"].tolist() for _, g in means.groupby("label")])


@query(
    "kmeans_step",
    """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding)))::INTEGER AS pos FROM embeddings),
       c AS (SELECT dense_rank() OVER (ORDER BY label) - 1 AS cluster, pos, m FROM (SELECT label, pos, avg(v) AS m FROM x GROUP BY 1, 2)),
       s AS (SELECT vec_id, cluster, sum((v - m) * (v - m)) AS sq FROM x JOIN c USING (pos) GROUP BY 1, 2),
       a AS (SELECT vec_id, cluster FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY sq, cluster) = 1)
       SELECT cluster::INTEGER AS cluster, pos, round(avg(v), 6) AS centre, count(*) AS n FROM x JOIN a USING (vec_id) GROUP BY 1, 2""",
)
def kmeans_step(spark, d):
    return rounded(C.kmeans_step(embeddings(spark, d), "embedding", label_centres(spark, d)))


@query(
    "bss_tss",
    """WITH x AS (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS pos FROM embeddings),
       t AS (SELECT sum(s) AS tss FROM (SELECT var_pop(v) * count(*) AS s FROM x GROUP BY pos)),
       w AS (SELECT sum(s) AS wss FROM (SELECT var_pop(v) * count(*) AS s FROM x GROUP BY pos, label))
       SELECT round(tss, 6) AS tss, round(wss, 6) AS wss, round(tss - wss, 6) AS bss, round((tss - wss) / tss, 6) AS ratio FROM t, w""",
)
def bss_tss(spark, d):
    return rounded(C.sums_of_squares(embeddings(spark, d), "embedding", "label"))


@query("elbow_wss")
def elbow_wss(spark, d):
    return C.elbow(embeddings(spark, d), "embedding", range(10, 101, 10))


def vectors(spark, d):
    """The unlabelled set."""
    return embeddings(spark, d).select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))


@query("gap_stat")
def gap_stat(spark, d):
    return C.gap_statistic(vectors(spark, d), "vec", range(1, 11))


@query("cluster_indices")
def cluster_indices(spark, d):
    return I.cluster_indices(vectors(spark, d), "vec", range(2, 11))


@query("hier_ward")
def hier_ward(spark, d):
    return A.agglomerative(embeddings(spark, d), "vec_id", "embedding", 8)


@query("hier_centroid")
def hier_centroid(spark, d):
    return A.agglomerative(embeddings(spark, d), "vec_id", "embedding", 8, ward=False)


@query("bisecting_kmeans")
def bisecting_kmeans(spark, d):
    whole = embeddings(spark, d).select("vec_id", "embedding")
    return C.bisecting(whole, "vec_id", "embedding", 8)


@query("kernel_kmeans")
def kernel_kmeans(spark, d):
    rows = embeddings(spark, d)
    return C.kernel_kmeans(rows, "embedding", 5, gamma=0.5).select("vec_id", "label", "cluster", F.round("missed", 6).alias("missed"))


@query(
    "eval_cluster_match",
    """WITH p AS (SELECT o_orderpriority AS label, substr(o_orderpriority, 1, 1) AS one,
           CASE WHEN o_totalprice < 350000 THEN cast((substr(o_orderpriority, 1, 1)::INTEGER % 5) + 1 AS VARCHAR)
                ELSE substr(o_orderpriority, 1, 1) END AS cluster FROM orders),
       t AS (SELECT count(*) AS n, avg((one = cluster)::INTEGER) AS raw FROM p),
       m AS (SELECT count(*) AS k FROM p WHERE cluster = cast((one::INTEGER % 5) + 1 AS VARCHAR))
       SELECT n, round(raw, 6) AS raw_agreement, round(k / n, 6) AS matched_agreement FROM t, m""",
)
def eval_cluster_match(spark, d):
    # cluster ids are the labels turned by one place for the cheaper orders
    one = F.substring("o_orderpriority", 1, 1)
    turned = (one.cast("int") % 5 + 1).cast("string")
    rows = table(spark, d, "orders").select(
        one.alias("label"), F.when(F.col("o_totalprice") < 350000, turned).otherwise(one).alias("cluster")
    )
    return rounded(M.cluster_match(rows, "label", "cluster"))


@query(
    "classifier_errors",
    f"WITH {GNB_SCORES} SELECT label, predicted, count(*) AS n FROM b JOIN embeddings USING (vec_id) WHERE k = 1 GROUP BY 1, 2",
)
def classifier_errors(spark, d):
    """Confusion table of the Gaussian model on the embeddings."""
    return M.confusion(gnb_predictions(spark, d), "label", "predicted").withColumn("predicted", F.col("predicted").cast("int"))
