"""Registered queries on the ``embeddings`` table (64-D points with a label), SURVEY §7.2:
seeded K-Means assignment (F4), exact silhouette of the given labels (F5) and the
10-restart K-Means fit (F3) — the workloads the baseline figures describe."""

from __future__ import annotations

from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.operators import segment as sg
from persona_engine.plans.oracle_views import kmeans_ctes
from persona_engine.plans.registry import register

K, SEED = 7, 42
DIM = 64
E_COLS = [f"e{i}" for i in range(DIM)]


def points(src):
    """Embedding array → 64 double columns (float → double is exact)."""
    e = src.embeddings
    return e.select("vec_id", F.col("label").cast("long").alias("label"),
                    *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(E_COLS)])


LONG_SQL = """emb AS (SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
z AS (SELECT vec_id, printf('e%02d', i - 1) AS feature, v[i] AS value FROM (
        SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS i FROM emb))"""


ASSIGN_SQL = "WITH RECURSIVE " + ",\n".join(f"{n} AS ({q})" for n, q in [
    ("emb", "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"),
    *kmeans_ctes(K, SEED, points="SELECT vec_id, v FROM emb", id_col="vec_id")]) + """
SELECT vec_id, persona_cluster AS cluster, round_even(sq_dist, 6) AS sq_dist FROM assigned"""


@register("embedding_kmeans_assign", ASSIGN_SQL)
def q_embedding_assign(src):
    """F3/F4 on 64-D embeddings: seeded Lloyd (k=7, 10 restarts to convergence), nearest-centroid labels."""
    pts = points(src).select("vec_id", *E_COLS)
    held = pts.persist()
    try:
        cents, _ = sg.lloyd_kmeans(held, E_COLS, sg.clamp_k(held.count(), K), SEED, id_col="vec_id")
    finally:
        held.unpersist()
    out = sg.assign_nearest(pts, E_COLS, cents, label="cluster")
    return out.select("vec_id", "cluster", F.bround("sq_dist", 6).alias("sq_dist"))


SIL_SQL = f"""WITH {LONG_SQL},
smp AS (SELECT vec_id, label AS c, v FROM emb ORDER BY md5('{SEED}:silhouette:' || CAST(vec_id AS VARCHAR))
        LIMIT {fixed.SILHOUETTE_SAMPLE})
SELECT CAST(round_even(avg(s), 6) AS DOUBLE) AS silhouette, count(*) AS n_sampled FROM (
  SELECT x_id, CASE WHEN own_n <= 1 THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s
  FROM (SELECT x_id, max(CASE WHEN same THEN n END) AS own_n, max(CASE WHEN same THEN tot / (n - 1) END) AS a,
               min(CASE WHEN NOT same THEN tot / n END) AS b
        FROM (SELECT x.vec_id AS x_id, y.c = x.c AS same, y.c, sum(list_distance(x.v, y.v)) AS tot, count(*) AS n
              FROM smp x CROSS JOIN smp y GROUP BY x.vec_id, y.c, x.c)
        GROUP BY x_id))"""


@register("embedding_silhouette", SIL_SQL)
def q_embedding_silhouette(src):
    """F5 on 64-D embeddings: exact Euclidean silhouette of the given labels (≤2,000 seeded sample)."""
    s = sg.silhouette_score(points(src), E_COLS, "label", SEED, id_col="vec_id")
    return s.select(F.bround("silhouette", 6).alias("silhouette"), F.col("n_sampled").cast("long"))


@register("embedding_kmeans_fit")
def q_embedding_kmeans_fit(src):
    """F3 on 64-D embeddings: pyspark.ml K-Means, k=7, 10 restarts (seeds 42–51), lowest cost kept (rows-only)."""
    pts = points(src)
    data = sg.assemble(pts.select("vec_id", *E_COLS), E_COLS)
    held = data.persist()
    try:
        model, cost = sg.fit_kmeans(held, E_COLS, sg.clamp_k(held.count(), K), SEED, fixed.N_INIT, features_col="features")
    finally:
        held.unpersist()
    return model.transform(data).select("vec_id", F.col("persona_cluster").cast("long").alias("cluster"),
                                        F.lit(float(cost)).alias("training_cost"))
