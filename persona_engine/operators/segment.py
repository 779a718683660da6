"""Segmentation.

Two K-Means paths:

* ``lloyd_kmeans`` — seeded, deterministic Lloyd iterations with restarts, each to
  convergence. Seeds are the k rows with the smallest md5(seed:init:restart:id) (a
  distributed top-k). ``lloyd.iterate`` steps from them over blocks of points, all restarts in
  one job; a pass of exact distances for all restarts (numpy in the tasks against broadcast
  centroids, one row of sums per restart and cluster) confirms the result. The final labels come from
  ``assign_nearest``, a JVM projection over the centroids written as one SQL expression.
  Results do not depend on partitioning, so they are checkable against SQL.
* ``fit_kmeans`` — ``pyspark.ml`` K-Means (k-means||) with ``n_init`` restarts, keeping the
  lowest training cost, as the original's n_init=10; the restarts are stepped together.

The silhouette is exact Euclidean on a hash sample of at most 2,000 points:
the sample (bounded: 2000 × d doubles) is broadcast and each task scores its
share of sample points against it with numpy inside ``mapInPandas``.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.functions.expr import hash_order
from persona_engine.operators.lloyd import iterate, point_blocks


TOO_FEW_ROWS = "At least 2 samples are required for clustering."
NOT_FINITE = "K-Means takes finite values only; a row has a missing or an infinite one."


def clamp_k(n_rows: int, n_personas: int) -> int:
    """Q9: k = min(n_personas, n); when k == n use max(2, n − 1); n < 2 is an error."""
    if n_rows < 2:
        raise ValueError(TOO_FEW_ROWS)
    k = min(n_personas, n_rows)
    if k == n_rows:
        k = max(2, n_rows - 1)
    return k


def guard_min_rows(df: DataFrame) -> int:
    """cheap check that at least two rows exist (reads at most 2 rows)."""
    n = df.limit(2).count()
    if n < 2:
        raise ValueError(TOO_FEW_ROWS)
    return n


def group_errors(df: DataFrame, by: list[str]) -> DataFrame:
    """F9 for many small jobs at once: each group's rows and ``error``, what clustering it would raise, or null."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).withColumn("error", F.when(F.col("n") < 2, TOO_FEW_ROWS))


def _dbl(v: float) -> str:
    """Exact SQL double literal (repr round-trips the binary value)."""
    return f"({float(v)!r}D)"


def sq_dist_sql(cols: list[str], centroid) -> str:
    terms = [f"(`{c}` - {_dbl(v)}) * (`{c}` - {_dbl(v)})" for c, v in zip(cols, centroid)]
    return "(" + " + ".join(terms) + ")"


def assign_nearest(df: DataFrame, cols: list[str], centroids: dict, label: str = "persona_cluster",
                   dist: str = "sq_dist") -> DataFrame:
    """label = id of the nearest centroid (ties → smallest id), plus the squared distance.

    ``centroids`` maps cluster id → vector. Pure projection: no join, no shuffle.
    The expression is handed to Spark as one SQL text (one parse instead of
    hundreds of client-side expression calls).
    """
    ids = sorted(centroids)
    arr = "array(" + ", ".join(sq_dist_sql(cols, centroids[i]) for i in ids) + ")"
    id_arr = "array(" + ", ".join(f"CAST({int(i)} AS BIGINT)" for i in ids) + ")"
    d = df.withColumn("_d", F.expr(arr))
    return d.withColumns({label: F.expr(f"element_at({id_arr}, CAST(array_position(_d, array_min(_d)) AS INT))"),
                          dist: F.array_min("_d")}).drop("_d")


def seed_centroids(df: DataFrame, cols: list[str], k: int, seed: int, id_col: str = "cust_id", restarts: int = 1) -> list[dict]:
    """Per restart, the k rows of smallest md5(seed:init:restart:id): one job of distributed top-k's, ≤ k rows each."""
    tops = []
    for r in range(restarts):
        h = hash_order(seed, f"init:{r}", id_col)
        tops.append(df.select(F.lit(r).alias("_r"), h.alias("_h"), *cols).orderBy("_h").limit(k))
    rows = reduce(DataFrame.unionByName, tops).collect()
    out = []
    for r in range(restarts):
        mine = sorted((x for x in rows if x["_r"] == r), key=lambda x: x["_h"])
        out.append({i: [x[c] for c in cols] for i, x in enumerate(mine)})
    return out


_CHUNK_ROWS = 2_048


def lloyd_partials(df: DataFrame, cols: list[str], centroids: dict[int, dict]) -> dict:
    """One Lloyd step of several restarts: {restart: {cluster: (count, cost, coordinate sums)}}.

    Each task assigns its rows with numpy against the broadcast centroids (restarts × k × d
    doubles), adds up over all its batches, and emits one row per restart and cluster; those
    rows (≤ restarts × k per partition) are summed in the JVM with map-side combine.
    """
    spark = df.sparkSession
    keys = [(r, i) for r in sorted(centroids) for i in sorted(centroids[r])]
    bc = spark.sparkContext.broadcast((keys, np.array([centroids[r][i] for r, i in keys], dtype=float)))
    d = len(cols)

    def step(batches):
        names, c = bc.value
        cut = [j for j in range(len(names)) if j == 0 or names[j][0] != names[j - 1][0]] + [len(names)]
        n, cost, sums = np.zeros(len(names), np.int64), np.zeros(len(names)), np.zeros((len(names), d))
        for pdf in batches:
            every = pdf.to_numpy(dtype=float)
            for lo in range(0, len(every), _CHUNK_ROWS):
                x = every[lo:lo + _CHUNK_ROWS]
                dist = np.stack([((x - v) ** 2).sum(axis=1) for v in c], axis=1)
                for a, b in zip(cut[:-1], cut[1:]):
                    j = dist[:, a:b].argmin(axis=1) + a      # ties → the smallest cluster id
                    n += np.bincount(j, minlength=len(names))
                    cost += np.bincount(j, dist[np.arange(len(x)), j], len(names))
                    np.add.at(sums, j, x)
        hit = np.flatnonzero(n)
        if len(hit):
            yield pd.DataFrame({"r": [names[j][0] for j in hit], "cid": [names[j][1] for j in hit], "n": n[hit], "cost": cost[hit],
                                **{f"s{k}": sums[hit, k] for k in range(d)}})

    part = df.select(*cols).mapInPandas(step, "r long, cid long, n long, cost double, " + ", ".join(f"s{k} double" for k in range(d)))
    rows = part.groupBy("r", "cid").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"),
                                        *[F.sum(f"s{k}").alias(f"s{k}") for k in range(d)]).collect()
    bc.unpersist()
    out: dict = {r: {} for r in centroids}
    for x in rows:
        out[x["r"]][x["cid"]] = (x["n"], x["cost"], np.array([x[f"s{k}"] for k in range(d)]))
    return out


def lloyd_kmeans(df: DataFrame, cols: list[str], k: int, seed: int = 42, n_init: int = fixed.N_INIT, max_iter: int = 300,
                 id_col: str = "cust_id", tol: float = 1e-9, blocks: RDD | None = None) -> tuple[dict, list]:
    """Lloyd K-Means with ``n_init`` seeded restarts, each until its centroids stop moving (``max_iter`` steps at most).

    ``lloyd.iterate`` steps over blocks of points from the seeds; passes with exact distances,
    shared by all restarts that still move, then confirm that nothing moves. Returns the
    centroids of the restart with the lowest cost (of equal costs to six digits, the first)
    and its cost per exact pass. Empty clusters drop out (their id is not reused). ``df`` is
    scanned by every exact pass: the caller persists it. ``blocks``: its ``point_blocks``, if made.
    """
    seeds = seed_centroids(df, cols, k, seed, id_col, n_init)
    held = blocks if blocks is not None else point_blocks(df, cols)
    try:
        found = iterate(held, [(sorted(s), np.array([s[i] for i in sorted(s)], float)) for s in seeds], len(cols), max_iter, tol)
    finally:
        if blocks is None:
            held.unpersist()
    if not all(np.isfinite(s.at).all() for s in found):
        raise ValueError(NOT_FINITE)
    cents = {r: {i: list(map(float, v)) for i, v in zip(s.ids, s.at)} for r, s in enumerate(found)}
    history: dict = {r: [] for r in cents}
    moving = set(cents)
    while moving:
        parts = lloyd_partials(df, cols, {r: cents[r] for r in moving})
        for r in sorted(moving):
            new = {i: (s / n).tolist() for i, (n, _c, s) in parts[r].items()}
            history[r].append(sum(c for _n, c, _s in parts[r].values()))
            still = new.keys() == cents[r].keys() and all(
                np.linalg.norm(np.subtract(new[i], cents[r][i])) <= tol for i in new)
            if still or found[r].steps < max_iter:
                cents[r] = new
            if still or found[r].steps >= max_iter:
                moving.discard(r)
            found[r].steps += 1
    best = min(cents, key=lambda r: (round(history[r][-1], 6) if history[r] else 0.0, r))
    return cents[best], history[best]


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


#: Costs this near (as a share) to the lowest one's are told apart by pyspark.ml's own fits.
NEAR_COST = 1e-6


def fit_kmeans(df: DataFrame, cols: list[str], k: int, seed: int = 42, n_init: int = fixed.N_INIT,
               max_iter: int = 300, features_col: str | None = None, parallel: int | None = None):
    """pyspark.ml K-Means with n_init restarts; keeps the lowest training cost (ties → earlier seed).

    pyspark.ml draws the starting centres of every restart (k-means||, concurrent jobs). The
    restarts' steps, up to pyspark.ml's tolerance, run together over blocks of points
    (``lloyd.iterate``); the restart of lowest cost, and any as near as ``NEAR_COST``, are then
    fitted by pyspark.ml, whose model and cost are returned. The caller should cache ``df``.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml.functions import vector_to_array
    data = df if features_col else assemble(df, cols)
    fc = features_col or "features"

    def estimator(i, steps):
        return KMeans(k=k, seed=seed + i, maxIter=steps, featuresCol=fc, predictionCol="persona_cluster")

    def start(i):
        return np.array(estimator(i, 0).fit(data).clusterCenters(), float)

    def one(i):
        model = estimator(i, max_iter).fit(data)
        return i, model, model.summary.trainingCost

    with ThreadPoolExecutor(max_workers=parallel or min(n_init, 4)) as pool:
        near = list(range(n_init))
        if n_init > 1:
            starts = list(pool.map(start, near))
            arrays = data.select(vector_to_array(fc).alias("v"))
            blocks = point_blocks(arrays.select(*[F.col("v")[j].alias(f"c{j}") for j in range(len(cols))]), [f"c{j}" for j in range(len(cols))])
            try:
                found = iterate(blocks, [(list(range(len(c))), c) for c in starts], len(cols), max_iter, KMeans().getTol(), drop_empty=False)
            finally:
                blocks.unpersist()
            lowest = min(s.cost for s in found)
            near = [i for i in near if not found[i].cost > lowest * (1 + NEAR_COST)]
        fits = list(pool.map(one, near))
    _, model, cost = min(fits, key=lambda t: (t[2], t[0]))
    return model, cost


def covariance(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Sample covariance matrix of the columns (missing values count as 0): one aggregation in the JVM, columns × columns on the driver."""
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils

    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    vectors = MLUtils.convertVectorColumnsFromML(assemble(filled, cols).select("features"), "features")
    return RowMatrix(vectors).computeCovariance().toArray()


def principal_axes(cov: np.ndarray, k: int = 2) -> np.ndarray:
    """The first k eigenvectors by falling eigenvalue, each signed so that its largest component (the first of equals) is positive.

    That makes them, and the coordinates along them, a function of the matrix alone, as long
    as the eigenvalues differ.
    """
    value, vector = np.linalg.eigh(cov)
    axes = vector[:, np.argsort(-value, kind="stable")[:k]].T
    size = np.abs(axes)
    lead = np.argmax(size >= size.max(axis=1, keepdims=True) - 1e-9, axis=1)
    return axes * np.where(axes[np.arange(len(axes)), lead] < 0, -1.0, 1.0)[:, None]


def pca_projection(df: DataFrame, cols: list[str], k: int = 2, keep: list[str] | None = None) -> DataFrame:
    """F2 (re-aimed): coordinates x, y along the first principal axes of the columns, with the canonical signs of ``principal_axes``.

    A projection of each row; the axes are literals. A single column gives y = 0.
    """
    axes = principal_axes(covariance(df, cols), k)

    def along(j):
        return F.expr(" + ".join(f"coalesce(CAST(`{c}` AS DOUBLE), 0D) * {_dbl(w)}" for c, w in zip(cols, axes[j]))) if j < len(axes) else F.lit(0.0)
    keep = keep or [c for c in df.columns]
    return df.select(*keep, along(0).alias("x"), along(1).alias("y"))


def silhouette_sample(df: DataFrame, cols: list[str], label: str, seed: int = 42,
                      sample_size: int = fixed.SILHOUETTE_SAMPLE, id_col: str = "cust_id") -> DataFrame:
    """Hash sample of ≤ sample_size rows (distributed top-k on md5 order)."""
    return (df.select(id_col, label, *cols)
            .orderBy(hash_order(seed, "silhouette", id_col)).limit(sample_size))


def silhouette_points(df: DataFrame, cols: list[str], label: str = "persona_cluster", seed: int = 42,
                      sample_size: int = fixed.SILHOUETTE_SAMPLE, id_col: str = "cust_id",
                      partitions: int = 8) -> DataFrame:
    """exact Euclidean silhouette value per sampled point.

    s(i) = (b − a) / max(a, b); a = mean distance to the rest of its cluster,
    b = smallest mean distance to another cluster; singleton cluster → 0.
    """
    sample = silhouette_sample(df, cols, label, seed, sample_size, id_col)
    pdf = sample.toPandas()          # bounded: ≤ sample_size rows
    if pdf.empty:
        return sample.sparkSession.createDataFrame([], f"{id_col} long, {label} long, silhouette double")
    spark = sample.sparkSession
    bc = spark.sparkContext.broadcast((pdf[cols].to_numpy(dtype=float), pdf[label].to_numpy()))

    def score(it):
        X, lab = bc.value
        uniq = np.unique(lab)
        counts = {u: int((lab == u).sum()) for u in uniq}
        for part in it:
            if part.empty:
                continue
            P = part[cols].to_numpy(dtype=float)
            D = np.sqrt(((P[:, None, :] - X[None, :, :]) ** 2).sum(axis=2))
            own = part[label].to_numpy()
            out = np.zeros(len(part))
            for j, li in enumerate(own):
                n_own = counts[li]
                if n_own <= 1:
                    out[j] = 0.0
                    continue
                a = D[j, lab == li].sum() / (n_own - 1)
                b = min(D[j, lab == u].mean() for u in uniq if u != li) if len(uniq) > 1 else 0.0
                m = max(a, b)
                out[j] = 0.0 if m == 0 else (b - a) / m
            yield pd.DataFrame({id_col: part[id_col].astype("int64"), label: part[label].astype("int64"),
                                "silhouette": out})

    # the rows scored are those collected, so the sample is computed once
    return (spark.createDataFrame(pdf, sample.schema).repartition(partitions, id_col)
            .mapInPandas(score, f"{id_col} long, {label} long, silhouette double"))


def silhouette_score(df: DataFrame, cols: list[str], label: str = "persona_cluster", seed: int = 42,
                     sample_size: int = fixed.SILHOUETTE_SAMPLE, id_col: str = "cust_id") -> DataFrame:
    """one-row mean silhouette of the sample (returned as a row, seeded)."""
    pts = silhouette_points(df, cols, label, seed, sample_size, id_col)
    return pts.agg(F.avg("silhouette").alias("silhouette"), F.count(F.lit(1)).alias("n_sampled"))


def k_sweep(df: DataFrame, cols: list[str], k_values, seed: int = 42, n_init: int = fixed.N_INIT,
            max_iter: int = 300, id_col: str = "cust_id") -> DataFrame:
    """(k, inertia, silhouette) per k, each with ``n_init`` restarts to convergence."""
    data = df.select(id_col, *cols).persist()
    blocks = point_blocks(data, cols)
    rows = []
    try:
        for k in k_values:
            cents, history = lloyd_kmeans(data, cols, k, seed, n_init, max_iter, id_col, blocks=blocks)
            labelled = assign_nearest(data, cols, cents)
            sil = silhouette_score(labelled, cols, "persona_cluster", seed, id_col=id_col).first()["silhouette"]
            rows.append((int(k), float(history[-1]), float(sil) if sil is not None else None))
    finally:
        blocks.unpersist()
        data.unpersist()
    return df.sparkSession.createDataFrame(rows, "k long, inertia double, silhouette double")


def cluster_density(df: DataFrame, x: str, y: str, width: float, label: str = "persona_cluster") -> DataFrame:
    """F8: cluster map as a binned 2-D density (cluster, bin_x, bin_y, n)."""
    return (df.groupBy(F.col(label).cast("long").alias(label),
                       F.floor(F.col(x) / F.lit(width)).cast("long").alias("bin_x"),
                       F.floor(F.col(y) / F.lit(width)).cast("long").alias("bin_y"))
            .agg(F.count(F.lit(1)).alias("n_points")))
