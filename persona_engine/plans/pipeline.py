"""End-to-end persona plans: customers → features → segments → personas.

Jobs run by a plan, in order: (1) the customer table (joins + rollups) is
checkpointed once; (2) three aggregates fit medians, means and population stds;
(3) K-Means restarts step together over blocks of points, and exact passes for all restarts confirm them, each
a map-only pass + an aggregate of restarts × k rows; (4) the final lazy projection feeding
the single ``groupBy(persona_cluster)`` of the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.operators import features as fe
from persona_engine.operators import personas as pe
from persona_engine.operators import segment as sg
from persona_engine.operators import sparse_segment as ss
from persona_engine.session import materialize
from persona_engine.sources import views
from persona_engine.sources.tables import Sources

Z = "z__"


@dataclass
class Segmentation:
    encoded: DataFrame        # raw encoded customer table (checkpointed)
    labelled: DataFrame       # encoded + z__ features + persona_cluster + sq_dist
    feature_cols: list
    params: dict
    centroids: dict
    k: int
    history: list
    cluster_cols: list        # the columns clustered on

    @property
    def z_cols(self):
        return [Z + c for c in self.feature_cols]


def encode_table(df: DataFrame, regions: list | None = None, checkpoint: bool = True, region_columns: bool = True):
    """Encode a customer-shaped table and (optionally) cut its lineage."""
    enc, cols = fe.encode_all(df, regions, region_columns)
    cols = fe.numeric_columns(enc, cols)
    if checkpoint:
        enc = materialize(enc)
    return enc, cols


def encoded_customers(src: Sources, checkpoint: bool = True):
    return encode_table(views.customers(src), views.region_values(src), checkpoint)


def _clustered(df: DataFrame, cols: list, k: int, seed: int, n_init: int, max_iter: int, id_col: str):
    """Centroids and cost history of the best restart; the rows scanned by every iteration are held in memory
    (spilling to disk) only while it runs."""
    points = df.select(id_col, *cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return sg.lloyd_kmeans(points, cols, k, seed, n_init, max_iter, id_col)
    finally:
        points.unpersist()


def segment_table(enc: DataFrame, cols: list, n_personas: int = 7, seed: int = 42, n_init: int = fixed.N_INIT,
                  max_iter: int = 300, id_col: str = "cust_id", cluster_on: str = "features") -> Segmentation:
    """Median-impute, standardise and run the seeded K-Means on an encoded table.

    ``cluster_on="projection"`` clusters the 2-D linear projection of the standardised
    features (as the original clusters its 2-D embedding) instead of the features themselves.
    """
    medians, moments, n = fe.fit_scaling(enc, cols)
    k = sg.clamp_k(n, n_personas)
    z = enc.select("*", *fe.scale_exprs(medians, moments, Z))
    zc = [Z + c for c in cols]
    on = zc
    if cluster_on == "projection":
        z, on = sg.pca_projection(z, zc), ["x", "y"]
    cents, hist = _clustered(z, on, k, seed, n_init, max_iter, id_col)
    labelled = sg.assign_nearest(z, on, cents)
    return Segmentation(enc, labelled, cols, {"medians": medians, "moments": moments}, cents, k, hist, on)


def segment_table_by_category(enc: DataFrame, cols: list, category: str, n_personas: int = 7, seed: int = 42,
                              n_init: int = fixed.N_INIT, max_iter: int = 300, id_col: str = "cust_id") -> Segmentation:
    """``segment_table`` with the one-hot columns of ``category`` (any number of values) never made; ``cols`` are the others."""
    medians, moments, n = fe.fit_scaling(enc, cols)
    k = sg.clamp_k(n, n_personas)
    z = enc.select("*", *fe.scale_exprs(medians, moments, Z))
    zc = [Z + c for c in cols]
    points = z.select(id_col, *zc, category).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cents, cost = ss.kmeans_with_category(points, zc, category, k, seed, n_init, max_iter, id_col)
    finally:
        points.unpersist()
    return Segmentation(enc, ss.assign_with_category(z, zc, category, cents), cols, {"medians": medians, "moments": moments},
                        cents.dense, k, [cost], zc)


def segment(src: Sources, n_personas: int = 7, seed: int = 42, checkpoint: bool = True) -> Segmentation:
    enc, cols = encoded_customers(src, checkpoint)
    return segment_table(enc, cols, n_personas, seed)


def stats_frame(seg: Segmentation, stats_on: str = "raw") -> DataFrame:
    if stats_on == "scaled":
        base = [c for c in seg.labelled.columns if c not in seg.feature_cols]
        df = seg.labelled.select(*[F.col(c).alias(c[len(Z):]) if c.startswith(Z) else F.col(c) for c in base])
    else:
        df = seg.labelled
    return pe.cluster_stats(df)


def persona_table(src: Sources, n_personas: int = 7, seed: int = 42, stats_on: str = "raw") -> DataFrame:
    seg = segment(src, n_personas, seed)
    return pe.personas(stats_frame(seg, stats_on))


def run_pipeline(spark, cfg, responder_factory=None) -> dict:
    """End-to-end job: fit marginals on the sources → synthetic population →
    features → segments → personas, with parquet / JSON sinks (A3, A4, A6).

    The synthetic and the clustered table are written to ``cfg.output_dir`` and
    re-read, so what follows starts from files (a lost executor re-reads them);
    the feature table is a sink. The clustered table is partitioned by cluster
    for partition-pruned drill-downs.
    """
    from persona_engine.operators import responder as rp
    from persona_engine.operators import synth as sy
    from persona_engine.sources.tables import metadata_frame, write_json, write_parquet

    out = cfg.output_dir.rstrip("/")
    src = Sources(spark, cfg.source_dir)
    params = sy.fit(views.demo(src), views.clv(src), src.events, views.interests(src))
    syn_path = write_parquet(sy.synth_population(spark, cfg.n_synthetic_customers, params, cfg.random_state),
                             f"{out}/synthetic_customers.parquet")
    syn = spark.read.parquet(syn_path)
    regions = fe.one_hot_values(syn, "usr_cnty_ap2")
    enc, cols = encode_table(syn, regions, checkpoint=False, region_columns=regions is not None)
    if regions is None:          # too many for a column each
        seg = segment_table_by_category(enc, cols, "usr_cnty_ap2", cfg.n_personas, cfg.random_state, cfg.n_init, cfg.max_iter, "index")
    else:
        seg = segment_table(enc, cols, cfg.n_personas, cfg.random_state, cfg.n_init, cfg.max_iter, "index", cfg.cluster_on)
    labelled = seg.labelled
    if cfg.cluster_on != "projection":     # the 2-D map of the features, as a projection of each row
        labelled = sg.pca_projection(labelled, seg.z_cols)
    labelled = labelled.withColumnsRenamed({"x": "proj_x", "y": "proj_y"})
    feat_path = write_parquet(labelled.drop("persona_cluster", "sq_dist", "proj_x", "proj_y"), f"{out}/features.parquet")
    clu_path = write_parquet(labelled, f"{out}/clustered_customers.parquet", partition_by=["persona_cluster"])
    clu = spark.read.parquet(clu_path)
    on = {"x": "proj_x", "y": "proj_y"}
    silhouette = sg.silhouette_score(clu, [on.get(c, c) for c in seg.cluster_cols], seed=cfg.random_state,
                                     sample_size=cfg.silhouette_sample, id_col="index").first()["silhouette"]
    stats = stats_frame(Segmentation(seg.encoded, clu, seg.feature_cols, seg.params, seg.centroids, seg.k,
                                     seg.history, seg.cluster_cols), cfg.stats_on)
    factory = responder_factory or rp.NoModelResponder
    personas = pe.profile_via_responder(stats, factory)
    samples = pe.cluster_sample(clu, cfg.stories_per_cluster, cfg.random_state, id_col="index")
    rows = [c for c in samples.columns if not c.startswith(Z) and c not in ("persona_cluster", "sample_rank", "sq_dist", "proj_x", "proj_y")]
    stories = pe.individual_stories(samples, factory, rows)      # from the whole sampled row
    full = personas.join(stories.select("cluster_id", "individual_stories"), "cluster_id", "left") \
        .orderBy("cluster_id")
    per_path = write_json(full.coalesce(1), f"{out}/personas.json")
    n_generated = spark.read.json(per_path).count()
    meta = {"status": "success", "random_state": cfg.random_state,
            "n_synthetic_customers": cfg.n_synthetic_customers, "n_personas_requested": cfg.n_personas,
            "n_personas_generated": n_generated, "clustering_cost": seg.history[-1] if seg.history else None,
            "silhouette": silhouette,
            "outputs": {"synthetic_data": syn_path, "features": feat_path, "clustered_data": clu_path,
                        "personas": per_path}}
    metadata_frame(spark, meta).coalesce(1).write.mode("overwrite").json(f"{out}/pipeline_metadata.json")
    return meta


def run_eda(spark, source_dir: str, output_dir: str) -> str:
    """EDA summary (A2/A7/C11): distinct customers and purchase-line count, written as text lines.

    Only the two tables the summary uses are read (column-pruned scans).
    """
    src = Sources(spark, source_dir)
    n_cust = views.demo(src).agg(F.countDistinct("cust_id")).first()[0]
    n_lines = src.lineitem.agg(F.count(F.lit(1))).first()[0]
    lines = ["=== EDA Summary ===", f"Total customers: {n_cust}", f"Purchase count: {n_lines}"]
    path = f"{output_dir.rstrip('/')}/eda_summary.txt"
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path
