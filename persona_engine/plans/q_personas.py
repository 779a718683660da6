"""Registered queries: persona pieces (G1–G5, G7–G9), samples (D2, B21), ML fits (F2, F3, F5, F6), A6."""

from __future__ import annotations

from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.operators import features as fe
from persona_engine.operators import personas as pe
from persona_engine.operators import responder as rp
from persona_engine.operators import segment as sg
from persona_engine.plans import pipeline as pl
from persona_engine.plans.oracle_views import kmeans_ctes, projection_ctes, py_float_sql, with_views
from persona_engine.plans.q_segments import (K, PERSONA_SELECT, RULES_SQL, SEED, SEG_CTES, SEG_VIEWS, STATS_SQL,
                                             _seg)
from persona_engine.plans.registry import register
from persona_engine.sources.tables import Sources

PERS_CTES = SEG_CTES + STATS_SQL + [RULES_SQL]
SAMPLE_COLS = ["cust_id", "usr_gndr", "usr_age", "pchs_cnt"]


def _stats(src: Sources):
    return pl.stats_frame(_seg(src))


def _sql(body, extra=()):
    return with_views(SEG_VIEWS, body, PERS_CTES + list(extra))


@register("persona_rules", _sql("SELECT cluster_id, persona_name, persona_name_en, preferred_channel, keywords, "
                                "gender_hint FROM rules"))
def q_rules(src):
    """Rule-based name, channel, keywords and gender hint."""
    return pe.persona_rules(_stats(src)).select("cluster_id", "persona_name", "persona_name_en",
                                                "preferred_channel", "keywords", "gender_hint")


@register("persona_scores", _sql("SELECT cluster_id, purchase_intent, brand_attitude, marketing_acceptance, "
                                 "future_value, churn_risk FROM rules"))
def q_scores(src):
    """Persona scores (clamped, 1 decimal)."""
    return pe.persona_scores(_stats(src)).select("cluster_id", "purchase_intent", "brand_attitude",
                                                 "marketing_acceptance", "future_value", "churn_risk")


@register("persona_age_range", _sql("SELECT cluster_id, age_value, age_range FROM ("
                                    + PERSONA_SELECT.replace("SELECT cluster_id,", "SELECT cluster_id, age_value,", 1)
                                    + ")"))
def q_age_range(src):
    """Age range ±5 bounded to 18–70."""
    return pe.persona_age(_stats(src)).select("cluster_id", "age_value", "age_range")


@register("persona_text", _sql("SELECT cluster_id, description, key_characteristics, interests, segment_tags FROM ("
                               + PERSONA_SELECT + ")"))
def q_text(src):
    """Description, characteristics, interests, tags."""
    return pe.personas(_stats(src)).select("cluster_id", "description", "key_characteristics", "interests",
                                           "segment_tags")


SAMPLE_SQL = ("smp", """SELECT persona_cluster, cust_id, usr_gndr, usr_age, pchs_cnt, sample_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY persona_cluster
        ORDER BY md5('42:sample:' || CAST(cust_id AS VARCHAR)), cust_id) AS sample_rank FROM lab)
    WHERE sample_rank <= 3""")


@register("cluster_sample", _sql("SELECT persona_cluster, cust_id, CAST(sample_rank AS BIGINT) AS sample_rank FROM smp",
                                 [SAMPLE_SQL]))
def q_cluster_sample(src):
    """Seeded sample of ≤3 customers per cluster."""
    s = pe.cluster_sample(_seg(src).labelled, fixed.REPORT_TRUNCATIONS["pattern_questions"], SEED)
    return s.select("persona_cluster", "cust_id", F.col("sample_rank").cast("long"))


@register("rows_to_json", _sql("""SELECT persona_cluster, string_agg(CAST(to_json({'cust_id': cust_id,
    'usr_gndr': coalesce(usr_gndr, ''), 'usr_age': coalesce(usr_age, 0), 'pchs_cnt': coalesce(pchs_cnt, 0)}) AS VARCHAR),
    '|' ORDER BY sample_rank) AS records FROM smp GROUP BY persona_cluster""", [SAMPLE_SQL]))
def q_rows_to_json(src):
    """B20 + B21: sampled rows, nulls filled by type, as JSON records per cluster."""
    s = pe.cluster_sample(_seg(src).labelled, 3, SEED).select("persona_cluster", "sample_rank", *SAMPLE_COLS)
    return pe.rows_to_json(pe.fill_by_type(s.na.fill(0, ["usr_age", "pchs_cnt"])), "persona_cluster", "sample_rank",
                           SAMPLE_COLS)


def _json_field(name, kind):
    if kind == "int":
        v = f"CAST({name} AS VARCHAR)"
    elif kind == "str":
        v = f"""'"' || replace(replace({name}, '\\', '\\\\'), '"', '\\"') || '"'"""
    else:
        v = py_float_sql(name)
    return f"""'  "{name}": ' || {v}"""


STATS_JSON_SQL = ("'{' || chr(10) || " + " || ',' || chr(10) || ".join(
    _json_field(f, "int" if f in pe.INT_FIELDS else "str" if f == "top_region" else "float")
    for f in pe.PROFILE_FIELDS) + " || chr(10) || '}'")


@register("profile_prompt", _sql(f"""SELECT cluster_id, 'Cluster statistics:' || chr(10) || {STATS_JSON_SQL}
    || chr(10) || chr(10) || 'Return one JSON object with persona_name, persona_name_en, age_range, description, '
    || 'key_characteristics, preferred_channel, keywords, interests, segment_tags and these values: cluster_id='
    || CAST(cluster_id AS VARCHAR) || ', purchase_intent=' || {py_float_sql('purchase_intent')}
    || ', brand_attitude=' || {py_float_sql('brand_attitude')}
    || ', marketing_acceptance=' || {py_float_sql('marketing_acceptance')}
    || ', future_value=' || {py_float_sql('future_value')} || ', churn_risk=' || {py_float_sql('churn_risk')}
    || ', size=' || CAST(size AS VARCHAR) AS prompt FROM rules"""))
def q_profile_prompt(src):
    """Parameterised profile prompt over the cluster statistics."""
    return pe.profile_prompt(_stats(src))


PROFILE_SQL = _sql("""SELECT * REPLACE (
    CASE WHEN cluster_id % 3 < 2 THEN 'Model ' || CAST(cluster_id AS VARCHAR) ELSE persona_name END AS persona_name,
    CASE WHEN cluster_id % 3 = 0 THEN 'says "hi"' ELSE description END AS description,
    CASE WHEN cluster_id % 3 = 0 THEN 'k1|k2' ELSE keywords END AS keywords,
    CASE WHEN cluster_id % 3 = 0 THEN '30-39' ELSE age_range END AS age_range),
    CASE WHEN cluster_id % 3 < 2 THEN 'model' ELSE 'fallback' END AS source, CAST(NULL AS VARCHAR) AS error FROM (""" + PERSONA_SELECT + ")")


@register("persona_profile", PROFILE_SQL)
def q_profile(src):
    """Profiles through the responder: whole, partial (the rest by rule) and without JSON (all by rule)."""
    return pe.profile_via_responder(_stats(src), rp.PersonaStubResponder)


@register("individual_stories", _sql("""SELECT persona_cluster AS cluster_id,
    CAST(CASE WHEN arg_min(cust_id, sample_rank) % 3 = 0 THEN 0 ELSE count(*) END AS BIGINT) AS n_stories,
    CASE WHEN arg_min(cust_id, sample_rank) % 3 = 0 THEN ''
         ELSE string_agg('N' || CAST(cust_id AS VARCHAR) || ':' || usr_gndr, '|' ORDER BY sample_rank) END AS stories,
    CAST(NULL AS VARCHAR) AS error FROM smp GROUP BY persona_cluster""", [SAMPLE_SQL]))
def q_stories(src):
    """Stories for the sampled customers, prompted from their whole rows; a broken answer gives none."""
    s = pe.cluster_sample(_seg(src).labelled, 3, SEED)
    rows = [c for c in s.columns if not c.startswith(pl.Z) and c not in ("persona_cluster", "sample_rank", "sq_dist")]
    out = pe.individual_stories(s, rp.PersonaStubResponder, rows)
    return out.select("cluster_id", F.size("individual_stories").cast("long").alias("n_stories"),
                      F.array_join(F.transform("individual_stories", lambda x: F.concat_ws(":", x["name"], x["personality"])), "|").alias("stories"), "error")


def _z(src):
    seg = _seg(src)
    return seg, seg.labelled, seg.z_cols


@register("pca_projection", with_views(["z"], "SELECT cust_id, round_even(x, 4) AS x, round_even(y, 4) AS y FROM proj", projection_ctes()))
def q_pca(src):
    """F2 (re-aimed): 2-D coordinates of the standardised features along their principal axes, signs canonical."""
    enc, cols = pl.encoded_customers(src)
    med, mom, _ = fe.fit_scaling(enc, cols)
    z = enc.select("cust_id", *fe.scale_exprs(med, mom, pl.Z))
    out = sg.pca_projection(z, [pl.Z + c for c in cols], keep=["cust_id"])
    return out.select("cust_id", F.bround("x", 4).alias("x"), F.bround("y", 4).alias("y"))


@register("kmeans_fit", _sql("""SELECT count(*) AS n_rows, (SELECT k FROM kk) AS n_clusters,
    count(*) AS n_nearest, CAST(1 AS BIGINT) AS cost_matches, CAST(1 AS BIGINT) AS cost_near_best FROM assigned"""))
def q_kmeans(src):
    """pyspark.ml K-Means with n_init restarts on the standardised features, checked: every label is the
    nearest centre's, the cost is the sum of those distances, and it is near the seeded restarts' best."""
    seg, lab, zc = _z(src)
    data = sg.assemble(lab.select("cust_id", *zc), zc)
    held = data.persist()
    try:
        model, cost = sg.fit_kmeans(held, zc, seg.k, SEED, fixed.N_INIT, features_col="features")
    finally:
        held.unpersist()
    centres = {i: list(map(float, c)) for i, c in enumerate(model.clusterCenters())}
    out = sg.assign_nearest(model.transform(data).withColumnRenamed("persona_cluster", "given"), zc, centres)
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("given").alias("n_clusters"),
                   F.sum((F.col("given") == F.col("persona_cluster")).cast("long")).alias("n_nearest"),
                   (F.abs(F.sum("sq_dist") - F.lit(cost)) <= 1e-6 * cost).cast("long").alias("cost_matches"),
                   F.lit(int(cost <= 1.05 * seg.history[-1])).cast("long").alias("cost_near_best"))


SIL_SQL = _sql("""SELECT CAST(round_even(avg(s), 6) AS DOUBLE) AS silhouette, count(*) AS n_sampled FROM (
    SELECT x_id, CASE WHEN own_n <= 1 THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0
                      ELSE (b - a) / greatest(a, b) END AS s FROM (
      SELECT x_id, max(CASE WHEN same THEN n END) AS own_n, max(CASE WHEN same THEN tot / (n - 1) END) AS a,
             min(CASE WHEN NOT same THEN tot / n END) AS b
      FROM (SELECT x.cust_id AS x_id, y.c = x.c AS same, y.c, sum(list_distance(x.v, y.v)) AS tot, count(*) AS n
            FROM smp2 x CROSS JOIN smp2 y GROUP BY x.cust_id, y.c, x.c)
      GROUP BY x_id))""", [
    ("zl", "SELECT cust_id, list(value ORDER BY feature) AS v FROM z GROUP BY cust_id"),
    ("smp2", """SELECT a.cust_id, a.persona_cluster AS c, zl.v FROM assigned a JOIN zl ON a.cust_id = zl.cust_id
        ORDER BY md5('42:silhouette:' || CAST(a.cust_id AS VARCHAR)) LIMIT 2000""")])


@register("silhouette_exact", SIL_SQL)
def q_silhouette(src):
    """exact Euclidean silhouette on a seeded sample of ≤2,000 points."""
    _, lab, zc = _z(src)
    s = sg.silhouette_score(lab, zc, "persona_cluster", SEED)
    return s.select(F.bround("silhouette", 6).alias("silhouette"), F.col("n_sampled").cast("long"))


SWEEP = (2, 3, 4)
SWEEP_SQL = " UNION ALL ".join(f"""SELECT CAST({k} AS BIGINT) AS k, (SELECT round_even(cost, 4) FROM s{k}_cost) AS inertia,
    CAST(round_even(avg(s), 6) AS DOUBLE) AS silhouette FROM (
    SELECT x_id, CASE WHEN own_n <= 1 THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM (
      SELECT x_id, max(CASE WHEN same THEN n END) AS own_n, max(CASE WHEN same THEN tot / (n - 1) END) AS a,
             min(CASE WHEN NOT same THEN tot / n END) AS b
      FROM (SELECT x.cust_id AS x_id, y.c = x.c AS same, y.c, sum(list_distance(x.v, y.v)) AS tot, count(*) AS n
            FROM s{k}_smp x CROSS JOIN s{k}_smp y GROUP BY x.cust_id, y.c, x.c) GROUP BY x_id))""" for k in SWEEP)
SWEEP_CTES = [c for k in SWEEP for c in [*kmeans_ctes(k, SEED, p=f"s{k}_"), (f"s{k}_smp", f"""SELECT a.cust_id, a.persona_cluster AS c, p.v
    FROM s{k}_assigned a JOIN s{k}_pt p ON a.cust_id = p.cust_id
    ORDER BY md5('{SEED}:silhouette:' || CAST(a.cust_id AS VARCHAR)) LIMIT {fixed.SILHOUETTE_SAMPLE}""")]]


@register("k_sweep", with_views(SEG_VIEWS, SWEEP_SQL, SWEEP_CTES))
def q_k_sweep(src):
    """inertia and silhouette per k (2–4), 10 restarts each to convergence."""
    enc, cols = pl.encoded_customers(src)
    med, mom, _ = fe.fit_scaling(enc, cols)
    out = sg.k_sweep(enc.select("cust_id", *fe.scale_exprs(med, mom, pl.Z)), [pl.Z + c for c in cols], SWEEP, SEED)
    return out.select("k", F.bround("inertia", 4).alias("inertia"), F.bround("silhouette", 6).alias("silhouette"))


@register("run_metadata", _sql(f"""SELECT 'success' AS status, CAST({SEED} AS BIGINT) AS random_state,
    (SELECT count(*) FROM customer) AS n_synthetic_customers, CAST({K} AS BIGINT) AS n_personas_requested,
    (SELECT count(DISTINCT persona_cluster) FROM assigned) AS n_personas_generated"""))
def q_run_metadata(src):
    """Run metadata row (status, seed, sizes, personas generated)."""
    seg = _seg(src)
    n = src.customer.count()
    return src.spark.createDataFrame([("success", SEED, n, K, len(seg.centroids))],
                                     "status string, random_state long, n_synthetic_customers long, "
                                     "n_personas_requested long, n_personas_generated long")
