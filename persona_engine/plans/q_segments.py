"""Registered queries: features, segmentation, cluster statistics, personas."""

from __future__ import annotations

from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.operators import features as fe
from persona_engine.operators import personas as pe
from persona_engine.operators import segment as sg
from persona_engine.plans import pipeline as pl
from persona_engine.plans.oracle_views import LAB_CTE, _q, kmeans_ctes, projection_ctes, py_float_sql, with_views
from persona_engine.plans.registry import register
from persona_engine.sources import views

K, SEED = 7, 42

# ---------------------------------------------------------------- SQL pieces
STATS_SQL = [
    ("stats", "SELECT persona_cluster AS cluster_id, count(*) AS size, "
     + ", ".join(f"coalesce(round_even(avg(CAST({src} AS DOUBLE)), {d}), 0.0) AS {name}"
                 for name, src, d in pe.MEAN_STATS)
     + ", coalesce(round_even(avg(coalesce(CAST(usr_gndr = 'M' AS DOUBLE), 0.0)), 2), 0.5) AS gender_ratio_male"
     " FROM lab GROUP BY persona_cluster"),
    ("topreg", """SELECT persona_cluster AS cluster_id, usr_cnty_ap2 AS top_region FROM (
        SELECT persona_cluster, usr_cnty_ap2, count(*) AS n FROM lab WHERE usr_cnty_ap2 IS NOT NULL
        GROUP BY persona_cluster, usr_cnty_ap2)
        QUALIFY row_number() OVER (PARTITION BY persona_cluster ORDER BY n DESC, usr_cnty_ap2) = 1"""),
    ("cstats", f"""SELECT s.*, coalesce(t.top_region, {_q(fixed.UNKNOWN)}) AS top_region
        FROM stats s LEFT JOIN topreg t ON s.cluster_id = t.cluster_id"""),
]

_g, _h, _b = fixed.PERSONA_GAMER, fixed.PERSONA_SMART_HOME, fixed.PERSONA_BALANCED


def _pick(i):
    return (f"CASE WHEN avg_game_ratio >= {fixed.GAME_RATIO_THRESHOLD} THEN {_q(_g[i])} "
            f"WHEN smartthings_rate >= {fixed.SMARTTHINGS_THRESHOLD} THEN {_q(_h[i])} ELSE {_q(_b[i])} END")


def _kw():
    return (f"CASE WHEN avg_game_ratio >= {fixed.GAME_RATIO_THRESHOLD} THEN {_q('|'.join(_g[3]))} "
            f"WHEN smartthings_rate >= {fixed.SMARTTHINGS_THRESHOLD} THEN {_q('|'.join(_h[3]))} "
            f"ELSE {_q('|'.join(_b[3]))} END")


RULES_SQL = ("rules", f"""SELECT *, {_pick(0)} AS persona_name, {_pick(1)} AS persona_name_en,
    {_pick(2)} AS preferred_channel, {_kw()} AS keywords,
    CASE WHEN gender_ratio_male >= {fixed.MALE_HIGH} THEN {_q(fixed.GENDER_HINT_MALE)}
         WHEN gender_ratio_male <= {fixed.MALE_LOW} THEN {_q(fixed.GENDER_HINT_FEMALE)}
         ELSE {_q(fixed.GENDER_HINT_BALANCED)} END AS gender_hint,
    round_even(least(greatest(avg_ltv / 10000.0, 0.0), 100.0), 1) AS purchase_intent,
    round_even(least(greatest(avg_retention * 100.0, 0.0), 100.0), 1) AS brand_attitude,
    round_even(least(greatest(repurchase_rate * 100.0, 0.0), 100.0), 1) AS marketing_acceptance,
    round_even(least(avg_ltv / 200.0, 100.0), 1) AS future_value,
    round_even((1.0 - avg_retention) * 100.0, 1) AS churn_risk,
    CAST(round_even(avg_age, 0) AS BIGINT) AS age_value
    FROM cstats""")

_c, _i = fixed.CHARACTERISTIC_LABELS, fixed.INTEREST_LABELS
PERSONA_SELECT = f"""SELECT cluster_id, persona_name, persona_name_en,
    CAST(greatest({fixed.AGE_FLOOR}, age_value - {fixed.AGE_HALF_WIDTH}) AS VARCHAR) || '-' ||
    CAST(least({fixed.AGE_CEIL}, age_value + {fixed.AGE_HALF_WIDTH}) AS VARCHAR) AS age_range,
    printf({_q(fixed.DESCRIPTION_TEMPLATE)}, top_region, gender_hint, CAST(age_value AS VARCHAR)) AS description,
    {_q(_c[0])} || {py_float_sql('avg_purchase_count')} || '|' || {_q(_c[1])} || {py_float_sql('avg_premium_count')}
      || '|' || {_q(_c[2])} || {py_float_sql('avg_daily_usage_min')} || {_q(fixed.CHARACTERISTIC_SUFFIX_MINUTES)}
      AS key_characteristics,
    purchase_intent, brand_attitude, marketing_acceptance, future_value, preferred_channel, keywords,
    {_q(_i[0])} || {py_float_sql('avg_game_ratio')} || '|' || {_q(_i[1])} || {py_float_sql('avg_social_ratio')}
      || '|' || {_q(_i[2])} || {py_float_sql('health_app_rate')} AS interests,
    top_region || '|' || preferred_channel || '|' || 'cluster-' || CAST(cluster_id AS VARCHAR) AS segment_tags,
    churn_risk, size FROM rules"""

SEG_CTES = [*kmeans_ctes(K, SEED), LAB_CTE]
SEG_VIEWS = ["z", "enc"]


def _seg(src):
    return pl.segment(src, K, SEED)


# ---------------------------------------------------------------- queries
@register("personas", with_views(SEG_VIEWS, PERSONA_SELECT, SEG_CTES + STATS_SQL + [RULES_SQL]))
def q_personas(src):
    """G6 flagship: customers → features → seeded K-Means → cluster stats → rule-based personas."""
    return pe.personas(pl.stats_frame(_seg(src)))


@register("cluster_stats", with_views(SEG_VIEWS, "SELECT * FROM cstats", SEG_CTES + STATS_SQL))
def q_cluster_stats(src):
    """One groupBy over the clustered customers."""
    return pl.stats_frame(_seg(src))


@register("cluster_mode", with_views(SEG_VIEWS, "SELECT cluster_id, top_region FROM cstats",
                                     SEG_CTES + STATS_SQL))
def q_cluster_mode(src):
    """Most frequent region per cluster (smallest on ties, 'Unknown' when none)."""
    lab = _seg(src).labelled
    return lab.groupBy(F.col("persona_cluster").alias("cluster_id")).agg(
        pe.cluster_mode("usr_cnty_ap2").alias("top_region"))


@register("gender_ratio", with_views(SEG_VIEWS, "SELECT cluster_id, gender_ratio_male FROM stats",
                                     SEG_CTES + STATS_SQL[:1]))
def q_gender_ratio(src):
    """Share of 'M' per cluster."""
    lab = _seg(src).labelled
    return lab.groupBy(F.col("persona_cluster").alias("cluster_id")).agg(
        pe.gender_ratio().alias("gender_ratio_male"))


@register("cluster_sizes", with_views(SEG_VIEWS, """SELECT persona_cluster AS cluster_id, count(*) AS size,
    CAST(sum(count(*)) OVER () AS BIGINT) AS n_total FROM assigned GROUP BY persona_cluster""", SEG_CTES))
def q_cluster_sizes(src):
    """Sorted cluster ids with sizes (sizes sum to n)."""
    lab = _seg(src).labelled
    s = lab.groupBy(F.col("persona_cluster").alias("cluster_id")).agg(F.count(F.lit(1)).alias("size"))
    from pyspark.sql import Window
    return s.withColumn("n_total", F.sum("size").over(Window.partitionBy())).orderBy("cluster_id")


def _mapped(src):
    """Labelled customers with their coordinates on the 2-D map of the standardised features."""
    seg = _seg(src)
    return sg.pca_projection(seg.labelled, seg.z_cols)


@register("clustered_customers", with_views(SEG_VIEWS, """SELECT a.cust_id, a.persona_cluster, round_even(a.sq_dist, 6) AS sq_dist,
    round_even(p.x, 4) AS x, round_even(p.y, 4) AS y FROM assigned a JOIN proj p ON a.cust_id = p.cust_id""", SEG_CTES + projection_ctes()))
def q_clustered(src):
    """label, distance and 2-D coordinates attached to every customer."""
    return _mapped(src).select("cust_id", "persona_cluster", F.bround("sq_dist", 6).alias("sq_dist"),
                               F.bround("x", 4).alias("x"), F.bround("y", 4).alias("y"))


@register("cluster_filter", with_views(SEG_VIEWS, """SELECT cust_id, usr_age, ltv_r FROM lab
    WHERE persona_cluster = 0""", SEG_CTES))
def q_cluster_filter(src):
    """B1: drill-down into one cluster."""
    return _seg(src).labelled.where(F.col("persona_cluster") == 0).select("cust_id", "usr_age", "ltv_r")


@register("assign_nearest", with_views(SEG_VIEWS, """SELECT cust_id, cid AS persona_cluster,
    round_even(d, 6) AS sq_dist FROM near""", kmeans_ctes(K, SEED, 0)))
def q_assign_nearest(src):
    """assignment to the seeded centroids (no iterations)."""
    enc, cols = pl.encoded_customers(src)
    med, mom, n = fe.fit_scaling(enc, cols)
    z = enc.select("cust_id", *fe.scale_exprs(med, mom, pl.Z))
    zc = [pl.Z + c for c in cols]
    cents = sg.seed_centroids(z, zc, sg.clamp_k(n, K), SEED)[0]
    return sg.assign_nearest(z, zc, cents).select("cust_id", "persona_cluster",
                                                  F.bround("sq_dist", 6).alias("sq_dist"))


@register("cluster_density", with_views(SEG_VIEWS, """SELECT a.persona_cluster, CAST(floor(p.x / 0.5) AS BIGINT) AS bin_x,
    CAST(floor(p.y / 0.5) AS BIGINT) AS bin_y, count(*) AS n_points
    FROM assigned a JOIN proj p ON a.cust_id = p.cust_id GROUP BY ALL""", SEG_CTES + projection_ctes()))
def q_cluster_density(src):
    """F8: the cluster map as a binned density over the 2-D coordinates."""
    return sg.cluster_density(_mapped(src), "x", "y", 0.5)


@register("feature_matrix", with_views(["z"], "SELECT cust_id, feature, round_even(value, 6) AS value FROM z"))
def q_feature_matrix(src):
    """standardised feature matrix, reported long (cust_id, feature, value)."""
    enc, cols = pl.encoded_customers(src)
    med, mom, _ = fe.fit_scaling(enc, cols)
    z = enc.select("cust_id", *[e for e in fe.scale_exprs(med, mom, "")])
    return fe.to_long(z, "cust_id", cols)


# the same features with missing values put in: null and NaN by customer number (views.with_gaps)
GAP_CTES = [
    ("gap_long", """SELECT cust_id, feature, CASE WHEN cust_id % 7 = 3 OR cust_id % 11 = 5 THEN NULL ELSE value END AS value
        FROM raw_long WHERE feature NOT LIKE 'region_%' AND feature NOT IN ('usr_gndr_enc', 'is_active')"""),
    ("gap_med", "SELECT feature, median(value) AS med FROM gap_long WHERE value IS NOT NULL GROUP BY feature"),
    ("gap_imp", "SELECT r.cust_id, r.feature, coalesce(r.value, m.med) AS value FROM gap_long r JOIN gap_med m ON r.feature = m.feature"),
]


def _gapped(src):
    enc, cols = pl.encoded_customers(src)
    cols = [c for c in cols if c in fixed.FEATURE_COLS]
    return views.with_gaps(enc, cols), cols


@register("median_impute", with_views(["raw_long"], "SELECT cust_id, feature, value FROM gap_imp", GAP_CTES))
def q_median_impute(src):
    """Median imputation of every feature, with null and NaN values put in."""
    enc, cols = _gapped(src)
    med = fe.fit_medians(enc, cols)
    # values are exact quotients of integer sums (or medians of them): no rounding needed
    return fe.to_long(fe.impute(enc.select("cust_id", *cols), med), "cust_id", cols, digits=None)


@register("standardize", with_views(["raw_long"], """SELECT feature, round_even(avg(value), 3) AS mean,
    round_even(stddev_pop(value), 3) AS std_pop FROM gap_imp GROUP BY feature""", GAP_CTES))
def q_standardize(src):
    """Fitted mean and population std per imputed feature, with null and NaN values put in."""
    enc, cols = _gapped(src)
    _, mom, _ = fe.fit_scaling(enc, cols)
    rows = [(c, m, s) for c, (m, s) in mom.items()]
    df = src.spark.createDataFrame(rows, "feature string, mean double, std_pop double")
    return df.select("feature", F.bround("mean", 3).alias("mean"), F.bround("std_pop", 3).alias("std_pop"))


@register("encode_binary", with_views(["enc"], "SELECT cust_id, usr_gndr, usr_gndr_enc FROM enc"))
def q_encode_binary(src):
    """B2: gender == 'M' → 1."""
    return fe.encode_gender(views.demo(src)).select("cust_id", "usr_gndr", "usr_gndr_enc")


@register("encode_active", with_views(["enc"], "SELECT cust_id, sa_activeness, is_active FROM enc"))
def q_encode_active(src):
    """Activeness text starting with 'Active' → 1."""
    return fe.encode_active(views.demo(src)).select("cust_id", "sa_activeness", "is_active")


@register("one_hot_region", with_views(["raw_long"], """SELECT cust_id, feature, CAST(value AS BIGINT) AS value
    FROM raw_long WHERE feature LIKE 'region_%'"""))
def q_one_hot(src):
    """Region one-hot columns (reported long)."""
    d, names = fe.one_hot(views.demo(src))
    return d.select("cust_id", *names).unpivot("cust_id", names, "feature", "value")


@register("sparse_region_clusters", with_views(SEG_VIEWS, "SELECT cust_id, persona_cluster, round_even(sq_dist, 6) AS sq_dist FROM assigned",
                                               kmeans_ctes(K, SEED, 2)))
def q_sparse_region_clusters(src):
    """The clustering (of two restarts) with the region's one-hot columns never made."""
    enc, cols = pl.encode_table(views.customers(src), region_columns=False)
    seg = pl.segment_table_by_category(enc, cols, "usr_cnty_ap2", K, SEED, n_init=2)
    return seg.labelled.select("cust_id", "persona_cluster", F.bround("sq_dist", 6).alias("sq_dist"))


@register("region_index", """SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS "index"
    FROM (SELECT DISTINCT c_name AS value FROM customer WHERE c_name IS NOT NULL)""")
def q_region_index(src):
    """Distinct values numbered without collecting them (customer names: one for each customer)."""
    return fe.value_index(src.customer, "c_name")
