"""Registered queries: sources, derivations (B), marginals (C1–C5, C11, C13–C15), D1/D3/D4/D6."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.functions.expr import (clip, normalize_category, normalize_feature, parse_list_text,
                                           safe_default)
from persona_engine.operators import derive as dv
from persona_engine.operators import features as fe
from persona_engine.operators import marginals as mg
from persona_engine.operators import sketches as sk
from persona_engine.operators.indexing import row_number_within
from persona_engine.plans.oracle_views import _q, half_even_sql, sql_list, with_views
from persona_engine.plans.registry import register
from persona_engine.session import materialize
from persona_engine.sources import views
from persona_engine.sources.tables import table_row_counts

SEED = 42


def values_sql(rows, cols) -> str:
    def lit(v):
        if isinstance(v, str):
            return _q(v)
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        return f"CAST({v} AS BIGINT)"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


def hash_unit_sql(seed, salt, key) -> str:
    return (f"((CAST(CAST(('0x' || substr(md5('{seed}:{salt}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) AS DOUBLE)"
            f" + 0.5) / 4294967296.0)")


REGION_DIM_SQL = values_sql(fixed.REGION_DIM, ["ap2", "gc", "cnty_cd", "cnty_cd2", "currency", "exchange_rate"])
REGION_MAP_SQL = values_sql(fixed.REGION_TO_AP2, ["region_name", "ap2"])
CATEGORY_DIM_SQL = values_sql(fixed.CATEGORY_DIM, ["pd_category", "pd_division", "pd_group"])
PTYPE_MAP_SQL = values_sql(fixed.PTYPE_TO_CATEGORY, ["p_type", "pd_category"])
TIER_DIM_SQL = values_sql(fixed.TIER_DIM, ["tier_name", "tier_level_code", "tier_level"])
DFLT = fixed.REGION_DEFAULTS

REGION_JOIN_SQL = f"""LEFT JOIN ({REGION_MAP_SQL}) rm ON d.usr_cnty_ap2 = rm.region_name
    LEFT JOIN ({REGION_DIM_SQL}) rd ON rm.ap2 = rd.ap2"""

# ------------------------------------------------------------------ A / C11
EDA_SQL = with_views(["demo", "lines"], """SELECT 'total_customers' AS metric, count(DISTINCT cust_id) AS value FROM demo
    UNION ALL SELECT 'purchase_count' AS metric, count(*) AS value FROM lines""")


@register("eda_summary", EDA_SQL)
def q_eda_summary(src):
    """Distinct customers and purchase-line count."""
    d = src.customer.agg(F.countDistinct("c_custkey").alias("value")).select(F.lit("total_customers").alias("metric"), "value")
    p = src.lineitem.agg(F.count(F.lit(1)).alias("value")).select(F.lit("purchase_count").alias("metric"), "value")
    return d.unionByName(p)


@register("distinct_buyers", """SELECT year(CAST(o_orderdate AS DATE)) AS order_year, count(DISTINCT o_custkey) AS n_buyers,
    CAST(1 AS BIGINT) AS sketch_within_bound FROM orders GROUP BY ALL""")
def q_distinct_buyers(src):
    """C11: buyers per year, exact, and whether the union of the months' stored sketches is within five standard errors of it."""
    o = src.orders.select("o_custkey", F.to_date("o_orderdate").alias("d")).withColumns({"order_year": F.year("d"), "order_month": F.month("d")})
    by_month = materialize(sk.distinct_sketches(o, ["order_year", "order_month"], "o_custkey"))
    exact = o.groupBy("order_year").agg(F.countDistinct("o_custkey").alias("n_buyers"))
    near = F.abs(F.col("n") - F.col("n_buyers")) <= 5 * sk.relative_error() * F.col("n_buyers")
    return exact.join(sk.estimate_distinct(by_month, ["order_year"]), "order_year").select("order_year", "n_buyers", near.alias("sketch_within_bound"))


@register("load_sources", """SELECT table_name, n_rows FROM (
    SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer UNION ALL
    SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL
    SELECT 'part', count(*) FROM part UNION ALL SELECT 'events', count(*) FROM events UNION ALL
    SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'region', count(*) FROM region)""")
def q_load_sources(src):
    """A1: the named source tables the customer model reads, with row counts."""
    return table_row_counts(src, ["customer", "orders", "lineitem", "part", "events", "nation", "region"])


# ------------------------------------------------------------------ B
@register("age_band", with_views(["demo"], """SELECT cust_id, usr_age,
    CASE WHEN usr_age > 0 AND usr_age <= 29 THEN '20s' WHEN usr_age > 29 AND usr_age <= 39 THEN '30s'
         WHEN usr_age > 39 AND usr_age <= 49 THEN '40s' WHEN usr_age > 49 AND usr_age <= 59 THEN '50s'
         WHEN usr_age > 59 AND usr_age <= 100 THEN '60s+' END AS age_band FROM demo"""))
def q_age_band(src):
    """Right-closed age bands."""
    return dv.with_age_band(views.demo(src)).select("cust_id", "usr_age", "age_band")


@register("dim_lookup", with_views(["demo"], f"""SELECT d.cust_id, d.usr_cnty_ap2, rm.ap2,
    coalesce(rd.gc, {_q(DFLT['gc'])}) AS gc, coalesce(rd.cnty_cd, {_q(DFLT['cnty_cd'])}) AS cnty_cd,
    coalesce(rd.cnty_cd2, {_q(DFLT['cnty_cd2'])}) AS cnty_cd2, coalesce(rd.currency, {_q(DFLT['currency'])}) AS currency,
    coalesce(rd.exchange_rate, CAST({DFLT['fx']} AS DOUBLE)) AS exchange_rate
    FROM demo d {REGION_JOIN_SQL}"""))
def q_dim_lookup(src):
    """Broadcast regional dimension with defaults."""
    return dv.with_region_dim(views.demo(src)).select("cust_id", "usr_cnty_ap2", "ap2", "gc", "cnty_cd", "cnty_cd2",
                                                      "currency", "exchange_rate")


@register("category_division", f"""SELECT p.p_partkey AS part_id, p.p_type AS category, m.pd_category,
    c.pd_division, c.pd_group,
    CASE WHEN m.pd_category IN ({sql_list(fixed.MX_PRODUCT_MAPPINGS)}) THEN 'MX' ELSE 'VD' END AS division_fin
    FROM part p LEFT JOIN ({PTYPE_MAP_SQL}) m ON p.p_type = m.p_type
    LEFT JOIN ({CATEGORY_DIM_SQL}) c ON m.pd_category = c.pd_category""")
def q_category_division(src):
    """Product category → division / group; MX membership."""
    parts = src.part.select(F.col("p_partkey").alias("part_id"), F.col("p_type").alias("category"))
    return dv.with_category(parts).select("part_id", "category", "pd_category", "pd_division", "pd_group",
                                          "division_fin")


def _usd(x, d):
    return f"({half_even_sql(x, d)} / 100.0)"


_SALE_U = "greatest(base_c * 100 - disc_u - coalesce(trade_u, 0) - coalesce(rew_u, 0), 10000)"
PRICE_SQL = with_views(["lines", "demo"], f"""SELECT order_id, line_no, currency, exchange_rate,
    {_usd(_SALE_U, 100)} AS sale_amt_usd, base_c / 100.0 AS price_base_usd,
    {_usd('disc_u', 100)} AS price_discount_all_usd, {_usd('trade_u', 100)} AS price_discount_tradein_usd,
    {_usd('rew_u', 100)} AS price_discount_rewards_usd, {_usd(_SALE_U + ' * fx_c', 10000)} AS sale_amt_local,
    {_usd('base_c * fx_c', 100)} AS price_base_local, {_usd('trade_u * fx_c', 10000)} AS price_discount_tradein_local,
    {_usd('base_c * ' + str(int(round(fixed.SELLIN_RATIO * 100))), 100)} AS sellin_price
    FROM (SELECT l.order_id, l.line_no, coalesce(rd.currency, 'USD') AS currency,
        coalesce(rd.exchange_rate, CAST(1.0 AS DOUBLE)) AS exchange_rate,
        CAST(round(l.price_base * 100) AS BIGINT) AS base_c,
        CAST(round(l.price_base * 100) AS BIGINT) * CAST(round(l.l_discount_rate * 100) AS BIGINT) AS disc_u,
        nullif(CAST(round(l.price_base * 100) AS BIGINT) * CAST(round(l.tax_rate * 100) AS BIGINT), 0) AS trade_u,
        CASE WHEN l.return_flag = 'A' THEN CAST(round(l.price_base * 100) AS BIGINT) * 3 END AS rew_u,
        CAST(round(coalesce(rd.exchange_rate, CAST(1.0 AS DOUBLE)) * 100) AS BIGINT) AS fx_c
      FROM lines l JOIN demo d ON l.cust_id = d.cust_id {REGION_JOIN_SQL})""")


@register("price_waterfall", PRICE_SQL)
def q_price_waterfall(src):
    """Price waterfall with FX from the customer's region."""
    fx = dv.with_region_dim(views.customer_region(src)).select("cust_id", "currency", "exchange_rate")
    return dv.price_waterfall(views.purchase_lines(src, product=False, per_customer=fx))


@register("order_key", """SELECT o.o_orderkey AS order_id,
    substr(r.r_name, 1, 2) || strftime(CAST(o.o_orderdate AS DATE), '%y%m%d') || '-' || lpad(CAST(o.o_orderkey AS VARCHAR), 8, '0') AS order_key
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_order_key(src):
    """Order key from region prefix, yymmdd and the number."""
    o = src.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("od"))
    geo = (src.customer.select("c_custkey", "c_nationkey")
           .join(F.broadcast(src.nation), F.col("c_nationkey") == F.col("n_nationkey"))
           .join(F.broadcast(src.region), F.col("n_regionkey") == F.col("r_regionkey")))
    j = o.join(geo, o.o_custkey == geo.c_custkey)
    return j.select(F.col("o_orderkey").alias("order_id"), dv.order_key("r_name", "od", "o_orderkey").alias("order_key"))


@register("tenure_days", with_views(["clv"], f"""SELECT cust_id, strftime(c, '%Y-%m-%d') AS last_capped,
    CAST(greatest(date_diff('day', first_reg_dt, c), 0) AS BIGINT) AS reg_diff,
    strftime(c - INTERVAL 365 DAY, '%Y-%m-%d') AS valid_from, strftime(c + INTERVAL 365 DAY, '%Y-%m-%d') AS valid_to,
    strftime(first_reg_dt + INTERVAL 6 DAY, '%Y-%m-%d') AS week_end,
    strftime(first_reg_dt + INTERVAL 7 DAY, '%Y-%m-%d') AS next_load
    FROM (SELECT cust_id, first_reg_dt, least(last_reg_dt, DATE '{fixed.LAST_DATE_CAP}') AS c FROM clv)"""))
def q_tenure(src):
    """Capped last date, non-negative tenure, ±365 d validity, +6/+7 d."""
    return dv.tenure(views.clv(src)).select("cust_id", "last_capped", "reg_diff", "valid_from", "valid_to",
                                            "week_end", "next_load")


@register("normalize_name", """SELECT DISTINCT p_type || ' & ' || p_name AS interest,
    replace(replace(p_type || ' & ' || p_name, ' & ', '_AND_'), ' ', '_') AS category,
    'interest_' || replace(replace(lower(p_type || ' & ' || p_name), ' & ', '_'), ' ', '_') AS feature_name
    FROM part""")
def q_normalize_name(src):
    """Category code and feature-name normalisation of interest labels."""
    lab = F.concat(F.col("p_type"), F.lit(" & "), F.col("p_name"))
    return src.part.select(lab.alias("interest")).distinct().select(
        "interest", normalize_category("interest").alias("category"),
        F.concat(F.lit("interest_"), normalize_feature("interest")).alias("feature_name"))


POINTS_SQL = with_views(["rewards"], f"""SELECT cust_id, point_acc_amt, -rdm AS point_rdm_amt, point_exp_amt,
    CAST(greatest(point_acc_amt - rdm - point_exp_amt, 0) AS BIGINT) AS point_amt,
    round_even(greatest(point_acc_amt - rdm - point_exp_amt, 0) * {fixed.POINT_RATE}, 2) AS point_amt_usd,
    round_even(point_acc_amt * {fixed.POINT_RATE}, 2) AS point_acc_amt_usd,
    round_even(-rdm * {fixed.POINT_RATE}, 2) AS point_rdm_amt_usd FROM rewards""")


@register("points_balance", POINTS_SQL)
def q_points_balance(src):
    """Points balance and USD values."""
    return dv.points_balance(views.rewards(src))


_t = fixed.TIER_THRESHOLDS


@register("tier_lookup", with_views(["rewards"], f"""SELECT r.cust_id, r.point_acc_amt, t.tier_name, d.tier_level_code,
    d.tier_level FROM rewards r CROSS JOIN LATERAL (SELECT CASE WHEN r.point_acc_amt < {_t[0][0]} THEN '{_t[0][1]}'
    WHEN r.point_acc_amt < {_t[1][0]} THEN '{_t[1][1]}' WHEN r.point_acc_amt < {_t[2][0]} THEN '{_t[2][1]}'
    ELSE 'Platinum' END AS tier_name) t LEFT JOIN ({TIER_DIM_SQL}) d ON t.tier_name = d.tier_name"""))
def q_tier_lookup(src):
    """Tier → code and level."""
    return dv.with_tier(views.rewards(src)).select("cust_id", "point_acc_amt", "tier_name", "tier_level_code",
                                                   "tier_level")


GAP_COLS = ["ltv_r", "val_p", "retention_score"]
# null and NaN by customer number (views.with_gaps); a missing value stays missing
GAPS = ("gaps", "SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN cust_id % 7 = 3 THEN NULL WHEN cust_id % 11 = 5 THEN CAST('NaN' AS DOUBLE) ELSE CAST({c} AS DOUBLE) END AS {c}"
    for c in GAP_COLS) + ") FROM customers")


def _there(c: str) -> str:
    return f"({c} IS NOT NULL AND NOT isnan({c}))"


@register("clip_values", with_views(["customers"], f"""SELECT cust_id,
    CASE WHEN {_there('ltv_r')} THEN least(greatest(ltv_r, {fixed.LTV_CLIP[0]}), {fixed.LTV_CLIP[1]}) END AS ltv_clipped,
    CASE WHEN {_there('val_p')} THEN least(greatest(val_p, {fixed.VAL_P_CLIP[0]}), {fixed.VAL_P_CLIP[1]}) END AS val_p_clipped,
    CAST(least(greatest(usr_age, {fixed.AGE_CLIP[0]}), {fixed.AGE_CLIP[1]}) AS BIGINT) AS age_clipped,
    CASE WHEN {_there('retention_score')} THEN round_even(least(greatest(retention_score * 0.9, {fixed.RETENTION_ADJ_CLIP[0]}),
        {fixed.RETENTION_ADJ_CLIP[1]}), 6) END AS retention_adj,
    CASE WHEN {_there('ltv_r')} THEN greatest(ltv_r, 1.0) END AS ltv_floor1 FROM gaps""", [GAPS]))
def q_clip_values(src):
    """Two-sided and one-sided clips, with null and NaN values put in."""
    c = views.with_gaps(views.customers(src), GAP_COLS)
    return c.select("cust_id", clip("ltv_r", *fixed.LTV_CLIP).alias("ltv_clipped"),
                    clip("val_p", *fixed.VAL_P_CLIP).alias("val_p_clipped"),
                    clip("usr_age", *fixed.AGE_CLIP).alias("age_clipped"),
                    F.bround(clip(F.col("retention_score") * 0.9, *fixed.RETENTION_ADJ_CLIP), 6).alias("retention_adj"),
                    clip("ltv_r", 1.0).alias("ltv_floor1"))


@register("safe_default", with_views(["customers"], """SELECT cust_id,
    coalesce(app_game_ratio, 0.0) AS game_ratio, coalesce(avg_daily_usage_min, 0.0) AS daily_min,
    coalesce(CAST(pchs_cnt AS DOUBLE), 0.0) AS pchs_cnt, coalesce(retention_score, 30.0) AS retention FROM customers"""))
def q_safe_default(src):
    """null/NaN → default."""
    c = views.customers(src)
    return c.select("cust_id", safe_default("app_game_ratio").alias("game_ratio"),
                    safe_default("avg_daily_usage_min").alias("daily_min"), safe_default("pchs_cnt").alias("pchs_cnt"),
                    safe_default("retention_score", 30.0).alias("retention"))


LIST_SQL = """SELECT cust_id, list_text, pos, item FROM (
    SELECT cust_id, list_text, generate_subscripts(items, 1) AS pos, unnest(items) AS item FROM (
      SELECT user_id AS cust_id,
        '[' || array_to_string(list_transform(list_sort(list_distinct(list(event_type))), lambda x: '''' || x || ''''), ', ') || ']' AS list_text,
        list_sort(list_distinct(list(event_type))) AS items
      FROM events GROUP BY user_id))"""


@register("parse_list_col", LIST_SQL)
def q_parse_list(src):
    """List printed as text → array → exploded items (round trip through the text form)."""
    per = src.events.groupBy(F.col("user_id").alias("cust_id")).agg(
        F.sort_array(F.collect_set("event_type")).alias("s"))
    t = per.select("cust_id", dv.list_text(F.col("s")).alias("list_text"))
    return t.select("cust_id", "list_text", F.posexplode(parse_list_text("list_text")).alias("pos", "item")) \
        .withColumn("pos", F.col("pos") + 1)


@register("compose_text", with_views(["lines"], """SELECT order_id, line_no,
    concat_ws(',', category, brand, product_name) AS pd_description FROM lines"""))
def q_compose_text(src):
    """Composite text from columns."""
    return views.purchase_lines(src).select("order_id", "line_no",
                                            F.concat_ws(",", "category", "brand", "product_name").alias("pd_description"))


@register("fill_by_type", with_views(["customers"], """SELECT cust_id, coalesce(usr_cnty_name, '') AS usr_cnty_name,
    coalesce(app_game_ratio, 0.0) AS app_game_ratio, coalesce(app_social_ratio, 0.0) AS app_social_ratio,
    coalesce(avg_daily_usage_min, 0.0) AS avg_daily_usage_min, coalesce(ltv_r, 0.0) AS ltv_r FROM customers"""))
def q_fill_by_type(src):
    """Doubles → 0.0, strings → ''."""
    from persona_engine.operators.personas import fill_by_type
    c = views.customers(src).select("cust_id", "usr_cnty_name", "app_game_ratio", "app_social_ratio",
                                    "avg_daily_usage_min", "ltv_r")
    return fill_by_type(c)


@register("propensity_scores", with_views(["enc"], f"""SELECT cust_id,
    round_even(af, 6) AS age_factor, round_even(act, 6) AS active_factor, round_even(ret, 6) AS retention,
    round_even(least(greatest(ret * 0.8, 0.1), 0.9), 6) AS repurchase_p,
    round_even(least(greatest(0.35 + af * 0.1, 0.1), 0.8), 6) AS health_p,
    round_even(least(greatest(0.25 + act * 0.3, 0.1), 0.8), 6) AS wallet_p,
    round_even(least(greatest(0.20 + coalesce(premium_cnt, 0) / 10.0, 0.1), 0.7), 6) AS smartthings_p
    FROM (SELECT cust_id, premium_cnt, af, act,
            least(greatest(af * 0.5 + act + (0.2 + 0.3 * {hash_unit_sql(SEED, 'retention', 'cust_id')}), 0.2), 0.99) AS ret
          FROM (SELECT cust_id, premium_cnt, CAST(1.0 AS DOUBLE) - CAST(usr_age - 18 AS DOUBLE) / 100.0 AS af,
                       CAST(is_active AS DOUBLE) * 0.2 AS act FROM enc))"""))
def q_propensity(src):
    """CLV propensities from age, activity and a hash draw."""
    enc, _ = fe.encode_all(views.customers(src))
    return dv.propensities(enc, SEED)


_vs = fixed.VOYAGER_SEGMENTS


@register("choose_k", with_views(["demo"], f"""SELECT cust_id, k,
    array_to_string(list_transform(list_slice(list_sort(list_transform([{sql_list(_vs)}],
        lambda x: {{'h': md5('{SEED}:voyager:' || CAST(cust_id AS VARCHAR) || ':' || x), 'v': x}})), 1, k), lambda s: s.v), '|') AS segments
    FROM (SELECT cust_id, CAST(floor(1 + {hash_unit_sql(SEED, 'voyager_k', 'cust_id')} * 3) AS BIGINT) AS k FROM demo)"""))
def q_choose_k(src):
    """D3: 1–3 of the 8 segment labels per customer, without replacement (hash-ordered)."""
    from persona_engine.functions.expr import hash_unit
    lo, hi = fixed.VOYAGER_PICK
    d = views.demo(src).select("cust_id")
    k = F.floor(F.lit(lo) + hash_unit(SEED, "voyager_k", "cust_id") * (hi - lo)).cast("long")
    d = d.withColumn("k", k)
    return d.select("cust_id", "k", dv.choose_k(_vs, F.col("k").cast("int"), SEED, "cust_id", "voyager").alias("segments"))


# ------------------------------------------------------------------ C / D
MARG_COLS = ["usr_gndr", "sa_activeness", "usr_cnty_ap2"]


@register("marginal_shares", with_views(["demo"], """SELECT "column", value, n, n / sum(n) OVER (PARTITION BY "column") AS share
    FROM (SELECT "column", value, count(*) AS n FROM (
        SELECT unnest(['usr_gndr', 'sa_activeness', 'usr_cnty_ap2']) AS "column",
               unnest([usr_gndr, sa_activeness, usr_cnty_ap2]) AS value FROM demo)
      WHERE value IS NOT NULL GROUP BY "column", value)"""))
def q_marginal_shares(src):
    """Categorical shares (nulls excluded)."""
    return mg.categorical_shares(views.demo(src), MARG_COLS)


NUM_COLS = ["usr_age", "retention_score", "ltv_r", "val_p"]


@register("numeric_marginals", with_views(["customers"], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round_even(avg(CAST({c} AS DOUBLE)), 3) AS mean, "
    f"round_even(stddev_samp(CAST({c} AS DOUBLE)), 3) AS std FROM customers" for c in NUM_COLS)))
def q_numeric_marginals(src):
    """Mean and sample std."""
    m = mg.numeric_moments(views.customers(src), NUM_COLS)
    return m.select("column", F.bround("mean", 3).alias("mean"), F.bround("std", 3).alias("std"))


FLAG_COLS = ["cum_repchs_flg", "samsunghealth_flag", "samsungwallet_flag", "smartthings_flag"]


@register("flag_rates", with_views(["customers"], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CAST({c} AS DOUBLE)) AS rate FROM customers" for c in FLAG_COLS)))
def q_flag_rates(src):
    """Bernoulli rates."""
    return mg.flag_rates(views.customers(src), FLAG_COLS)


@register("lognormal_fit", with_views(["customers"], f"""SELECT 'ltv_r' AS "column",
    round_even(ln(avg(greatest(ltv_r, 1.0))), 6) AS mu,
    round_even(stddev_samp(greatest(ltv_r, 1.0)) / avg(greatest(ltv_r, 1.0)), 6) AS sigma FROM gaps WHERE {_there('ltv_r')}
    UNION ALL SELECT 'val_p', round_even(ln(avg(greatest(val_p, 1.0))), 6), CAST(0.8 AS DOUBLE) FROM gaps WHERE {_there('val_p')}""", [GAPS]))
def q_lognormal_fit(src):
    """C4: log-normal parameters after clipping at 1 (val_p sigma fixed 0.8), with null and NaN values put in."""
    c = views.with_gaps(views.customers(src), GAP_COLS)
    out = mg.lognormal_params(c, "ltv_r").unionByName(mg.lognormal_params(c, "val_p", fixed.VAL_P_SIGMA))
    return out.select("column", F.bround("mu", 6).alias("mu"), F.bround("sigma", 6).alias("sigma"))


@register("interest_means", with_views(["interests"], """SELECT interest, round_even(avg(interest_score), 9) AS mean_score,
    count(*) AS n FROM interests GROUP BY interest"""))
def q_interest_means(src):
    """Mean score per interest."""
    m = mg.interest_means(views.interests(src))
    return m.select("interest", F.bround("mean_score", 9).alias("mean_score"), "n")


@register("top_interests", with_views(["interests"], """SELECT interest, mean_score, rank FROM (
    SELECT interest, round_even(avg(interest_score), 9) AS mean_score,
      row_number() OVER (ORDER BY round_even(avg(interest_score), 9) DESC, interest) AS rank
    FROM interests GROUP BY interest) WHERE rank <= 8"""))
def q_top_interests(src):
    """Top-8 interests by mean (ties → name order)."""
    m = mg.interest_means(views.interests(src)).select("interest", F.bround("mean_score", 9).alias("mean_score"))
    return mg.top_interests(m).select("interest", "mean_score", F.col("rank").cast("long"))


@register("clv_rollup", with_views(["clv"], """SELECT cust_id, pchs_cnt, premium_cnt, prod_cnt, ltv_r, val_p,
    strftime(first_reg_dt, '%Y-%m-%d') AS first_reg_dt, strftime(last_reg_dt, '%Y-%m-%d') AS last_reg_dt,
    cum_repchs_flg, samsunghealth_flag, samsungwallet_flag, smartthings_flag, retention_score FROM clv"""))
def q_clv_rollup(src):
    """CLV rollup from purchases (order-first two-level aggregation)."""
    return views.clv(src)


@register("usage_ratios", with_views(["app"], """SELECT cust_id, app_game_ratio, app_social_ratio, app_samsung_ratio,
    avg_daily_usage_min, active_days FROM app"""))
def q_usage_ratios(src):
    """C14: usage ratios and average daily minutes."""
    return views.app_features(src)


WEEKLY_SQL = """SELECT cust_id, app_id, strftime(ws, '%Y-%m-%d') AS week_start,
    printf('%d-W%02d', year(ws + 3), week(ws)) AS usage_month, strftime(ws + 6, '%Y-%m-%d') AS week_end,
    usage_cnt, usage_cents / 100.0 AS usage_value, strftime(fst, '%Y-%m-%d') AS fst_usage_date,
    strftime(lst, '%Y-%m-%d') AS lst_usage_date
    FROM (SELECT user_id AS cust_id, event_type AS app_id, CAST(date_trunc('week', ts) AS DATE) AS ws,
        count(*) AS usage_cnt, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS usage_cents,
        min(CAST(ts AS DATE)) AS fst, max(CAST(ts AS DATE)) AS lst
      FROM events GROUP BY ALL)"""


def weekly_usage(ev):
    """User × app × ISO week: count, value, first/last day, week label and bounds."""
    ws = F.to_date(F.date_trunc("week", F.col("ts")))
    g = ev.groupBy(F.col("cust_id"), F.col("app_id"), ws.alias("ws")).agg(
        F.count(F.lit(1)).alias("usage_cnt"),
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("usage_cents"),
        F.min(F.to_date("ts")).alias("fst"), F.max(F.to_date("ts")).alias("lst"))
    return g.select("cust_id", "app_id", F.col("ws").alias("week_start"),
                    F.format_string("%d-W%02d", F.year(F.date_add("ws", 3)), F.weekofyear("ws")).alias("usage_month"),
                    F.date_add("ws", 6).alias("week_end"), "usage_cnt",
                    (F.col("usage_cents") / F.lit(100.0)).alias("usage_value"),
                    F.col("fst").alias("fst_usage_date"), F.col("lst").alias("lst_usage_date"))


@register("weekly_usage", WEEKLY_SQL)
def q_weekly_usage(src):
    """Weekly usage per customer × app."""
    return weekly_usage(views.app_usage_events(src))


@register("device_seq", with_views(["lines"], """SELECT cust_id, order_id, line_no,
    row_number() OVER (PARTITION BY cust_id ORDER BY order_date, order_id, line_no) AS dvc_index FROM lines"""))
def q_device_seq(src):
    """Consecutive child sequence per customer (skew-safe numbering)."""
    lines = views.purchase_lines(src, product=False).select("cust_id", "order_id", "line_no", "order_date")
    out = row_number_within(lines, ["cust_id"], ["order_date", "order_id", "line_no"], "dvc_index")
    return out.select("cust_id", "order_id", "line_no", "dvc_index")


@register("top_n_per_group", with_views(["customers"], """SELECT usr_cnty_ap2, cust_id, ltv_r, rank FROM (
    SELECT usr_cnty_ap2, cust_id, ltv_r, row_number() OVER (PARTITION BY usr_cnty_ap2 ORDER BY ltv_r DESC NULLS LAST, cust_id) AS rank
    FROM customers) WHERE rank <= 3"""))
def q_top_n(src):
    """Top-3 customers by LTV per region (planned as a WindowGroupLimit)."""
    c = views.customers(src)
    w = Window.partitionBy("usr_cnty_ap2").orderBy(F.desc_nulls_last("ltv_r"), "cust_id")
    return c.select("usr_cnty_ap2", "cust_id", "ltv_r", F.row_number().over(w).alias("rank")) \
        .where(F.col("rank") <= 3).withColumn("rank", F.col("rank").cast("long"))
