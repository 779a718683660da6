"""Registered queries: synthetic population (E1–E12), n = number of source customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.operators import synth as sy
from persona_engine.plans.oracle_views import _q, with_views
from persona_engine.plans.q_derive import hash_unit_sql
from persona_engine.plans.registry import register
from persona_engine.sources import views

SEED = 42
TWO_PI = 2.0 * 3.141592653589793


# ------------------------------------------------------------------ Spark side
def _fit(src):
    p = sy.fit(views.demo(src), views.clv(src), src.events, views.interests(src))
    return p


def _population(src, interests=False):
    p = _fit(src)
    n = src.customer.count()
    return sy.synth_population(src.spark, n, p, SEED, interests=interests), p


def _r6(df, cols, d=6):
    return df.withColumns({c: F.bround(F.col(c), d) for c in cols})


# ------------------------------------------------------------------ SQL side
def u_sql(salt):
    return hash_unit_sql(SEED, salt, "id")


def z_sql(salt):
    return f"(sqrt(-2.0 * ln({u_sql(salt + ':n1')})) * cos({TWO_PI!r} * {u_sql(salt + ':n2')}))"


def clip_sql(x, lo=None, hi=None):
    if lo is not None:
        x = f"greatest({x}, {lo!r})"
    if hi is not None:
        x = f"least({x}, {hi!r})"
    return x


def fixed_cat_sql(salt, values, shares):
    lv = sy.fixed_levels(values, shares)
    parts = [f"WHEN {u_sql(salt)} < {hi!r} THEN {_q(v) if isinstance(v, str) else v}" for v, hi in lv[:-1]]
    last = lv[-1][0]
    return f"(CASE {' '.join(parts)} ELSE {_q(last) if isinstance(last, str) else last} END)"


def beta_sql(salt, k, n):
    return f"list_sort([{', '.join(u_sql(f'{salt}:{i}') for i in range(n))}])[{k}]"


PARAM_CTES = [
    ("pd", "SELECT avg(CAST(usr_age AS DOUBLE)) AS am, stddev_samp(CAST(usr_age AS DOUBLE)) AS asd FROM demo"),
    ("pc", "SELECT avg(retention_score) AS rm, stddev_samp(retention_score) AS rsd, "
           "ln(avg(greatest(ltv_r, 1.0))) AS lmu, stddev_samp(greatest(ltv_r, 1.0)) / avg(greatest(ltv_r, 1.0)) AS lsig, "
           "ln(avg(greatest(val_p, 1.0))) AS vmu, "
           + ", ".join(f"avg(CAST({f} AS DOUBLE)) AS f_{f}" for f in sy.CLV_FLAGS) + " FROM clv"),
    ("pe", f"SELECT avg(CAST(event_type = {_q(fixed.BRAND_EVENT)} AS DOUBLE)) AS bm FROM events"),
    ("spine", "SELECT unnest(generate_series(1, (SELECT count(*) FROM customer))) AS id"),
    ("cnt", """SELECT "column", value, count(*) AS n FROM (
        SELECT unnest(['usr_gndr', 'sa_activeness', 'usr_cnty_ap2']) AS "column",
               unnest([usr_gndr, sa_activeness, usr_cnty_ap2]) AS value FROM demo) WHERE value IS NOT NULL
        GROUP BY "column", value"""),
    ("sh", """SELECT "column", value, (cum - n) / tot AS lo, cum / tot AS hi FROM (
        SELECT "column", value, n,
          sum(n) OVER (PARTITION BY "column" ORDER BY n DESC, value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
          sum(n) OVER (PARTITION BY "column") AS tot FROM cnt)"""),
    ("ut", "SELECT id, " + ", ".join(f"{u_sql(c)} AS u_{c}" for c in sy.DEMO_CATEGORICAL) + " FROM spine"),
    ("cat", "SELECT ut.id, " + ", ".join(f"s_{c}.value AS {c}" for c in sy.DEMO_CATEGORICAL) + " FROM ut "
     + " ".join(f"LEFT JOIN sh s_{c} ON s_{c}.\"column\" = '{c}' AND ut.u_{c} >= s_{c}.lo AND ut.u_{c} < s_{c}.hi"
                for c in sy.DEMO_CATEGORICAL)),
]
SYN_VIEWS = ["demo", "clv"]

AGE_SQL = f"CAST(least(greatest(trunc(pd.am + pd.asd * {z_sql('age')}), {fixed.AGE_CLIP[0]}), {fixed.AGE_CLIP[1]}) AS BIGINT)"
RET_SQL = clip_sql(f"(pc.rm + pc.rsd * {z_sql('retention')})", 0.0, 1.0)
LTV_SQL = clip_sql(f"exp(pc.lmu + pc.lsig * {z_sql('ltv')})", 0.0)
VALP_SQL = clip_sql(f"exp(pc.vmu + {fixed.VAL_P_SIGMA!r} * {z_sql('val_p')})", 0.0)
BRAND_SQL = clip_sql(f"(pe.bm + {fixed.BRAND_APP_SD!r} * {z_sql('brand')})", 0.0, 1.0)
DAILY_SQL = clip_sql(f"({fixed.DAILY_MIN_MEAN!r} + {fixed.DAILY_MIN_SD!r} * {z_sql('daily')})", *fixed.DAILY_MIN_CLIP)
PCHS_SQL = (f"CAST(floor({fixed.PCHS_CNT_RANGE[0]} + {u_sql('pchs_cnt')} * "
            f"{fixed.PCHS_CNT_RANGE[1] - fixed.PCHS_CNT_RANGE[0]}) AS BIGINT)")
PREM_SQL = (f"CAST(floor({fixed.PREMIUM_CNT_RANGE[0]} + {u_sql('premium_cnt')} * "
            f"{fixed.PREMIUM_CNT_RANGE[1] - fixed.PREMIUM_CNT_RANGE[0]}) AS BIGINT)")
GAME_SQL = beta_sql("game", fixed.GAME_BETA[0], sum(fixed.GAME_BETA) - 1)
SOCIAL_SQL = beta_sql("social", fixed.SOCIAL_BETA[0], sum(fixed.SOCIAL_BETA) - 1)


def flag_sql(f):
    return f"CAST({u_sql(f)} < coalesce(pc.f_{f}, 0.0) AS BIGINT)"


def home_sql():
    out = {}
    for name, values, shares in fixed.HOME_CATEGORICAL:
        out[name] = fixed_cat_sql(name, values, shares)
        if isinstance(values[0], int):
            out[name] = f"CAST({out[name]} AS BIGINT)"
    for name, m, s in fixed.HOME_SCORES:
        out[name] = f"CAST(trunc({clip_sql(f'({m!r} + {s!r} * {z_sql(name)})', 0.0, 100.0)}) AS BIGINT)"
    return {k: out[k] for k in fixed.HOME_COLUMN_ORDER}


FROM_PARAMS = "FROM spine CROSS JOIN pd CROSS JOIN pc CROSS JOIN pe"


def synth_sql(select: str, from_: str = FROM_PARAMS) -> str:
    return with_views(SYN_VIEWS, f"SELECT {select} {from_}", PARAM_CTES)


# ------------------------------------------------------------------ queries
@register("synth_spine", "SELECT unnest(generate_series(1, (SELECT count(*) FROM customer))) AS id")
def q_spine(src):
    """Id spine 1..n (n = source customers)."""
    return sy.spine(src.spark, src.customer.count())


@register("synth_categorical", with_views(SYN_VIEWS, "SELECT id, usr_gndr, sa_activeness, usr_cnty_ap2 FROM cat",
                                          PARAM_CTES))
def q_categorical(src):
    """Weighted categorical draws from fitted shares."""
    df, _ = _population(src)
    return df.select(F.col("index").alias("id"), "usr_gndr", "sa_activeness", "usr_cnty_ap2")


@register("synth_age", synth_sql(f"id, {AGE_SQL} AS usr_age"))
def q_age(src):
    """Normal age, truncated, clipped to 18–75."""
    df, _ = _population(src)
    return df.select(F.col("index").alias("id"), "usr_age")


@register("synth_clipped_normal", synth_sql(f"id, round_even({RET_SQL}, 6) AS retention_score, "
                                            f"round_even({BRAND_SQL}, 6) AS app_samsung_ratio, "
                                            f"round_even({DAILY_SQL}, 6) AS avg_daily_usage_min"))
def q_clipped_normal(src):
    """Clipped normals (retention, brand-app ratio, daily minutes)."""
    df, _ = _population(src)
    return _r6(df.select(F.col("index").alias("id"), "retention_score", "app_samsung_ratio", "avg_daily_usage_min"),
               ["retention_score", "app_samsung_ratio", "avg_daily_usage_min"])


@register("synth_lognormal", synth_sql(f"id, round_even({LTV_SQL}, 4) AS ltv_r, round_even({VALP_SQL}, 4) AS val_p"))
def q_lognormal(src):
    """E5: log-normal LTV and value."""
    df, _ = _population(src)
    return _r6(df.select(F.col("index").alias("id"), "ltv_r", "val_p"), ["ltv_r", "val_p"], 4)


@register("synth_uniform_int", synth_sql(f"id, {PCHS_SQL} AS pchs_cnt, {PREM_SQL} AS premium_cnt"))
def q_uniform_int(src):
    """Uniform integers."""
    df, _ = _population(src)
    return df.select(F.col("index").alias("id"), "pchs_cnt", "premium_cnt")


@register("synth_flags", synth_sql("id, " + ", ".join(f"{flag_sql(f)} AS {f}" for f in sy.CLV_FLAGS)))
def q_flags(src):
    """Bernoulli flags at the fitted rates."""
    df, _ = _population(src)
    return df.select(F.col("index").alias("id"), *sy.CLV_FLAGS)


@register("synth_beta", synth_sql(f"id, round_even({GAME_SQL}, 6) AS app_game_ratio, "
                                  f"round_even({SOCIAL_SQL}, 6) AS app_social_ratio"))
def q_beta(src):
    """Beta(2,5) and Beta(3,4) as order statistics of six uniforms."""
    df, _ = _population(src)
    return _r6(df.select(F.col("index").alias("id"), "app_game_ratio", "app_social_ratio"),
               ["app_game_ratio", "app_social_ratio"])


TOP8_CTE = ("top8", """SELECT interest, mean_score, rank FROM (SELECT interest, round_even(avg(interest_score), 9) AS mean_score,
        row_number() OVER (ORDER BY round_even(avg(interest_score), 9) DESC, interest) AS rank
        FROM interests GROUP BY interest) WHERE rank <= 8""")
TOP8_WIDE_CTE = ("top8w", "SELECT " + ", ".join(f"max(interest) FILTER (WHERE rank = {r}) AS i{r}, max(mean_score) FILTER (WHERE rank = {r}) AS m{r}"
                                                for r in range(1, 9)) + " FROM top8")


def interest_score_sql(r: int) -> str:
    """E9 score of the interest of rank r for spine.id, from top8w."""
    u = (f"((CAST(CAST(('0x' || substr(md5('{SEED}:interest:' || t8.i{r} || ':' || CAST(spine.id AS VARCHAR)), 1, 8)) AS BIGINT) AS DOUBLE)"
         " + 0.5) / 4294967296.0)")
    return f"round_even(least(greatest(-t8.m{r} * ln(1.0 - {u}), 0.0), 1.0), 6)"


INTEREST_SQL = with_views(["interests"], f"""SELECT s.id, 'interest_' || replace(replace(lower(t.interest), ' & ', '_'), ' ', '_') AS interest,
    round_even(least(greatest(-t.mean_score * ln(1.0 - ((CAST(CAST(('0x' || substr(md5('{SEED}:interest:' || t.interest || ':' || CAST(s.id AS VARCHAR)), 1, 8)) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296.0)), 0.0), 1.0), 6) AS score
    FROM spine s CROSS JOIN top8 t""", [
    ("spine", "SELECT unnest(generate_series(1, (SELECT count(*) FROM customer))) AS id"),
    ("top8", """SELECT interest, mean_score FROM (SELECT interest, round_even(avg(interest_score), 9) AS mean_score,
        row_number() OVER (ORDER BY round_even(avg(interest_score), 9) DESC, interest) AS rank
        FROM interests GROUP BY interest) WHERE rank <= 8""")])


@register("synth_interest", INTEREST_SQL)
def q_interest(src):
    """Exponential interest scores for the top-8 interests (reported long)."""
    df, p = _population(src, interests=True)
    cols = [sy.interest_column_name(i) for i, _ in p.interests]
    long = df.select(F.col("index").alias("id"), *cols).unpivot("id", cols, "interest", "score")
    return long.withColumn("score", F.bround("score", 6))


HOME = home_sql()


@register("synth_home", synth_sql("id, " + ", ".join(f"{v} AS {k}" for k, v in HOME.items()), "FROM spine"))
def q_home(src):
    """18 household / home / loyalty attributes."""
    df, _ = _population(src)
    return df.select(F.col("index").alias("id"), *fixed.HOME_COLUMN_ORDER)


WIDE = {"usr_age": AGE_SQL, "usr_gndr": "spine.usr_gndr", "sa_activeness": "spine.sa_activeness",
        "usr_cnty_ap2": "spine.usr_cnty_ap2", "retention_score": f"round_even({RET_SQL}, 6)",
        "ltv_r": f"round_even({LTV_SQL}, 4)", "val_p": f"round_even({VALP_SQL}, 4)",
        "pchs_cnt": PCHS_SQL, "premium_cnt": PREM_SQL,
        **{f: flag_sql(f) for f in sy.CLV_FLAGS},
        "app_game_ratio": f"round_even({GAME_SQL}, 6)", "app_social_ratio": f"round_even({SOCIAL_SQL}, 6)",
        "app_samsung_ratio": f"round_even({BRAND_SQL}, 6)", "avg_daily_usage_min": f"round_even({DAILY_SQL}, 6)",
        **HOME}


INTEREST_COLS = {f"interest_{r}": interest_score_sql(r) for r in range(1, 9)}


@register("synth_customers", with_views(
    [*SYN_VIEWS, "interests"], "SELECT spine.id AS \"index\", " + ", ".join(f"{v} AS {k}" for k, v in (WIDE | INTEREST_COLS).items())
    + " FROM (SELECT cat.* FROM cat) spine CROSS JOIN pd CROSS JOIN pc CROSS JOIN pe CROSS JOIN top8w t8", [*PARAM_CTES, TOP8_CTE, TOP8_WIDE_CTE]))
def q_synth_customers(src):
    """The assembled wide synthetic table; its interest columns are named by rank here, as the interests differ by table."""
    df, p = _population(src, interests=True)
    df = df.withColumnsRenamed({sy.interest_column_name(i): f"interest_{r}" for r, (i, _) in enumerate(p.interests, start=1)})
    df = _r6(df, [f"interest_{r}" for r in range(1, len(p.interests) + 1)])
    df = _r6(df, ["retention_score", "app_game_ratio", "app_social_ratio", "app_samsung_ratio", "avg_daily_usage_min"])
    return _r6(df, ["ltv_r", "val_p"], 4)


DRIFT_NUMBERS = {"usr_age": AGE_SQL, "retention_score": RET_SQL, "ltv_r": LTV_SQL, "val_p": VALP_SQL}


def _drift_number_sql(c: str) -> str:
    source = "demo" if c == "usr_age" else "clv"
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", '{stat}' AS value, round_even(a.v, 3) AS source_share, round_even(b.v, 3) AS synth_share,
        round_even(abs(b.v - a.v), 3) AS diff FROM (SELECT {fn}(CAST({c} AS DOUBLE)) AS v FROM {source}) a,
        (SELECT {fn}(CAST({DRIFT_NUMBERS[c]} AS DOUBLE)) AS v {FROM_PARAMS}) b""" for stat, fn in (("mean", "avg"), ("std", "stddev_samp")))


@register("synth_drift", with_views(SYN_VIEWS, """SELECT coalesce(a."column", b."column") AS "column",
    coalesce(a.value, b.value) AS value, round_even(a.share, 6) AS source_share, round_even(b.share, 6) AS synth_share,
    round_even(coalesce(b.share, 0.0) - coalesce(a.share, 0.0), 6) AS diff
    FROM (SELECT "column", value, n / sum(n) OVER (PARTITION BY "column") AS share FROM cnt) a
    FULL OUTER JOIN (SELECT "column", value, n / sum(n) OVER (PARTITION BY "column") AS share FROM (
        SELECT "column", value, count(*) AS n FROM (
          SELECT unnest(['usr_gndr', 'sa_activeness', 'usr_cnty_ap2']) AS "column",
                 unnest([usr_gndr, sa_activeness, usr_cnty_ap2]) AS value FROM cat) WHERE value IS NOT NULL
        GROUP BY "column", value)) b ON a."column" = b."column" AND a.value = b.value
    UNION ALL """ + " UNION ALL ".join(_drift_number_sql(c) for c in DRIFT_NUMBERS), PARAM_CTES))
def q_drift(src):
    """Source vs synthetic categorical shares, and means and sample stds of the fitted numbers."""
    df, _ = _population(src)
    d = _r6(sy.drift(views.demo(src), df, sy.DEMO_CATEGORICAL), ["source_share", "synth_share", "diff"])
    numbers = sy.numeric_drift(views.demo(src).select("usr_age"), df, ["usr_age"]).unionByName(
        sy.numeric_drift(views.clv(src), df, [c for c in DRIFT_NUMBERS if c != "usr_age"]))
    numbers = numbers.withColumn("diff", F.abs("diff"))
    return d.unionByName(_r6(numbers, ["source_share", "synth_share", "diff"], 3))
