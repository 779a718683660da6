"""Synthetic population (E1–E12): fit marginals with aggregates, sample on ``spark.range``.

Fitting is one small aggregate per source table (shares, means, stds, rates);
the fitted parameters are scalars and, for categories, a table of intervals. Sampling is
a projection over ``spark.range(1, n+1)``: every draw is a pure function of
(seed, salt, id) — md5-derived uniforms, Box-Muller normals, order-statistic
betas — so the output does not depend on partitioning, survives task retries
bit-for-bit, and scales linearly with n and the number of executors. A categorical draw
looks its uniform up in the table of intervals: a join on a bucket of [0, 1), by
broadcast up to a counted size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.functions.expr import clip, hash_unit, normalize_feature, std_normal
from persona_engine.operators import marginals as mg
from persona_engine.session import materialize

DEMO_CATEGORICAL = ["usr_gndr", "sa_activeness", "usr_cnty_ap2"]
CLV_FLAGS = ["cum_repchs_flg", "samsunghealth_flag", "samsungwallet_flag", "smartthings_flag"]


@dataclass
class SynthParams:
    levels: DataFrame | None = None                 # column, value, lo, hi (marginals.levels)
    age: tuple = (0.0, 0.0)                         # mean, sample std
    retention: tuple = (0.0, 0.0)
    ltv: tuple = (0.0, 0.0)                         # mu, sigma
    val_p_mu: float = 0.0
    flags: dict = field(default_factory=dict)
    brand_mean: float = 0.0
    interests: list = field(default_factory=list)   # [(interest, mean)] top-8


def fit(demo: DataFrame, clv: DataFrame, events: DataFrame, interests: DataFrame) -> SynthParams:
    """Fit every marginal with one aggregate per source.

    demo and clv are each read by two fits; they are persisted for the fit
    (memory, spilling to disk) so the joins behind them run once.
    """
    from pyspark import StorageLevel
    demo = demo.persist(StorageLevel.MEMORY_AND_DISK)
    clv = clv.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit(demo, clv, events, interests)
    finally:
        demo.unpersist()
        clv.unpersist()


def _fit(demo: DataFrame, clv: DataFrame, events: DataFrame, interests: DataFrame) -> SynthParams:
    p = SynthParams()
    p.levels = materialize(mg.levels(demo, DEMO_CATEGORICAL))
    a = demo.agg(F.avg(F.col("usr_age").cast("double")), F.stddev_samp(F.col("usr_age").cast("double"))).first()
    p.age = (a[0], a[1])
    x = clip("ltv_r", 1.0)
    v = clip("val_p", 1.0)
    c = clv.agg(F.avg("retention_score"), F.stddev_samp("retention_score"), F.log(F.avg(x)),
                F.stddev_samp(x) / F.avg(x), F.log(F.avg(v)),
                *[F.avg(F.col(f).cast("double")) for f in CLV_FLAGS]).first()
    p.retention, p.ltv, p.val_p_mu = (c[0], c[1]), (c[2], c[3]), c[4]
    p.flags = {f: c[5 + i] for i, f in enumerate(CLV_FLAGS)}
    p.brand_mean = events.agg(F.avg((F.col("event_type") == fixed.BRAND_EVENT).cast("double"))).first()[0]
    means = mg.interest_means(interests).withColumn("mean_score", F.bround("mean_score", 9))
    top = mg.top_interests(means).orderBy("rank").collect()     # ≤ 8 rows
    p.interests = [(r["interest"], r["mean_score"]) for r in top]
    return p


def spine(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Ids 1..n; ~1M ids per partition so tasks stay small at any n."""
    parts = partitions or max(spark.sparkContext.defaultParallelism, (n + 999_999) // 1_000_000)
    return spark.range(1, n + 1, 1, parts)


def u(seed, salt):
    return hash_unit(seed, salt, "id")


def z(seed, salt):
    return std_normal(seed, salt, "id")


def categorical(seed, salt: str, levels: list) -> F.Column:
    """E2, a few levels fixed by the code: the first whose cumulative bound exceeds u."""
    if len(levels) == 1:
        return F.lit(levels[0][0])
    bounds = F.array(*[F.lit(float(hi)) for _, hi in levels[:-1]])
    values = F.array(*[F.lit(v) for v, _ in levels])
    passed = F.size(F.filter(bounds, lambda hi: hi <= u(seed, salt)))
    return F.element_at(values, (passed + 1).cast("int"))


# Rows of a table of intervals that may travel to every task.
BROADCAST_LEVELS = 200_000


def draw_categories(df: DataFrame, levels: DataFrame, cols: list[str], seed, broadcast_rows: int = BROADCAST_LEVELS) -> DataFrame:
    """E2, fitted levels: each column of ``cols`` drawn for every id, null where a column has no level.

    [0, 1) is cut into about as many equal buckets as the column has levels; a level's row
    stands in each bucket that its interval touches (two rows a level on average). Buckets
    are hit equally often whatever the shares, so the join by shuffle that more than
    ``broadcast_rows`` rows take has no hot key.
    """
    sizes = {r["column"]: r["n"] for r in levels.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}     # one row a column
    for c in cols:
        n = sizes.get(c, 0)
        if not n:
            df = df.withColumn(c, F.lit(None).cast("string"))
            continue
        buckets = 1 << min(24, (n - 1).bit_length())
        touched = F.sequence(F.floor(F.col("lo") * buckets), F.least(F.floor(F.col("hi") * buckets), F.lit(buckets - 1)))
        table = levels.where(F.col("column") == c).select(F.col("value").alias(c), "lo", "hi", F.explode(touched).alias("_bucket"))
        if n + buckets <= broadcast_rows:
            table = F.broadcast(table)
        df = df.withColumn("_u", u(seed, c)).withColumn("_bucket", F.floor(F.col("_u") * buckets))
        within = (F.col("_u") >= F.col("lo")) & (F.col("_u") < F.col("hi"))
        df = df.join(table, (df["_bucket"] == table["_bucket"]) & within, "left").drop("_u", "_bucket", "lo", "hi")
    return df


def fixed_levels(values: list, shares: list | None) -> list:
    """Cumulative bounds for fixed shares (uniform when none are given)."""
    shares = shares or [1.0 / len(values)] * len(values)
    acc, out = 0.0, []
    for v, s in zip(values, shares):
        acc += s
        out.append((v, acc))
    return out


def truncated_int(x: F.Column) -> F.Column:
    return x.cast("long")      # truncation toward zero, like astype(int)


def beta_order_stat(seed, salt: str, k: int, n: int) -> F.Column:
    """Beta(k, n+1−k) as the k-th smallest of n uniforms (no UDF)."""
    arr = F.array(*[u(seed, f"{salt}:{i}") for i in range(n)])
    return F.element_at(F.array_sort(arr), k)


def demo_block(p: SynthParams, seed) -> dict:
    m, s = p.age
    lo, hi = fixed.AGE_CLIP
    return {
        "usr_age": clip(truncated_int(F.lit(m) + F.lit(s) * z(seed, "age")), lo, hi),
        **{c: F.col(c) for c in DEMO_CATEGORICAL},      # drawn before
    }


def clv_block(p: SynthParams, seed) -> dict:
    rm, rs = p.retention
    mu, sig = p.ltv
    plo, phi = fixed.PCHS_CNT_RANGE
    qlo, qhi = fixed.PREMIUM_CNT_RANGE
    out = {
        "retention_score": clip(F.lit(rm) + F.lit(rs) * z(seed, "retention"), 0.0, 1.0),
        "ltv_r": clip(F.exp(F.lit(mu) + F.lit(sig) * z(seed, "ltv")), 0.0),
        "val_p": clip(F.exp(F.lit(p.val_p_mu) + F.lit(fixed.VAL_P_SIGMA) * z(seed, "val_p")), 0.0),
        "pchs_cnt": F.floor(F.lit(plo) + u(seed, "pchs_cnt") * (phi - plo)).cast("long"),
        "premium_cnt": F.floor(F.lit(qlo) + u(seed, "premium_cnt") * (qhi - qlo)).cast("long"),
    }
    for f in CLV_FLAGS:
        out[f] = (u(seed, f) < F.lit(float(p.flags[f] or 0.0))).cast("long")
    return out


def app_block(p: SynthParams, seed) -> dict:
    lo, hi = fixed.DAILY_MIN_CLIP
    return {
        "app_game_ratio": beta_order_stat(seed, "game", fixed.GAME_BETA[0], sum(fixed.GAME_BETA) - 1),
        "app_social_ratio": beta_order_stat(seed, "social", fixed.SOCIAL_BETA[0], sum(fixed.SOCIAL_BETA) - 1),
        "app_samsung_ratio": clip(F.lit(float(p.brand_mean or 0.0)) + F.lit(fixed.BRAND_APP_SD) * z(seed, "brand"),
                                  0.0, 1.0),
        "avg_daily_usage_min": clip(F.lit(fixed.DAILY_MIN_MEAN) + F.lit(fixed.DAILY_MIN_SD) * z(seed, "daily"), lo, hi),
    }


def home_block(seed) -> dict:
    out = {}
    for name, values, shares in fixed.HOME_CATEGORICAL:
        col = categorical(seed, name, fixed_levels(values, shares))
        out[name] = col.cast("long") if isinstance(values[0], int) else col
    for name, m, s in fixed.HOME_SCORES:
        out[name] = truncated_int(clip(F.lit(m) + F.lit(s) * z(seed, name), 0.0, 100.0))
    return {k: out[k] for k in fixed.HOME_COLUMN_ORDER}


def interest_column_name(interest: str) -> str:
    return "interest_" + interest.lower().replace(" & ", "_").replace(" ", "_")


def interest_block(p: SynthParams, seed) -> dict:
    """exponential(mean) scores clipped to [0, 1], one column per top interest."""
    return {interest_column_name(i): clip(-F.lit(float(m)) * F.log(F.lit(1.0) - u(seed, "interest:" + i)), 0.0, 1.0)
            for i, m in p.interests}


def synth_population(spark: SparkSession, n: int, p: SynthParams, seed: int = 42,
                     interests: bool = True, partitions: int | None = None) -> DataFrame:
    """The wide synthetic table: fitted categories joined to the id spine, all else in one projection over it."""
    cols = {**demo_block(p, seed), **clv_block(p, seed), **app_block(p, seed)}
    if interests:
        cols.update(interest_block(p, seed))
    cols.update(home_block(seed))
    ids = draw_categories(spine(spark, n, partitions), p.levels, DEMO_CATEGORICAL, seed)
    return ids.select(F.col("id").alias("index"), *[c.alias(k) for k, c in cols.items()])


def drift(source: DataFrame, synthetic: DataFrame, cols: list[str]) -> DataFrame:
    """Source vs synthetic share per (column, value), full outer join."""
    a = mg.categorical_shares(source, cols).select("column", "value", F.col("share").alias("source_share"))
    b = mg.categorical_shares(synthetic, cols).select("column", "value", F.col("share").alias("synth_share"))
    j = a.join(b, ["column", "value"], "full_outer")
    return j.withColumn("diff", F.coalesce("synth_share", F.lit(0.0)) - F.coalesce("source_share", F.lit(0.0)))


def numeric_drift(source: DataFrame, synthetic: DataFrame, cols: list[str]) -> DataFrame:
    """E12, numbers: mean and sample std per column in the source and the synthetic table, in the shape of ``drift``."""
    def stats(df, name):
        aggs = [F.array(*[F.struct(F.lit(s).alias("value"), f(F.col(c).cast("double")).alias(name)) for s, f in (("mean", F.avg), ("std", F.stddev_samp))]).alias(c)
                for c in cols]
        return df.agg(*aggs).unpivot([], cols, "column", "x").select("column", F.explode("x").alias("x")).select("column", "x.*")

    j = stats(source, "source_share").join(stats(synthetic, "synth_share"), ["column", "value"])
    return j.withColumn("diff", F.col("synth_share") - F.col("source_share"))
