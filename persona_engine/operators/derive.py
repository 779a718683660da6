"""Row-level derivations (B5–B18, B23, D3). All are projections or broadcast
joins against fixed-size dimension tables (proven bound: the dimension is a
fixed list of ≤ a few dozen rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.functions.expr import age_band, cents, clip, half_even_div, hash_unit, hash_order, rnd


def region_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.REGION_DIM, "ap2 string, gc string, cnty_cd string, cnty_cd2 string, "
                                                   "currency string, exchange_rate double")


def region_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.REGION_TO_AP2, "region_name string, ap2 string")


def category_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.CATEGORY_DIM, "pd_category string, pd_division string, pd_group string")


def ptype_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.PTYPE_TO_CATEGORY, "p_type string, pd_category string")


def tier_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.TIER_DIM, "tier_name string, tier_level_code string, tier_level int")


def with_age_band(df: DataFrame, age: str = "usr_age", out: str = "age_band") -> DataFrame:
    """B5."""
    return df.withColumn(out, age_band(age))


def with_region_dim(df: DataFrame, region_col: str = "usr_cnty_ap2") -> DataFrame:
    """Region → ap2 code → group, country codes, currency, FX (defaults when unmapped)."""
    spark = df.sparkSession
    d = df.join(F.broadcast(region_map(spark)), F.col(region_col) == F.col("region_name"), "left").drop("region_name")
    d = d.join(F.broadcast(region_dim(spark)), "ap2", "left")
    dflt = fixed.REGION_DEFAULTS
    return d.withColumns({
        "gc": F.coalesce("gc", F.lit(dflt["gc"])),
        "cnty_cd": F.coalesce("cnty_cd", F.lit(dflt["cnty_cd"])),
        "cnty_cd2": F.coalesce("cnty_cd2", F.lit(dflt["cnty_cd2"])),
        "currency": F.coalesce("currency", F.lit(dflt["currency"])),
        "exchange_rate": F.coalesce("exchange_rate", F.lit(dflt["fx"])),
    })


def with_category(df: DataFrame, ptype_col: str = "category") -> DataFrame:
    """Part type → product category → division / group; MX membership test."""
    spark = df.sparkSession
    d = df.join(F.broadcast(ptype_map(spark)), F.col(ptype_col) == F.col("p_type"), "left").drop("p_type")
    d = d.join(F.broadcast(category_dim(spark)), "pd_category", "left")
    return d.withColumn("division_fin", F.when(F.col("pd_category").isin(fixed.MX_PRODUCT_MAPPINGS), "MX")
                        .otherwise("VD"))


def price_waterfall(lines: DataFrame) -> DataFrame:
    """sale = base − disc − tradein − rewards (absent → 0), floor 1.0; ×FX; round 2; sell-in 0.65×base.

    Money is carried as exact integers (cents, percent) and rounded half-even
    to cents with integer arithmetic, so the result does not depend on float
    summation order. Stand-in discounts: trade-in = base×tax (zero → absent),
    rewards = 3 % on lines with return flag 'A'.
    """
    base_c = cents("price_base")
    disc_pct = F.round(F.col("l_discount_rate") * 100).cast("long")
    tax_pct = F.round(F.col("tax_rate") * 100).cast("long")
    fx_c = F.round(F.col("exchange_rate") * 100).cast("long")
    d = lines.select("order_id", "line_no", "currency", "exchange_rate", base_c.alias("base_c"),
                     (base_c * disc_pct).alias("disc_u"), F.nullif(base_c * tax_pct, F.lit(0)).alias("trade_u"),
                     F.when(F.col("return_flag") == "A", base_c * 3).alias("rew_u"), fx_c.alias("fx_c"))
    sale_u = F.greatest(F.col("base_c") * 100 - F.col("disc_u") - F.coalesce("trade_u", F.lit(0))
                        - F.coalesce("rew_u", F.lit(0)), F.lit(10000))

    def usd(units, scale):
        return (half_even_div(units, scale) / F.lit(100.0))

    return d.select(
        "order_id", "line_no", "currency", "exchange_rate",
        usd(sale_u, 100).alias("sale_amt_usd"), (F.col("base_c") / F.lit(100.0)).alias("price_base_usd"),
        usd(F.col("disc_u"), 100).alias("price_discount_all_usd"),
        usd(F.col("trade_u"), 100).alias("price_discount_tradein_usd"),
        usd(F.col("rew_u"), 100).alias("price_discount_rewards_usd"),
        usd(sale_u * F.col("fx_c"), 10000).alias("sale_amt_local"),
        usd(F.col("base_c") * F.col("fx_c"), 100).alias("price_base_local"),
        usd(F.col("trade_u") * F.col("fx_c"), 10000).alias("price_discount_tradein_local"),
        usd(F.col("base_c") * int(round(fixed.SELLIN_RATIO * 100)), 100).alias("sellin_price"),
    )


def order_key(prefix_src: str, date_col: str, num_col: str) -> F.Column:
    """2-char region prefix + yymmdd + '-' + zero-padded number."""
    return F.concat(F.substring(F.col(prefix_src), 1, 2), F.date_format(F.col(date_col), "yyMMdd"),
                    F.lit("-"), F.lpad(F.col(num_col).cast("string"), 8, "0"))


def tenure(df: DataFrame, first: str = "first_reg_dt", last: str = "last_reg_dt") -> DataFrame:
    """Cap the last date, non-negative day difference, ±365 d validity, +6/+7 d."""
    capped = F.least(F.col(last), F.to_date(F.lit(fixed.LAST_DATE_CAP)))
    return df.withColumns({
        "last_capped": capped,
        "reg_diff": F.greatest(F.datediff(capped, F.col(first)), F.lit(0)).cast("long"),
        "valid_from": F.date_sub(capped, 365),
        "valid_to": F.date_add(capped, 365),
        "week_end": F.date_add(F.col(first), 6),
        "next_load": F.date_add(F.col(first), 7),
    })


def points_balance(rw: DataFrame) -> DataFrame:
    """balance = max(0, acc − rdm − exp); USD = ×0.01 (2 dp); redeemed shown negative."""
    bal = F.greatest(F.col("point_acc_amt") - F.col("rdm") - F.col("point_exp_amt"), F.lit(0)).cast("long")
    rate = fixed.POINT_RATE
    return rw.select(
        "cust_id", "point_acc_amt", (-F.col("rdm")).alias("point_rdm_amt"), "point_exp_amt",
        bal.alias("point_amt"),
        rnd(bal * rate, 2).alias("point_amt_usd"),
        rnd(F.col("point_acc_amt") * rate, 2).alias("point_acc_amt_usd"),
        rnd(-F.col("rdm") * rate, 2).alias("point_rdm_amt_usd"),
    )


def tier_of(acc: str = "point_acc_amt") -> F.Column:
    t = fixed.TIER_THRESHOLDS
    return (F.when(F.col(acc) < t[0][0], t[0][1]).when(F.col(acc) < t[1][0], t[1][1])
            .when(F.col(acc) < t[2][0], t[2][1]).otherwise("Platinum"))


def with_tier(df: DataFrame, acc: str = "point_acc_amt") -> DataFrame:
    """Tier → code and level (broadcast 4-row dimension)."""
    d = df.withColumn("tier_name", tier_of(acc))
    return d.join(F.broadcast(tier_dim(df.sparkSession)), "tier_name", "left")


def propensities(df: DataFrame, seed: int = 42) -> DataFrame:
    """Retention from age and activity (+ a U(0.2, 0.5) draw); repurchase, health,
    wallet and smart-home probabilities, each clipped."""
    age_factor = F.lit(1.0) - (F.col("usr_age") - F.lit(18)) / F.lit(100.0)
    active_factor = F.col("is_active").cast("double") * F.lit(0.2)
    u = F.lit(0.2) + F.lit(0.3) * hash_unit(seed, "retention", "cust_id")
    ret = clip(age_factor * 0.5 + active_factor + u, 0.2, 0.99)
    return df.select(
        "cust_id",
        rnd(age_factor, 6).alias("age_factor"), rnd(active_factor, 6).alias("active_factor"),
        rnd(ret, 6).alias("retention"),
        rnd(clip(ret * 0.8, 0.1, 0.9), 6).alias("repurchase_p"),
        rnd(clip(F.lit(0.35) + age_factor * 0.1, 0.1, 0.8), 6).alias("health_p"),
        rnd(clip(F.lit(0.25) + active_factor * 0.3, 0.1, 0.8), 6).alias("wallet_p"),
        rnd(clip(F.lit(0.20) + F.coalesce(F.col("premium_cnt"), F.lit(0)) / 10.0, 0.1, 0.7), 6).alias("smartthings_p"),
    )


def choose_k(items: list[str], k_col: F.Column, seed: int, key: str, salt: str = "choose") -> F.Column:
    """D3: k of m without replacement — order the list by md5(seed:salt:key:item), keep the first k."""
    arr = F.array(*[F.struct(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(salt), F.col(key).cast("string"),
                                                F.lit(it))).alias("h"), F.lit(it).alias("v")) for it in items])
    return F.transform(F.slice(F.array_sort(arr), 1, k_col), lambda s: s["v"])


def list_text(arr: F.Column) -> F.Column:
    """Python-style text of a string list: ['a', 'b']."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
                    F.lit("]"))
