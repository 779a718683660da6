"""Customer-model views over the test tables.

The customer model the engine works on has five inputs: demographics, CLV,
purchase lines, app usage and interests (plus rewards). The test tables are
TPC-H-like, so these views derive each input from them. Gender, age, the flags
and the activeness buckets are invented stand-ins for testing (they are not in
the original data); the aggregation logic around them is the engine's own.

Scale notes: nation/region are fixed 25/5-row TPC-H dimensions and are
broadcast; every other join is left to Catalyst/AQE (size-checked broadcast or
sort-merge). Purchases are rolled up order-first: when lineitem⋈orders is a
sort-merge join (the large-scale case) the order-level aggregation reuses its
order-key partitioning, and only order-level rows (¼ of the lines) are shuffled
to the customer grain, with map-side partial aggregation so a customer holding a
third of all orders is pre-combined per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.functions.expr import clip, flag, rnd
from persona_engine.sources.tables import Sources, scalar


def order_date_bounds(src: Sources) -> tuple:
    """(min, max) order date — two fitted scalars from one global aggregate (computed once per source)."""
    key = "_order_date_bounds"
    if key not in src.__dict__:
        row = src.orders.agg(F.min(F.to_date("o_orderdate")).alias("lo"),
                             F.max(F.to_date("o_orderdate")).alias("hi")).first()
        src.__dict__[key] = (row["lo"], row["hi"])
    return src.__dict__[key]


def region_values(src: Sources) -> list:
    """Distinct customer regions (one-hot domain) from the small customer⋈nation⋈region join."""
    geo = (src.customer.select("c_nationkey")
           .join(F.broadcast(src.nation.select("n_nationkey", "n_regionkey")),
                 F.col("c_nationkey") == F.col("n_nationkey"))
           .join(F.broadcast(src.region.select("r_regionkey", "r_name")),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    vals = geo.select("r_name").where(F.col("r_name").isNotNull()).distinct().collect()   # one column each
    return sorted(r[0] for r in vals)


def last_order_by_customer(src: Sources) -> DataFrame:
    return (src.orders.groupBy(F.col("o_custkey").alias("cust_id"))
            .agg(F.max(F.to_date("o_orderdate")).alias("last_order_date")))


def activeness(days: F.Column) -> F.Column:
    """Days since the last order → activeness bucket (stand-in for the app signal)."""
    lv = fixed.ACTIVENESS_LEVELS
    return (F.when(days <= 30, lv[0]).when(days <= 90, lv[1]).when(days <= 180, lv[2])
            .when(days <= 365, lv[3]).otherwise(lv[4]))


def customer_region(src: Sources) -> DataFrame:
    """Customer → country and region only (no order aggregate): for lookups that need the geography."""
    geo = (src.customer.select("c_custkey", "c_nationkey")
           .join(F.broadcast(src.nation.select("n_nationkey", "n_name", "n_regionkey")),
                 F.col("c_nationkey") == F.col("n_nationkey"))
           .join(F.broadcast(src.region.select("r_regionkey", "r_name")),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    return geo.select(F.col("c_custkey").alias("cust_id"), F.col("n_name").alias("usr_cnty_name"),
                      F.col("r_name").alias("usr_cnty_ap2"))


def demo(src: Sources) -> DataFrame:
    """One row per customer: region, country, gender, age, activeness."""
    _, ref = order_date_bounds(src)
    geo = (src.customer.select("c_custkey", "c_nationkey")
           .join(F.broadcast(src.nation.select("n_nationkey", "n_name", "n_regionkey")),
                 F.col("c_nationkey") == F.col("n_nationkey"))
           .join(F.broadcast(src.region.select("r_regionkey", "r_name")),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    last = last_order_by_customer(src)
    out = geo.join(last, geo.c_custkey == last.cust_id, "left")
    days = F.datediff(F.lit(ref), F.col("last_order_date"))
    return out.select(
        F.col("c_custkey").alias("cust_id"),
        F.col("n_name").alias("usr_cnty_name"),
        F.col("r_name").alias("usr_cnty_ap2"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("usr_gndr"),
        (F.lit(18) + F.col("c_custkey") % 58).cast("long").alias("usr_age"),
        activeness(days).alias("sa_activeness"),
    )


def purchase_lines(src: Sources, product: bool = True, per_customer: DataFrame | None = None) -> DataFrame:
    """One row per order line with order, customer and, if asked for, product attributes.

    lineitem⟕part first, then ⋈orders, so the result stays partitioned by the order key for
    the order-level rollup. Lines whose part is unknown stay, with null product columns.
    ``per_customer`` (cust_id and more columns) is joined to the orders, a quarter of the
    rows, before they meet the lines.
    """
    li = src.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                             "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    od = src.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                           "o_orderpriority")
    extra = []
    if per_customer is not None:
        extra = [c for c in per_customer.columns if c != "cust_id"]
        od = od.join(per_customer, od.o_custkey == F.col("cust_id"), "left").drop("cust_id")
    if product:
        li = li.join(src.part.select("p_partkey", "p_type", "p_brand", "p_name"), F.col("l_partkey") == F.col("p_partkey"), "left")
    j = li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
    base = F.col("l_extendedprice")
    # exact money: price in cents × (100 − discount in %) = net in 1e-4 units (integer sums are exact)
    units = (F.round(base * 100).cast("long") * (F.lit(100) - F.round(F.col("l_discount") * 100).cast("long")))
    return j.select(
        F.col("o_custkey").alias("cust_id"),
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("l_linenumber").cast("long").alias("line_no"),
        F.col("l_partkey").alias("part_id"),
        *([F.col("p_type").alias("category"), F.col("p_brand").alias("brand"), F.col("p_name").alias("product_name"),
           flag(F.col("p_type").isin(fixed.PREMIUM_PTYPES)).alias("premium_flg")] if product else []),
        F.col("l_quantity").alias("quantity"),
        base.alias("price_base"),
        (base * F.col("l_discount")).alias("price_discount"),
        units.alias("net_units"),
        (units / F.lit(10000.0)).alias("net_amount"),
        (base * F.col("l_tax")).alias("tax_amount"),
        F.col("l_tax").alias("tax_rate"),
        F.col("l_discount").alias("l_discount_rate"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("order_priority"),
        *extra,
    )


def order_rollup(lines: DataFrame) -> DataFrame:
    """Order grain: value, premium, line count, return flag."""
    return (lines.groupBy("order_id", "cust_id", "order_date", "order_status", "order_priority")
            .agg(F.sum("net_units").alias("order_units"),
                 F.max("premium_flg").alias("has_premium"),
                 F.count(F.lit(1)).alias("n_lines"),
                 F.max((F.col("return_flag") == "R").cast("long")).alias("any_return")))


def clv(src: Sources) -> DataFrame:
    """CLV rollup per customer from purchases."""
    lo, hi = order_date_bounds(src)
    span = float((hi - lo).days) if lo and hi else 1.0
    orders = order_rollup(purchase_lines(src))
    agg = orders.groupBy("cust_id").agg(
        F.count(F.lit(1)).alias("pchs_cnt"),
        F.sum("has_premium").alias("premium_cnt"),
        F.sum("n_lines").alias("prod_cnt"),
        F.sum("order_units").alias("ltv_units"),
        F.avg("order_units").alias("val_units"),
        F.min("order_date").alias("first_reg_dt"),
        F.max("order_date").alias("last_reg_dt"),
        F.max((F.col("order_priority") == "1-URGENT").cast("long")).alias("samsunghealth_flag"),
        F.max((F.col("order_status") == "F").cast("long")).alias("samsungwallet_flag"),
        F.max("any_return").alias("smartthings_flag"),
    )
    recency = F.datediff(F.lit(hi), F.col("last_reg_dt")).cast("double")
    return agg.select(
        "cust_id", "pchs_cnt", "premium_cnt", "prod_cnt",
        (F.col("ltv_units") / F.lit(10000.0)).alias("ltv_r"),
        (F.col("val_units") / F.lit(10000.0)).alias("val_p"),
        "first_reg_dt", "last_reg_dt",
        (F.col("pchs_cnt") > 1).cast("long").alias("cum_repchs_flg"),
        "samsunghealth_flag", "samsungwallet_flag", "smartthings_flag",
        rnd(clip(F.lit(1.0) - recency / F.lit(span), 0.0, 1.0), 3).alias("retention_score"),
    )


def app_usage_daily(src: Sources) -> DataFrame:
    """User × day usage; event types play app categories (view=game, click=social, purchase=brand app)."""
    ev = src.events.select("user_id", "ts", "event_type", "value")
    v = F.round(F.col("value") * 100).cast("long")      # exact cents: integer sums
    return (ev.groupBy(F.col("user_id").alias("cust_id"), F.to_date("ts").alias("usage_date"))
            .agg(F.sum(v).alias("total"),
                 F.sum(F.when(F.col("event_type") == fixed.GAME_EVENT, v).otherwise(0)).alias("game"),
                 F.sum(F.when(F.col("event_type") == fixed.SOCIAL_EVENT, v).otherwise(0)).alias("social"),
                 F.sum(F.when(F.col("event_type") == fixed.BRAND_EVENT, v).otherwise(0)).alias("brand")))


def app_features(src: Sources) -> DataFrame:
    """C14: game / social / brand-app ratios and average daily minutes per user."""
    d = app_usage_daily(src)
    u = d.groupBy("cust_id").agg(F.sum("total").alias("total"), F.sum("game").alias("game"),
                                 F.sum("social").alias("social"), F.sum("brand").alias("brand"),
                                 F.count(F.lit(1)).alias("active_days"))
    t = F.col("total")
    return u.select(
        "cust_id",
        F.try_divide(F.col("game").cast("double"), t.cast("double")).alias("app_game_ratio"),
        F.try_divide(F.col("social").cast("double"), t.cast("double")).alias("app_social_ratio"),
        F.try_divide(F.col("brand").cast("double"), t.cast("double")).alias("app_samsung_ratio"),
        rnd(t / F.col("active_days") / F.lit(100.0), 6).alias("avg_daily_usage_min"),
        "active_days",
    )


def customers(src: Sources) -> DataFrame:
    """Wide customer table: demo ⟕ clv ⟕ app features (nulls where no orders/events)."""
    c = clv(src).drop("first_reg_dt", "last_reg_dt", "prod_cnt")
    a = app_features(src).drop("active_days")
    return demo(src).join(c, "cust_id", "left").join(a, "cust_id", "left")


def interests(src: Sources) -> DataFrame:
    """Customer × brand interest score = the brand's share of the customer's spend."""
    lines = purchase_lines(src)
    cb = lines.groupBy("cust_id", F.col("brand").alias("interest")).agg(F.sum("net_units").alias("spend"))
    tot = cb.groupBy("cust_id").agg(F.sum("spend").alias("total"))       # from the small brand rollup
    return cb.join(tot, "cust_id").select(
        "cust_id", "interest", (F.col("spend").cast("double") / F.col("total").cast("double")).alias("interest_score"))


def rewards(src: Sources) -> DataFrame:
    """Points per customer: accrued = order totals, redeemed = finished orders, expired = 5% of pending."""
    pts = F.floor(F.col("o_totalprice")).cast("long")
    return (src.orders.groupBy(F.col("o_custkey").alias("cust_id"))
            .agg(F.sum(pts).alias("point_acc_amt"),
                 F.sum(F.when(F.col("o_orderstatus") == "F", pts).otherwise(0)).alias("rdm"),
                 F.expr("sum(CASE WHEN o_orderstatus = 'P' THEN floor(o_totalprice) ELSE 0 END) div 20")
                 .alias("point_exp_amt")))


def app_usage_events(src: Sources) -> DataFrame:
    """Event rows with a timestamp usable for watermarks (TIMESTAMP_NTZ → TIMESTAMP)."""
    return src.events.select(F.col("user_id").alias("cust_id"), F.col("event_type").alias("app_id"),
                             F.col("ts").cast("timestamp").alias("ts"), "value")


def with_gaps(df: DataFrame, cols: list[str], key: str = "cust_id") -> DataFrame:
    """Missing values for checks: null and NaN by customer number (the tables have hardly any)."""
    return df.withColumns({c: F.when(F.col(key) % 7 == 3, F.lit(None).cast("double")).when(F.col(key) % 11 == 5, F.lit(float("nan")))
                           .otherwise(F.col(c).cast("double")) for c in cols})
