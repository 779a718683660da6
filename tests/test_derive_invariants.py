"""Price waterfall fixture, skew-safe numbering, synthetic sampling invariants."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from persona_engine.operators import derive as dv
from persona_engine.operators import marginals as mg
from persona_engine.operators import synth as sy
from persona_engine.operators.indexing import row_number_within


def test_price_waterfall_fixture(spark):
    rows = [(1, 1, "USD", 1.0, 100.0, 0.10, 0.05, "A"),     # all discounts set
            (1, 2, "USD", 1.0, 100.0, 0.0, 0.0, "N"),       # no discounts: trade-in zero → null
            (1, 3, "KRW", 1320.0, 10.0, 0.10, 0.90, "A"),   # discounts above base → floor 1.0
            ]
    df = spark.createDataFrame(rows, "order_id long, line_no long, currency string, exchange_rate double, "
                                     "price_base double, l_discount_rate double, tax_rate double, return_flag string")
    out = {r["line_no"]: r for r in dv.price_waterfall(df).collect()}
    assert out[1]["sale_amt_usd"] == 82.0 and out[1]["price_discount_tradein_usd"] == 5.0
    assert out[1]["price_discount_rewards_usd"] == 3.0 and out[1]["sellin_price"] == 65.0
    assert out[2]["price_discount_tradein_usd"] is None and out[2]["sale_amt_usd"] == 100.0
    assert out[3]["sale_amt_usd"] == 1.0 and out[3]["sale_amt_local"] == 1320.0


def test_row_number_within_matches_window_under_skew(spark):
    # one hot key holds a third of the rows
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("g"),
                                     (F.col("id") * 7919 % 3001).alias("o"))
    a = row_number_within(df, ["g"], ["o"], "rn", partitions=8).select("g", "o", "rn")
    b = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select("g", "o", "rn").collect()))
    glob = row_number_within(df, [], ["o", "g"], "rn", partitions=8).agg(F.min("rn"), F.max("rn"), F.countDistinct("rn"))
    assert tuple(glob.first()) == (1, 3000, 3000)


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([("M",), ("F",), ("M",), (None,)], "g string")
    sh = mg.categorical_shares(df, ["g"]).collect()
    assert abs(sum(r["share"] for r in sh) - 1.0) < 1e-12 and {r["value"] for r in sh} == {"M", "F"}


def test_synthetic_draws_partition_independent(spark):
    levels = spark.createDataFrame([("usr_gndr", "M", 0.0, 0.5), ("usr_gndr", "F", 0.5, 1.0), ("sa_activeness", "Active (1M)", 0.0, 1.0),
                                    ("usr_cnty_ap2", "ASIA", 0.0, 1.0)], "column string, value string, lo double, hi double")
    p = sy.SynthParams(levels=levels,
                       age=(40.0, 10.0), retention=(0.6, 0.1), ltv=(8.0, 0.5), val_p_mu=6.0,
                       flags={f: 0.3 for f in sy.CLV_FLAGS}, brand_mean=0.2, interests=[("Brand#1", 0.1)])
    a = sy.synth_population(spark, 5000, p, 42, partitions=1).orderBy("index").collect()
    b = sy.synth_population(spark, 5000, p, 42, partitions=13).orderBy("index").collect()
    assert a == b
    ages = [r["usr_age"] for r in a]
    assert min(ages) >= 18 and max(ages) <= 75
    games = [r["app_game_ratio"] for r in a]
    assert abs(sum(games) / len(games) - 2 / 7) < 0.01          # Beta(2,5) mean
    flags = [r["smartthings_flag"] for r in a]
    assert abs(sum(flags) / len(flags) - 0.3) < 0.03
