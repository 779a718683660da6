"""Literal-input checks of the expression helpers."""

import math

from pyspark.sql import functions as F

from persona_engine.functions import expr as X


def rows(df, col):
    return [r[col] for r in df.collect()]


def test_half_even_rounding_matches_numpy_style(spark):
    vals = [0.285, 1.005, 2.675, 0.125, 2.5, -0.7]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = rows(df.select(X.rnd("x", 2).alias("r")), "r")
    assert out == [0.28, 1.0, 2.68, 0.12, 2.5, -0.7]
    assert rows(spark.createDataFrame([(0.25,), (0.35,)], "x double").select(X.rnd("x", 1).alias("r")), "r") == [0.2, 0.4]


def test_exact_half_even_integer_division(spark):
    df = spark.createDataFrame([(250,), (350,), (251,), (-250,), (None,)], "x long")
    assert rows(df.select(X.half_even_div("x", 100).alias("r")), "r") == [2, 4, 3, -2, None]


def test_clip_one_and_two_sided(spark):
    df = spark.createDataFrame([(-5.0,), (0.5,), (7.0,)], "x double")
    assert rows(df.select(X.clip("x", 0.0, 1.0).alias("r")), "r") == [0.0, 0.5, 1.0]
    assert rows(df.select(X.clip("x", 1.0).alias("r")), "r") == [1.0, 1.0, 7.0]


def test_safe_default_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (2.5,)], "x double")
    assert rows(df.select(X.safe_default("x", 9.0).alias("r")), "r") == [9.0, 9.0, 2.5]


def test_parse_list_text_both_reprs(spark):
    df = spark.createDataFrame([("['Gamer', 'Premium Buyer']",), ("[np.str_('Gamer')]",), ("[]",), (None,)], "v string")
    assert rows(df.select(X.parse_list_text("v").alias("a")), "a") == [["Gamer", "Premium Buyer"], ["Gamer"], [], None]


def test_age_band_right_closed_edges(spark):
    ages = [0, 18, 29, 30, 39, 59, 60, 100, 101, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    assert rows(df.select(X.age_band("age").alias("b")), "b") == [None, "20s", "20s", "30s", "30s", "50s", "60s+",
                                                                  "60s+", None, None]


def test_activeness_prefix(spark):
    df = spark.createDataFrame([("Active (1M)",), ("Inactive",), (None,)], "s string")
    assert rows(df.select(X.starts_with_active("s").alias("f")), "f") == [1, 0, 0]


def test_python_float_text(spark):
    df = spark.createDataFrame([(3.5,), (12.0,), (12345678.0,), (0.0,)], "x double")
    assert rows(df.select(X.py_float_text("x").alias("t")), "t") == ["3.5", "12.0", "12345678.0", "0.0"]


def test_hash_unit_is_deterministic_and_in_range(spark):
    a = spark.range(1, 2001).select(X.hash_unit(42, "s", "id").alias("u"))
    b = spark.range(1, 2001).repartition(16).select("id", X.hash_unit(42, "s", "id").alias("u")).orderBy("id")
    ua, ub = rows(a, "u"), rows(b, "u")
    assert ua == ub
    assert all(0.0 < u < 1.0 for u in ua)
    assert abs(sum(ua) / len(ua) - 0.5) < 0.03


def test_box_muller_moments(spark):
    z = rows(spark.range(1, 20001).select(X.std_normal(7, "z", "id").alias("z")), "z")
    m = sum(z) / len(z)
    v = sum((x - m) ** 2 for x in z) / len(z)
    assert abs(m) < 0.03 and abs(math.sqrt(v) - 1.0) < 0.03


def test_normalize_names(spark):
    df = spark.createDataFrame([("ART & CUSTOMIZED",), ("SMART HOME & IOT",)], "s string")
    assert rows(df.select(X.normalize_category("s").alias("c")), "c") == ["ART_AND_CUSTOMIZED", "SMART_HOME_AND_IOT"]
    assert rows(df.select(X.normalize_feature("s").alias("c")), "c") == ["art_customized", "smart_home_iot"]
    _ = F


def test_age_truncates_toward_zero_then_clips(spark):
    from persona_engine.operators.synth import truncated_int
    df = spark.createDataFrame([(2.7,), (-2.7,), (17.9,), (80.2,)], "x double")
    out = rows(df.select(X.clip(truncated_int(F.col("x")), 18, 75).alias("a")), "a")
    assert out == [18, 18, 18, 75]
    assert rows(df.select(truncated_int(F.col("x")).alias("t")), "t") == [2, -2, 17, 80]


def test_clip_keeps_missing_values_missing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (7.0,), (300.0,)], "x double")
    assert rows(df.select(X.clip("x", 50.0, 200.0).alias("r")), "r") == [None, None, 50.0, 200.0]


def test_options_are_valid_json(spark):
    import json

    from persona_engine.operators.responses import options_json
    df = spark.createDataFrame([(['say "hi"', "b\\c", "line\nbreak"],)], "o array<string>")
    assert json.loads(df.select(options_json(F.col("o")).alias("j")).first()["j"]) == ['say "hi"', "b\\c", "line\nbreak"]
