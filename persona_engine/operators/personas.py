"""Cluster statistics and persona profiles.

One ``groupBy(persona_cluster)`` computes every cluster's statistics in a
single pass (the per-cluster filter loop of a driver program disappears); the
persona is then a projection over the k-row statistics table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.functions.expr import clip, hash_order, py_float_text, rnd, safe_default

# (output name, source column, digits)
MEAN_STATS = [
    ("avg_age", "usr_age", 1),
    ("avg_ltv", "ltv_r", 0),
    ("avg_retention", "retention_score", 3),
    ("avg_purchase_count", "pchs_cnt", 1),
    ("avg_premium_count", "premium_cnt", 1),
    ("repurchase_rate", "cum_repchs_flg", 2),
    ("health_app_rate", "samsunghealth_flag", 2),
    ("wallet_rate", "samsungwallet_flag", 2),
    ("smartthings_rate", "smartthings_flag", 2),
    ("avg_game_ratio", "app_game_ratio", 2),
    ("avg_social_ratio", "app_social_ratio", 2),
    ("avg_daily_usage_min", "avg_daily_usage_min", 0),
]


def cluster_mode(c: str, present: bool = True) -> F.Column:
    """Most frequent value, smallest on ties, 'Unknown' when none."""
    if not present:
        return F.lit(fixed.UNKNOWN)
    return F.coalesce(F.mode(F.col(c), True).cast("string"), F.lit(fixed.UNKNOWN))


def gender_ratio(c: str = "usr_gndr", present: bool = True) -> F.Column:
    """Share of 'M' (null counts as not-M), rounded to 2; 0.5 when the column is absent."""
    if not present:
        return F.lit(0.5)
    return safe_default(rnd(F.avg(F.coalesce((F.col(c) == "M").cast("double"), F.lit(0.0))), 2), 0.5)


def cluster_stats(df: DataFrame, label: str = "persona_cluster") -> DataFrame:
    """Size, 12 rounded means, male ratio and top region per cluster (missing column → 0.0)."""
    cols = set(df.columns)
    aggs = [F.count(F.lit(1)).alias("size")]
    for name, src, d in MEAN_STATS:
        aggs.append(safe_default(rnd(F.avg(F.col(src).cast("double")), d)).alias(name)
                    if src in cols else F.lit(0.0).alias(name))
    aggs.append(gender_ratio(present="usr_gndr" in cols).alias("gender_ratio_male"))
    aggs.append(cluster_mode("usr_cnty_ap2", "usr_cnty_ap2" in cols).alias("top_region"))
    return df.groupBy(F.col(label).cast("long").alias("cluster_id")).agg(*aggs)


def _arr(*xs):
    return F.array(*[F.lit(x) if isinstance(x, str) else x for x in xs])


def persona_rules(stats: DataFrame) -> DataFrame:
    """Name, channel, keywords (first matching rule wins) and gender hint."""
    game = F.col("avg_game_ratio") >= fixed.GAME_RATIO_THRESHOLD
    home = F.col("smartthings_rate") >= fixed.SMARTTHINGS_THRESHOLD
    g, h, b = fixed.PERSONA_GAMER, fixed.PERSONA_SMART_HOME, fixed.PERSONA_BALANCED

    def pick(i):
        return F.when(game, F.lit(g[i])).when(home, F.lit(h[i])).otherwise(F.lit(b[i]))

    kw = F.when(game, _arr(*g[3])).when(home, _arr(*h[3])).otherwise(_arr(*b[3]))
    m = F.col("gender_ratio_male")
    hint = (F.when(m >= fixed.MALE_HIGH, fixed.GENDER_HINT_MALE)
            .when(m <= fixed.MALE_LOW, fixed.GENDER_HINT_FEMALE).otherwise(fixed.GENDER_HINT_BALANCED))
    return stats.withColumns({"persona_name": pick(0), "persona_name_en": pick(1),
                              "preferred_channel": pick(2), "keywords": kw, "gender_hint": hint})


def persona_scores(stats: DataFrame) -> DataFrame:
    """Intent, attitude, acceptance (clamped 0–100), future value, churn risk; 1 decimal."""
    ltv, ret, rep = F.col("avg_ltv"), F.col("avg_retention"), F.col("repurchase_rate")
    return stats.withColumns({
        "purchase_intent": rnd(clip(ltv / 10000.0, 0.0, 100.0), 1),
        "brand_attitude": rnd(clip(ret * 100.0, 0.0, 100.0), 1),
        "marketing_acceptance": rnd(clip(rep * 100.0, 0.0, 100.0), 1),
        "future_value": rnd(F.least(ltv / 200.0, F.lit(100.0)), 1),
        "churn_risk": rnd((F.lit(1.0) - ret) * 100.0, 1),
    })


def persona_age(stats: DataFrame) -> DataFrame:
    """age_value = round(avg_age); range ±5 bounded to [18, 70]."""
    age = F.bround(F.col("avg_age"), 0).cast("long")
    return stats.withColumns({
        "age_value": age,
        "age_range": F.concat(F.greatest(F.lit(fixed.AGE_FLOOR), age - fixed.AGE_HALF_WIDTH).cast("string"),
                              F.lit("-"),
                              F.least(F.lit(fixed.AGE_CEIL), age + fixed.AGE_HALF_WIDTH).cast("string")),
    })


def persona_text(df: DataFrame) -> DataFrame:
    """Description, key characteristics, interests and segment tags."""
    c, i = fixed.CHARACTERISTIC_LABELS, fixed.INTEREST_LABELS
    return df.withColumns({
        "description": F.format_string(fixed.DESCRIPTION_TEMPLATE, F.col("top_region"), F.col("gender_hint"),
                                       F.col("age_value").cast("string")),
        "key_characteristics": F.array(
            F.concat(F.lit(c[0]), py_float_text("avg_purchase_count")),
            F.concat(F.lit(c[1]), py_float_text("avg_premium_count")),
            F.concat(F.lit(c[2]), py_float_text("avg_daily_usage_min"), F.lit(fixed.CHARACTERISTIC_SUFFIX_MINUTES))),
        "interests": F.array(
            F.concat(F.lit(i[0]), py_float_text("avg_game_ratio")),
            F.concat(F.lit(i[1]), py_float_text("avg_social_ratio")),
            F.concat(F.lit(i[2]), py_float_text("health_app_rate"))),
        "segment_tags": F.array(F.col("top_region"), F.col("preferred_channel"),
                                F.concat(F.lit("cluster-"), F.col("cluster_id").cast("string"))),
    })


PERSONA_COLUMNS = ["cluster_id", "persona_name", "persona_name_en", "age_range", "description",
                   "key_characteristics", "purchase_intent", "brand_attitude", "marketing_acceptance",
                   "future_value", "preferred_channel", "keywords", "interests", "segment_tags",
                   "churn_risk", "size"]


def personas(stats: DataFrame) -> DataFrame:
    """The full rule-based persona row per cluster."""
    out = persona_text(persona_age(persona_scores(persona_rules(stats))))
    return out.select(*PERSONA_COLUMNS)


def cluster_sample(df: DataFrame, n: int = 3, seed: int = 42, label: str = "persona_cluster",
                   id_col: str = "cust_id") -> DataFrame:
    """Seeded sample of ≤ n rows per cluster.

    ``row_number() ≤ n`` is planned as a WindowGroupLimit: each task keeps only
    its n best rows per cluster before the shuffle, so a huge cluster costs the
    same as a small one.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(label).orderBy(hash_order(seed, "sample", id_col), id_col)
    return df.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= n)


def fill_by_type(df: DataFrame) -> DataFrame:
    """Double columns null → 0.0, string columns null → ''."""
    return df.na.fill(0.0).na.fill("")


def rows_to_json(df: DataFrame, group: str, order: str, cols: list[str] | None = None) -> DataFrame:
    """Each row → JSON record; records collected per group (bounded groups only, e.g. D2 samples)."""
    rec = F.to_json(F.struct(*[F.col(c) for c in (cols or df.columns)]))
    return (df.select(group, order, rec.alias("record"))
            .groupBy(group).agg(F.sort_array(F.collect_list(F.struct(order, "record"))).alias("_r"))
            .select(group, F.transform("_r", lambda x: x["record"]).alias("records")))


PROFILE_FIELDS = ["cluster_id", "size", "avg_age", "gender_ratio_male", "avg_ltv", "avg_retention",
                  "avg_purchase_count", "avg_premium_count", "repurchase_rate", "health_app_rate", "wallet_rate",
                  "smartthings_rate", "avg_game_ratio", "avg_social_ratio", "avg_daily_usage_min", "top_region"]
INT_FIELDS = {"cluster_id", "size"}


def json_text(c) -> F.Column:
    """JSON string literal of a text column: to_json of a one-entry list without its brackets."""
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", "")


def stats_json(df: DataFrame) -> F.Column:
    """The statistics row as indented JSON text (2-space indent, Python float text)."""
    parts = []
    for f in PROFILE_FIELDS:
        if f in INT_FIELDS:
            v = F.col(f).cast("string")
        elif f == "top_region":
            v = json_text(f)
        else:
            v = py_float_text(f)
        parts.append(F.concat(F.lit(f'  "{f}": '), v))
    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *parts), F.lit("\n}"))


def profile_prompt(stats: DataFrame) -> DataFrame:
    """Parameterised profile prompt per cluster (statistics JSON + target scores)."""
    sc = persona_scores(stats)
    body = F.concat(
        F.lit("Cluster statistics:\n"), stats_json(sc),
        F.lit("\n\nReturn one JSON object with persona_name, persona_name_en, age_range, description, "
              "key_characteristics, preferred_channel, keywords, interests, segment_tags and these values: "
              "cluster_id="), F.col("cluster_id").cast("string"),
        F.lit(", purchase_intent="), py_float_text("purchase_intent"),
        F.lit(", brand_attitude="), py_float_text("brand_attitude"),
        F.lit(", marketing_acceptance="), py_float_text("marketing_acceptance"),
        F.lit(", future_value="), py_float_text("future_value"),
        F.lit(", churn_risk="), py_float_text("churn_risk"),
        F.lit(", size="), F.col("size").cast("string"))
    return sc.select("cluster_id", body.alias("prompt"))


PROFILE_SCHEMA = ("struct<persona_name:string,persona_name_en:string,age_range:string,description:string,"
                  "key_characteristics:array<string>,preferred_channel:string,keywords:array<string>,"
                  "interests:array<string>,segment_tags:array<string>>")
STORY_SCHEMA = "array<struct<index:long,name:string,job:string,personality:string,samsung_experience:string>>"


def profile_via_responder(stats: DataFrame, factory) -> DataFrame:
    """Model profile when the responder returns valid JSON, else the rule-based persona."""
    from persona_engine.operators.responder import run_responder
    prompts = profile_prompt(stats)
    out = run_responder(prompts, ["cluster_id"], "prompt", factory)
    parsed = out.select("cluster_id", "error", F.from_json(F.regexp_extract("raw", r"(?s)\{.*\}", 0),
                                                           PROFILE_SCHEMA).alias("m"))
    base = personas(stats).join(parsed, "cluster_id", "left")
    ok = F.col("m.persona_name").isNotNull()
    # a field that the model left out keeps the rule-based value
    cols = {c: F.when(ok, F.coalesce(F.col(f"m.{c}"), F.col(c))).otherwise(F.col(c)) for c in
            ["persona_name", "persona_name_en", "age_range", "description", "key_characteristics",
             "preferred_channel", "keywords", "interests", "segment_tags"]}
    return base.withColumns(cols).withColumn("source", F.when(ok, "model").otherwise("fallback")).drop("m")


def individual_stories(samples: DataFrame, factory, cols: list[str]) -> DataFrame:
    """≤3 sampled customers per cluster → story prompt → parsed stories (empty on failure)."""
    from persona_engine.operators.responder import run_responder
    recs = rows_to_json(fill_by_type(samples.select("persona_cluster", "sample_rank", *cols)),
                        "persona_cluster", "sample_rank", cols)
    prompts = recs.select(F.col("persona_cluster").alias("cluster_id"),
                          F.concat(F.lit("Customer rows:\n["), F.array_join("records", ",\n"),
                                   F.lit("]\nReturn a JSON array of {index, name, job, personality, "
                                         "samsung_experience}.")).alias("prompt"))
    out = run_responder(prompts, ["cluster_id"], "prompt", factory)
    stories = F.coalesce(F.from_json(F.regexp_extract("raw", r"(?s)\[.*\]", 0), STORY_SCHEMA),
                         F.array().cast(STORY_SCHEMA))
    return out.select("cluster_id", stories.alias("individual_stories"), "error")
