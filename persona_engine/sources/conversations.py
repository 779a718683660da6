"""Survey / simulation inputs derived from the ``conversations`` table.

A conversation plays one project and one persona: user turns are the survey
questions, the following assistant turns the persona's answers. The model
outputs used to exercise the parsers are composed around the conversation text
(clean JSON, prose around JSON, non-object items, broken JSON, empty array) —
invented test stand-ins, not original behaviour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from persona_engine.operators.survey import valid_requests
from persona_engine.sources.tables import Sources

SURVEY_TYPES = ["concept", "ad", "usage"]          # 'usage' has no templates → default set
TEMPLATE_EPOCH = "2024-01-01"
TEMPLATE_VERSIONS = [
    ("concept", "t-concept", "1", "2024-01-01", ["screening", "concept"]),
    ("concept", "t-concept", "2", "2024-05-01", ["screening", "concept", "price"]),
    ("ad", "t-ad", "1", "2024-01-01", ["recall"]),
    ("ad", "t-ad", "2", "2024-03-15", ["recall", "liking"]),
    ("ad", "t-ad-open", "1", "2024-09-01", []),
    ("usage", "t-usage", "1", "2024-02-01", ["habits"]),      # none is valid in January
]
PROSE_HEAD = "Sure, here is the list:\n"
PROSE_TAIL = "\nHope it helps."


def survey_requests(src: Sources) -> DataFrame:
    """One draft request per conversation: first user turn = prompt, #user turns = count; its date, filter and
    source of segments are told by the conversation's number."""
    u = (src.conversations.where(F.col("role") == "user").groupBy("conv_id")
         .agg(F.min_by("text", "turn").alias("user_prompt"), F.count(F.lit(1)).alias("n_user")))
    types = F.array(*[F.lit(t) for t in SURVEY_TYPES])
    return u.select(
        F.concat(F.lit("p-"), F.col("conv_id").cast("string")).alias("project_id"), "conv_id", "user_prompt",
        F.element_at(types, (F.pmod(F.col("conv_id"), F.lit(len(SURVEY_TYPES))) + 1).cast("int")).alias("survey_type"),
        F.col("n_user").cast("long").alias("question_count"),
        F.lit("").alias("project_purpose"),
        F.date_add(F.lit(TEMPLATE_EPOCH).cast("date"), F.pmod(F.col("conv_id"), F.lit(365)).cast("int")).alias("requested_on"),
        F.when(F.pmod(F.col("conv_id"), F.lit(3)) == 0, F.lit("")).otherwise(F.concat(F.lit("at least "), F.col("n_user").cast("string"), F.lit(" turns")))
        .alias("filter_summary"),
        F.when(F.pmod(F.col("conv_id"), F.lit(2)) == 0, F.lit("conversations")).alias("segment_source"))


def survey_templates(src: Sources) -> DataFrame:
    """Versions of survey templates with the date from which each is valid."""
    return src.spark.createDataFrame(TEMPLATE_VERSIONS, "survey_type string, template_id string, template_version string, "
                                     "valid_from string, required_blocks array<string>").withColumn("valid_from", F.col("valid_from").cast("date"))


def first_assistant(src: Sources) -> DataFrame:
    return (src.conversations.where(F.col("role") == "assistant").groupBy("conv_id")
            .agg(F.min_by("text", "turn").alias("answer_text")))


def survey_model_output(src: Sources) -> DataFrame:
    """Raw model output per project, five shapes by conversation."""
    a = first_assistant(src)
    req = valid_requests(survey_requests(src)).select("project_id", "conv_id")     # a rejected request reaches no model
    j = req.join(a, "conv_id")
    t = F.col("answer_text")
    obj1 = F.to_json(F.struct(t.alias("text"), F.lit("리커트척도").alias("type"),
                              F.array(F.lit("매우 그렇다"), F.lit("그렇다")).alias("options"),
                              F.lit("  ").alias("rationale"),
                              F.array(F.struct(F.lit("turn").alias("label"), F.lit("1").alias("value"))).alias("evidence")))
    obj2 = F.to_json(F.struct(F.concat(t, F.lit(" (2)")).alias("text"), F.lit("주관식").alias("type"),
                              F.array(F.lit("x")).alias("options"), F.lit("because").alias("rationale")))
    v = F.pmod(F.col("conv_id"), F.lit(5))
    raw = (F.when(v == 0, F.concat(F.lit("["), obj1, F.lit(","), obj2, F.lit("]")))
           .when(v == 1, F.concat(F.lit(PROSE_HEAD + "["), obj1, F.lit("]" + PROSE_TAIL)))
           .when(v == 2, F.concat(F.lit('[42, {"type": "단일선택"}, '), obj1, F.lit("]")))
           .when(v == 3, F.lit('[{"text": '))
           .otherwise(F.lit("[]")))
    return j.select("project_id", raw.alias("raw"))


def sim_personas(src: Sources) -> DataFrame:
    """One persona per conversation; segment from the conversation's total length."""
    c = src.conversations.groupBy("conv_id").agg(F.sum(F.length("text")).alias("n_chars"))
    seg = F.when(F.col("n_chars") >= 3000, "heavy").when(F.col("n_chars") >= 1000, "regular").otherwise("light")
    return c.select(F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("persona_id"), "conv_id",
                    F.concat(F.lit("Persona "), F.col("conv_id").cast("string")).alias("persona_name"),
                    seg.alias("segment"))


def sim_questions(src: Sources) -> DataFrame:
    """User turns as questions: id 'q<turn>', single-choice, no options."""
    return src.conversations.where(F.col("role") == "user").select(
        "conv_id", "turn", F.concat(F.lit("q"), F.col("turn").cast("string")).alias("question_id"),
        F.col("text").alias("question_text"))


def sim_answer_pairs(src: Sources) -> DataFrame:
    """(user turn, next turn if it is the assistant's) pairs."""
    c = src.conversations
    q = c.where(F.col("role") == "user").select("conv_id", F.col("turn").alias("q_turn"))
    a = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("q_turn"),
                                                      F.col("text").alias("answer"))
    return q.join(a, ["conv_id", "q_turn"])


def sim_model_output(src: Sources) -> DataFrame:
    """Raw responder output per persona: a JSON answer array (broken for every 4th conversation)."""
    p = sim_answer_pairs(src)
    ans = F.struct(
        F.col("q_turn").alias("k"),
        F.concat(F.lit("q"), F.col("q_turn").cast("string")).alias("question_id"),
        F.element_at(F.split(F.trim(F.col("answer")), " "), 1).alias("selected_option"),
        F.col("answer").alias("rationale"),
        F.array(F.concat(F.lit("step:"), F.col("q_turn").cast("string")),
                F.concat(F.lit("len:"), F.length("answer").cast("string"))).alias("cot"),
        (F.lit(85.0) + (F.length("answer") % 15).cast("double")).alias("integrity_score"))
    g = p.groupBy("conv_id").agg(F.sort_array(F.collect_list(ans)).alias("a"))
    arr = F.to_json(F.transform("a", lambda x: x.dropFields("k")))
    raw = F.when(F.pmod(F.col("conv_id"), F.lit(4)) == 3, F.concat(F.lit("[{\"question_id\": "), F.lit("")))\
        .otherwise(F.concat(F.lit("Answers:\n"), arr, F.lit("\nend")))
    return g.select("conv_id", raw.alias("raw"))
