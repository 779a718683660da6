"""Survey drafting (H1–H8).

A draft request is a row (project_id, user_prompt, survey_type,
question_count). Fallback questions are a template join: each request is
expanded with ``explode(sequence(0, n−1))`` (n ≤ 20 by validation) and joined to
the fixed 12-row template table on (type, i mod len) — a broadcast of a table
whose size is fixed by the code. Model output is parsed with JVM-side JSON
functions: the greedy ``[...]`` block → ``array<string>`` (keeps valid items when
others are not objects) → per-item ``get_json_object``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from persona_engine.functions import fixed, prompts
from persona_engine.functions.expr import render
from persona_engine.operators.answer_store import AnswerStore
from persona_engine.operators.indexing import as_of
from persona_engine.operators.responder import run_responder

TYPES_WITH_TEMPLATES = sorted({t for t, _, _ in fixed.QUESTION_TEMPLATES if t != "*"})
QUESTION_TYPES = ", ".join(t for t, _ in fixed.QUESTION_TYPE_REASON)
EVIDENCE_SCHEMA = f"array<{prompts.form_schema(prompts.EVIDENCE_FORM)}>"


def templates(spark: SparkSession) -> DataFrame:
    """H1: template table (type_key, idx, text, options, n_in_type)."""
    rows, seen = [], {}
    for t, text, opts in fixed.QUESTION_TEMPLATES:
        i = seen.get(t, 0)
        seen[t] = i + 1
        rows.append((t, i, text, opts))
    df = spark.createDataFrame(rows, "type_key string, idx int, text string, options array<string>")
    sizes = spark.createDataFrame(list(seen.items()), "type_key string, n_in_type int")
    return df.join(sizes, "type_key")


def template_key(survey_type: F.Column) -> F.Column:
    """Unknown survey types use the default set ('*')."""
    return F.when(survey_type.isin(TYPES_WITH_TEMPLATES), survey_type).otherwise(F.lit("*"))


def type_reason(type_col: F.Column) -> F.Column:
    """H5 lookup: default rationale per question type ('' when unknown)."""
    m = F.create_map(*[x for t, r in fixed.QUESTION_TYPE_REASON for x in (F.lit(t), F.lit(r))])
    return F.coalesce(F.element_at(m, type_col), F.lit(""))


def question_id(project: F.Column, order: F.Column) -> F.Column:
    """H3: repeatable id from (project, order)."""
    return F.concat(F.lit("q-"), F.substring(F.md5(F.concat_ws(":", project, order.cast("string"))), 1, 8))


def fallback_questions(requests: DataFrame) -> DataFrame:
    """H2: n questions per request, cycling the type's templates by i mod len."""
    spark = requests.sparkSession
    t = templates(spark)
    r = requests.select("project_id", "user_prompt", "survey_type",
                        F.posexplode(F.sequence(F.lit(0), F.col("question_count") - 1)).alias("i", "_v"),
                        template_key(F.col("survey_type")).alias("type_key"))
    sizes = t.select("type_key", "n_in_type").distinct()
    r = r.join(F.broadcast(sizes), "type_key").withColumn("idx", F.col("i") % F.col("n_in_type"))
    j = r.join(F.broadcast(t.drop("n_in_type")), ["type_key", "idx"])
    qtype = F.lit(fixed.DEFAULT_QUESTION_TYPE)
    order = (F.col("i") + 1).cast("long")
    return j.select(
        "project_id",
        question_id(F.col("project_id"), order).alias("id"),
        F.concat(F.col("user_prompt"), F.lit(" - "), F.col("text")).alias("text"),
        qtype.alias("type"), F.col("options"), order.alias("order"),
        F.lit("draft").alias("status"), F.lit("fallback").alias("generation_source"),
        type_reason(qtype).alias("ai_rationale"),
        F.array(F.struct(F.lit("survey_type").alias("label"), F.col("survey_type").alias("value")),
                F.struct(F.lit("user_prompt").alias("label"), F.col("user_prompt").alias("value"))).alias("ai_evidence"),
    )


def parse_questions(raw: DataFrame, raw_col: str = "raw") -> DataFrame:
    """H4/H5: model output → question rows; order counts every parsed item (gaps kept)."""
    block = F.regexp_extract(F.col(raw_col), r"(?s)\[.*\]", 0)
    items = F.from_json(F.nullif(block, F.lit("")), "array<string>")
    x = raw.select("project_id", F.posexplode(items).alias("pos", "item"))
    keys = F.json_object_keys(F.col("item"))
    x = x.where(F.coalesce(F.array_contains(keys, "text"), F.lit(False)))
    qtype = F.coalesce(F.get_json_object("item", "$.type"), F.lit(fixed.DEFAULT_QUESTION_TYPE))
    opts = F.coalesce(F.from_json(F.get_json_object("item", "$.options"), "array<string>"), F.array().cast("array<string>"))
    rationale = F.coalesce(F.nullif(F.trim(F.get_json_object("item", "$.rationale")), F.lit("")), type_reason(qtype))
    ev = F.coalesce(F.from_json(F.get_json_object("item", "$.evidence"), EVIDENCE_SCHEMA),
                    F.array().cast(EVIDENCE_SCHEMA))
    order = (F.col("pos") + 1).cast("long")
    return x.select(
        "project_id", question_id(F.col("project_id"), order).alias("id"),
        F.get_json_object("item", "$.text").alias("text"), qtype.alias("type"),
        F.when(qtype == fixed.OPEN_ENDED_TYPE, F.array().cast("array<string>")).otherwise(opts).alias("options"),
        order.alias("order"), F.lit("draft").alias("status"), F.lit("model").alias("generation_source"),
        rationale.alias("ai_rationale"), ev.alias("ai_evidence"),
    )


QUESTION_COUNT = (1, 20)       # of a draft request


def valid_requests(requests: DataFrame) -> DataFrame:
    """Requests whose question count a draft may have; the others are rejected, not clamped."""
    return requests.where(F.col("question_count").between(*QUESTION_COUNT))


def rejected_requests(requests: DataFrame) -> DataFrame:
    """One error row per request outside the bounds (a missing count too)."""
    lo, hi = QUESTION_COUNT
    return requests.where(~F.coalesce(F.col("question_count").between(lo, hi), F.lit(False))).select(
        "project_id", F.col("question_count").cast("long").alias("requested_count"),
        F.lit(f"question_count must be between {lo} and {hi}").alias("error"))


def with_fallback(requests: DataFrame, parsed: DataFrame) -> DataFrame:
    """H6: projects with no valid parsed question get the fallback set."""
    missing = requests.join(parsed.select("project_id").distinct(), "project_id", "left_anti")
    return parsed.unionByName(fallback_questions(missing))


def evidence_text(c: F.Column) -> F.Column:
    return F.array_join(F.transform(c, lambda e: F.concat_ws("=", e["label"], e["value"])), "|")


TEMPLATE_FIELDS = ["template_id", "template_version", "segment_source"]


def with_templates(requests: DataFrame, versions: DataFrame) -> DataFrame:
    """Requests with template_id, template_version and required_blocks of the version valid on ``requested_on`` for their survey type."""
    return as_of(requests, versions, "survey_type", "requested_on")


def draft_metadata(questions: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """H8: count, source and template fields per project; with the requests, also the
    requested count and whether the drafted count differs from it (the model's count
    is not enforced, Q11), and what template and source of segments the request had;
    rejected requests are rows with an error and no draft."""
    m = questions.groupBy("project_id").agg(
        F.count(F.lit(1)).alias("question_count"),
        F.first("generation_source").alias("generation_source"))
    if requests is None:
        return m.withColumns({c: F.lit(None).cast("string") for c in TEMPLATE_FIELDS})
    fields = [F.col(c) if c in requests.columns else F.lit(None).cast("string").alias(c) for c in TEMPLATE_FIELDS]
    r = requests.select("project_id", F.col("question_count").cast("long").alias("requested_count"), *fields)
    m = m.join(r, "project_id", "left").withColumns({
        "count_mismatch": (F.col("question_count") != F.col("requested_count")).cast("long"), "error": F.lit(None).cast("string")})
    return m.unionByName(rejected_requests(requests), allowMissingColumns=True)


def segments_text(segments: DataFrame) -> tuple[str, int]:
    """Segment lines and target count for the prompt — one row per segment
    (bounded by the number of segments), collected once as a fitted value."""
    row = segments.agg(F.sort_array(F.collect_list(F.struct("name", "count"))).alias("segs"),
                       F.sum("count").alias("target")).first()
    segs = row["segs"] or []
    text = "\n".join(prompts.SURVEY_SEGMENT_LINE.format(name=s["name"], count=s["count"]) for s in segs)
    return text or prompts.SURVEY_PROMPT_NO_SEGMENTS, int(row["target"] or 0)


def survey_prompt(requests: DataFrame, segments: DataFrame) -> DataFrame:
    """H7: draft prompt per request (projection with the segment block as a literal).

    Filter summary, required blocks and template come from the request's columns of these
    names where it has them (see ``with_templates``); missing or empty ones have defaults.
    """
    seg_text, target = segments_text(segments)
    has = lambda c: c in requests.columns
    purpose = F.coalesce(F.nullif(F.col("project_purpose"), F.lit("")), F.col("user_prompt"))
    filters = F.coalesce(F.nullif(F.col("filter_summary"), F.lit("")), F.lit(prompts.SURVEY_FILTER_DEFAULT)) if has("filter_summary") \
        else prompts.SURVEY_FILTER_DEFAULT
    blocks = F.coalesce(F.nullif(F.array_join("required_blocks", ", "), F.lit("")), F.lit(prompts.SURVEY_PROMPT_FREE_BLOCKS)) \
        if has("required_blocks") else prompts.SURVEY_PROMPT_FREE_BLOCKS
    note = F.coalesce(render(prompts.SURVEY_TEMPLATE_NOTE, template_id=F.col("template_id"), template_version=F.col("template_version")),
                      F.lit("")) if has("template_id") else ""
    text = render(prompts.SURVEY_PROMPT_TEMPLATE, question_count=F.col("question_count"), purpose=purpose,
                  user_prompt=F.col("user_prompt"), filter_summary=filters, target_count=target, segments=seg_text,
                  survey_type=F.col("survey_type"), required_blocks=blocks, template_note=note,
                  form=prompts.form_example(prompts.QUESTION_FORM), types=QUESTION_TYPES, open_type=fixed.OPEN_ENDED_TYPE)
    return requests.select("project_id", text.alias("prompt"))


def draft_surveys(requests: DataFrame, segments: DataFrame, versions: DataFrame, factory, store: AnswerStore | None = None,
                  **calls) -> tuple[DataFrame, DataFrame]:
    """H1–H8 in one job: templates, prompts, model, parse, fallback; returns (questions, metadata).

    With a ``store``, a job run again calls the model only for what is open.
    """
    r = with_templates(requests, versions)
    valid = valid_requests(r)
    asked = survey_prompt(valid, segments)
    raw = store.answer(asked, ["project_id"], "prompt", factory, **calls) if store else run_responder(asked, ["project_id"], "prompt", factory)
    questions = with_fallback(valid, parse_questions(raw))
    return questions, draft_metadata(questions, r)
