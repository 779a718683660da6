"""Registered queries: survey drafting (H1–H8) over conversation-derived requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from persona_engine.functions import fixed, prompts
from persona_engine.operators import survey as sv
from persona_engine.operators.responder import DraftStubResponder
from persona_engine.plans.oracle_views import _q, render_sql, sql_list
from persona_engine.plans.registry import register
from persona_engine.sources import conversations as cv

NL = "chr(10)"
TYPES = sql_list(cv.SURVEY_TYPES)
REASON_CASE = ("CASE " + " ".join(f"WHEN {{t}} = {_q(t)} THEN {_q(r)}" for t, r in fixed.QUESTION_TYPE_REASON)
               + " ELSE '' END")


def reason_sql(t: str) -> str:
    return REASON_CASE.replace("{t}", t)


def _tmpl_rows():
    rows, seen = [], {}
    for t, text, opts in fixed.QUESTION_TEMPLATES:
        i = seen.get(t, 0)
        seen[t] = i + 1
        rows.append((t, i, text, "|".join(opts)))
    return [(t, i, text, o, seen[t]) for t, i, text, o in rows]


TMPL_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({_q(t)}, {i}, {_q(x)}, {_q(o)}, {n})" for t, i, x, o, n in _tmpl_rows()) + \
    ") AS t(type_key, idx, text, options, n_in_type)"
TKEY = f"CASE WHEN survey_type IN ({sql_list(sv.TYPES_WITH_TEMPLATES)}) THEN survey_type ELSE '*' END"

CTES = [
    ("every", f"""SELECT 'p-' || CAST(conv_id AS VARCHAR) AS project_id, conv_id, arg_min(text, turn) AS user_prompt,
        [{TYPES}][(conv_id % {len(cv.SURVEY_TYPES)}) + 1] AS survey_type,
        count(*) AS question_count, '' AS project_purpose,
        CAST('{cv.TEMPLATE_EPOCH}' AS DATE) + CAST(conv_id % 365 AS INTEGER) AS requested_on,
        CASE WHEN conv_id % 3 = 0 THEN '' ELSE 'at least ' || CAST(count(*) AS VARCHAR) || ' turns' END AS filter_summary,
        CASE WHEN conv_id % 2 = 0 THEN 'conversations' END AS segment_source
        FROM conversations WHERE role = 'user' GROUP BY conv_id"""),
    ("tversions", "SELECT * FROM (VALUES " + ", ".join(
        f"({_q(t)}, {_q(i)}, {_q(v)}, CAST({_q(d)} AS DATE), {_q(', '.join(b))})" for t, i, v, d, b in cv.TEMPLATE_VERSIONS)
     + ") AS t(survey_type, template_id, template_version, valid_from, blocks)"),
    ("everyt", "SELECT e.*, t.template_id, t.template_version, t.blocks FROM every e ASOF LEFT JOIN tversions t "
               "ON e.survey_type = t.survey_type AND e.requested_on >= t.valid_from"),
    ("req", "SELECT * FROM everyt WHERE question_count BETWEEN 1 AND 20"),
    ("tmpl", TMPL_SQL),
    ("asst", "SELECT conv_id, arg_min(text, turn) AS answer_text FROM conversations WHERE role = 'assistant' GROUP BY conv_id"),
    ("raw", f"""SELECT r.project_id, CASE r.conv_id % 5
          WHEN 0 THEN '[' || o.o1 || ',' || o.o2 || ']'
          WHEN 1 THEN {_q(cv.PROSE_HEAD.rstrip(chr(10)))} || {NL} || '[' || o.o1 || ']' || {NL} || {_q(cv.PROSE_TAIL.lstrip(chr(10)))}
          WHEN 2 THEN '[42, {{"type": "단일선택"}}, ' || o.o1 || ']'
          WHEN 3 THEN '[{{"text": '
          ELSE '[]' END AS raw
        FROM req r JOIN asst a ON r.conv_id = a.conv_id,
        LATERAL (SELECT CAST(json_object('text', a.answer_text, 'type', '리커트척도', 'options', ['매우 그렇다', '그렇다'],
                    'rationale', '  ', 'evidence', [json_object('label', 'turn', 'value', '1')]) AS VARCHAR) AS o1,
                 CAST(json_object('text', a.answer_text || ' (2)', 'type', '주관식', 'options', ['x'],
                    'rationale', 'because') AS VARCHAR) AS o2) o"""),
    ("arr", """SELECT project_id, json_extract(CAST(b AS JSON), '$[*]') AS l FROM (
        SELECT project_id, regexp_extract(raw, '(?s)\\[.*\\]', 0) AS b FROM raw)
        WHERE b <> '' AND json_valid(b) AND json_type(CAST(b AS JSON)) = 'ARRAY'"""),
    ("items", """SELECT project_id, pos, l[pos] AS item FROM (
        SELECT project_id, l, unnest(range(1, len(l) + 1)) AS pos FROM arr)"""),
    ("parsed", f"""SELECT project_id, 'q-' || substr(md5(project_id || ':' || CAST(pos AS VARCHAR)), 1, 8) AS id,
        item->>'$.text' AS text, typ AS type,
        CASE WHEN typ = {_q(fixed.OPEN_ENDED_TYPE)} THEN ''
             ELSE coalesce(array_to_string(from_json(item->'$.options', '["VARCHAR"]'), '|'), '') END AS options,
        CAST(pos AS BIGINT) AS "order", 'draft' AS status, 'model' AS generation_source,
        coalesce(nullif(trim(item->>'$.rationale'), ''), {reason_sql('typ')}) AS ai_rationale,
        coalesce(array_to_string(list_transform(from_json(item->'$.evidence', '[{{"label": "VARCHAR", "value": "VARCHAR"}}]'),
            lambda e: concat_ws('=', e.label, e.value)), '|'), '') AS ai_evidence
        FROM (SELECT *, coalesce(item->>'$.type', {_q(fixed.DEFAULT_QUESTION_TYPE)}) AS typ FROM items
              WHERE json_type(item) = 'OBJECT' AND json_exists(item, '$.text'))"""),
]


def fallback_sql(req: str) -> str:
    return f"""SELECT r.project_id, 'q-' || substr(md5(r.project_id || ':' || CAST(r.i + 1 AS VARCHAR)), 1, 8) AS id,
        r.user_prompt || ' - ' || t.text AS text, {_q(fixed.DEFAULT_QUESTION_TYPE)} AS type, t.options,
        CAST(r.i + 1 AS BIGINT) AS "order", 'draft' AS status, 'fallback' AS generation_source,
        {_q(dict(fixed.QUESTION_TYPE_REASON)[fixed.DEFAULT_QUESTION_TYPE])} AS ai_rationale,
        'survey_type=' || r.survey_type || '|user_prompt=' || r.user_prompt AS ai_evidence
        FROM (SELECT *, {TKEY} AS type_key, unnest(range(question_count)) AS i FROM {req}) r
        JOIN tmpl t ON t.type_key = r.type_key AND t.idx = r.i % t.n_in_type"""


def with_ctes(body: str, extra=()) -> str:
    ctes = list(CTES) + list(extra)
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n" + body


def _flat(df):
    return df.withColumn("ai_evidence", sv.evidence_text(F.col("ai_evidence")))


@register("question_templates", with_ctes(f"""SELECT project_id, survey_type, {TKEY} AS template_type,
    CAST((SELECT count(*) FROM tmpl t WHERE t.type_key = {TKEY}) AS BIGINT) AS n_templates FROM req"""))
def q_templates(src):
    """H1: template set used per request (default set for unknown types)."""
    req = sv.valid_requests(cv.survey_requests(src))
    t = sv.templates(src.spark).groupBy("type_key").agg(F.count(F.lit(1)).alias("n_templates"))
    r = req.select("project_id", "survey_type", sv.template_key(F.col("survey_type")).alias("template_type"))
    return r.join(F.broadcast(t), r.template_type == t.type_key).drop("type_key")


@register("draft_questions", with_ctes(fallback_sql("req")))
def q_draft(src):
    """H2/H3: template-cycled fallback questions with repeatable ids."""
    return _flat(sv.fallback_questions(sv.valid_requests(cv.survey_requests(src))))


@register("parse_questions", with_ctes("SELECT * FROM parsed"))
def q_parse(src):
    """H4: model output → questions (greedy [..], per-item checks, open-ended → no options, order gaps)."""
    return _flat(sv.parse_questions(cv.survey_model_output(src)))


@register("question_rationale", with_ctes('SELECT project_id, "order", type, ai_rationale FROM parsed'))
def q_rationale(src):
    """H5: rationale, defaulted by question type when blank."""
    return sv.parse_questions(cv.survey_model_output(src)).select("project_id", "order", "type", "ai_rationale")


@register("question_fallback", with_ctes("SELECT * FROM parsed UNION ALL " + fallback_sql(
    "(SELECT * FROM req WHERE project_id NOT IN (SELECT project_id FROM parsed))")))
def q_fallback(src):
    """H6: parsed questions, or the fallback set when nothing valid was parsed."""
    return _flat(sv.with_fallback(sv.valid_requests(cv.survey_requests(src)), sv.parse_questions(cv.survey_model_output(src))))


SEG_CTE = ("segs", """SELECT segment AS name, count(*) AS count FROM (
    SELECT conv_id, CASE WHEN sum(length(text)) >= 3000 THEN 'heavy' WHEN sum(length(text)) >= 1000 THEN 'regular'
           ELSE 'light' END AS segment FROM conversations GROUP BY conv_id) GROUP BY segment""")


SURVEY_PROMPT_SQL = render_sql(
    prompts.SURVEY_PROMPT_TEMPLATE, question_count="question_count", purpose="coalesce(nullif(project_purpose, ''), user_prompt)",
    user_prompt="user_prompt", filter_summary=f"coalesce(nullif(filter_summary, ''), {_q(prompts.SURVEY_FILTER_DEFAULT)})",
    target_count="(SELECT coalesce(sum(count), 0) FROM segs)",
    segments=f"""coalesce((SELECT string_agg({render_sql(prompts.SURVEY_SEGMENT_LINE, name='name', count='count')}, {NL}
        ORDER BY name, count) FROM segs), {_q(prompts.SURVEY_PROMPT_NO_SEGMENTS)})""",
    survey_type="survey_type", required_blocks=f"coalesce(nullif(blocks, ''), {_q(prompts.SURVEY_PROMPT_FREE_BLOCKS)})",
    template_note=f"""CASE WHEN template_id IS NULL THEN '' ELSE {render_sql(prompts.SURVEY_TEMPLATE_NOTE, template_id='template_id',
        template_version='template_version')} END""",
    form=_q(prompts.form_example(prompts.QUESTION_FORM)), types=_q(sv.QUESTION_TYPES), open_type=_q(fixed.OPEN_ENDED_TYPE))


def _segments(src):
    return cv.sim_personas(src).groupBy(F.col("segment").alias("name")).agg(F.count(F.lit(1)).alias("count"))


@register("survey_prompt", with_ctes(f"SELECT project_id, {SURVEY_PROMPT_SQL} AS prompt FROM req", [SEG_CTE]))
def q_survey_prompt(src):
    """H7: draft prompt per request: segments, filter, and the blocks of the template valid when it was made."""
    requests = sv.with_templates(sv.valid_requests(cv.survey_requests(src)), cv.survey_templates(src))
    return sv.survey_prompt(requests, _segments(src))


METADATA_SQL = """SELECT m.project_id, m.question_count, m.generation_source, r.template_id, r.template_version, r.segment_source,
    r.question_count AS requested_count, CAST(m.question_count <> r.question_count AS BIGINT) AS count_mismatch, CAST(NULL AS VARCHAR) AS error
    FROM ({drafts}) m LEFT JOIN req r ON m.project_id = r.project_id
    UNION ALL SELECT project_id, NULL, NULL, NULL, NULL, NULL, question_count, NULL, 'question_count must be between 1 and 20'
    FROM every WHERE question_count NOT BETWEEN 1 AND 20"""


@register("draft_metadata", with_ctes(METADATA_SQL.format(drafts="""
      SELECT project_id, count(*) AS question_count, 'model' AS generation_source FROM parsed GROUP BY project_id
      UNION ALL SELECT project_id, question_count, 'fallback' FROM req WHERE project_id NOT IN (SELECT project_id FROM parsed)""")))
def q_metadata(src):
    """H8: draft metadata (count, source, template id and version, source of the segments) per project."""
    req = sv.with_templates(cv.survey_requests(src), cv.survey_templates(src))
    q = sv.with_fallback(sv.valid_requests(req), sv.parse_questions(cv.survey_model_output(src)))
    return sv.draft_metadata(q, req)


@register("request_templates", with_ctes("SELECT project_id, survey_type, CAST(requested_on AS VARCHAR) AS requested_on, template_id, "
                                         "template_version, CASE WHEN template_id IS NULL THEN NULL ELSE replace(blocks, ', ', '|') END "
                                         "AS required_blocks FROM everyt"))
def q_request_templates(src):
    """H7/H8: the template version valid for each request (as-of join)."""
    return sv.with_templates(cv.survey_requests(src), cv.survey_templates(src)).select(
        "project_id", "survey_type", "requested_on", "template_id", "template_version", "required_blocks")


DRAFTED = "question_count % 3 <> 0 AND question_count % 5 <> 1"


def _drafts(src):
    return sv.draft_surveys(cv.survey_requests(src), _segments(src), cv.survey_templates(src), DraftStubResponder)


@register("survey_drafts", with_ctes(f"""SELECT project_id, 'q-' || substr(md5(project_id || ':' || CAST(i AS VARCHAR)), 1, 8) AS id,
      'Question ' || CAST(i AS VARCHAR) || ' of ' || CAST(question_count AS VARCHAR) AS text, {_q(fixed.DEFAULT_QUESTION_TYPE)} AS type,
      'a|b' || CAST(i AS VARCHAR) AS options, CAST(i AS BIGINT) AS "order", 'draft' AS status, 'model' AS generation_source,
      'because ' || CAST(i AS VARCHAR) AS ai_rationale, '' AS ai_evidence
    FROM (SELECT *, unnest(range(1, question_count + 1)) AS i FROM req WHERE {DRAFTED})
    UNION ALL """ + fallback_sql(f"(SELECT * FROM req WHERE NOT ({DRAFTED}))")))
def q_survey_drafts(src):
    """H1–H8 as one job: the questions of every valid request, by the model or the templates."""
    return _flat(_drafts(src)[0])


@register("survey_draft_metadata", with_ctes(METADATA_SQL.format(drafts=f"""SELECT project_id, question_count,
    CASE WHEN {DRAFTED} THEN 'model' ELSE 'fallback' END AS generation_source FROM req""")))
def q_survey_draft_metadata(src):
    """H8 of that job."""
    return _drafts(src)[1]
