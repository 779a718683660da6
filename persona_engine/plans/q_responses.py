"""Registered queries: persona responses (I1–I8) over conversation-derived personas."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import functions as F

from persona_engine.functions import fixed, prompts
from persona_engine.operators import responder as rp
from persona_engine.operators import responses as rs
from persona_engine.operators.answer_store import AnswerStore
from persona_engine.plans.oracle_views import _q, render_sql
from persona_engine.plans.registry import register
from persona_engine.session import ensure_checkpoint_dir
from persona_engine.sources import conversations as cv

BATCH = fixed.DEFAULT_BATCH_SIZE


def sim_questions(src):
    q = cv.sim_questions(src)
    return q.select("conv_id", F.col("turn").alias("q_order"), "question_id",
                    F.lit(fixed.DEFAULT_QUESTION_TYPE).alias("question_type"), "question_text",
                    F.array().cast("array<string>").alias("options"))


def sim_parsed(src):
    personas = cv.sim_personas(src)
    raw = cv.sim_model_output(src)
    return rs.parse_answers(personas.join(raw, "conv_id", "left"))


SEG = """CASE WHEN sum(length(text)) >= 3000 THEN 'heavy' WHEN sum(length(text)) >= 1000 THEN 'regular' ELSE 'light' END"""
CTES = [
    ("pers", f"""SELECT 'conv-' || CAST(conv_id AS VARCHAR) AS persona_id, conv_id,
        'Persona ' || CAST(conv_id AS VARCHAR) AS persona_name, {SEG} AS segment FROM conversations GROUP BY conv_id"""),
    ("qs", f"""SELECT conv_id, count(*) AS n_questions, string_agg({render_sql(prompts.SIMULATION_QUESTION_LINE, i='rn',
        id="'q' || CAST(turn AS VARCHAR)", type=_q(fixed.DEFAULT_QUESTION_TYPE), text='text', options="'[]'")},
        chr(10) ORDER BY turn) AS questions_text
        FROM (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn
              FROM conversations WHERE role = 'user') GROUP BY conv_id"""),
    ("pairs", """SELECT u.conv_id, u.turn AS q_turn, a.text AS answer FROM conversations u
        JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
        WHERE u.role = 'user'"""),
    ("simraw", """SELECT conv_id, CASE WHEN conv_id % 4 = 3 THEN '[{"question_id": '
        ELSE 'Answers:' || chr(10) || CAST(to_json(list({'question_id': 'q' || CAST(q_turn AS VARCHAR),
            'selected_option': string_split(trim(answer), ' ')[1], 'rationale': answer,
            'cot': ['step:' || CAST(q_turn AS VARCHAR), 'len:' || CAST(length(answer) AS VARCHAR)],
            'integrity_score': 85.0 + CAST(length(answer) % 15 AS DOUBLE)} ORDER BY q_turn)) AS VARCHAR)
            || chr(10) || 'end' END AS raw
        FROM pairs GROUP BY conv_id"""),
    ("pa", """SELECT p.persona_id, p.conv_id, p.persona_name, p.segment, r.raw,
        CASE WHEN r.b <> '' AND json_valid(r.b) THEN from_json(r.b, '[{"question_id": "VARCHAR",
            "selected_option": "VARCHAR", "rationale": "VARCHAR", "cot": ["VARCHAR"], "integrity_score": "DOUBLE"}]')
        END AS answers
        FROM pers p LEFT JOIN (SELECT conv_id, raw, regexp_extract(raw, '(?s)\\[.*\\]', 0) AS b FROM simraw) r
        ON p.conv_id = r.conv_id"""),
    ("ev", f"""SELECT persona_id, CASE WHEN coalesce(len(answers), 0) > 0 THEN 'result' ELSE 'error' END AS type,
        persona_name, segment, CAST(coalesce(len(answers), 0) AS BIGINT) AS n_answers,
        CASE WHEN coalesce(len(answers), 0) > 0 THEN NULL
             ELSE coalesce(nullif(raw, ''), {_q(fixed.PARSE_FAILURE_MESSAGE)}) END AS message FROM pa"""),
]


def with_ctes(body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in CTES) + "\n" + body


PROMPT_SQL = with_ctes(f"""SELECT p.conv_id, p.persona_id, q.n_questions, {render_sql(
    prompts.SIMULATION_PROMPT_TEMPLATE, name='p.persona_name', age="''", gender="''", occupation="''",
    occupation_category="''", segment='p.segment', region="''", interests="''", keywords="''",
    preferred_channel="''", buy_channel="''", purchase_history="''", purchase_intent="'0'", brand_attitude="'0'",
    marketing_acceptance="'0'", profile="''", project_name="''", project_purpose="''",
    questions='q.questions_text', n_questions='q.n_questions', form=_q(prompts.form_example(prompts.ANSWER_FORM)))} AS prompt
    FROM pers p JOIN qs q ON p.conv_id = q.conv_id""")


@register("response_prompts", PROMPT_SQL)
def q_prompts(src):
    """Persona × ordered question list → prompt text."""
    return rs.build_prompts(cv.sim_personas(src), sim_questions(src), "conv_id")


@register("batch_inference", with_ctes("""SELECT p.persona_id, 'result' AS type, p.persona_name, p.segment,
    q.n_questions AS n_answers, CAST(NULL AS VARCHAR) AS message FROM pers p JOIN qs q ON p.conv_id = q.conv_id"""))
def q_batch_inference(src):
    """Responder over every prompt (deterministic first-option stub), per-row error capture."""
    prompts = rs.build_prompts(cv.sim_personas(src), sim_questions(src), "conv_id")
    out = rp.run_responder(prompts, ["persona_id"], "prompt", rp.FirstOptionResponder)
    return rs.route(rs.parse_answers(out.join(cv.sim_personas(src), "persona_id"))).drop("answers")


def store_path(src, name: str) -> str:
    return f"{ensure_checkpoint_dir(src.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("resumed_inference", with_ctes("""SELECT p.persona_id, p.segment, q.n_questions AS n_answers,
    CAST(CASE WHEN p.segment = 'heavy' THEN 2 ELSE 1 END AS BIGINT) AS attempt, CAST(NULL AS VARCHAR) AS error
    FROM pers p JOIN qs q ON p.conv_id = q.conv_id"""))
def q_resumed_inference(src):
    """A job that the model fails for one segment, made again on its answer store: the rest is not asked twice."""
    personas = cv.sim_personas(src)
    asked = rs.build_prompts(personas, sim_questions(src), "conv_id")
    path = store_path(src, "answers")
    for up in (False, True):
        out = AnswerStore(src.spark, path).answer(asked, ["persona_id"], "prompt", partial(rp.LateResponder, "heavy", up),
                                                  prompts_per_task=1000)
    return rs.parse_answers(out.join(personas, "persona_id")).select(
        "persona_id", "segment", F.size("answers").cast("long").alias("n_answers"), "attempt", "error")


STUB_CTES = [
    ("stub", """SELECT p.conv_id, p.persona_id, p.persona_name, p.segment, row_number() OVER (ORDER BY p.conv_id) AS rnk,
        CASE WHEN n IS NULL THEN 'none' WHEN p.conv_id % 4 = 3 THEN 'broken' WHEN p.conv_id % 5 = 4 THEN 'failed'
             WHEN p.conv_id % 7 = 5 THEN 'silent' ELSE 'answered' END AS mood, s.answers
        FROM pers p LEFT JOIN (
          SELECT conv_id, count(*) AS n, list({'question_id': 'q' || CAST(turn AS VARCHAR), 'selected_option': 'choice ' || CAST(conv_id % 3 AS VARCHAR),
            'rationale': 'q' || CAST(turn AS VARCHAR) || ' suits persona ' || CAST(conv_id AS VARCHAR),
            'cot': ['read', 'q' || CAST(turn AS VARCHAR)], 'integrity_score': 85.0::DOUBLE + conv_id % 15} ORDER BY turn) AS answers
          FROM conversations WHERE role = 'user' GROUP BY conv_id) s ON p.conv_id = s.conv_id"""),
    ("total", "SELECT count(*) AS n FROM pers"),
]
LOG_SQL = f"""SELECT CAST(rnk + (rnk - 1) // {BATCH} AS BIGINT) AS seq, CAST((rnk - 1) // {BATCH} AS BIGINT) AS batch,
      CASE WHEN mood = 'answered' THEN 'result' ELSE 'error' END AS type,
      CASE WHEN mood = 'answered' THEN CAST(json_object('type', 'result', 'persona_id', persona_id, 'persona_name', persona_name,
                                                        'segment', segment, 'answers', answers) AS VARCHAR)
           ELSE CAST(json_object('type', 'error', 'persona_id', persona_id, 'persona_name', persona_name, 'message',
             CASE mood WHEN 'broken' THEN '[{{"question_id": ' WHEN 'failed' THEN 'no model for persona ' || CAST(conv_id AS VARCHAR)
                       ELSE {_q(fixed.PARSE_FAILURE_MESSAGE)} END) AS VARCHAR) END AS payload
    FROM stub
    UNION ALL SELECT done + b + 1, b, 'progress',
      '{{"type":"progress","done":' || CAST(done AS VARCHAR) || ',"total":' || CAST(n AS VARCHAR) || '}}'
    FROM (SELECT CAST(b AS BIGINT) AS b, least((b + 1) * {BATCH}, n) AS done, n FROM total, range((n + {BATCH - 1}) // {BATCH}) AS r(b))
    UNION ALL SELECT n + (n + {BATCH - 1}) // {BATCH} + 1, (n + {BATCH - 1}) // {BATCH}, 'done',
      '{{"type":"done","total":' || CAST(n AS VARCHAR) || '}}' FROM total"""


def with_stub(body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in CTES + STUB_CTES) + "\n" + body


def _run(src):
    return rs.run_simulation(cv.sim_personas(src), sim_questions(src), "conv_id", rp.MoodyResponder, store_path(src, "answers"),
                             ["conv_id"], BATCH, prompts_per_task=1000)


@register("response_event_log", with_stub(LOG_SQL))
def q_event_log(src):
    """The whole job in one batch; its event log as written and read back."""
    path = store_path(src, "event-log")
    _run(src)[1].write.mode("append").parquet(path)
    return src.spark.read.parquet(path)


@register("simulated_answers", with_stub("""SELECT rank, persona_id, question_id, selected_option, rationale, integrity_score FROM (
    SELECT rnk AS rank, persona_id, unnest(answers, recursive := true) FROM stub WHERE mood = 'answered')"""))
def q_simulated_answers(src):
    """The job's answers, read back from its event log, one row per question."""
    log = _run(src)[1]
    events = rs.read_events(log).where("type = 'result'")
    return events.select((F.col("seq") - F.col("batch")).alias("rank"), "persona_id", F.explode("answers").alias("a")).select(
        "rank", "persona_id", "a.question_id", "a.selected_option", "a.rationale", "a.integrity_score")


@register("parse_answers", with_ctes("SELECT persona_id, CAST(coalesce(len(answers), 0) AS BIGINT) AS n_answers FROM pa"))
def q_parse_answers(src):
    """Answer array extracted from free text."""
    return sim_parsed(src).select("persona_id", F.size("answers").cast("long").alias("n_answers"))


@register("response_events", with_ctes("SELECT * FROM ev"))
def q_events(src):
    """Result / error events per persona."""
    return rs.route(sim_parsed(src)).drop("answers")


@register("progress_events", with_ctes(f"""SELECT 'progress' AS type, CAST((rnk - 1) // {BATCH} AS BIGINT) AS batch,
    CAST(max(rnk) AS BIGINT) AS done, CAST((SELECT count(*) FROM pers) AS BIGINT) AS total
    FROM (SELECT row_number() OVER (ORDER BY conv_id) AS rnk FROM pers) GROUP BY (rnk - 1) // {BATCH}
    UNION ALL SELECT 'done', CAST(((SELECT count(*) FROM pers) + {BATCH - 1}) // {BATCH} AS BIGINT),
      CAST((SELECT count(*) FROM pers) AS BIGINT), CAST((SELECT count(*) FROM pers) AS BIGINT)"""))
def q_progress(src):
    """Progress row per batch of 5 personas, then a done row."""
    return rs.progress(cv.sim_personas(src), ["conv_id"], BATCH)


@register("answers_long", with_ctes("""SELECT persona_id, CAST(pos AS BIGINT) AS pos, a.question_id, a.selected_option,
    a.rationale, a.integrity_score, array_to_string(a.cot, '|') AS cot FROM (
      SELECT persona_id, unnest(range(1, len(answers) + 1)) AS pos, answers FROM pa WHERE len(answers) > 0),
    LATERAL (SELECT answers[pos] AS a)"""))
def q_answers_long(src):
    """I8: one row per persona × question answer."""
    return rs.answers_long(sim_parsed(src))
