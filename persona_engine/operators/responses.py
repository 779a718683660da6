"""Persona responses (I1–I8): prompts, parsing, routing, progress.

Every persona is one row; its ordered question list (the run's own, of any length)
is assembled with ``collect_list`` per persona.
The batch barrier of a sequential driver loop disappears: batches are only a
label (``floor((rank−1)/batch_size)``) used for progress rows; the rank is a
skew-safe global row number, not a single-partition window.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from persona_engine.functions import fixed, prompts
from persona_engine.functions.expr import render
from persona_engine.operators.answer_store import AnswerStore
from persona_engine.operators.indexing import row_number_within
from persona_engine.session import ensure_checkpoint_dir, materialize

ANSWER_SCHEMA = f"array<{prompts.form_schema(prompts.ANSWER_FORM)}>"
TEXT_FIELDS = ["persona_name", "age", "gender", "occupation", "occupation_category", "segment", "region",
               "preferred_channel", "buy_channel", "profile"]
LIST_FIELDS = ["interests", "keywords", "purchase_history"]
SCORE_FIELDS = ["purchase_intent", "brand_attitude", "marketing_acceptance"]


def _txt(df: DataFrame, c: str) -> F.Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")


def _lst(df: DataFrame, c: str) -> F.Column:
    return F.coalesce(F.array_join(F.col(c), ", "), F.lit("")) if c in df.columns else F.lit("")


def _score(df: DataFrame, c: str) -> F.Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("0")) if c in df.columns else F.lit("0")


def options_json(c: F.Column) -> F.Column:
    """Python-style JSON text of a string list: ["a", "b"]."""
    # to_json of a one-entry list escapes the text; its brackets go
    quoted = F.transform(c, lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", ""))
    return F.concat(F.lit("["), F.coalesce(F.array_join(quoted, ", "), F.lit("")), F.lit("]"))


def question_lines(questions: DataFrame, key: str) -> DataFrame:
    """Per persona key: the numbered question block and the question count ."""
    q = questions.select(key, F.struct("q_order", "question_id", "question_type", "question_text",
                                       options_json(F.col("options")).alias("opts")).alias("q"))
    g = q.groupBy(key).agg(F.sort_array(F.collect_list("q")).alias("qs"))
    lines = F.transform("qs", lambda x, i: render(prompts.SIMULATION_QUESTION_LINE, i=i + 1, id=x["question_id"],
                                                  type=x["question_type"], text=x["question_text"], options=x["opts"]))
    return g.select(key, F.array_join(lines, "\n").alias("questions_text"), F.size("qs").cast("long").alias("n_questions"))


def build_prompts(personas: DataFrame, questions: DataFrame, key: str | None, project_name: str = "",
                  project_purpose: str = "") -> DataFrame:
    """One prompt per persona over its ordered questions.

    With ``key`` the questions are per persona (joined on it); with ``key=None``
    every persona answers the same survey: the list is collected once and attached as a literal, so the prompts are a
    projection over the personas (no join, no grouping).
    """
    if key is None:
        block, n = shared_question_block(questions)
        d = personas.withColumns({"questions_text": F.lit(block), "n_questions": F.lit(n).cast("long")})
    else:
        d = personas.join(question_lines(questions, key), key)
    body = render(prompts.SIMULATION_PROMPT_TEMPLATE, name=_txt(d, "persona_name"), age=_txt(d, "age"),
                  gender=_txt(d, "gender"), occupation=_txt(d, "occupation"),
                  occupation_category=_txt(d, "occupation_category"), segment=_txt(d, "segment"),
                  region=_txt(d, "region"), interests=_lst(d, "interests"), keywords=_lst(d, "keywords"),
                  preferred_channel=_txt(d, "preferred_channel"), buy_channel=_txt(d, "buy_channel"),
                  purchase_history=_lst(d, "purchase_history"), purchase_intent=_score(d, "purchase_intent"),
                  brand_attitude=_score(d, "brand_attitude"), marketing_acceptance=_score(d, "marketing_acceptance"),
                  profile=_txt(d, "profile"), project_name=project_name, project_purpose=project_purpose,
                  questions=F.col("questions_text"), n_questions=F.col("n_questions"), form=prompts.form_example(prompts.ANSWER_FORM))
    cols = ([key] if key else []) + ["persona_id", "n_questions"]
    return d.select(*cols, body.alias("prompt"))


def shared_question_block(questions: DataFrame) -> tuple[str, int]:
    """The survey's ordered question block: the run's own question list, of any length but not empty."""
    rows = questions.orderBy("q_order").collect()
    if not rows:
        raise ValueError("questions is empty")
    lines = []
    for i, r in enumerate(rows, start=1):
        opts = json.dumps(list(r["options"] or []), ensure_ascii=False)
        lines.append(prompts.SIMULATION_QUESTION_LINE.format(i=i, id=r["question_id"], type=r["question_type"],
                                                           text=r["question_text"], options=opts))
    return "\n".join(lines), len(rows)


def parse_answers(raw: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Greedy [..] block → typed answer array (empty when absent or invalid)."""
    block = F.regexp_extract(F.col(raw_col), r"(?s)\[.*\]", 0)
    parsed = F.from_json(F.nullif(block, F.lit("")), ANSWER_SCHEMA)
    return raw.withColumn("answers", F.coalesce(parsed, F.array().cast(ANSWER_SCHEMA)))


def route(parsed: DataFrame, *more: str) -> DataFrame:
    """I4: result when answers exist, else error with the raw/exception text or the default message; ``more`` columns stay."""
    has = F.size("answers") > 0
    raw_or_err = F.coalesce(F.col("error"), F.col("raw")) if "error" in parsed.columns else F.col("raw")
    return parsed.select(
        *more, "persona_id", F.when(has, "result").otherwise("error").alias("type"), "persona_name", "segment",
        F.size("answers").cast("long").alias("n_answers"), "answers",
        F.when(has, F.lit(None).cast("string"))
        .otherwise(F.coalesce(F.nullif(raw_or_err, F.lit("")), F.lit(fixed.PARSE_FAILURE_MESSAGE))).alias("message"))


def progress(personas: DataFrame, order_cols: list[str], batch_size: int = fixed.DEFAULT_BATCH_SIZE) -> DataFrame:
    """One progress row per batch (done = personas finished so far) and a final done row."""
    ranked = row_number_within(personas.select(*order_cols), [], order_cols, "rank")
    total = ranked.agg(F.count(F.lit(1)).alias("total"))
    per = ranked.groupBy(F.floor((F.col("rank") - 1) / batch_size).cast("long").alias("batch")) \
        .agg(F.max("rank").alias("done"))
    tot = total.first()["total"]
    rows = per.select(F.lit("progress").alias("type"), "batch", F.col("done").cast("long"),
                      F.lit(tot).cast("long").alias("total"))
    n_batches = (tot + batch_size - 1) // batch_size
    done = personas.sparkSession.createDataFrame([("done", n_batches, tot, tot)],
                                                 "type string, batch long, done long, total long")
    return rows.unionByName(done)


def answers_long(parsed: DataFrame) -> DataFrame:
    """I8: one row per persona × answer."""
    x = parsed.select("persona_id", F.posexplode("answers").alias("pos", "a"))
    return x.select("persona_id", (F.col("pos") + 1).cast("long").alias("pos"),
                    F.col("a.question_id").alias("question_id"), F.col("a.selected_option").alias("selected_option"),
                    F.col("a.rationale").alias("rationale"), F.col("a.integrity_score").alias("integrity_score"),
                    F.array_join(F.col("a.cot"), "|").alias("cot"))


def require_non_empty(df: DataFrame, what: str) -> DataFrame:
    """Reject an empty personas / questions input before any work is scheduled."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def run_errors(personas: DataFrame, questions: DataFrame, key: str) -> DataFrame:
    """I6 for many runs at once: personas and questions of each run and ``error``, what ``run_simulation`` would raise, or null."""
    count = lambda df, name: df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    both = count(personas, "n_personas").join(count(questions, "n_questions"), key, "full_outer")
    both = both.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_personas", "n_questions")})
    return both.withColumn("error", F.when(F.col("n_personas") == 0, "personas is empty").when(F.col("n_questions") == 0, "questions is empty"))


def event_log(events: DataFrame, first_rank: int, last_rank: int, total: int, batch_size: int = fixed.DEFAULT_BATCH_SIZE) -> DataFrame:
    """What the run reports, as rows (seq, batch, type, payload); payload is the event as JSON text.

    ``events`` (of ``route``, with ``rank``, 1 to ``total`` over the whole run) hold the
    personas ``first_rank`` to ``last_rank``. A progress row follows every ``batch_size``-th
    persona and the last one, then the done row; ``seq`` numbers all rows of the run, so the
    log of a run cut anywhere is the log of the whole run.
    """
    spark = events.sparkSession
    keep_null = {"ignoreNullFields": "false"}
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    result = F.to_json(F.struct("type", "persona_id", text("persona_name"), text("segment"), "answers"), keep_null)
    error = F.to_json(F.struct("type", "persona_id", text("persona_name"), "message"), keep_null)
    batch = F.floor((F.col("rank") - 1) / batch_size).cast("long")
    rows = events.select((F.col("rank") + batch).alias("seq"), batch.alias("batch"), "type",
                         F.when(F.col("type") == "result", result).otherwise(error).alias("payload"))
    if last_rank < first_rank:
        return rows
    # batches whose last persona is among these
    low, high = (first_rank - 1) // batch_size, last_rank // batch_size
    if last_rank == total and total % batch_size:
        high += 1
    done = F.least((F.col("id") + 1) * batch_size, F.lit(total))
    steps = spark.range(low, high).select(
        (done + F.col("id") + 1).alias("seq"), F.col("id").alias("batch"), F.lit("progress").alias("type"),
        F.to_json(F.struct(F.lit("progress").alias("type"), done.alias("done"), F.lit(total).cast("long").alias("total"))).alias("payload"))
    rows = rows.unionByName(steps)
    if last_rank == total:
        batches = -(-total // batch_size)
        last = spark.range(1).select(F.lit(total + batches + 1).cast("long").alias("seq"), F.lit(batches).cast("long").alias("batch"),
                                     F.lit("done").alias("type"),
                                     F.to_json(F.struct(F.lit("done").alias("type"), F.lit(total).cast("long").alias("total"))).alias("payload"))
        rows = rows.unionByName(last)
    return rows


LOG_EVENT = (f"type string, persona_id string, persona_name string, segment string, answers {ANSWER_SCHEMA}, message string, "
             "done bigint, total bigint")


def read_events(log: DataFrame) -> DataFrame:
    """The log's payloads as columns again, with seq and batch."""
    return log.select("seq", "batch", F.from_json("payload", LOG_EVENT).alias("e")).select("seq", "batch", "e.*")


def simulate(personas: DataFrame, questions: DataFrame, key: str | None, store: AnswerStore, factory, project_name: str = "",
             project_purpose: str = "", **calls) -> DataFrame:
    """I1–I4 for personas with columns persona_id, persona_name, segment, rank: prompts, answers, parse, route.

    Personas without a question of their own (with ``key``) are asked nothing and end as errors.
    """
    asked = build_prompts(personas, questions, key, project_name, project_purpose)
    raw = store.answer(asked, ["persona_id"], "prompt", factory, **calls).select("persona_id", "raw", "error")
    parsed = parse_answers(personas.select("persona_id", "persona_name", "segment", "rank").join(raw, "persona_id", "left"))
    return route(parsed, "rank")


def run_simulation(personas: DataFrame, questions: DataFrame, key: str | None, factory, store_path: str | None = None,
                   order_cols: list[str] | None = None, batch_size: int = fixed.DEFAULT_BATCH_SIZE, project_name: str = "",
                   project_purpose: str = "", **calls) -> tuple[DataFrame, DataFrame]:
    """I1–I5 end to end: (events with rank and answers, event log).

    ``key``: the column that joins personas to their questions; None, or a column that
    questions lack, means one survey for all. ``order_cols`` (default persona_id) rank the
    personas. Run again on the same ``store_path``, it calls the model only for what is
    open. ``calls`` go to ``AnswerStore.answer`` (prompts_per_task, calls_at_once, model, ...).
    """
    spark = personas.sparkSession
    require_non_empty(personas, "personas")
    require_non_empty(questions, "questions")
    path = store_path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/answers-{uuid.uuid4().hex}"
    ranked = materialize(row_number_within(personas, [], order_cols or ["persona_id"], "rank"))
    shared = key is None or key not in questions.columns
    events = materialize(simulate(ranked, questions, None if shared else key, AnswerStore(spark, path), factory,
                                  project_name, project_purpose, **calls))
    total = ranked.count()
    return events, event_log(events, 1, total, total, batch_size)
