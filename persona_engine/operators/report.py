"""Report aggregates and documents.

The aggregates a report needs (segment cards, keyword frequencies, age
buckets, option distributions, progress) are ordinary grouped aggregations with
map-side combine; every truncation ("first 5 segments", "top 10 keywords") is a
``row_number() ≤ n`` or a distributed top-k, so only the kept rows reach the
final one-row documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from persona_engine.functions import fixed, prompts
from persona_engine.functions.expr import age_band, clip, py_float_text, render, rnd
from persona_engine.operators.indexing import row_number_within

T = fixed.REPORT_TRUNCATIONS
S = fixed.STATIC_REPORT_TEXT


def segment_cards(customers: DataFrame, segment_col: str = "usr_cnty_ap2") -> DataFrame:
    """Per segment — size, mean purchase intent and brand attitude over the customers that have a value."""
    return customers.groupBy(F.col(segment_col).alias("segment")).agg(
        F.count(F.lit(1)).alias("n"),
        rnd(F.avg(clip(F.col("ltv_r") / 10000.0, 0.0, 100.0)), 1).alias("purchase_intent"),
        rnd(F.avg(clip(F.col("retention_score") * 100.0, 0.0, 100.0)), 1).alias("brand_attitude"))


def ranked_cards(cards: DataFrame, n: int) -> DataFrame:
    """The n largest cards with their rank: a distributed top-k, then a window over at most n rows."""
    order = [F.desc("n"), F.asc("segment")]
    return cards.orderBy(*order).limit(n).withColumn("card_rank", F.row_number().over(Window.orderBy(*order)))


def dominant_segment(cards: DataFrame) -> DataFrame:
    """The largest segment (ties → name order)."""
    return ranked_cards(cards, 1).select(F.col("segment").alias("dominant_segment"))


def tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Whitespace tokens, lower-case, over whole texts."""
    return docs.select(F.explode(F.split(F.lower(F.col(text_col)), r"\s+")).alias("keyword")) \
        .where(F.col("keyword") != "")


def keyword_items(docs: DataFrame, n: int = T["keywords"]) -> DataFrame:
    """Top-n keywords by frequency (ties → keyword order); distributed top-k."""
    counts = tokens(docs).groupBy("keyword").agg(F.count(F.lit(1)).alias("frequency"))
    top = counts.orderBy(F.desc("frequency"), F.asc("keyword")).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("frequency"), F.asc("keyword"))))


def keyword_radar(items: DataFrame) -> DataFrame:
    """Radar chart rows (baseline 50, full mark 100)."""
    return items.select(F.col("keyword").alias("subject"), F.col("frequency").alias("dominant"),
                        F.lit(fixed.RADAR_BASELINE).cast("long").alias("baseline"),
                        F.lit(fixed.RADAR_FULL_MARK).cast("long").alias("fullMark"))


def age_buckets(demo: DataFrame) -> DataFrame:
    """Customers per age band."""
    return demo.groupBy(age_band("usr_age").alias("age_band")).agg(F.count(F.lit(1)).alias("n"))


def option_distribution(answers: DataFrame) -> DataFrame:
    """Option counts per question, share, and the leading option's flag."""
    c = answers.groupBy("question_id", "selected_option").agg(F.count(F.lit(1)).alias("n"))
    # totals and leaders are aggregated per task first, so a question with very many options is no single task's
    first = F.min(F.struct((-F.col("n")).alias("less"), F.col("selected_option").isNull().alias("none"), "selected_option"))
    q = c.groupBy("question_id").agg(F.sum("n").alias("total"), first.alias("top")).withColumnRenamed("question_id", "q")
    return c.join(q, F.col("question_id").eqNullSafe(F.col("q"))).select(
        "question_id", "selected_option", "n", (F.col("n") / F.col("total")).alias("share"),
        F.col("selected_option").eqNullSafe(F.col("top.selected_option")).cast("long").alias("is_top"))


def response_progress(events: DataFrame) -> DataFrame:
    """Responses ÷ target as an integer percent (0 when there is no target)."""
    a = events.agg(F.sum((F.col("type") == "result").cast("long")).alias("response_count"),
                   F.count(F.lit(1)).alias("target_responses"))
    pct = F.coalesce(F.try_divide(F.col("response_count") * 100, F.col("target_responses")), F.lit(0.0))
    return a.select("response_count", "target_responses", F.floor(pct).cast("long").alias("response_progress"))


def segment_lines(cards: DataFrame, n: int = T["segments"]) -> DataFrame:
    """One line of intent and attitude for each of the first n cards."""
    r = ranked_cards(cards, n)
    line = render(prompts.REPORT_SEGMENT_LINE, segment=F.col("segment"),
                  purchase_intent=F.coalesce(py_float_text("purchase_intent"), F.lit("N/A")),
                  brand_attitude=F.coalesce(py_float_text("brand_attitude"), F.lit("N/A")))
    return r.select(F.col("card_rank").cast("long"), "segment", line.alias("line"))


def response_patterns(answers: DataFrame, personas: DataFrame) -> DataFrame:
    """Per segment (first 5) × question (first 3): top option and its first rationale (80 chars).

    Answers are aggregated to (segment, question, option) first — partial
    aggregation, so a segment holding most answers is pre-combined per task — and
    questions are ranked over those few aggregated rows.
    """
    a = answers.join(personas.select("persona_id", "segment"), "persona_id")
    # first 5 segments: distributed top-k, then a window over ≤ 5 rows
    segs = a.select("segment").distinct().orderBy("segment").limit(T["pattern_segments"]) \
        .withColumn("seg_rank", F.row_number().over(Window.orderBy("segment")))
    a = a.join(F.broadcast(segs), "segment")      # ≤ 5 rows
    opt = a.groupBy("segment", "seg_rank", "question_id", "selected_option").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("rationale", "persona_id").alias("rationale"))
    qn = F.regexp_extract("question_id", r"(\d+)$", 1).cast("long")
    opt = opt.withColumn("q_rank", F.dense_rank().over(Window.partitionBy("segment").orderBy(qn, "question_id"))) \
        .where(F.col("q_rank") <= T["pattern_questions"])
    w = Window.partitionBy("segment", "question_id").orderBy(F.desc("n"), F.asc_nulls_last("selected_option"))
    top = opt.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    return top.select(F.col("seg_rank").cast("long"), "segment", F.col("q_rank").cast("long"), "question_id",
                      F.col("selected_option").alias("top_option"),
                      F.substring(F.coalesce("rationale", F.lit("")), 1, T["rationale_chars"]).alias("rationale"))


def top_question(answers: DataFrame) -> DataFrame:
    """Most answered question id (ties → id order)."""
    c = answers.groupBy("question_id").agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.desc("n"), F.asc("question_id")).limit(1).select(F.col("question_id").alias("top_question"))


def top_responses(cards: DataFrame, top_q: str, n: int = T["top_responses"]) -> DataFrame:
    """Up to 10 lines from segment cards when no response summary exists."""
    r = ranked_cards(cards, n)
    sel = render(prompts.REPORT_INTENT_OPTION, value=F.coalesce(py_float_text("purchase_intent"), F.lit("N/A")))
    line = render(prompts.REPORT_TOP_RESPONSE_LINE, name=F.col("segment"), segment=F.col("segment"),
                  question=top_q[:T["question_chars"]], option=sel)
    return r.select(F.col("card_rank").cast("long"), line.alias("line"))


def persona_samples(answers: DataFrame, personas: DataFrame, n: int = T["samples"],
                    k: int = T["sample_answers"]) -> DataFrame:
    """First n answering personas × first k answers as report lines."""
    # first n answering personas: distributed top-k, then a window over ≤ n rows
    p = answers.select("persona_id").distinct().join(personas, "persona_id").orderBy("conv_id").limit(n)
    p = p.withColumn("p_rank", F.row_number().over(Window.orderBy("conv_id")))
    a = answers.where(F.col("pos") <= k).join(F.broadcast(p), "persona_id")    # ≤ n personas
    head = p.select(F.col("p_rank").cast("long"), F.lit(0).cast("long").alias("line_no"),
                    render(prompts.REPORT_SAMPLE_HEADER, name=F.col("persona_name"), segment=F.col("segment")).alias("line"))
    body = a.select(F.col("p_rank").cast("long"), F.col("pos").cast("long").alias("line_no"),
                    render(prompts.REPORT_SAMPLE_ANSWER, option=F.coalesce("selected_option", F.lit("")),
                           rationale=F.substring(F.coalesce("rationale", F.lit("")), 1, T["rationale_chars"]))
                    .alias("line"))
    return head.unionByName(body)


def report_types(requested: DataFrame, type_col: str = "report_type") -> DataFrame:
    """Label and instruction per requested type (default 'strategy')."""
    labels = F.create_map(*[x for t, lab in fixed.REPORT_TYPES for x in (F.lit(t), F.lit(lab))])
    instr = F.create_map(*[x for t, s in prompts.REPORT_TYPE_INSTRUCTIONS for x in (F.lit(t), F.lit(s))])
    dflt = fixed.DEFAULT_REPORT_TYPE
    return requested.withColumns({
        "type_label": F.coalesce(F.element_at(labels, F.col(type_col)), F.lit(dict(fixed.REPORT_TYPES)[dflt])),
        "instruction": F.coalesce(F.element_at(instr, F.col(type_col)),
                                  F.lit(dict(prompts.REPORT_TYPE_INSTRUCTIONS)[dflt]))})


def static_report(summary: DataFrame, project_name: str, report_type: str = fixed.DEFAULT_REPORT_TYPE) -> DataFrame:
    """The fallback report as one row of text fields (input: one summary row with
    persona_count, response_count, response_progress, dominant_segment)."""
    pc, rc = F.col("persona_count").cast("string"), F.col("response_count").cast("string")
    prog = F.concat(F.col("response_progress").cast("string"), F.lit("%"))
    dom = F.col("dominant_segment")
    return summary.select(
        F.lit(project_name + S["title_suffix"]).alias("title"), F.lit(report_type).alias("type"),
        F.format_string(S["summary_body"], F.lit(project_name), pc, rc).alias("summary"),
        F.format_string(S["findings_body"], dom).alias("findings"),
        F.concat(F.lit(S["evidence_segment"] + "="), dom, F.lit("|" + S["evidence_progress"] + "="), prog).alias("evidence"),
        F.format_string(S["action"], dom).alias("action"),
        F.concat(F.lit(S["kpi_progress"] + "="), prog, F.lit("|" + S["kpi_personas"] + "="), pc,
                 F.lit("|" + S["kpi_responses"] + "="), rc).alias("kpis"),
        F.concat(F.format_string(S["finding_segment"], dom), F.lit("|"), F.format_string(S["finding_total"], rc))
        .alias("key_findings"))


REPORT_SCHEMA = prompts.form_schema(prompts.REPORT_FORM)


def parse_report(raw: DataFrame, key: str, fallback: DataFrame, report_type: str = fixed.DEFAULT_REPORT_TYPE) -> DataFrame:
    """Greedy {...} → must have 'sections' → model report with forced type; else the
    fallback document (one row of ``report_document``), with the reason recorded instead of
    swallowed (Q13). The charts are the fallback document's in either case: they come from
    the data, not from the model."""
    block = F.regexp_extract(F.col("raw"), r"(?s)\{.*\}", 0)
    obj = F.nullif(block, F.lit(""))
    keys = F.json_object_keys(obj)
    ok = F.coalesce(F.array_contains(keys, "sections"), F.lit(False))
    parsed = F.from_json(obj, REPORT_SCHEMA)
    reason = (F.when(ok, F.lit(None).cast("string")).when(obj.isNull(), "no_json_object")
              .when(keys.isNull(), "invalid_json").otherwise("no_sections"))
    doc = fallback.select(F.to_json(F.struct("title", "sections", "kpis", "key_findings")).alias("d"), F.to_json("charts").alias("c")).first()
    own = F.from_json(F.lit(doc["d"]), REPORT_SCHEMA)
    charts = F.from_json(F.lit(doc["c"]), fallback.schema["charts"].dataType)
    got = raw.select(key, F.when(ok, "model").otherwise("fallback").alias("source"), F.when(ok, parsed).otherwise(own).alias("r"),
                     charts.alias("charts"), reason.alias("fallback_reason"))
    return got.select(key, "source", "r.title", F.lit(report_type).alias("type"), "r.sections", "r.kpis", "r.key_findings", "charts", "fallback_reason")


def report_text(reports: DataFrame) -> DataFrame:
    """Parsed reports with their nested fields as text (one line per section, '|' between parts)."""
    pairs = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("=", x["label"], x["value"])), "|")
    sections = F.transform("sections", lambda s: F.concat_ws("|", s["id"], s["title"], s["content"], s["action"]))
    evidence = pairs(F.flatten(F.filter(F.transform("sections", lambda s: s["evidence"]), lambda e: e.isNotNull())))
    return reports.withColumns({
        "n_sections": F.coalesce(F.size("sections"), F.lit(0)).cast("long"), "n_charts": F.size("charts").cast("long"),
        "evidence": evidence, "sections": F.array_join(sections, "\n"), "kpis": pairs("kpis"), "key_findings": F.array_join("key_findings", "|")}).drop("charts")


def question_strength(distribution: DataFrame) -> DataFrame:
    """J7 'question-strength' series: the leading option's share per question (percent, 1 decimal)."""
    top = distribution.where(F.col("is_top") == 1)
    return top.select("question_id", F.col("selected_option").alias("top_option"),
                      rnd(F.col("share") * 100.0, 1).alias("strength"))


def chart_index(counts: dict, top_question_title: str | None) -> list:
    """The five chart datasets (id, type, title, number of points) in their fixed order."""
    out = []
    for cid, ctype, title in fixed.CHARTS:
        if cid == "question-distribution" and top_question_title:
            title = top_question_title
        out.append((cid, ctype, title, int(counts.get(cid, 0))))
    return out


#: The columns of a point of each chart.
CHART_POINTS = {
    "keyword-radar": "subject string, dominant bigint, baseline bigint, fullMark bigint",
    "question-strength": "question_id string, top_option string, strength double",
    "age-distribution": "age_band string, n bigint",
    "question-distribution": "question_id string, selected_option string, n bigint, share double, is_top bigint",
    "segment-cards": "segment string, n bigint, purchase_intent double, brand_attitude double",
}


def chart_points(items: DataFrame, distribution: DataFrame, ages: DataFrame, cards: DataFrame, top_title: str | None) -> DataFrame:
    """The data of all five charts, a row per point: chart_id, chart_type, title, ord, point.

    ``point`` is the JSON text of the chart's own columns (``CHART_POINTS``; ``read_chart``
    gives them back typed), ``ord`` its place in the chart. A question's options may be many,
    so the points stay rows and are numbered over range partitions, not in one task.
    """
    nothing, text = F.lit(0.0), F.lit("")
    strength = question_strength(distribution)
    share = distribution.withColumn("share", rnd(F.col("share"), 3))
    data = {   # chart → rows and what orders them: a text, a number, a text
        "keyword-radar": (keyword_radar(items).join(items.select(F.col("keyword").alias("subject"), "rank"), "subject"), text, F.col("rank"), text),
        "question-strength": (strength, F.col("question_id"), nothing, text),
        "age-distribution": (ages, F.col("age_band"), nothing, text),
        "question-distribution": (share, F.col("question_id"), -F.col("n"), F.col("selected_option")),
        "segment-cards": (cards, text, -F.col("n"), F.col("segment")),
    }
    rows = None
    for cid, ctype, title, _ in chart_index({}, top_title):
        df, first, second, third = data[cid]
        names = [c.split(" ")[0] for c in CHART_POINTS[cid].split(", ")]
        part = df.select(F.lit(cid).alias("chart_id"), F.lit(ctype).alias("chart_type"), F.lit(title).alias("title"),
                         F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("point"),
                         first.alias("_a"), second.cast("double").alias("_b"), third.alias("_c"))
        rows = part if rows is None else rows.unionByName(part)
    return row_number_within(rows, ["chart_id"], ["_a", "_b", "_c"], "ord").select("chart_id", "chart_type", "title", "ord", "point")


def read_chart(points: DataFrame, chart_id: str) -> DataFrame:
    """One chart's points as typed columns, with ord."""
    return points.where(F.col("chart_id") == chart_id).select("ord", F.from_json("point", CHART_POINTS[chart_id]).alias("p")).select("ord", "p.*")


def report_document(summary: DataFrame, charts: list, project_name: str,
                    report_type: str = fixed.DEFAULT_REPORT_TYPE) -> DataFrame:
    """J1 + J7 as one nested document row: title, type, sections (with evidence and
    action), kpis, key_findings and the chart index.

    ``summary`` is the one-row aggregate (persona_count, response_count,
    response_progress, dominant_segment); ``charts`` is the five-entry chart index
    from ``chart_index`` (a fixed-size list), attached as a literal array.
    """
    pc, rc = F.col("persona_count").cast("string"), F.col("response_count").cast("string")
    prog = F.concat(F.col("response_progress").cast("string"), F.lit("%"))
    dom = F.col("dominant_segment")
    ev = "array<struct<label:string,value:string>>"

    def sec(i, t, c, e=None, a=None):
        return F.struct(F.lit(i).alias("id"), F.lit(t).alias("title"), c.alias("content"),
                        (e if e is not None else F.lit(None).cast(ev)).alias("evidence"),
                        (a if a is not None else F.lit(None).cast("string")).alias("action"))

    def kv(k, v):
        return F.struct(F.lit(k).alias("label"), v.alias("value"))

    chart_col = F.array(*[F.struct(F.lit(cid).alias("id"), F.lit(ctype).alias("type"), F.lit(title).alias("title"),
                                   F.lit(int(n)).cast("long").alias("n_points"))
                          for cid, ctype, title, n in charts])
    return summary.select(
        F.lit(project_name + S["title_suffix"]).alias("title"), F.lit(report_type).alias("type"),
        F.array(sec("summary", S["summary_title"], F.format_string(S["summary_body"], F.lit(project_name), pc, rc)),
                sec("findings", S["findings_title"], F.format_string(S["findings_body"], dom),
                    F.array(kv(S["evidence_segment"], dom), kv(S["evidence_progress"], prog)),
                    F.format_string(S["action"], dom))).alias("sections"),
        F.array(kv(S["kpi_progress"], prog), kv(S["kpi_personas"], pc), kv(S["kpi_responses"], rc)).alias("kpis"),
        F.array(F.format_string(S["finding_segment"], dom), F.format_string(S["finding_total"], rc)).alias("key_findings"),
        chart_col.alias("charts"))
