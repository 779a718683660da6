"""Registered queries: report aggregates and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from persona_engine.functions import fixed, prompts
from persona_engine.operators import report as rp
from persona_engine.operators.indexing import row_number_within
from persona_engine.operators import responses as rs
from persona_engine.plans import q_derive as qd
from persona_engine.plans import q_responses as qr
from persona_engine.plans.oracle_views import VIEW_SQL, _order, _q, py_float_sql, render_sql
from persona_engine.plans.registry import register
from persona_engine.sources import conversations as cv
from persona_engine.sources import views

T = fixed.REPORT_TRUNCATIONS
S = fixed.STATIC_REPORT_TEXT
PROJECT = "persona-survey"
REPORT_TYPE_CYCLE = ["strategy", "insight", "segment", "summary", "overview"]   # 'overview' → default

CTES = [(n, VIEW_SQL[n][1]) for n in _order(["customers", "demo"])] + qr.CTES + [
    ("cards", """SELECT usr_cnty_ap2 AS segment, count(*) AS n,
        round_even(avg(least(greatest(ltv_r / 10000.0, 0.0), 100.0)) FILTER (WHERE ltv_r IS NOT NULL), 1) AS purchase_intent,
        round_even(avg(least(greatest(retention_score * 100.0, 0.0), 100.0)) FILTER (WHERE retention_score IS NOT NULL), 1) AS brand_attitude
        FROM customers GROUP BY usr_cnty_ap2"""),
    ("rcards", "SELECT *, row_number() OVER (ORDER BY n DESC, segment) AS card_rank FROM cards"),
    ("kw", """SELECT keyword, count(*) AS frequency FROM (
        SELECT unnest(regexp_split_to_array(lower(text), '\\s+')) AS keyword FROM documents)
        WHERE keyword <> '' GROUP BY keyword"""),
    ("kwtop", """SELECT keyword, frequency, row_number() OVER (ORDER BY frequency DESC, keyword) AS rank FROM kw
        QUALIFY rank <= 10"""),
    ("ans", """SELECT persona_id, CAST(pos AS BIGINT) AS pos, a.question_id, a.selected_option, a.rationale FROM (
        SELECT persona_id, unnest(range(1, len(answers) + 1)) AS pos, answers FROM pa WHERE len(answers) > 0),
        LATERAL (SELECT answers[pos] AS a)"""),
    ("topq", "SELECT question_id AS top_question FROM ans GROUP BY question_id ORDER BY count(*) DESC, question_id LIMIT 1"),
]


def with_ctes(body: str, extra=()) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in list(CTES) + list(extra)) + "\n" + body


def _cards(src):
    return rp.segment_cards(views.customers(src))


def _answers(src):
    return rs.answers_long(qr.sim_parsed(src))


def _events(src):
    return rs.route(qr.sim_parsed(src)).drop("answers")


@register("segment_cards", with_ctes(f"""SELECT usr_cnty_ap2 AS segment, count(*) AS n,
    round_even(avg(least(greatest(ltv_r / 10000.0, 0.0), 100.0)) FILTER (WHERE {qd._there('ltv_r')}), 1) AS purchase_intent,
    round_even(avg(least(greatest(retention_score * 100.0, 0.0), 100.0)) FILTER (WHERE {qd._there('retention_score')}), 1) AS brand_attitude
    FROM gaps GROUP BY usr_cnty_ap2""", [qd.GAPS]))
def q_segment_cards(src):
    """Segment cards (size, mean intent, mean attitude), with null and NaN values put in."""
    return rp.segment_cards(views.with_gaps(views.customers(src), qd.GAP_COLS))


@register("dominant_segment", with_ctes("SELECT segment AS dominant_segment FROM rcards WHERE card_rank = 1"))
def q_dominant(src):
    """Largest segment."""
    return rp.dominant_segment(_cards(src))


@register("keyword_items", with_ctes("SELECT keyword, frequency, rank FROM kwtop"))
def q_keywords(src):
    """Top-10 keywords over whole document texts."""
    return rp.keyword_items(src.documents)


@register("keyword_radar", with_ctes(f"""SELECT keyword AS subject, frequency AS dominant,
    CAST({fixed.RADAR_BASELINE} AS BIGINT) AS baseline, CAST({fixed.RADAR_FULL_MARK} AS BIGINT) AS "fullMark" FROM kwtop"""))
def q_radar(src):
    """Keyword radar chart dataset."""
    return rp.keyword_radar(rp.keyword_items(src.documents))


@register("age_buckets", with_ctes("""SELECT CASE WHEN usr_age > 0 AND usr_age <= 29 THEN '20s'
    WHEN usr_age > 29 AND usr_age <= 39 THEN '30s' WHEN usr_age > 39 AND usr_age <= 49 THEN '40s'
    WHEN usr_age > 49 AND usr_age <= 59 THEN '50s' WHEN usr_age > 59 AND usr_age <= 100 THEN '60s+' END AS age_band,
    count(*) AS n FROM demo GROUP BY ALL"""))
def q_age_buckets(src):
    """Customers per age band."""
    return rp.age_buckets(views.demo(src))


@register("option_distribution", with_ctes("""SELECT question_id, selected_option, n,
    n / sum(n) OVER (PARTITION BY question_id) AS share,
    CAST(row_number() OVER (PARTITION BY question_id ORDER BY n DESC, selected_option NULLS LAST) = 1 AS BIGINT) AS is_top
    FROM (SELECT question_id, selected_option, count(*) AS n FROM ans GROUP BY question_id, selected_option)"""))
def q_option_distribution(src):
    """Option distribution per question and the leading option."""
    return rp.option_distribution(_answers(src))


@register("response_progress", with_ctes("""SELECT CAST(sum(CAST(type = 'result' AS BIGINT)) AS BIGINT) AS response_count,
    count(*) AS target_responses,
    CAST(floor(coalesce(sum(CAST(type = 'result' AS BIGINT)) * 100 / nullif(count(*), 0), 0.0)) AS BIGINT) AS response_progress
    FROM ev"""))
def q_progress(src):
    """Responses ÷ target."""
    return rp.response_progress(_events(src))


SEG_LINES_SQL = f"""SELECT card_rank, segment, {render_sql(prompts.REPORT_SEGMENT_LINE, segment='segment',
    purchase_intent=f"coalesce({py_float_sql('purchase_intent')}, 'N/A')",
    brand_attitude=f"coalesce({py_float_sql('brand_attitude')}, 'N/A')")} AS line
    FROM rcards WHERE card_rank <= {T['segments']}"""


@register("segment_lines", with_ctes(SEG_LINES_SQL))
def q_segment_lines(src):
    """Segment lines for the report prompt."""
    return rp.segment_lines(_cards(src))


PATTERNS_SQL = f"""SELECT CAST(seg_rank AS BIGINT) AS seg_rank, segment, CAST(q_rank AS BIGINT) AS q_rank,
    question_id, selected_option AS top_option, substring(coalesce(rationale, ''), 1, {T['rationale_chars']}) AS rationale
    FROM (SELECT *, row_number() OVER (PARTITION BY segment, question_id ORDER BY n DESC, selected_option NULLS LAST) AS r
      FROM (SELECT segment, seg_rank, question_id, q_rank, selected_option, count(*) AS n,
                   arg_min(rationale, persona_id) AS rationale
            FROM (SELECT a.*, s.segment, s.seg_rank, dense_rank() OVER (PARTITION BY s.segment
                    ORDER BY CAST(regexp_extract(a.question_id, '(\\d+)$', 1) AS BIGINT), a.question_id) AS q_rank
                  FROM ans a JOIN pers p ON a.persona_id = p.persona_id
                  JOIN (SELECT segment, row_number() OVER (ORDER BY segment) AS seg_rank
                        FROM (SELECT DISTINCT p2.segment FROM ans a2 JOIN pers p2 ON a2.persona_id = p2.persona_id)) s
                    ON p.segment = s.segment AND s.seg_rank <= {T['pattern_segments']})
            WHERE q_rank <= {T['pattern_questions']}
            GROUP BY segment, seg_rank, question_id, q_rank, selected_option))
    WHERE r = 1"""


@register("response_patterns", with_ctes(PATTERNS_SQL))
def q_patterns(src):
    """Per segment × question, top option and its first rationale (80 chars)."""
    return rp.response_patterns(_answers(src), cv.sim_personas(src))


@register("top_responses", with_ctes(f"""SELECT card_rank, {render_sql(prompts.REPORT_TOP_RESPONSE_LINE,
    name='segment', segment='segment', question=f"substring((SELECT top_question FROM topq), 1, {T['question_chars']})",
    option=render_sql(prompts.REPORT_INTENT_OPTION, value=f"coalesce({py_float_sql('purchase_intent')}, 'N/A')"))} AS line
    FROM rcards WHERE card_rank <= {T['top_responses']}"""))
def q_top_responses(src):
    """Top-response lines built from segment cards (no response summary)."""
    top = rp.top_question(_answers(src)).first()
    return rp.top_responses(_cards(src), top["top_question"] if top else "")


SAMPLES_SQL = f"""SELECT CAST(p_rank AS BIGINT) AS p_rank, CAST(0 AS BIGINT) AS line_no,
           {render_sql(prompts.REPORT_SAMPLE_HEADER, name='persona_name', segment='segment')} AS line
    FROM ap WHERE p_rank <= {T['samples']}
    UNION ALL
    SELECT CAST(ap.p_rank AS BIGINT), a.pos, {render_sql(prompts.REPORT_SAMPLE_ANSWER,
        option="coalesce(a.selected_option, '')", rationale=f"substring(coalesce(a.rationale, ''), 1, {T['rationale_chars']})")}
    FROM ans a JOIN ap ON a.persona_id = ap.persona_id WHERE ap.p_rank <= {T['samples']} AND a.pos <= {T['sample_answers']}"""
AP_CTE = ("ap", """SELECT p.*, row_number() OVER (ORDER BY p.conv_id) AS p_rank
      FROM pers p WHERE p.persona_id IN (SELECT persona_id FROM ans)""")


@register("persona_samples", with_ctes(SAMPLES_SQL, [AP_CTE]))
def q_samples(src):
    """Persona answer samples (5 personas × 2 answers)."""
    return rp.persona_samples(_answers(src), cv.sim_personas(src))


_labels = " ".join(f"WHEN {_q(t)} THEN {_q(lab)}" for t, lab in fixed.REPORT_TYPES)
_instr = " ".join(f"WHEN {_q(t)} THEN {_q(s)}" for t, s in prompts.REPORT_TYPE_INSTRUCTIONS)
_dflt = fixed.DEFAULT_REPORT_TYPE


@register("report_types", with_ctes(f"""SELECT segment, report_type,
    CASE report_type {_labels} ELSE {_q(dict(fixed.REPORT_TYPES)[_dflt])} END AS type_label,
    CASE report_type {_instr} ELSE {_q(dict(prompts.REPORT_TYPE_INSTRUCTIONS)[_dflt])} END AS instruction
    FROM (SELECT segment, [{", ".join(_q(t) for t in REPORT_TYPE_CYCLE)}][((card_rank - 1) % {len(REPORT_TYPE_CYCLE)}) + 1]
          AS report_type FROM rcards)"""))
def q_report_types(src):
    """Report type label / instruction lookup with the 'strategy' default."""
    cycle = F.array(*[F.lit(t) for t in REPORT_TYPE_CYCLE])
    ranked = row_number_within(_cards(src).withColumn("_less", -F.col("n")), [], ["_less", "segment"], "card_rank")
    r = ranked.select(
        "segment", F.element_at(cycle, ((F.col("card_rank") - 1) % len(REPORT_TYPE_CYCLE) + 1).cast("int"))
        .alias("report_type"))
    return rp.report_types(r)


def _summary_sql():
    pc = "CAST((SELECT count(*) FROM pers) AS VARCHAR)"
    rc = "CAST((SELECT count(*) FROM ev WHERE type = 'result') AS VARCHAR)"
    prog = ("CAST(CAST(floor(coalesce((SELECT sum(CAST(type = 'result' AS BIGINT)) * 100 / nullif(count(*), 0) FROM ev), 0.0))"
            " AS BIGINT) AS VARCHAR) || '%'")
    dom = f"coalesce((SELECT segment FROM rcards WHERE card_rank = 1), {_q(fixed.DOMINANT_DEFAULT)})"
    return f"""SELECT {_q(PROJECT + S['title_suffix'])} AS title, {_q(_dflt)} AS type,
        printf({_q(S['summary_body'])}, {_q(PROJECT)}, {pc}, {rc}) AS summary,
        printf({_q(S['findings_body'])}, {dom}) AS findings,
        {_q(S['evidence_segment'] + '=')} || {dom} || {_q('|' + S['evidence_progress'] + '=')} || {prog} AS evidence,
        printf({_q(S['action'])}, {dom}) AS action,
        {_q(S['kpi_progress'] + '=')} || {prog} || {_q('|' + S['kpi_personas'] + '=')} || {pc}
          || {_q('|' + S['kpi_responses'] + '=')} || {rc} AS kpis,
        printf({_q(S['finding_segment'])}, {dom}) || '|' || printf({_q(S['finding_total'])}, {rc}) AS key_findings"""


@register("static_report", with_ctes(_summary_sql()))
def q_static_report(src):
    """The fallback report document (one row)."""
    return rp.static_report(_summary(src), PROJECT)


def _summary(src):
    ev = _events(src)
    prog = rp.response_progress(ev).first()
    dom = rp.dominant_segment(_cards(src)).first()
    n_pers = cv.sim_personas(src).count()
    return src.spark.createDataFrame(
        [(n_pers, prog["response_count"] or 0, prog["response_progress"],
          dom["dominant_segment"] if dom else fixed.DOMINANT_DEFAULT)],
        "persona_count long, response_count long, response_progress long, dominant_segment string")


def report_model_output(src):
    """Model report texts composed around documents: valid, missing sections, broken."""
    d = src.documents
    obj = F.to_json(F.struct(F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("title"),
                             F.array(F.struct(F.lit("s1").alias("id"), F.col("lang").alias("title"), F.col("text").alias("content"),
                                              F.array(F.struct(F.lit("lang").alias("label"), F.col("lang").alias("value"))).alias("evidence"),
                                              F.concat(F.lit("see "), F.col("source")).alias("action")),
                                     F.struct(F.lit("s2").alias("id"), F.col("source").alias("title"), F.col("source").alias("content"),
                                              F.lit(None).cast("array<struct<label:string,value:string>>").alias("evidence"),
                                              F.lit(None).cast("string").alias("action"))).alias("sections"),
                             F.array(F.struct(F.lit("chars").alias("label"), F.col("n_chars").cast("string").alias("value"))).alias("kpis"),
                             F.array("lang", "source").alias("key_findings")))
    v = F.pmod(F.col("doc_id"), F.lit(3))
    raw = (F.when(v == 0, F.concat(F.lit("Report follows:\n"), obj, F.lit("\nEOF")))
           .when(v == 1, F.lit('{"title": "only title"}')).otherwise(F.lit('{"title": ')))
    return d.select("doc_id", raw.alias("raw"))


_PAIRS_SQL = '[{"label": "VARCHAR", "value": "VARCHAR"}]'


def _pairs_sql(x: str) -> str:
    return f"array_to_string(list_transform(from_json({x}, '{_PAIRS_SQL}'), lambda e: concat_ws('=', e.label, e.value)), '|')"


PARSE_REPORT_SQL = with_ctes(f"""SELECT doc_id, CASE WHEN ok THEN 'model' ELSE 'fallback' END AS source,
    CASE WHEN ok THEN b->>'$.title' ELSE st.title END AS title, st.type,
    CASE WHEN ok THEN array_to_string(list_transform(from_json(b->'$.sections',
           '[{{"id": "VARCHAR", "title": "VARCHAR", "content": "VARCHAR", "action": "VARCHAR"}}]'),
           lambda s: concat_ws('|', s.id, s.title, s.content, s.action)), chr(10))
         ELSE {_q('summary|' + S['summary_title'] + '|')} || st.summary || chr(10) || {_q('findings|' + S['findings_title'] + '|')}
           || st.findings || '|' || st.action END AS sections,
    CASE WHEN ok THEN {_pairs_sql("b->'$.kpis'")} ELSE st.kpis END AS kpis,
    CASE WHEN ok THEN array_to_string(from_json(b->'$.key_findings', '["VARCHAR"]'), '|') ELSE st.key_findings END AS key_findings,
    CASE WHEN ok THEN {_pairs_sql("b->'$.sections[0].evidence'")} ELSE st.evidence END AS evidence,
    CAST(CASE WHEN ok THEN coalesce(json_array_length(b, '$.sections'), 0) ELSE 2 END AS BIGINT) AS n_sections,
    CAST({len(fixed.CHARTS)} AS BIGINT) AS n_charts,
    CASE WHEN ok THEN NULL WHEN b = '' THEN 'no_json_object'
         WHEN NOT json_valid(b) OR json_type(b) <> 'OBJECT' THEN 'invalid_json' ELSE 'no_sections' END
      AS fallback_reason
    FROM st, (SELECT doc_id, b, CASE WHEN b <> '' AND json_valid(b) THEN json_type(b) = 'OBJECT'
            AND json_exists(b, '$.sections') ELSE false END AS ok
          FROM (SELECT doc_id, regexp_extract(raw, '(?s)\\{{.*\\}}', 0) AS b FROM (
            SELECT doc_id, CASE doc_id % 3
              WHEN 0 THEN 'Report follows:' || chr(10) || CAST(json_object('title', 'Doc ' || CAST(doc_id AS VARCHAR),
                'sections', [json_object('id', 's1', 'title', lang, 'content', text, 'evidence', [json_object('label', 'lang', 'value', lang)],
                                         'action', 'see ' || source),
                             json_object('id', 's2', 'title', source, 'content', source)],
                'kpis', [json_object('label', 'chars', 'value', CAST(n_chars AS VARCHAR))], 'key_findings', [lang, source]) AS VARCHAR)
                || chr(10) || 'EOF'
              WHEN 1 THEN '{{"title": "only title"}}' ELSE '{{"title": ' END AS raw FROM documents)))""", [("st", _summary_sql())])


@register("parse_report", PARSE_REPORT_SQL)
def q_parse_report(src):
    """Model report parse — needs a sections key, type forced, else the fallback document; whole content."""
    charts = rp.chart_index({}, None)
    document = rp.report_document(_summary(src), charts, PROJECT)
    return rp.report_text(rp.parse_report(report_model_output(src), "doc_id", document))


_NLS = "chr(10)"
RP_CTES = [AP_CTE, ("seglines", SEG_LINES_SQL), ("pats", PATTERNS_SQL), ("samps", SAMPLES_SQL),
           ("patlines", f"""SELECT seg_rank, 0 AS q_rank, 0 AS k, {render_sql(prompts.REPORT_PATTERN_HEADER, segment='segment')} AS line
                FROM (SELECT DISTINCT seg_rank, segment FROM pats)
              UNION ALL SELECT seg_rank, q_rank, 1, {render_sql(prompts.REPORT_PATTERN_OPTION, top_option='top_option')}
                FROM pats WHERE top_option IS NOT NULL AND top_option <> ''
              UNION ALL SELECT seg_rank, q_rank, 2, {render_sql(prompts.REPORT_PATTERN_RATIONALE, rationale='rationale')}
                FROM pats WHERE rationale IS NOT NULL AND rationale <> ''""")]
_label = dict(fixed.REPORT_TYPES)[_dflt]
_instr_text = dict(prompts.REPORT_TYPE_INSTRUCTIONS)[_dflt]
_SAMPLES_AGG = f"(SELECT string_agg(line, {_NLS} ORDER BY p_rank, line_no) FROM samps)"
REPORT_PROMPT_SQL = with_ctes(f"""SELECT {_q(PROJECT)} AS project_name, {_q(_dflt)} AS report_type,
    (SELECT count(*) FROM pers) AS persona_count, (SELECT count(DISTINCT persona_id) FROM ans) AS response_count,
    {render_sql(prompts.REPORT_PROMPT_TEMPLATE, type_label=_q(_label), project_name=_q(PROJECT), purpose="''",
        persona_count="(SELECT count(*) FROM pers)", response_count="(SELECT count(DISTINCT persona_id) FROM ans)",
        dominant_segment=f"coalesce((SELECT segment FROM rcards WHERE card_rank = 1), {_q(fixed.DOMINANT_DEFAULT)})",
        segments=f"coalesce((SELECT string_agg(line, {_NLS} ORDER BY card_rank) FROM seglines), {_q(prompts.REPORT_NO_DATA)})",
        patterns=f"coalesce((SELECT string_agg(line, {_NLS} ORDER BY seg_rank, q_rank, k) FROM patlines), {_q(prompts.REPORT_NO_DATA)})",
        persona_section=f"coalesce({render_sql(prompts.REPORT_SAMPLES_SECTION, samples=_SAMPLES_AGG)}, '')",
        keywords=f"""coalesce((SELECT string_agg({render_sql(prompts.REPORT_KEYWORD_ITEM, keyword='keyword', frequency='frequency')},
            ', ' ORDER BY rank) FROM kwtop), {_q(prompts.REPORT_NO_KEYWORDS)})""",
        instruction=_q(_instr_text), form=_q(prompts.form_example(prompts.REPORT_FORM)))} AS prompt""", RP_CTES)


@register("report_prompt", REPORT_PROMPT_SQL)
def q_report_prompt(src):
    """The report prompt assembled from the bounded report pieces."""
    from persona_engine.operators.report_prompt import build_report_prompt
    return build_report_prompt(src.spark, _cards(src), rp.keyword_items(src.documents), _answers(src),
                               cv.sim_personas(src), PROJECT)


STRENGTH_SQL = """SELECT question_id, selected_option AS top_option, round_even(share * 100.0, 1) AS strength FROM (
    SELECT question_id, selected_option, n / sum(n) OVER (PARTITION BY question_id) AS share,
           row_number() OVER (PARTITION BY question_id ORDER BY n DESC, selected_option NULLS LAST) AS r
    FROM (SELECT question_id, selected_option, count(*) AS n FROM ans GROUP BY question_id, selected_option))
    WHERE r = 1"""


@register("question_strength", with_ctes(STRENGTH_SQL))
def q_question_strength(src):
    """Leading-option strength per question (the area chart series)."""
    return rp.question_strength(rp.option_distribution(_answers(src)))


_TITLES = {cid: (ctype, title) for cid, ctype, title in fixed.CHARTS}
_POINTS = {   # chart → rows, what orders them, its JSON members
    "keyword-radar": ("kwtop", "rank", f"""'subject', keyword, 'dominant', frequency, 'baseline', {fixed.RADAR_BASELINE}, 'fullMark', {fixed.RADAR_FULL_MARK}"""),
    "question-strength": (f"({STRENGTH_SQL})", "question_id", "'question_id', question_id, 'top_option', top_option, 'strength', strength"),
    "age-distribution": ("""(SELECT CASE WHEN usr_age > 0 AND usr_age <= 29 THEN '20s' WHEN usr_age > 29 AND usr_age <= 39 THEN '30s'
            WHEN usr_age > 39 AND usr_age <= 49 THEN '40s' WHEN usr_age > 49 AND usr_age <= 59 THEN '50s'
            WHEN usr_age > 59 AND usr_age <= 100 THEN '60s+' END AS age_band, count(*) AS n FROM demo GROUP BY ALL)""",
                         "age_band NULLS FIRST", "'age_band', age_band, 'n', n"),
    "question-distribution": ("""(SELECT question_id, selected_option, n, round_even(n / sum(n) OVER (PARTITION BY question_id), 3) AS share,
            CAST(row_number() OVER (PARTITION BY question_id ORDER BY n DESC, selected_option NULLS LAST) = 1 AS BIGINT) AS is_top
            FROM (SELECT question_id, selected_option, count(*) AS n FROM ans GROUP BY question_id, selected_option))""",
                              "question_id NULLS FIRST, n DESC, selected_option NULLS FIRST",
                              "'question_id', question_id, 'selected_option', selected_option, 'n', n, 'share', share, 'is_top', is_top"),
    "segment-cards": ("cards", "n DESC, segment NULLS FIRST",
                      "'segment', segment, 'n', n, 'purchase_intent', purchase_intent, 'brand_attitude', brand_attitude"),
}
CHARTS_SQL = " UNION ALL ".join(
    f"SELECT {_q(cid)} AS chart_id, {_q(_TITLES[cid][0])} AS chart_type, "
    + (f"coalesce((SELECT top_question FROM topq), {_q(_TITLES[cid][1])})" if cid == "question-distribution" else _q(_TITLES[cid][1]))
    + f" AS title, row_number() OVER (ORDER BY {order}) AS ord, CAST(json_object({members}) AS VARCHAR) AS point FROM {rows}"
    for cid, (rows, order, members) in _POINTS.items())


@register("report_charts", with_ctes(CHARTS_SQL))
def q_report_charts(src):
    """The points of the five charts attached to every report."""
    ans = _answers(src)
    top = rp.top_question(ans).first()
    return rp.chart_points(rp.keyword_items(src.documents), rp.option_distribution(ans), rp.age_buckets(views.demo(src)), _cards(src),
                           top["top_question"] if top else None)
