"""Model-output parsing (H4/H5, I3/I4, J14) on the literal llm_raw fixture."""

from pyspark.sql import functions as F

from persona_engine.operators import report as rp
from persona_engine.operators import responses as rs
from persona_engine.operators import survey as sv

Q_OK = '{"text": "Q1", "type": "단일선택", "options": ["a", "b"], "rationale": "r1"}'
RAW = [
    ("clean", "[" + Q_OK + "]"),
    ("prose", "Here you go:\n[" + Q_OK + "]\nThanks"),
    ("newline", '[{"text": "line1\\nline2", "type": "주관식", "options": ["x"]}]'),
    ("nonobject", '[42, {"type": "단일선택"}, ' + Q_OK + "]"),
    ("null_rationale", '[{"text": "Q", "type": "리커트척도", "rationale": null}]'),
    ("empty", "[]"),
    ("broken", '[{"text": "Q", '),
    ("nojson", "no json here"),
    ("blank", ""),
]


def test_parse_questions_fixture(spark):
    raw = spark.createDataFrame(RAW, "project_id string, raw string")
    got = {(r["project_id"], r["order"]): r for r in sv.parse_questions(raw).collect()}
    assert set(got) == {("clean", 1), ("prose", 1), ("newline", 1), ("nonobject", 3), ("null_rationale", 1)}
    assert got[("clean", 1)]["options"] == ["a", "b"] and got[("clean", 1)]["ai_rationale"] == "r1"
    assert got[("newline", 1)]["text"] == "line1\nline2" and got[("newline", 1)]["options"] == []
    assert got[("null_rationale", 1)]["ai_rationale"].startswith("태도 강도")   # default for the type
    assert got[("clean", 1)]["id"] == got[("clean", 1)]["id"] and got[("clean", 1)]["id"].startswith("q-")


def test_fallback_for_unparsed_projects(spark):
    req = spark.createDataFrame([(p, "prompt", "ad", 3, "") for p, _ in RAW],
                                "project_id string, user_prompt string, survey_type string, question_count long, "
                                "project_purpose string")
    raw = spark.createDataFrame(RAW, "project_id string, raw string")
    q = sv.with_fallback(req, sv.parse_questions(raw))
    src = {r["project_id"]: r["generation_source"] for r in q.collect()}
    assert src["empty"] == src["broken"] == src["nojson"] == src["blank"] == "fallback"
    assert src["clean"] == "model"
    fb = q.where(F.col("project_id") == "empty").orderBy("order").collect()
    assert [r["order"] for r in fb] == [1, 2, 3] and fb[0]["text"].startswith("prompt - 광고 메시지")


def test_parse_answers_and_route(spark):
    ans = '[{"question_id": "q1", "selected_option": "a", "rationale": "x", "cot": ["s"], "integrity_score": 90.5}]'
    raw = spark.createDataFrame([("p1", "n1", "s", "Sure:\n" + ans + "\nend", None),
                                 ("p2", "n2", "s", "[]", None),
                                 ("p3", "n3", "s", None, "boom"),
                                 ("p4", "n4", "s", "", None)],
                                "persona_id string, persona_name string, segment string, raw string, error string")
    ev = {r["persona_id"]: r for r in rs.route(rs.parse_answers(raw)).collect()}
    assert ev["p1"]["type"] == "result" and ev["p1"]["n_answers"] == 1 and ev["p1"]["message"] is None
    assert ev["p2"]["type"] == "error" and ev["p2"]["message"] == "[]"
    assert ev["p3"]["message"] == "boom"
    assert ev["p4"]["message"] == "응답 파싱 실패"


def _fallback_report(spark):
    summary = spark.createDataFrame([(3, 2, 66, "heavy")], "persona_count long, response_count long, response_progress long, dominant_segment string")
    return rp.report_document(summary, rp.chart_index({}, None), "P")


def test_parse_report_requires_sections(spark):
    raw = spark.createDataFrame([(1, 'x {"title": "T", "sections": [{"id": "a", "title": "b", "content": "c"}]} y'),
                                 (2, '{"title": "T"}'), (3, "{broken")], "doc_id long, raw string")
    got = {r["doc_id"]: r for r in rp.report_text(rp.parse_report(raw, "doc_id", _fallback_report(spark))).collect()}
    assert got[1]["source"] == "model" and got[1]["n_sections"] == 1 and got[1]["title"] == "T"
    assert got[2]["source"] == got[3]["source"] == "fallback"
    assert got[2]["title"].startswith("P") and got[2]["n_sections"] == 2 and got[2]["kpis"] and got[2]["n_charts"] == 5
    assert got[1]["fallback_reason"] is None and got[2]["fallback_reason"] == "no_sections"
    assert got[3]["fallback_reason"] == "no_json_object"


def test_empty_inputs_rejected(spark):
    import pytest
    empty = spark.createDataFrame([], "persona_id string")
    with pytest.raises(ValueError):
        rs.require_non_empty(empty, "personas")


def test_responder_errors_are_captured_per_row(spark):
    from persona_engine.operators.responder import run_responder

    class _Boom:          # defined locally so it ships to the Python workers by value
        def respond(self, prompt):
            if "bad" in prompt:
                raise RuntimeError("model unavailable")
            return '[{"question_id": "q1", "selected_option": "a", "rationale": "r", "cot": [], "integrity_score": 90.0}]'
    df = spark.createDataFrame([("p1", "good prompt"), ("p2", "bad prompt")], "persona_id string, prompt string")
    out = {r["persona_id"]: r for r in run_responder(df, ["persona_id"], "prompt", _Boom).collect()}
    assert out["p1"]["error"] is None and out["p1"]["raw"].startswith("[")
    assert out["p2"]["raw"] is None and out["p2"]["error"] == "model unavailable"
    routed = {r["persona_id"]: r for r in rs.route(rs.parse_answers(
        spark.createDataFrame([(k, "n", "s", v["raw"], v["error"]) for k, v in out.items()],
                              "persona_id string, persona_name string, segment string, raw string, error string")))
        .collect()}
    assert routed["p1"]["type"] == "result" and routed["p2"]["message"] == "model unavailable"


def test_shared_survey_prompts_and_validation(spark):
    import pytest

    from persona_engine.operators import responder as rp
    personas = spark.createDataFrame([("p1", "Ann", "heavy"), ("p2", "Bo", "light")],
                                     "persona_id string, persona_name string, segment string")
    qs = spark.createDataFrame([(1, "q-a", "단일선택", "Q one", ["x", "y"]), (2, "q-b", "주관식", "Q two", [])],
                               "q_order long, question_id string, question_type string, question_text string, "
                               "options array<string>")
    pr = {r["persona_id"]: r for r in rs.build_prompts(personas, qs, None).collect()}
    assert pr["p1"]["n_questions"] == 2
    assert '1. [q-a] (단일선택) Q one\n   options: ["x", "y"]' in pr["p1"]["prompt"] and "Bo" in pr["p2"]["prompt"]
    events, _ = rs.run_simulation(personas, qs, "persona_id", rp.FirstOptionResponder, batch_size=1)
    got = {r["persona_id"]: r for r in events.collect()}
    assert got["p1"]["n_answers"] == 2 and got["p2"]["type"] == "result"
    many = spark.range(1, 23).selectExpr("id AS q_order", "concat('q', id) AS question_id", "'단일선택' AS question_type",
                                         "'t' AS question_text", "array() AS options")
    assert rs.build_prompts(personas, many, None).first()["n_questions"] == 22
    with pytest.raises(ValueError):
        rs.build_prompts(personas, many.limit(0), None)


def test_report_document_nested_and_json(spark, tmp_path):
    import json

    from persona_engine.functions import fixed
    summary = spark.createDataFrame([(10, 7, 70, "ASIA")], "persona_count long, response_count long, "
                                                          "response_progress long, dominant_segment string")
    charts = rp.chart_index({"keyword-radar": 10, "segment-cards": 5}, None)
    doc = rp.report_document(summary, charts, "proj")
    out = str(tmp_path / "report")
    doc.coalesce(1).write.mode("overwrite").json(out)
    rec = json.loads(spark.read.text(out).first()["value"])
    assert rec["title"] == "proj" + fixed.STATIC_REPORT_TEXT["title_suffix"] and rec["type"] == "strategy"
    assert [s["id"] for s in rec["sections"]] == ["summary", "findings"]
    assert "evidence" not in rec["sections"][0] and rec["sections"][1]["evidence"][1]["value"] == "70%"
    assert [c["id"] for c in rec["charts"]] == [c[0] for c in fixed.CHARTS]
    assert rec["charts"][0]["n_points"] == 10 and rec["key_findings"][0].endswith("ASIA")


def test_draft_requests_outside_the_bounds_are_rejected(spark):
    from persona_engine.operators import survey as sv
    req = spark.createDataFrame([("a", 1), ("b", 20), ("c", 21), ("d", 0), ("e", None)], "project_id string, question_count bigint")
    assert [r["project_id"] for r in sv.valid_requests(req).orderBy("project_id").collect()] == ["a", "b"]
    bad = sv.rejected_requests(req).orderBy("project_id").collect()
    assert [(r["project_id"], r["requested_count"]) for r in bad] == [("c", 21), ("d", 0), ("e", None)] and all(r["error"] for r in bad)


def test_a_run_takes_any_number_of_questions(spark):
    from persona_engine.operators.responses import shared_question_block
    q = spark.createDataFrame([(i, f"q{i}", "t", f"text {i}", ["a"]) for i in range(30)],
                              "q_order int, question_id string, question_type string, question_text string, options array<string>")
    block, n = shared_question_block(q)
    assert n == 30 and "[q29]" in block


def test_responder_spreads_and_keeps_answers(spark):
    from persona_engine.operators.responder import PersonaStubResponder, run_responder
    df = spark.createDataFrame([(i, f"cluster_id={i},") for i in range(6)], "cluster_id bigint, prompt string")
    out = run_responder(df, ["cluster_id"], "prompt", PersonaStubResponder, tasks=3, calls_at_once=2)
    got = {r["cluster_id"]: r["raw"] for r in out.collect()}
    assert "Model 0" in got[0] and "keywords" not in got[1] and got[2] == "no profile today"
