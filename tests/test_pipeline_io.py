"""Sinks and read-back (A3–A6), the end-to-end pipeline, stream = batch."""

import os

from pyspark.sql import functions as F

from conftest import SF001, SF01
from persona_engine.config import PipelineConfig
from persona_engine.plans import pipeline as pl
from persona_engine.plans.q_derive import weekly_usage
from persona_engine.sources import views
from persona_engine.sources.tables import Sources, read_json
from persona_engine.streaming.usage_stream import run_weekly_usage_stream


def test_run_pipeline_writes_and_reads_back(spark, tmp_out):
    cfg = PipelineConfig(source_dir=SF001, output_dir=tmp_out, n_synthetic_customers=600, n_personas=4, max_iter=3)
    meta = pl.run_pipeline(spark, cfg)
    assert meta["status"] == "success" and meta["n_personas_generated"] == 4
    syn = spark.read.parquet(meta["outputs"]["synthetic_data"])
    assert syn.count() == 600
    clu = spark.read.parquet(meta["outputs"]["clustered_data"])
    assert os.path.isdir(os.path.join(meta["outputs"]["clustered_data"], "persona_cluster=0"))
    assert clu.groupBy("persona_cluster").count().agg(F.sum("count")).first()[0] == 600
    schema = "cluster_id long, persona_name string, size long, keywords array<string>, source string"
    back = read_json(spark, meta["outputs"]["personas"], schema).collect()
    assert sorted(r["cluster_id"] for r in back) == [0, 1, 2, 3]
    assert sum(r["size"] for r in back) == 600 and all(r["source"] == "fallback" for r in back)
    md = spark.read.json(os.path.join(tmp_out, "pipeline_metadata.json")).first()
    assert md["status"] == "success"


def test_weekly_usage_stream_equals_batch(spark):
    src = Sources(spark, SF001)
    batch = weekly_usage(views.app_usage_events(src))
    stream, _ = run_weekly_usage_stream(spark, SF001)
    cols = sorted(batch.columns)
    assert sorted(map(tuple, batch.select(cols).collect())) == sorted(map(tuple, stream.select(cols).collect()))


def test_simulation_stream_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    a = q["response_event_log"](spark, SF001)
    b = q["simulation_stream"](spark, SF001)
    cols = sorted(a.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, a.select(cols).collect())) == sorted(map(key, b.select(cols).collect()))


def test_weekly_usage_stream_independent_of_session_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        src = Sources(spark, SF001)
        batch = weekly_usage(views.app_usage_events(src))
        stream, _ = run_weekly_usage_stream(spark, SF001)
        cols = sorted(batch.columns)
        assert sorted(map(tuple, batch.select(cols).collect())) == sorted(map(tuple, stream.select(cols).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_run_simulation_end_to_end(spark):
    from persona_engine.operators import responder as rp
    from persona_engine.operators import responses as rs
    from persona_engine.plans.q_responses import sim_questions
    from persona_engine.sources import conversations as cv
    src = Sources(spark, SF001)
    personas = cv.sim_personas(src)
    events, log = rs.run_simulation(personas, sim_questions(src), "conv_id", rp.FirstOptionResponder, batch_size=5)
    ev = events.collect()
    assert len(ev) == personas.count()
    assert all(r["type"] == "result" and r["n_answers"] >= 1 for r in ev)
    pr = rs.read_events(log).where("done is not null or total is not null").collect()
    assert [r["total"] for r in pr if r["type"] == "done"] == [len(ev)]
    assert max(r["done"] for r in pr if r["type"] == "progress") == len(ev)


def test_synthetic_shares_within_three_standard_errors(spark):
    import math

    from persona_engine.operators import synth as sy
    src = Sources(spark, SF01)
    p = sy.fit(views.demo(src), views.clv(src), src.events, views.interests(src))
    n = 20000
    syn = sy.synth_population(spark, n, p, 42)
    d = sy.drift(views.demo(src), syn, sy.DEMO_CATEGORICAL).collect()
    for r in d:
        s = r["source_share"] or 0.0
        se = math.sqrt(max(s * (1 - s), 1e-9) / n)
        assert abs((r["synth_share"] or 0.0) - s) <= 3 * se + 1e-9, r


def test_run_pipeline_clusters_on_projection(spark, tmp_out):
    cfg = PipelineConfig(source_dir=SF001, output_dir=tmp_out, n_synthetic_customers=400, n_personas=3, max_iter=3,
                         cluster_on="projection", stats_on="scaled")
    meta = pl.run_pipeline(spark, cfg)
    assert meta["n_personas_generated"] == 3
    clu = spark.read.parquet(meta["outputs"]["clustered_data"])
    assert clu.count() == 400 and clu.select("persona_cluster").distinct().count() == 3


def test_run_eda_writes_summary(spark, tmp_out):
    path = pl.run_eda(spark, SF001, tmp_out)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert lines == ["=== EDA Summary ===", "Total customers: 150", "Purchase count: 6000"]


def test_report_prompt_without_a_response_summary(spark):
    from persona_engine.functions import fixed, prompts
    from persona_engine.operators import report as rp
    from persona_engine.operators.report_prompt import build_report_prompt
    from persona_engine.plans import q_report
    from persona_engine.sources import conversations as cv
    src = Sources(spark, SF001)
    cards, answers = q_report._cards(src), q_report._answers(src).limit(0)

    def prompt(cards):
        return build_report_prompt(spark, cards, rp.keyword_items(src.documents), answers, cv.sim_personas(src), "p").first()["prompt"]

    top = [r["line"] for r in rp.top_responses(cards, "").orderBy("card_rank").collect()]
    text = prompt(cards)
    assert top and "\n".join(top) in text and prompts.REPORT_NO_RESPONSES not in text
    assert prompts.REPORT_NO_RESPONSES in prompt(cards.limit(0))
