"""Answers kept over restarts, the streamed job, its event log."""

import json
import os
from collections import Counter

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from persona_engine.operators import responder as rp
from persona_engine.operators import responses as rs
from persona_engine.operators.answer_store import AnswerStore
from persona_engine.sources.tables import Sources
from persona_engine.streaming.simulation_stream import SimulationJob, run_simulation_stream


def counting(folder, dies_at=None):
    """A responder that notes every call in a file and dies (no caught failure) at one prompt while a flag file is missing."""

    class Counting(rp.Responder):        # local, so that it travels to the workers by value
        def respond(self, prompt):
            if dies_at and dies_at in prompt and not os.path.exists(f"{folder}/up"):
                raise SystemExit("killed")
            with open(f"{folder}/calls", "a") as f:
                f.write(json.dumps(prompt) + "\n")
            if prompt.endswith("-bad"):
                raise RuntimeError("no answer")
            return prompt.upper()

    return Counting


def calls(folder):
    if not os.path.exists(f"{folder}/calls"):
        return Counter()
    with open(f"{folder}/calls") as f:
        return Counter(json.loads(line) for line in f)


def prompts_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "k long, prompt string")


def test_answers_are_asked_once(spark, tmp_out):
    texts = [f"p{i}" for i in range(30)] + ["p1", "p1", None, "", "x-bad"]
    store = AnswerStore(spark, f"{tmp_out}/store")
    got = {r["k"]: r for r in store.answer(prompts_frame(spark, texts), ["k"], "prompt", counting(tmp_out), prompts_per_task=4).collect()}
    assert len(got) == len(texts) and got[30]["raw"] == "P1" == got[31]["raw"] and got[32]["raw"] == "" and got[34]["error"] == "no answer"
    assert set(calls(tmp_out).values()) == {1} and len(calls(tmp_out)) == 32
    # a second job over more rows asks for what is new, and again for what failed
    more = AnswerStore(spark, f"{tmp_out}/store").answer(prompts_frame(spark, texts + ["new"]), ["k"], "prompt", counting(tmp_out))
    assert {r["k"]: r["attempt"] for r in more.collect()} == {**{k: 1 for k in got}, 34: 1, 35: 2}
    n = calls(tmp_out)
    assert n.pop("x-bad") == 2 and n.pop("new") == 1 and set(n.values()) == {1}
    store.answer(prompts_frame(spark, texts), ["k"], "prompt", counting(tmp_out), retry_errors=False).collect()
    assert calls(tmp_out)["x-bad"] == 2
    # another model's answers are its own
    other = store.answer(prompts_frame(spark, ["p1"]), ["k"], "prompt", counting(tmp_out), model="b").collect()
    assert other[0]["raw"] == "P1" and calls(tmp_out)["p1"] == 2


def test_killed_run_keeps_what_ended(spark, tmp_out):
    texts = [f"p{i:03d}" for i in range(64)]
    store = AnswerStore(spark, f"{tmp_out}/store")
    ask = lambda: store.answer(prompts_frame(spark, texts), ["k"], "prompt", counting(tmp_out, "p040"), prompts_per_task=2)
    with pytest.raises(Exception):
        ask()
    kept = {r["raw"].lower() for r in store.rows().where("raw is not null").collect()}
    before = calls(tmp_out)
    assert kept <= set(before) and "p040" not in kept and kept
    open(f"{tmp_out}/up", "w").close()
    got = ask().collect()
    assert sorted(r["raw"] for r in got) == [t.upper() for t in texts]
    again = calls(tmp_out) - before
    assert set(again) == set(texts) - kept and set(again.values()) == {1}     # no call of an ended task is made again


def personas_frame(spark, n):
    return spark.range(1, n + 1).select(F.concat(F.lit("c"), F.col("id")).alias("persona_id"), F.col("id").alias("conv_id"),
                                        F.concat(F.lit("Persona "), F.col("id")).alias("persona_name"), F.lit("heavy").alias("segment"))


def survey(spark):
    return spark.createDataFrame([(1, "q1", "단일선택", "One?", ["x", "y"]), (2, "q2", "주관식", "Two?", [])],
                                 "q_order long, question_id string, question_type string, question_text string, options array<string>")


def plain_log(n, batch_size):
    """Event order of the sequential job: (type, persona or done)."""
    out = []
    for i in range(1, n + 1):
        mood = "error" if i % 4 == 3 or i % 5 == 4 or i % 7 == 5 else "result"
        out.append((mood, f"c{i}"))
        if i % batch_size == 0 or i == n:
            out.append(("progress", i))
    return out + [("done", n)]


def log_items(log):
    rows = log.orderBy("seq").collect()
    assert [r["seq"] for r in rows] == list(range(1, len(rows) + 1))
    out = []
    for r in rows:
        e = json.loads(r["payload"])
        assert e["type"] == r["type"]
        out.append((e["type"], e.get("persona_id", e.get("done", e.get("total")))))
    return out


@pytest.mark.parametrize("n,batch_size", [(23, 5), (20, 5), (3, 5), (1, 1)])
def test_event_log_is_the_sequential_jobs(spark, n, batch_size):
    events, log = rs.run_simulation(personas_frame(spark, n), survey(spark), None, rp.MoodyResponder, order_cols=["conv_id"], batch_size=batch_size)
    assert log_items(log) == plain_log(n, batch_size)
    back = {r["persona_id"]: r for r in rs.read_events(log).where("persona_id is not null").collect()}
    for r in events.collect():
        b = back[r["persona_id"]]
        assert b["type"] == r["type"] and (b["answers"] or []) == r["answers"] and b["message"] == r["message"]


def test_stream_equals_batch_and_survives_a_kill(spark, tmp_out):
    personas, n = personas_frame(spark, 23), 23
    batch = sorted(rs.run_simulation(personas, survey(spark), None, rp.MoodyResponder, order_cols=["conv_id"])[1].collect())
    for slices in (1, 4):
        assert sorted(run_simulation_stream(spark, personas, survey(spark), None, rp.MoodyResponder, ["conv_id"], slices).collect()) == batch

    class Dying(rp.MoodyResponder):
        def respond(self, prompt):
            if "name=Persona 13\n" in prompt and not os.path.exists(f"{tmp_out}/up"):
                raise SystemExit("killed")
            with open(f"{tmp_out}/calls", "a") as f:
                f.write(json.dumps(prompt) + "\n")
            return super().respond(prompt)

    def job():
        return SimulationJob(spark, f"{tmp_out}/job", survey(spark), None, Dying, n, ["conv_id"], prompts_per_task=1)

    for k in range(3):
        job().feed(personas.where(F.floor((F.col("conv_id") - 1) / 8) == k).coalesce(1), f"part-{k}")
        if k == 1:
            with pytest.raises(Exception):
                job().run(1_000)
            kept = AnswerStore(spark, f"{tmp_out}/job/answers/step=1").rows().where("raw is not null").count()
            before = calls(tmp_out)
            open(f"{tmp_out}/up", "w").close()
        job().run(1_000)                                    # a new object on the same folder: a restarted driver
        if k == 1:
            again = calls(tmp_out) - before
            failed = 2                                      # personas 9 and 14 fail without dying and are asked again
            assert sum(again.values()) <= 8 - kept + failed
    assert sorted(job().log().collect()) == batch
    job().run(1_000)                                        # nothing new: nothing happens
    assert sorted(job().log().collect()) == batch


def test_personas_without_questions_and_empty_input(spark):
    from persona_engine.plans.q_responses import sim_questions
    from persona_engine.sources import conversations as cv
    src = Sources(spark, SF001)
    personas = cv.sim_personas(src)
    some = sim_questions(src).where("conv_id % 2 = 0")
    events, log = rs.run_simulation(personas, some, "conv_id", rp.FirstOptionResponder, order_cols=["conv_id"])
    ev = events.collect()
    assert len(ev) == personas.count() and {r["type"] for r in ev} == {"result", "error"}
    assert max(r["seq"] for r in log.collect()) == log.count()
    with pytest.raises(ValueError):
        rs.run_simulation(personas.limit(0), some, "conv_id", rp.FirstOptionResponder)
    with pytest.raises(ValueError):
        rs.run_simulation(personas, some.limit(0), "conv_id", rp.FirstOptionResponder)
