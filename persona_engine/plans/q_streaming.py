"""Registered queries: the streaming forms (C13, I7). Their outputs equal the batch
queries', so they share the batch oracles."""

from __future__ import annotations

from persona_engine.operators.responder import MoodyResponder
from persona_engine.plans import q_derive, q_responses  # noqa: F401  (their oracles are reused below)
from persona_engine.plans.registry import ORACLES, register
from persona_engine.sources import conversations as cv
from persona_engine.streaming.simulation_stream import run_simulation_stream
from persona_engine.streaming.usage_stream import run_weekly_usage_stream


@register("weekly_usage_stream", ORACLES["weekly_usage"])
def q_weekly_stream(src):
    """C13 streamed: watermarked 7-day windows over the events replayed in the order of time."""
    return run_weekly_usage_stream(src.spark, src.sf_dir)[0]


@register("simulation_stream", ORACLES["response_event_log"])
def q_simulation_stream(src):
    """The whole response job as a stream of persona slices; its event log equals the batch job's."""
    return run_simulation_stream(src.spark, cv.sim_personas(src), q_responses.sim_questions(src), "conv_id", MoodyResponder, ["conv_id"])
