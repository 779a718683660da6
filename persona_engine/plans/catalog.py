"""All registered queries (importing the query modules fills the registry)."""

from persona_engine.plans import q_derive, q_embeddings, q_io, q_personas, q_report, q_responses, q_segments, q_streaming, q_survey, q_synth  # noqa: F401
from persona_engine.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
