"""Spark-native customer-persona analytics engine.

Every public job is a lazy ``DataFrame -> DataFrame`` function; the driver only
ever sees fitted scalars (means, medians, centroids, shares), never rows.
"""

from persona_engine.config import PipelineConfig, SimulationConfig, SurveyConfig
from persona_engine.session import ensure_checkpoint_dir, get_session


def run_pipeline(spark, config):
    """End-to-end persona job (see ``persona_engine.plans.pipeline.run_pipeline``)."""
    from persona_engine.plans.pipeline import run_pipeline as _run
    return _run(spark, config)


def run_eda(spark, source_dir, output_dir):
    """EDA summary sink (see ``persona_engine.plans.pipeline.run_eda``)."""
    from persona_engine.plans.pipeline import run_eda as _run
    return _run(spark, source_dir, output_dir)


__all__ = [
    "PipelineConfig",
    "SimulationConfig",
    "SurveyConfig",
    "get_session",
    "ensure_checkpoint_dir",
    "run_pipeline",
    "run_eda",
]
