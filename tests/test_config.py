"""Parameter validation."""

import pytest

from persona_engine.config import PipelineConfig, SimulationConfig, SurveyConfig


def test_pipeline_bounds():
    PipelineConfig(source_dir="/x")
    for bad in [dict(n_synthetic_customers=99), dict(n_personas=1), dict(n_personas=21), dict(output_dir="  "),
                dict(stats_on="z")]:
        with pytest.raises(ValueError):
            PipelineConfig(source_dir="/x", **bad)
    with pytest.raises(ValueError):
        PipelineConfig(source_dir=" ")


def test_survey_and_simulation_bounds():
    SurveyConfig(project_id="p", user_prompt="u", survey_type="ad")
    with pytest.raises(ValueError):
        SurveyConfig(project_id="p", user_prompt="u", survey_type="ad", question_count=21)
    with pytest.raises(ValueError):
        SimulationConfig(project_id="p", batch_size=0)
