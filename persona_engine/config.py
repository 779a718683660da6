"""Validated job parameters, checked on the driver before any read."""

from __future__ import annotations

from dataclasses import dataclass, field


#: Bounds of a pipeline job.
LEAST_CUSTOMERS, PERSONA_BOUNDS = 100, (2, 20)
TOO_FEW_CUSTOMERS = f"n_synthetic_customers must be >= {LEAST_CUSTOMERS}"
PERSONAS_OUT_OF_BOUNDS = f"n_personas must be between {PERSONA_BOUNDS[0]} and {PERSONA_BOUNDS[1]}"


def _non_blank(name: str, value: str) -> str:
    value = (value or "").strip()
    if not value:
        raise ValueError(f"{name} must not be empty")
    return value


@dataclass(frozen=True)
class PipelineConfig:
    """Persona pipeline parameters (synthetic size, persona count, seed, paths)."""

    source_dir: str
    output_dir: str = "./output"
    random_state: int = 42
    n_synthetic_customers: int = 1000
    n_personas: int = 7
    n_init: int = 10
    max_iter: int = 300
    silhouette_sample: int = 2000
    stories_per_cluster: int = 3
    stats_on: str = "raw"            # "raw" | "scaled" (parity with scaled statistics)
    cluster_on: str = "features"     # "features" | "projection"

    def __post_init__(self):
        object.__setattr__(self, "source_dir", _non_blank("source_dir", self.source_dir))
        object.__setattr__(self, "output_dir", _non_blank("output_dir", self.output_dir))
        if self.n_synthetic_customers < LEAST_CUSTOMERS:
            raise ValueError(TOO_FEW_CUSTOMERS)
        if not PERSONA_BOUNDS[0] <= self.n_personas <= PERSONA_BOUNDS[1]:
            raise ValueError(PERSONAS_OUT_OF_BOUNDS)
        if self.stats_on not in ("raw", "scaled"):
            raise ValueError("stats_on must be 'raw' or 'scaled'")
        if self.cluster_on not in ("features", "projection"):
            raise ValueError("cluster_on must be 'features' or 'projection'")


@dataclass(frozen=True)
class SurveyConfig:
    project_id: str
    user_prompt: str
    survey_type: str
    question_count: int = 5
    project_purpose: str = ""
    template: dict = field(default_factory=dict)

    def __post_init__(self):
        _non_blank("project_id", self.project_id)
        if not 1 <= self.question_count <= 20:
            raise ValueError("question_count must be between 1 and 20")


@dataclass(frozen=True)
class SimulationConfig:
    project_id: str
    batch_size: int = 5
    project_name: str = ""
    project_purpose: str = ""

    def __post_init__(self):
        _non_blank("project_id", self.project_id)
        if not 1 <= self.batch_size <= 20:
            raise ValueError("batch_size must be between 1 and 20")


def request_errors(requests):
    """A table of pipeline requests (n_synthetic_customers, n_personas) with ``error``: what ``PipelineConfig`` would raise, or null."""
    from pyspark.sql import functions as F

    n, k = F.col("n_synthetic_customers"), F.col("n_personas")
    few = ~F.coalesce(n >= LEAST_CUSTOMERS, F.lit(False))
    outside = ~F.coalesce(k.between(*PERSONA_BOUNDS), F.lit(False))
    return requests.withColumn("error", F.when(few, TOO_FEW_CUSTOMERS).when(outside, PERSONAS_OUT_OF_BOUNDS))
