"""Command line: ``python -m persona_engine pipeline|eda --source DIR --out DIR [options]``."""

from __future__ import annotations

import argparse
import json

from persona_engine.config import PipelineConfig
from persona_engine.plans.pipeline import run_eda, run_pipeline
from persona_engine.session import get_session


def main(argv=None):
    ap = argparse.ArgumentParser(prog="persona_engine")
    ap.add_argument("command", choices=["pipeline", "eda"])
    ap.add_argument("--source", required=True, help="directory with the source parquet tables")
    ap.add_argument("--out", default="./output")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--n-synthetic", type=int, default=1000)
    ap.add_argument("--n-personas", type=int, default=7)
    ap.add_argument("--stats-on", choices=["raw", "scaled"], default="raw")
    ap.add_argument("--cluster-on", choices=["features", "projection"], default="features")
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    if a.command == "eda":
        print(run_eda(spark, a.source, a.out))
        return
    cfg = PipelineConfig(source_dir=a.source, output_dir=a.out, random_state=a.seed,
                         n_synthetic_customers=a.n_synthetic, n_personas=a.n_personas,
                         stats_on=a.stats_on, cluster_on=a.cluster_on)
    print(json.dumps(run_pipeline(spark, cfg), ensure_ascii=False, indent=2))


if __name__ == "__main__":
    main()
