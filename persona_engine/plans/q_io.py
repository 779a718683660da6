"""Registered queries: sinks and their read-back (A3–A5), checked requests (A9, F9, I6), numeric columns."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from persona_engine import config
from persona_engine.operators import features as fe
from persona_engine.operators import personas as pe
from persona_engine.operators import responses as rs
from persona_engine.operators import segment as sg
from persona_engine.plans import pipeline as pl
from persona_engine.plans.oracle_views import _q, with_views
from persona_engine.plans.q_segments import K, PERSONA_SELECT, RULES_SQL, SEED, SEG_CTES, SEG_VIEWS, STATS_SQL
from persona_engine.plans.registry import register
from persona_engine.session import ensure_checkpoint_dir
from persona_engine.sources import conversations as cv
from persona_engine.sources.tables import read_json, write_json, write_parquet


def _folder(src, name: str) -> str:
    return f"{ensure_checkpoint_dir(src.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("parquet_round_trip", with_views(SEG_VIEWS, "SELECT cust_id, persona_cluster, usr_age, usr_cnty_ap2, ltv_r FROM lab", SEG_CTES))
def q_parquet_round_trip(src):
    """A3: the clustered customers written by cluster and read back."""
    labelled = pl.segment(src, K, SEED).labelled.select("cust_id", "persona_cluster", "usr_age", "usr_cnty_ap2", "ltv_r")
    return src.spark.read.parquet(write_parquet(labelled, _folder(src, "clustered"), ["persona_cluster"]))


@register("personas_json", with_views(SEG_VIEWS, PERSONA_SELECT, SEG_CTES + STATS_SQL + [RULES_SQL]))
def q_personas_json(src):
    """A4/A5: the personas written as JSON lines and read back by their schema."""
    personas = pe.personas(pl.stats_frame(pl.segment(src, K, SEED)))
    return read_json(src.spark, write_json(personas, _folder(src, "personas")), personas.schema)


@register("job_requests", f"""SELECT conv_id, n_synthetic_customers, n_personas,
    CASE WHEN n_synthetic_customers < {config.LEAST_CUSTOMERS} THEN {_q(config.TOO_FEW_CUSTOMERS)}
         WHEN n_personas NOT BETWEEN {config.PERSONA_BOUNDS[0]} AND {config.PERSONA_BOUNDS[1]} THEN {_q(config.PERSONAS_OUT_OF_BOUNDS)} END AS error
    FROM (SELECT conv_id, max(length(text)) AS n_synthetic_customers, count(*) AS n_personas FROM conversations GROUP BY conv_id)""")
def q_job_requests(src):
    """Requests (a conversation plays one: longest turn = customers, turns = personas) with what is wrong with them."""
    asked = src.conversations.groupBy("conv_id").agg(F.max(F.length("text")).cast("long").alias("n_synthetic_customers"),
                                                     F.count(F.lit(1)).alias("n_personas"))
    return config.request_errors(asked)


_GROUP = "CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(floor(c_acctbal / 1000) AS BIGINT) AS balance"


@register("cluster_guard", f"""SELECT c_nationkey, balance, count(*) AS n, CASE WHEN count(*) < 2 THEN {_q(sg.TOO_FEW_ROWS)} END AS error
    FROM (SELECT {_GROUP} FROM customer) GROUP BY ALL""")
def q_cluster_guard(src):
    """groups of customers that are too small to be clustered."""
    return sg.group_errors(src.customer.selectExpr("c_nationkey", "CAST(floor(c_acctbal / 1000) AS BIGINT) AS balance"), ["c_nationkey", "balance"])


@register("run_guard", """SELECT coalesce(p.conv_id, q.conv_id) AS conv_id, coalesce(p.n, 0) AS n_personas, coalesce(q.n, 0) AS n_questions,
    CASE WHEN coalesce(p.n, 0) = 0 THEN 'personas is empty' WHEN coalesce(q.n, 0) = 0 THEN 'questions is empty' END AS error
    FROM (SELECT conv_id, CAST(1 AS BIGINT) AS n FROM conversations GROUP BY conv_id HAVING sum(length(text)) >= 1000) p
    FULL OUTER JOIN (SELECT conv_id, count(*) AS n FROM conversations WHERE role = 'user' GROUP BY conv_id) q ON p.conv_id = q.conv_id""")
def q_run_guard(src):
    """Runs without personas (none but those of the regular and heavy segments take part) or questions."""
    return rs.run_errors(cv.sim_personas(src).where("segment <> 'light'"), cv.sim_questions(src), "conv_id")


@register("numeric_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, round_even(CAST(sum({c}) AS DOUBLE), 2) AS total FROM customer"
    for c in ("c_custkey", "c_nationkey", "c_acctbal")))
def q_numeric_columns(src):
    """The numeric columns of a table, found by their types, with their sums."""
    df = src.customer
    kept = fe.numeric_columns(df, df.columns)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in kept]).unpivot([], kept, "column", "x")
    return long.groupBy("column").agg(F.count("x").alias("n"), F.bround(F.sum("x"), 2).alias("total"))
