"""Pluggable responder (the hosted-model boundary) run as an Arrow-batched task.

A responder maps a batch of prompt texts to raw model texts. It is built
*inside* each task from a picklable factory, so credentials never travel with
the plan and a lost executor simply rebuilds it. Per-row failures are captured
in an ``error`` column instead of failing the batch.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame

from persona_engine.session import materialize


class Responder:
    """Protocol: ``respond(prompt) -> raw text``; may raise."""

    def respond(self, prompt: str) -> str:  # pragma: no cover - interface
        raise NotImplementedError


class NoModelResponder(Responder):
    """No model configured: every call returns an empty string (→ fallbacks / error events)."""

    def respond(self, prompt: str) -> str:
        return ""


_Q_LINE = re.compile(r"^\d+\. \[([^\]]*)\] \(([^)]*)\) .*$", re.M)
_OPTS = re.compile(r"^   options: \[(.*)\]$", re.M)


class FirstOptionResponder(Responder):
    """Deterministic stub for tests: answers each listed question with its first option."""

    def respond(self, prompt: str) -> str:
        ids = _Q_LINE.findall(prompt)
        opts = _OPTS.findall(prompt)
        out = []
        for i, (qid, _t) in enumerate(ids):
            first = opts[i].split(",")[0].strip().strip('"') if i < len(opts) and opts[i] else ""
            out.append('{"question_id": "%s", "selected_option": "%s", "rationale": "stub", "cot": [], '
                       '"integrity_score": 90.0}' % (qid, first))
        return "[" + ", ".join(out) + "]"


class MoodyResponder(Responder):
    """Deterministic stub: by the number in the persona's name it answers, breaks off, fails or stays silent."""

    def respond(self, prompt: str) -> str:
        number = int(re.search(r"^name=Persona (\d+)$", prompt, re.M).group(1))
        if number % 4 == 3:
            return '[{"question_id": '
        if number % 5 == 4:
            raise RuntimeError(f"no model for persona {number}")
        if number % 7 == 5:
            return ""
        answers = [{"question_id": qid, "selected_option": f"choice {number % 3}", "rationale": f"{qid} suits persona {number}",
                    "cot": ["read", qid], "integrity_score": 85.0 + number % 15} for qid, _ in _Q_LINE.findall(prompt)]
        return "Answers:\n" + json.dumps(answers) + "\nend"


class DraftStubResponder(Responder):
    """Deterministic stub for survey drafts: by the number of questions asked for it fails, breaks off or drafts them."""

    def respond(self, prompt: str) -> str:
        n = int(re.match(r"Draft (\d+) questions", prompt).group(1))
        if n % 3 == 0:
            raise RuntimeError("no model for drafts")
        if n % 5 == 1:
            return '[{"text": '
        return "Here:\n" + json.dumps([{"text": f"Question {i} of {n}", "options": ["a", f"b{i}"], "rationale": f"because {i}"}
                                       for i in range(1, n + 1)])


class LateResponder(FirstOptionResponder):
    """Deterministic stub for restarts: fails for one segment unless ``up``."""

    def __init__(self, down_for: str, up: bool):
        self.down_for, self.up = down_for, up

    def respond(self, prompt: str) -> str:
        if not self.up and f"\nsegment={self.down_for}\n" in prompt:
            raise RuntimeError("model is down")
        return super().respond(prompt)


class PersonaStubResponder(Responder):
    """Deterministic stub for profile and story prompts: whole, partial and broken answers in turn."""

    def respond(self, prompt: str) -> str:
        if prompt.startswith("Customer rows:"):
            rows = json.loads(prompt[prompt.index("["):prompt.rindex("]\nReturn") + 1])
            if rows and rows[0]["cust_id"] % 3 == 0:
                return "[{broken"
            return "Stories:\n" + json.dumps([{"index": i, "name": f"N{r['cust_id']}", "job": "stub", "personality": r["usr_gndr"],
                                               "samsung_experience": "stub"} for i, r in enumerate(rows)])
        cluster = int(re.search(r"cluster_id=(\d+)", prompt).group(1))
        if cluster % 3 == 2:
            return "no profile today"
        profile = {"persona_name": f"Model {cluster}"}
        if cluster % 3 == 0:
            profile |= {"description": 'says "hi"', "keywords": ["k1", "k2"], "age_range": "30-39"}
        return "Profile: " + json.dumps(profile)


def map_responder(df: DataFrame, key_cols: list[str], prompt_col: str,
                  factory: Callable[[], Responder] = NoModelResponder, calls_at_once: int = 1) -> DataFrame:
    """(keys, prompt) → (keys, raw, error), one responder per task, up to ``calls_at_once`` calls of a task under way.

    Lazy: each action calls the model. A failing call is the row's ``error``.
    """
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in df.select(*key_cols).schema.fields]
                       + ["raw string", "error string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        responder = factory()

        def call(prompt):
            try:
                return responder.respond(prompt or ""), None
            except Exception as e:  # noqa: BLE001 - per-row capture is the contract
                return None, str(e)

        with ThreadPoolExecutor(max_workers=max(1, calls_at_once)) as pool:
            for b in batches:
                got = list(pool.map(call, b[prompt_col].tolist()))
                out = b[key_cols].copy()
                out["raw"] = [r for r, _ in got]
                out["error"] = [e for _, e in got]
                yield out

    return df.select(*key_cols, prompt_col).mapInPandas(run, schema)


def run_responder(df: DataFrame, key_cols: list[str], prompt_col: str,
                  factory: Callable[[], Responder] = NoModelResponder, tasks: int | None = None,
                  calls_at_once: int = 1) -> DataFrame:
    """``map_responder`` over ``tasks`` partitions, the answers written to the shared
    checkpoint folder, so no later action calls the model again. A job that should survive
    a restart of its driver takes an ``AnswerStore`` instead.
    """
    return materialize(map_responder(df.repartition(tasks) if tasks else df, key_cols, prompt_col, factory, calls_at_once))
