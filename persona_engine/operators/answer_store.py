"""I2, resumable: a job's model answers kept by prompt, so that a restart calls only for what is open.

The store is a folder of Parquet files, one sub-folder for each attempt. A row is an
answer (or the error) under the digest of model name and prompt. An attempt writes with
the file committer that publishes each task's file when the task ends, so an attempt that
dies leaves behind what its finished tasks answered; the next one joins those away and
calls for the rest. At most the calls of tasks under way are made again: keep tasks small
(``prompts_per_task``) where calls are dear.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from persona_engine.operators.responder import NoModelResponder, Responder, map_responder
from persona_engine.session import materialize

_ROW = "prompt_hash string, raw string, error string"


class AnswerStore:
    """The answers under one folder; one job at a time writes to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        # so that there is a folder to read; left alone where one is
        spark.createDataFrame([], _ROW).write.mode("ignore").parquet(f"{self.path}/attempt=0")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(f"{_ROW}, attempt int").parquet(self.path)

    def answers(self) -> DataFrame:
        """One row per prompt: its first answer, or its first error if there is no answer."""
        first = F.struct(F.col("error").isNotNull().alias("failed"), "attempt", "raw", "error")
        return self.rows().groupBy("prompt_hash").agg(F.min(first).alias("a")).select("prompt_hash", "a.raw", "a.error", "a.attempt")

    def answer(self, prompts: DataFrame, key_cols: list[str], prompt_col: str = "prompt",
               factory: Callable[[], Responder] = NoModelResponder, model: str = "", prompts_per_task: int = 64,
               calls_at_once: int = 1, retry_errors: bool = True) -> DataFrame:
        """(keys, prompt) → (keys, raw, error, attempt); equal prompts are asked once. Null prompts count as empty.

        Prompts with an answer in the store are not asked again; those with an error only if ``retry_errors``.
        """
        digest = F.sha2(F.concat_ws("\x1f", F.lit(model), F.coalesce(F.col(prompt_col), F.lit(""))), 256)
        asked = materialize(prompts.select(*key_cols, F.coalesce(F.col(prompt_col), F.lit("")).alias("prompt"), digest.alias("prompt_hash")))
        known = self.answers()
        if retry_errors:
            known = known.where("error is null")
        # min: equal digests are equal prompts, and it is combined before the shuffle, so a prompt that many rows share stays one row
        still_open = asked.groupBy("prompt_hash").agg(F.min("prompt").alias("prompt")).join(known, "prompt_hash", "left_anti")
        n = still_open.count()
        if n:
            attempt = (self.rows().agg(F.max("attempt")).first()[0] or 0) + 1
            tasks = -(-n // max(1, prompts_per_task))
            (map_responder(still_open.repartition(tasks), ["prompt_hash"], "prompt", factory, calls_at_once)
             .write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{self.path}/attempt={attempt}"))
        return asked.drop("prompt").join(self.answers(), "prompt_hash", "left").drop("prompt_hash")
