"""The whole persona-response job, fed incrementally with Structured Streaming.

A job is a folder: ``in`` (personas as they are fed; ``fed`` notes which are whole), ``answers`` (what the model said),
``log`` (the events, A8), ``state`` (personas done) and ``checkpoint``. Each micro-batch
ranks its personas after those done before, writes their prompts, calls the responder,
parses, routes, and appends events and progress rows to the log. Every write is a folder
of the micro-batch's id, overwritten if it is run again, and the answers of a micro-batch
are looked up before the model is called; so a job that died anywhere goes on with the
same log as if it had not, and calls the model again only for answers of tasks that were
under way. The log equals that of the batch job (``responses.run_simulation``) over the
same personas in the same order, whatever the micro-batches were.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.operators import responses as rs
from persona_engine.operators.answer_store import AnswerStore
from persona_engine.operators.indexing import row_number_within
from persona_engine.operators.responder import Responder
from persona_engine.session import ensure_checkpoint_dir, materialize
from persona_engine.sources.tables import write_once

_LOG = "seq bigint, batch bigint, type string, payload string"
_STATE = "done bigint"


class SimulationJob:
    """A response job over ``total`` personas in one folder; made again on the same folder, it goes on where it stopped."""

    def __init__(self, spark: SparkSession, folder: str, questions: DataFrame, key: str | None, factory: Callable[[], Responder],
                 total: int, order_cols: list[str], batch_size: int = fixed.DEFAULT_BATCH_SIZE, project_name: str = "",
                 project_purpose: str = "", **calls):
        if total < 1:
            raise ValueError("personas is empty")
        rs.require_non_empty(questions, "questions")
        self.spark, self.folder, self.questions, self.key, self.factory = spark, folder.rstrip("/"), questions, key, factory
        self.total, self.order_cols, self.batch_size = total, order_cols, batch_size
        self.project_name, self.project_purpose, self.calls = project_name, project_purpose, calls

    def feed(self, personas: DataFrame, name: str) -> None:
        """Personas put before the job under a name; a name fed before is left as it is (a restarted feeder may repeat itself)."""
        write_once(personas, f"{self.folder}/in/{name}", f"{self.folder}/fed/{name}")

    def run(self, files_per_trigger: int = 1) -> None:
        """Works off what was fed and not done yet, ``files_per_trigger`` files a micro-batch."""
        schema = self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.folder}/in").schema
        fed = (self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
               .option("recursiveFileLookup", "true").parquet(f"{self.folder}/in"))
        (fed.writeStream.foreachBatch(self._step).option("checkpointLocation", f"{self.folder}/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())

    def done(self, before: int) -> int:
        """Personas done by micro-batches below ``before``: the number the one before it wrote."""
        if not before:
            return 0
        return self.spark.read.schema(_STATE).parquet(f"{self.folder}/state/step={before - 1}").first()[0]

    def _step(self, personas: DataFrame, step: int) -> None:
        before = self.done(step)
        ranked = row_number_within(personas, [], self.order_cols, "rank").withColumn("rank", F.col("rank") + before)
        ranked = materialize(ranked)
        n = ranked.count()
        store = AnswerStore(self.spark, f"{self.folder}/answers/step={step}")      # this step's only: a look-up never grows with the job
        events = rs.simulate(ranked, self.questions, self.key, store, self.factory, self.project_name, self.project_purpose, **self.calls)
        log = rs.event_log(events, before + 1, before + n, self.total, self.batch_size)
        log.write.mode("overwrite").parquet(f"{self.folder}/log/step={step}")
        self.spark.createDataFrame([(before + n,)], _STATE).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/state/step={step}")

    def log(self) -> DataFrame:
        """The event log so far: seq, batch, type, payload."""
        return self.spark.read.schema(f"{_LOG}, step int").parquet(f"{self.folder}/log").drop("step")


def run_simulation_stream(spark: SparkSession, personas: DataFrame, questions: DataFrame, key: str | None,
                          factory: Callable[[], Responder], order_cols: list[str], slices: int = 4, folder: str | None = None,
                          **options) -> DataFrame:
    """A table of personas fed in ``slices`` by rank and worked off one after the other; the job's event log."""
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/simulation-{uuid.uuid4().hex}"
    ranked = materialize(row_number_within(personas, [], order_cols, "_rank"))
    total = ranked.count()
    job = SimulationJob(spark, folder, questions, key, factory, total, order_cols, **options)
    for k in range(slices):
        part = ranked.where(F.floor((F.col("_rank") - 1) * slices / total) == k).drop("_rank")
        job.feed(part.coalesce(1) if total <= 10_000 * slices else part, f"slice-{k:05d}")
        job.run(files_per_trigger=1_000_000)       # a slice is one micro-batch, however many files it has
    return job.log()
