"""C13 as Structured Streaming: weekly usage over the events stream.

Event time is ``ts`` (TIMESTAMP_NTZ in the files, cast to TIMESTAMP because
watermarks need it). Windows are 7-day tumbling windows shifted by 4 days so
they start on Mondays (the epoch is a Thursday), i.e. ISO weeks. Each trigger
emits only the windows it changed (``update`` mode), and a window's state goes when
the watermark passes its end. Rows that come after that are kept apart as late rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from persona_engine.session import ensure_checkpoint_dir
from persona_engine.sources.tables import write_once

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def weekly_usage_streaming(events: DataFrame, watermark: str = "7 days") -> DataFrame:
    """Streaming weekly usage per user × app (same columns as the batch query)."""
    ev = events.select(F.col("user_id").alias("cust_id"), F.col("event_type").alias("app_id"),
                       F.col("ts").cast("timestamp").alias("ts"), "value")
    g = (ev.withWatermark("ts", watermark)
         .groupBy(F.window("ts", "7 days", "7 days", "4 days").alias("w"), "cust_id", "app_id")
         .agg(F.count(F.lit(1)).alias("usage_cnt"),
              F.sum(F.round(F.col("value") * 100).cast("long")).alias("usage_cents"),
              F.min(F.to_date("ts")).alias("fst_usage_date"), F.max(F.to_date("ts")).alias("lst_usage_date")))
    ws = F.to_date(F.col("w.start"))
    return g.select("cust_id", "app_id", ws.alias("week_start"),
                    F.format_string("%d-W%02d", F.year(F.date_add(ws, 3)), F.weekofyear(ws)).alias("usage_month"),
                    F.date_add(ws, 6).alias("week_end"), "usage_cnt",
                    (F.col("usage_cents") / F.lit(100.0)).alias("usage_value"), "fst_usage_date", "lst_usage_date")


class UsageStream:
    """Weekly usage of one feed, in a folder: ``in`` (what was fed), ``out`` (windows by micro-batch), ``late``, ``seen``.

    ``run`` works off what was fed since the last run. State and offsets live in the
    folder's checkpoint, so a restarted query resumes instead of recounting; each micro-batch
    writes to a folder of its id, overwritten on retry. A window whose end the watermark
    (latest time of earlier micro-batches less ``lateness``) has passed is closed: its state
    goes, and rows for it that come later are written to ``late`` instead of being lost.
    """

    def __init__(self, spark: SparkSession, folder: str, lateness: str = "1 day"):
        self.spark, self.folder, self.lateness = spark, folder.rstrip("/"), lateness
        self.progress: list[dict] = []       # of the runs of this object, as Spark reports it

    def feed(self, events: DataFrame, name: str) -> None:
        """Events put before the stream under a name; a name fed before is left as it is."""
        write_once(events.select("event_id", "ts", "user_id", "event_type", "value", "props"), f"{self.folder}/in/{name}", f"{self.folder}/fed/{name}")

    def run(self) -> None:
        """One micro-batch over what was fed since the last run."""
        # the files hold wall-clock TIMESTAMP_NTZ; the watermark needs TIMESTAMP, and that
        # cast uses the session zone — pin UTC while the stream runs so the Monday-aligned
        # windows are wall-clock weeks whatever zone the caller's session uses
        spark, zone = self.spark, self.spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            for name, stream, sink in (("late", lambda e: e, self._note_late), ("out", lambda e: weekly_usage_streaming(e, self.lateness), self._windows)):
                fed = spark.readStream.schema(EVENTS_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.folder}/in")
                q = (stream(fed).writeStream.outputMode("update" if name == "out" else "append").foreachBatch(sink)
                     .option("checkpointLocation", f"{self.folder}/checkpoint-{name}").trigger(availableNow=True).start())
                q.awaitTermination()
                if name == "out":
                    self.progress += [p for p in q.recentProgress]
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    def _windows(self, batch: DataFrame, step: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.folder}/out/step={step}")

    def _note_late(self, batch: DataFrame, step: int) -> None:
        before = self.spark.read.schema("latest timestamp").parquet(f"{self.folder}/seen/step={step - 1}").first()[0] if step else None
        ts = F.col("ts").cast("timestamp")
        end = F.date_trunc("week", ts) + F.expr("INTERVAL 7 days")
        passed = F.lit(before) - F.expr(f"INTERVAL {self.lateness}") if before is not None else F.lit(None).cast("timestamp")
        batch.where(end <= passed).write.mode("overwrite").parquet(f"{self.folder}/late/step={step}")
        latest = batch.agg(F.greatest(F.max(ts), F.lit(before).cast("timestamp")).alias("latest"))
        latest.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/seen/step={step}")

    def windows(self) -> DataFrame:
        """The latest version of every window."""
        versions = self.spark.read.parquet(f"{self.folder}/out")
        keys = ["cust_id", "app_id", "week_start"]
        rest = [c for c in versions.columns if c not in (*keys, "step")]
        return versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "step").alias("r")).select(*keys, "r.*")

    def late_rows(self) -> DataFrame:
        return self.spark.read.schema(EVENTS_SCHEMA).parquet(f"{self.folder}/late")

    def state_rows(self) -> list[int]:
        """Windows held in state after each micro-batch of this object's runs."""
        return [o["numRowsTotal"] for p in self.progress for o in p["stateOperators"]]


def run_weekly_usage_stream(spark: SparkSession, sf_dir: str, slices: int = 4, lateness: str = "1 day",
                            folder: str | None = None) -> tuple[DataFrame, UsageStream]:
    """The events table replayed in the order of time, in ``slices`` of about equal size; (windows, the stream).

    The table's rows are in no order; replayed as they lie they would need a watermark of
    the table's whole span. One pass deals them into slices of time, which are then fed one
    after the other: the state holds the open weeks only.
    """
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-usage-{uuid.uuid4().hex}"
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    stream = UsageStream(spark, folder, lateness)
    second = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx(second, [k / slices for k in range(1, slices)], 1000).alias("q")).first()["q"] or []
    place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < second)) if cuts else F.lit(0)
    events.withColumn("slice", F.coalesce(place, F.lit(0))).write.mode("overwrite").partitionBy("slice").parquet(f"{folder}/slices")
    dealt = spark.read.parquet(f"{folder}/slices")
    for k in range(slices):
        stream.feed(dealt.where(F.col("slice") == k), f"slice-{k:05d}")
        stream.run()
    return stream.windows(), stream
