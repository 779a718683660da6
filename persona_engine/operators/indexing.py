"""Consecutive row numbers that do not funnel a group through one task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group to
one task; with a group holding a third of the data that task is the job. Here
the rows are range-partitioned on (g, o) instead, so a hot group is spread over
many range partitions; each (partition, group) slice is numbered locally, and a
small table of slice sizes (one row per slice) yields each slice's offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from persona_engine.session import materialize


def row_number_within(df: DataFrame, group_cols: list[str], order_cols: list[str], out: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """1-based consecutive row number per group in (order_cols) order; ties must be broken by the caller."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]
    # slice ids are fixed once written
    sliced = materialize(df.repartitionByRange(n, *keys).withColumn("_slice", F.spark_partition_id()))
    local = sliced.withColumn("_local", F.row_number().over(
        Window.partitionBy("_slice", *group_cols).orderBy(*order_cols)))
    sizes = sliced.groupBy("_slice", *group_cols).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group_cols).orderBy("_slice") if group_cols else Window.orderBy("_slice")
    offsets = sizes.withColumn("_off", F.sum("_n").over(w) - F.col("_n")).drop("_n")
    return (local.join(offsets, ["_slice", *group_cols])
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_slice", "_local", "_off"))


def running_sum_within(df: DataFrame, group_cols: list[str], order_cols: list[str], value: str, out: str = "running",
                       partitions: int | None = None) -> DataFrame:
    """Sum of ``value`` over a group's rows up to and including this one, in (order_cols) order; the same slices as above."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = materialize(df.repartitionByRange(n, *group_cols, *order_cols).withColumn("_slice", F.spark_partition_id()))
    upto = Window.partitionBy("_slice", *group_cols).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    sums = sliced.groupBy("_slice", *group_cols).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*group_cols).orderBy("_slice") if group_cols else Window.orderBy("_slice")
    offsets = sums.withColumn("_off", F.sum("_sum").over(w) - F.col("_sum")).drop("_sum")
    return (sliced.withColumn("_local", F.sum(value).over(upto)).join(offsets, ["_slice", *group_cols])
            .withColumn(out, F.col("_off") + F.col("_local")).drop("_slice", "_local", "_off"))


def as_of(df: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str = "valid_from",
          broadcast_rows: int = 10_000) -> DataFrame:
    """Each row with the version of its key that was valid at its time: the latest ``valid_from`` not after ``at``, else nulls.

    Of versions with the same key and ``valid_from``, the greatest by the other columns
    counts. The versions become intervals first, so the join keeps one row per row. They
    travel to the tasks if there are at most ``broadcast_rows``; else the rows are shuffled
    by key (skewed keys are split by the adaptive join).
    """
    rest = [c for c in versions.columns if c not in (key, valid_from)]
    one = versions.groupBy(key, valid_from).agg(F.max(F.struct(*rest)).alias("_v"))
    until = F.lead(valid_from).over(Window.partitionBy(key).orderBy(valid_from))
    spans = one.select(F.col(key).alias("_key"), F.col(valid_from).alias("_from"), until.alias("_until"), "_v")
    if spans.count() <= broadcast_rows:
        spans = F.broadcast(spans)
    valid = (F.col(at) >= F.col("_from")) & (F.col("_until").isNull() | (F.col(at) < F.col("_until")))
    return df.join(spans, (F.col(key) == F.col("_key")) & valid, "left").select(*df.columns, *[F.col(f"_v.{c}").alias(c) for c in rest])
