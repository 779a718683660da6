"""Tables between steps: written to the shared folder, and broadcast only if counted small."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from persona_engine.session import ensure_checkpoint_dir


def store(df: DataFrame) -> DataFrame:
    """The table written as Parquet to the shared checkpoint folder and read again: cuts lineage, columns compressed."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it has at most ``rows`` rows; else as it is, for a join by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df
