"""Named source tables (A1/A2) and sinks."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


class Sources:
    """Lazy registry of the parquet tables under one directory.

    Nothing is read until a DataFrame is used; Catalyst prunes columns and
    pushes filters into each scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.table(name)
        raise AttributeError(name)


def scalar(df: DataFrame):
    """First column of the single row of a global aggregate (a fitted parameter)."""
    row = df.first()
    return None if row is None else row[0]


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_once(df: DataFrame, path: str, marker: str) -> bool:
    """Written under ``path`` unless ``marker`` says that an earlier call has done so; what a call that died left is overwritten."""
    spark = df.sparkSession
    try:
        if spark.read.schema("done boolean").parquet(marker).count():
            return False
    except AnalysisException:       # no such folder yet
        pass
    df.write.mode("overwrite").parquet(path)
    spark.createDataFrame([(True,)], "done boolean").coalesce(1).write.mode("overwrite").parquet(marker)
    return True


def write_json(df: DataFrame, path: str) -> str:
    """JSON-lines sink (one persona per line)."""
    df.write.mode("overwrite").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read back a JSON sink with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def metadata_frame(spark: SparkSession, meta: dict) -> DataFrame:
    """One-row run-metadata table; nested values are stored as JSON text."""
    flat = {k: (json.dumps(v, ensure_ascii=False) if isinstance(v, (dict, list)) else v) for k, v in meta.items()}
    return spark.createDataFrame([flat])


def table_row_counts(src: Sources, names: list[str]) -> DataFrame:
    """Row count per named table, as one union of tiny global aggregates."""
    parts = [src.table(n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
