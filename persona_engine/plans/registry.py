"""Query registry: key → (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from persona_engine.sources.tables import Sources

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def finalize(df: DataFrame) -> DataFrame:
    """Stable output types: integers → long, float/decimal → double, date → text,
    boolean → 0/1 long, array<string> → '|'-joined text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(t, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.BooleanType):
            c = c.cast("long")
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StringType):
            c = F.array_join(c, "|", "")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(key: str, sql: str | None = None):
    def deco(fn: Callable[[Sources], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(Sources(spark, sf_dir)))
        run.__name__ = f"q_{key}"
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco
