"""Fitted marginals (C1–C5, D1): every fit is one aggregate whose output size is
bounded by the number of columns or distinct category values, never by rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from persona_engine.functions import fixed
from persona_engine.functions.expr import clip
from persona_engine.operators.indexing import running_sum_within


def categorical_shares(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n, share) per categorical column; nulls excluded.

    Unpivot → one groupBy(column, value) with map-side combine → share via a
    window over the (tiny) aggregated rows.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy("column"))
    return counts.withColumn("share", F.col("n") / tot)


def levels(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n, lo, hi): the values of each column by count desc, value asc, as neighbouring
    intervals of [0, 1) of the width of their share; nulls excluded. However many values there are, they
    are neither collected nor ordered in one task."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = running_sum_within(counts.withColumn("_less", -F.col("n")), ["column"], ["_less", "value"], "n", "upto")
    total = upto.groupBy("column").agg(F.sum("n").alias("total"))       # one row a column
    return upto.join(F.broadcast(total), "column").select(
        "column", "value", "n", ((F.col("upto") - F.col("n")) / F.col("total")).alias("lo"), (F.col("upto") / F.col("total")).alias("hi"))


def numeric_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and sample std per numeric column (one aggregate, then unpivoted)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
                 F.stddev_samp(F.col(c).cast("double")).alias(f"{c}__std")]
    row = df.agg(*aggs)
    parts = [row.select(F.lit(c).alias("column"), F.col(f"{c}__mean").alias("mean"),
                        F.col(f"{c}__std").alias("std")) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fit_numeric(df: DataFrame, cols: list[str]) -> dict:
    r = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"{c}__m") for c in cols],
               *[F.stddev_samp(F.col(c).cast("double")).alias(f"{c}__s") for c in cols]).first()
    return {c: (r[f"{c}__m"], r[f"{c}__s"]) for c in cols}


def flag_rates(df: DataFrame, cols: list[str]) -> DataFrame:
    """Bernoulli rate of 0/1 flags (mean of the non-null values)."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    return row.unpivot([], cols, "column", "rate")


def lognormal_params(df: DataFrame, col: str, sigma: float | None = None) -> DataFrame:
    """C4: after clipping at 1, mu = ln(mean), sigma = std / mean (or fixed); missing values don't count."""
    x = clip(F.col(col).cast("double"), 1.0)
    m = F.avg(x)
    s = F.lit(float(sigma)) if sigma is not None else F.stddev_samp(x) / m
    return df.agg(F.log(m).alias("mu"), s.alias("sigma")).select(F.lit(col).alias("column"), "mu", "sigma")


def interest_means(interests: DataFrame) -> DataFrame:
    """Mean interest score per interest."""
    return interests.groupBy("interest").agg(F.avg("interest_score").alias("mean_score"),
                                             F.count(F.lit(1)).alias("n"))


def top_interests(means: DataFrame, n: int = fixed.TOP_INTERESTS) -> DataFrame:
    """Top-n interests by mean (ties → name order)."""
    w = Window.orderBy(F.desc("mean_score"), F.asc("interest"))
    return means.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
