"""C11 at scale: distinct counts from mergeable sketches, kept per part of the data.

An exact distinct count over all parts shuffles every value again whenever a part is
added. A HyperLogLog sketch per part is some kilobytes; the count over any set of parts is
the union of theirs. The relative standard error is about ``1.04 / sqrt(2 ** lg_size)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_SIZE = 12


def relative_error(lg_size: int = LG_SIZE) -> float:
    return 1.04 / 2 ** (lg_size / 2)


def distinct_sketches(df: DataFrame, part_cols: list[str], column: str, lg_size: int = LG_SIZE) -> DataFrame:
    """part_cols, sketch: one sketch of the non-null values of each part, filled in the tasks and merged."""
    return df.groupBy(*part_cols).agg(F.hll_sketch_agg(column, lg_size).alias("sketch"))


def estimate_distinct(sketches: DataFrame, by: list[str]) -> DataFrame:
    """by, n: the estimated number of distinct values over the parts of each group."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))
