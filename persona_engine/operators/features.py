"""Encoding, imputation, standardisation and the feature matrix.

Fitting is a single global aggregate per step (medians, then mean and
population std); the fitted scalars travel to executors as literals inside a
projection, so applying them is a map-only stage with no shuffle and no join.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from persona_engine.functions import fixed
from persona_engine.functions.expr import flag, present, starts_with_active
from persona_engine.operators.indexing import row_number_within
from persona_engine.session import materialize

# Precision of the quantiles that bracket a median: the bracket holds about 4 / accuracy of the rows.
BRACKET_ACCURACY = 10_000
# Distinct values of all brackets that are counted one by one on the driver; wider brackets are narrowed first.
BRACKET_VALUES = 200_000


def encode_gender(df: DataFrame, src: str = "usr_gndr", out: str = "usr_gndr_enc") -> DataFrame:
    """B2: 1 when 'M', else 0 (null → 0)."""
    return df.withColumn(out, flag(F.col(src) == "M"))


def encode_active(df: DataFrame, src: str = "sa_activeness", out: str = "is_active") -> DataFrame:
    """1 when the text starts with 'Active' ('Inactive' → 0, null → 0)."""
    return df.withColumn(out, starts_with_active(src))


# Values of which each may become a column; a wider domain is clustered without columns (sparse_segment).
ONE_HOT_COLUMNS = 2_048


def one_hot_values(df: DataFrame, column: str) -> list | None:
    """Sorted distinct non-null values of a column (each becomes a column of the result); None if there are too many."""
    vals = df.select(column).where(F.col(column).isNotNull()).distinct().limit(ONE_HOT_COLUMNS + 1).collect()
    return None if len(vals) > ONE_HOT_COLUMNS else sorted(r[0] for r in vals)


def one_hot(df: DataFrame, column: str = "usr_cnty_ap2", prefix: str = "region",
            values: list | None = None) -> tuple[DataFrame, list[str]]:
    """``region_<value>`` 0/1 columns (sorted; null → all 0; skipped if the column is absent).

    More than ``ONE_HOT_COLUMNS`` values are an error: ``value_index`` numbers any number of
    them, and ``sparse_segment`` clusters on them without columns.
    """
    if column not in df.columns:
        return df, []
    values = one_hot_values(df, column) if values is None else values
    if values is None:
        raise ValueError(f"{column} has more than {ONE_HOT_COLUMNS} values")
    names = [f"{prefix}_{v}" for v in values]
    cols = [flag(F.col(column) == F.lit(v)).alias(n) for v, n in zip(values, names)]
    return df.select("*", *cols), names


def value_index(df: DataFrame, column: str) -> DataFrame:
    """value, index (from 0 in value order): the distinct non-null values numbered over range partitions, not in one task."""
    values = df.select(F.col(column).alias("value")).where("value is not null").distinct()
    return row_number_within(values, [], ["value"], "index").withColumn("index", F.col("index") - 1)


def one_hot_sparse(df: DataFrame, column: str, out: str = "region_vector") -> DataFrame:
    """B4 for a domain of any size: a sparse vector with a 1 at the value's index; null → no 1.

    The index is joined on: values are neither collected nor made columns.
    """
    index = materialize(value_index(df, column))
    n = index.count()
    # a null has the index after the last value, which the encoder leaves out
    keyed = df.join(index, F.col(column) == F.col("value"), "left").withColumn("index", F.coalesce("index", F.lit(n)).cast("double")).drop("value")
    sizes = df.sparkSession.createDataFrame([(float(n),)], "index double")
    model = OneHotEncoder(inputCols=["index"], outputCols=[out], dropLast=True).fit(sizes)
    return model.transform(keyed).drop("index")


def encode_all(df: DataFrame, regions: list | None = None, region_columns: bool = True) -> tuple[DataFrame, list[str]]:
    """Encodings plus the full clustered feature list, with a column per region if asked."""
    df = encode_active(encode_gender(df))
    df, region_cols = one_hot(df, values=regions) if region_columns else (df, [])
    return df, list(fixed.FEATURE_COLS) + ["usr_gndr_enc", "is_active"] + region_cols


def numeric_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Keep numeric columns only."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in cols if isinstance(types.get(c), NumericType)]


def fit_medians(df: DataFrame, cols: list[str]) -> dict:
    """C6 fit: interpolated median per column over its present values (none → null), one way at every size.

    One aggregate counts the values and brackets each median between two quantiles that
    are sure to lie on either side of it. A second pass counts the values below each
    bracket and each distinct value inside it (partial counts per task); the middle ranks
    are then looked up. Brackets that hold too many distinct values are narrowed by
    another round of quantiles inside them.
    """
    if not cols:
        return {}
    x = {c: present(c) for c in cols}
    wide = [0.5 - 2 / BRACKET_ACCURACY, 0.5 + 2 / BRACKET_ACCURACY]
    row = df.agg(*[F.count(x[c]).alias(f"{c}__n") for c in cols],
                 *[F.percentile_approx(x[c], wide, BRACKET_ACCURACY).alias(f"{c}__q") for c in cols]).first()
    n = {c: row[f"{c}__n"] for c in cols}
    bracket = {c: tuple(row[f"{c}__q"]) for c in cols if n[c]}
    long = df.select(*[x[c].alias(c) for c in bracket]).unpivot([], list(bracket), "feature", "value").where("value is not null") \
        if bracket else None
    counts: dict = {c: [] for c in bracket}
    while bracket:
        lo = F.create_map(*[F.lit(v) for c, (a, _) in bracket.items() for v in (c, a)])[F.col("feature")]
        hi = F.create_map(*[F.lit(v) for c, (_, b) in bracket.items() for v in (c, b)])[F.col("feature")]
        place = F.when(F.col("value") < lo, F.lit(float("-inf"))).when(F.col("value") > hi, F.lit(float("inf"))).otherwise(F.col("value"))
        at = long.where(F.col("feature").isin(list(bracket))).groupBy("feature", place.alias("value")).agg(F.count(F.lit(1)).alias("n"))
        got = at.limit(BRACKET_VALUES + 1).collect()
        if len(got) <= BRACKET_VALUES:
            for r in got:
                counts[r["feature"]].append((r["value"], r["n"]))
            break
        # the middle's rank inside the bracket, from the counts below it
        below = {r["feature"]: r["n"] for r in at.where(F.col("value") == float("-inf")).collect()}
        inside = {r["feature"]: r["n"] for r in at.where(F.abs("value") < float("inf")).groupBy("feature").agg(F.sum("n").alias("n")).collect()}
        mid = {c: (n[c] / 2 - below.get(c, 0)) / inside[c] for c in bracket}
        one = long.where((F.col("value") >= lo) & (F.col("value") <= hi))
        q = one.groupBy("feature").agg(*[F.percentile_approx("value", [max(0.0, mid[c] - 2 / BRACKET_ACCURACY), min(1.0, mid[c] + 2 / BRACKET_ACCURACY)],
                                                             BRACKET_ACCURACY).alias(c) for c in bracket]).collect()
        bracket = {r["feature"]: tuple(r[r["feature"]]) for r in q}
    out = {}
    for c in cols:
        if not n[c]:
            out[c] = None
            continue
        want, seen, mids = [(n[c] - 1) // 2, n[c] // 2], 0, []
        for value, k in sorted(counts[c]):
            mids += [value for w in want if seen <= w < seen + k]
            seen += k
        out[c] = mids[0] if mids[0] == mids[1] else (mids[0] + mids[1]) / 2
    return out


def impute(df: DataFrame, medians: dict) -> DataFrame:
    """C6 apply: the present value, else the median, as double."""
    rep = {c: (F.coalesce(present(c), F.lit(m)) if m is not None else present(c)) for c, m in medians.items()}
    return df.withColumns(rep)


def fit_moments(df: DataFrame, cols: list[str]) -> dict:
    """C7 fit: mean and population std per column (one aggregate)."""
    exprs = []
    for c in cols:
        exprs += [F.avg(present(c)).alias(f"{c}__m"), F.stddev_pop(present(c)).alias(f"{c}__s")]
    row = df.agg(*exprs).first()
    return {c: (row[f"{c}__m"], row[f"{c}__s"]) for c in cols}


def standardize(df: DataFrame, moments: dict) -> DataFrame:
    """C7 apply: (x − mean) / std_pop; zero or undefined std → 0."""
    rep = {}
    for c, (m, s) in moments.items():
        if m is None:
            rep[c] = F.lit(None).cast("double")
        elif not s:
            rep[c] = F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
        else:
            rep[c] = (F.col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(rep)


def build_features(customers: DataFrame, regions: list | None = None):
    """encode → median impute → standardise.

    Returns (encoded raw frame, scaled frame, feature column list, fitted params).
    The raw frame keeps the unscaled values for the persona statistics (the
    scaler does not overwrite them here).
    """
    enc, cols = encode_all(customers, regions)
    cols = numeric_columns(enc, cols)
    medians = fit_medians(enc, cols)
    imputed = impute(enc, medians)
    moments = fit_moments(imputed, cols)
    scaled = standardize(imputed, moments)
    return enc, scaled, cols, {"medians": medians, "moments": moments}


def to_long(df: DataFrame, id_col: str, cols: list[str], digits: int | None = 6,
            name: str = "feature", value: str = "value") -> DataFrame:
    """Wide feature columns → (id, feature, value) rows (for reporting / checks)."""
    v = F.col(value)
    long = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot(id_col, cols, name, value)
    return long.withColumn(value, F.bround(v, digits) if digits is not None else v)


def scale_exprs(medians: dict, moments: dict, prefix: str = "z__") -> list:
    """Imputed + standardised expressions as new columns (raw columns stay untouched)."""
    out = []
    for c, (m, s) in moments.items():
        x = present(c)
        if medians.get(c) is not None:
            x = F.coalesce(x, F.lit(medians[c]))
        if m is None:
            e = F.lit(None).cast("double")
        elif not s:
            e = F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
        else:
            e = (x - F.lit(m)) / F.lit(s)
        out.append(e.alias(prefix + c))
    return out


def fit_scaling(df: DataFrame, cols: list[str]) -> tuple[dict, dict, int]:
    """C6 + C7: medians, the moments of the *imputed* columns, and the number of rows.

    Per column, one aggregate gives the count, mean and population variance of the
    present values. Imputation adds (N − c) copies of the median, so the imputed moments
    follow from the pooled-variance combination of two groups (Chan et al.):
    mean = (c·μ + (N−c)·m) / N and M2 = c·σ² + (m − μ)²·c·(N−c) / N.
    """
    medians = fit_medians(df, cols)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        x = present(c)
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mu"), F.var_pop(x).alias(f"{c}__var")]
    row = df.agg(*aggs).first()
    n_rows, moments = row["__rows"], {}
    for c in cols:
        m, cnt, mu, var = medians[c], row[f"{c}__n"], row[f"{c}__mu"], row[f"{c}__var"]
        if m is None or not cnt:
            moments[c] = (None, None)
            continue
        n_imp = n_rows - cnt
        mean = (cnt * mu + n_imp * m) / n_rows
        m2 = cnt * (var or 0.0) + (m - mu) ** 2 * cnt * n_imp / n_rows
        moments[c] = (mean, (m2 / n_rows) ** 0.5)
    return medians, moments, n_rows
