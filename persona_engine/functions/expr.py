"""Column-expression helpers. All of them stay JVM-side (whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo=None, hi=None) -> Column:
    """least(greatest(x, lo), hi); either bound may be omitted. Null and NaN are missing and give null."""
    x = out = col(c)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(x.isNotNull() & ~F.isnan(x.cast("double")), out)


def present(c) -> Column:
    """The value as double; NaN is missing, as null is."""
    return F.nanvl(col(c).cast("double"), F.lit(None).cast("double"))


def safe_default(c, default: float = 0.0) -> Column:
    """Null and NaN both become ``default``."""
    x = col(c).cast("double")
    return F.coalesce(F.nanvl(x, F.lit(None).cast("double")), F.lit(float(default)))


def rnd(c, digits: int) -> Column:
    """Half-even rounding (numpy / Python semantics for the values we produce)."""
    return F.bround(col(c).cast("double"), digits)


def flag(cond: Column) -> Column:
    """Boolean condition → 0/1 long, null → 0."""
    return F.coalesce(cond.cast("long"), F.lit(0).cast("long"))


def starts_with_active(c) -> Column:
    """'Active (1M)' → 1, 'Inactive' → 0, null → 0."""
    return flag(F.startswith(col(c), F.lit("Active")))


def age_band(c) -> Column:
    """Right-closed bins (0,29], (29,39], (39,49], (49,59], (59,100]; else null."""
    a = col(c)
    return (F.when((a > 0) & (a <= 29), "20s")
             .when((a > 29) & (a <= 39), "30s")
             .when((a > 39) & (a <= 49), "40s")
             .when((a > 49) & (a <= 59), "50s")
             .when((a > 59) & (a <= 100), "60s+"))


def normalize_category(c) -> Column:
    """Interest category code: ' & ' → '_AND_', then spaces → '_'."""
    return F.replace(F.replace(col(c), F.lit(" & "), F.lit("_AND_")), F.lit(" "), F.lit("_"))


def normalize_feature(c) -> Column:
    """Feature column name: lower-case, ' & ' → '_', spaces → '_'."""
    return F.replace(F.replace(F.lower(col(c)), F.lit(" & "), F.lit("_")), F.lit(" "), F.lit("_"))


def parse_list_text(c) -> Column:
    """Python list printed as text → array<string>.

    Handles ``['A', 'B']`` and the numpy-2 repr ``[np.str_('A')]``; ``[]`` → empty
    array, null stays null.
    """
    return F.regexp_extract_all(col(c), F.lit(r"'([^']*)'"), 1)


def py_float_text(c) -> Column:
    """Text of a double the way Python prints a float (no exponent below 1e16)."""
    x = col(c).cast("double")
    big = F.abs(x) >= F.lit(1e7)
    fixed = F.regexp_replace(F.format_string("%.6f", x), r"0+$", "")
    fixed = F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed)
    return F.when(big, fixed).otherwise(x.cast("string"))


def _sq(s) -> str:
    return "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _key_sql(key) -> str:
    if not isinstance(key, str):
        raise TypeError("hash draws take a column name")
    return f"CAST(`{key}` AS STRING)"


def hash_unit_sql(seed, salt: str, key: str) -> str:
    h = f"md5(concat_ws(':', {_sq(seed)}, {_sq(salt)}, {_key_sql(key)}))"
    return f"((CAST(conv(substring({h}, 1, 8), 16, 10) AS DOUBLE) + 0.5D) / 4294967296.0D)"


def hash_unit(seed, salt: str, key) -> Column:
    """Deterministic uniform in (0, 1) from md5('seed:salt:key').

    A pure function of (seed, salt, key): the draw does not depend on the
    partitioning or the task that computes it, so retries and speculative
    tasks reproduce it exactly. Built as one SQL expression (cheap to plan even
    when a table needs dozens of draws).
    """
    return F.expr(hash_unit_sql(seed, salt, key))


def hash_order(seed, salt: str, key) -> Column:
    """Deterministic sort key (md5 hex) for seeded sampling / shuffling."""
    return F.expr(f"md5(concat_ws(':', {_sq(seed)}, {_sq(salt)}, {_key_sql(key)}))")


def std_normal(seed, salt: str, key) -> Column:
    """Box-Muller standard normal from two hash uniforms."""
    u1 = hash_unit_sql(seed, salt + ":n1", key)
    u2 = hash_unit_sql(seed, salt + ":n2", key)
    return F.expr(f"(sqrt(-2.0D * ln({u1})) * cos({2.0 * 3.141592653589793!r}D * {u2}))")


def half_even_div(x, d: int) -> Column:
    """Integer x / d rounded half-to-even, exactly (x long, d > 0); null stays null."""
    x = col(x).cast("long")
    r = F.pmod(x, F.lit(d))
    q = ((x - r) / F.lit(d)).cast("long")
    up = F.when(r * 2 > d, 1).when((r * 2 == d) & (F.pmod(q, F.lit(2)) == 1), 1).otherwise(0)
    return q + up


def cents(x) -> Column:
    """Money double with ≤ 2 decimals → exact integer cents."""
    return F.round(col(x) * 100).cast("long")


def template_parts(template: str) -> list:
    """Split 'a {x} b' into ['a ', ('x',), ' b'] (literal text and field names)."""
    import string
    out = []
    for lit, field, _spec, _conv in string.Formatter().parse(template):
        if lit:
            out.append(lit)
        if field is not None:
            out.append((field,))
    return out


def render(template: str, **fields) -> Column:
    """Fill a fixed template with columns (or Python values) — one concat, JVM-side."""
    cols = []
    for p in template_parts(template):
        if isinstance(p, tuple):
            v = fields[p[0]]
            cols.append(v.cast("string") if isinstance(v, Column) else F.lit(str(v)))
        else:
            cols.append(F.lit(p))
    return F.concat(*cols)
