"""Driver contract: entry, registry and oracles (DuckDB) on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from persona_engine.plans.catalog import ORACLES
from persona_engine.sources.tables import TABLE_NAMES


def _keys():
    """Every oracle-backed key except those that re-run the segmentation (the full set,
    including those, runs in tools/check_oracle.py); two segmentation keys stay in."""
    import re

    import persona_engine.plans.q_personas as qp
    import persona_engine.plans.q_segments as qs
    seg_keys = set()
    for m in (qp, qs):
        seg_keys |= set(re.findall(r'@register\("([a-z_0-9]+)"', open(m.__file__).read()))
    return sorted(k for k in ORACLES if k not in seg_keys) + ["personas", "silhouette_exact"]


KEYS = _keys()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def canon(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and "persona_name" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 90


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    sp = E.queries()[key](spark, SF001).toPandas()
    dk = duck.execute(E.oracle_sql()[key]).fetchdf()
    assert sorted(sp.columns) == sorted(dk.columns)
    cols = sorted(sp.columns)
    a = sorted(tuple(canon(x) for x in r) for r in sp[cols].itertuples(index=False, name=None))
    b = sorted(tuple(canon(x) for x in r) for r in dk[cols].itertuples(index=False, name=None))
    assert a == b
