"""Every registered query against its DuckDB oracle on sf0.001 (the driver
checks the same at sf0.01).  Compares column names, types and an
order-insensitive multiset of rows, exactly."""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tillroll.plans import registry

duckdb = pytest.importorskip("duckdb")
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date"}
KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v.isoformat() if hasattr(v, "isoformat") else v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = registry.queries()[key](spark, SF_SMALL)
    got = [tuple(_norm(v) for v in r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    assert [d[0] for d in cur.description] == df.columns
    assert [TYPES.get(str(d[1]), str(d[1])) for d in cur.description] == \
        [f.dataType.simpleString() for f in df.schema.fields]
    exp = [tuple(_norm(v) for v in r) for r in cur.fetchall()]
    assert _sorted(got) == _sorted(exp)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "mom_growth_pct" in df.columns
