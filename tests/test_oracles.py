"""Every query of the engine's own operators against DuckDB on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import sparkloom.registry as registry

registry.load()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 6) + 0.0)
    return v.isoformat()[:26] if hasattr(v, "isoformat") else None if v is None else str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows(spark, sf_dir, duck, name):
    df = registry.QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    cursor = duck.execute(registry.ORACLES[name])
    found = [x[0] for x in cursor.description]
    assert sorted(found) == cols
    places = [found.index(c) for c in cols]
    want = sorted(str([plain(r[i]) for i in places]) for r in cursor.fetchall())
    assert sorted(str([plain(r[c]) for c in cols]) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs_without_oracle(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0
