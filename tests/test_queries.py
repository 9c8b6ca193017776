"""Every registered query of the log operators against its SQL oracle on the smallest tables."""

import duckdb
import pytest

from tidelog.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events conversations".split()


def text(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if v is None or v != v:
        return "-"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_oracle(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.execute(registry.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = sorted(tuple(text(r[c]) for c in columns) for r in got.collect())
    assert rows == sorted(tuple(text(v) for v in r) for r in want.fetchall())


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
