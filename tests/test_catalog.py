"""Every query of the catalog against its SQL oracle on the smallest tables."""

import os
from collections import Counter

import pytest

from sparkfolio.plans import catalog
from sparkfolio.session import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return str(v.replace(tzinfo=None)) if hasattr(v, "tzinfo") else str(v)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(v) for v in r) for r in df.select(*cols).collect())
    cur = duck.execute(catalog.ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == Counter(tuple(norm(r[i]) for i in order) for r in cur.fetchall())
