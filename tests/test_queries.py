"""Every registered query against its SQL on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from kinetrail.plans import catalog

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 5) + 0.0
    return value


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sql, name):
    df = catalog.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = Counter(tuple(plain(x) for x in r) for r in df.select(*columns).collect())
    if name not in catalog.ORACLE_SQL:
        assert got
        return
    cursor = sql.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
