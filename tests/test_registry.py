import os
from collections import Counter

import pytest

from lexiforge.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "documents benchmark pages conversations part".split()


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for name in TABLES:
        c.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_like_sql(spark, con, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(map(str, r)) for r in df.select(*cols).collect())
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    want = Counter(tuple(map(str, r)) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall())
    assert got == want and got


def test_entry_without_optional_part():
    import __spark_entry__

    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
