"""Every registered query against its SQL in DuckDB, over the smallest tables."""

import duckdb
import pytest

from fieldseries.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def plain(rows):
    def one(v):
        return f"{v + 0:.6f}" if isinstance(v, float) else str(v)[:10] if hasattr(v, "year") else str(v)

    return sorted(tuple(one(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DIR)
    columns = sorted(got.columns)
    found = [tuple(r) for r in got.select(*columns).collect()]
    if name in registry.oracle_sql():
        want = duck.sql(registry.oracle_sql()[name])
        assert sorted(want.columns) == columns
        assert plain(found) == plain(want.select(*[f'"{c}"' for c in columns]).fetchall())
    else:
        assert found
