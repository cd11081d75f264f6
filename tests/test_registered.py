"""Every station query against its DuckDB twin."""

import duckdb
import pytest

from stationflow.plans import registry

TABLES = ("region", "nation", "customer", "events")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_rows(spark, duck, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(row) for row in df.select(*cols).collect()), key=repr)
    found = duck.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted((tuple(row[i] for i in at) for row in found.fetchall()), key=repr)
    assert got == want
