"""Every registered query against its DuckDB oracle on the smallest test data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from cadenza.plans.registry import registry  # noqa: E402
from oracle_check import duck_type, table_hash  # noqa: E402

SF = "/root/testdata/sf0.001"
REG = registry()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from cadenza.sources.testdata import SOURCE_TABLES

    con = duckdb.connect()
    for t in SOURCE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.fixture(scope="module")
def catalog(spark):
    from cadenza.sources.testdata import from_testdata

    return from_testdata(spark, SF)


@pytest.mark.parametrize("name", sorted(REG))
def test_matches_oracle(name, catalog, duck):
    q = REG[name]
    df = q.build(catalog)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    sql = q.oracle_sql()
    if sql is None:
        pytest.skip("no oracle")
    cur = duck.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    types = {f.name: duck_type(f.dataType.simpleString()) for f in df.schema.fields}
    assert types == dict(zip(d_cols, [str(c[1]) for c in cur.description]))
    assert len(s_rows) == len(d_rows)
    assert table_hash(s_cols, s_rows) == table_hash(d_cols, d_rows)
