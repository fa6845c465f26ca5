"""Every query against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from tramline.plans import ALL

TABLES = "region nation customer supplier part orders lineitem events".split()


def normal(rows):
    return sorted(tuple("" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, tiny, name):
    query, sql = ALL[name]
    df = entry.queries()[name](spark, tiny)
    columns = sorted(df.columns)
    got = normal(map(tuple, df.select(*columns).collect()))
    assert got
    if sql is None:
        return
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    want = con.sql(sql)
    assert sorted(want.columns) == columns
    assert got == normal(con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
