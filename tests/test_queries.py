"""Every registered query runs, and agrees with its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from quern.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows(frame: pd.DataFrame):
    """Rows as text; pandas keeps whole numbers beside nulls as floats."""

    def shown(v):
        if v is None or v is pd.NA or v != v:
            return "NULL"
        return str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)

    return sorted(map(tuple, frame[sorted(frame.columns)].astype(object).map(shown).values.tolist()))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, sf_dir, name):
    got = registry.queries()[name](spark, sf_dir).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql:
        want = duck.sql(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
