"""Every query with SQL gives the rows that DuckDB gives for it, on the smallest tables."""

import math

import duckdb
import pytest

from taxoweave import catalog
from taxoweave.plans.fixtures import TABLES

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "None"
    if isinstance(v, bool):
        return str(v)
    try:
        return f"{float(v):.9g}" if not isinstance(v, str) else v
    except (TypeError, ValueError):
        return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    r = duck.execute(catalog.oracle_sql()[name])
    want = table([x[0] for x in r.description], r.fetchall())
    assert table(df.columns, [tuple(x) for x in df.collect()]) == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0
