"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import decimal

import duckdb
import pytest

from casegrid import catalogue
from casegrid.plans.projection import DUCKDB, SPARK, TABLES, frame, oracle, views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def shown(x):
    if isinstance(x, float):
        return f"{x:.9g}"
    if isinstance(x, decimal.Decimal):
        return f"decimal {x}"
    return str(x)


def rows(data):
    return sorted(tuple(map(shown, r)) for r in data)


def same(spark, duck, df, sql):
    columns = sorted(df.columns)
    cursor = duck.execute(f"select {', '.join(columns)} from ({sql})")
    assert rows(map(tuple, df.select(*columns).collect())) == rows(cursor.fetchall())
    assert len(duck.execute(f"select * from ({sql}) limit 0").description) == len(columns)


@pytest.mark.parametrize("name", [v for v in views(SPARK) if v != "spans"])
def test_views(spark, duck, name):
    assert list(views(SPARK)) == list(views(DUCKDB))
    df = frame(spark, SF, name)
    same(spark, duck, df, oracle((name,), f"select {', '.join(df.columns)} from {name}"))


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query(spark, duck, name):
    same(spark, duck, catalogue.queries()[name](spark, SF), catalogue.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_sql(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0
