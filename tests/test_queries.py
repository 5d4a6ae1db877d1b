"""Every query against its SQL twin on the smallest tables, and the entry point."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime | datetime.date):
        return str(value).removesuffix(" 00:00:00")
    return round(float(value), 6) if isinstance(value, float | decimal.Decimal) else value


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=str)


@pytest.fixture(scope="module")
def sql(small):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from read_parquet('{small}/{t}.parquet')")
    return db


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, small, sql, name):
    got, want = entry.queries()[name](spark, small), sql.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(list(want.columns), want.fetchall())


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["disclosure_index", "record"] and out.count() > 0


def test_page_text_of_real_pages(spark, small):
    texts = {r.page_id: r.text for r in entry.queries()["page_text"](spark, small).collect()}
    assert all(t and "<" not in t and "track(" not in t for t in texts.values())
