"""Every registered query against its SQL, on whole tables."""

import datetime
import decimal

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from queries import ORACLES, QUERIES


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return float(f"{float(value):.9g}")
    if isinstance(value, datetime.datetime):
        return str(value.replace(tzinfo=None))
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(name, spark, duck, sf_dir):
    frame = queries()[name](spark, sf_dir)
    oracle = duck.sql(oracle_sql()[name])
    assert sorted(frame.columns) == sorted(oracle.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(oracle.columns, oracle.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    assert entry(spark).count() > 0
