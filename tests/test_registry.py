"""Every registered query against its SQL check, on whole small tables."""

import pytest

import __spark_entry__ as entry
from riskloom.catalog import registry

QUERIES, CHECKS = registry.queries(), registry.oracle_sql()


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert len(QUERIES) > 140


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(CHECKS) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = _sorted(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    relation = duck.sql(CHECKS[name])
    assert sorted(relation.columns) == columns
    place = [relation.columns.index(c) for c in columns]
    want = _sorted(tuple(row[i] for i in place) for row in relation.fetchall())
    assert got == want
    types = {type(v) for row in got for v in row} ^ {type(v) for row in want for v in row}
    assert not types
