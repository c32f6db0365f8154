"""Every registered query runs, and equals its SQL twin where it has one."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

LARGER = "/root/testdata/sf0.01"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    if name in SQL:
        difference = compare(df, duck, SQL[name])
        if difference == "EMPTY":  # too few rows here: the next size must have some
            difference = compare(QUERIES[name](spark, LARGER), connect(LARGER), SQL[name])
        assert difference is None, difference
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).limit(5).count() == 5
