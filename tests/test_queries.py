"""Every query with SQL gives DuckDB's rows; those without run and give rows."""

from __future__ import annotations

import pytest
from conftest import DATA, duck_rows, rows

from loregraph import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    names, expected = duck_rows(duck, queries.oracle_sql()[name])
    df = queries.queries()[name](spark, DATA)
    assert sorted(df.columns) == names
    got = rows(df)
    assert len(got) == len(expected)
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_runs(spark, name):
    assert queries.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
