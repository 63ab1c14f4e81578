"""Every registered query of the prompt-bank operators against its SQL, or for its rows where it has none."""

import oracle as compare
import pytest

from quarrymill.plans import oracle, queries, stored, streams

QUERIES = queries.QUERIES | stored.QUERIES | streams.QUERIES
SQL = oracle.SQL | stored.SQL | streams.SQL
ROWS_ONLY = {"html_unescape_pages"}


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY and len(QUERIES) == sum(len(m.QUERIES) for m in (queries, stored, streams))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, name):
    assert compare.difference(spark, sf_dir, QUERIES[name], SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
