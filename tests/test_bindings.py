import pytest

from motolake.plans import bindings
from tests.oracle import same


@pytest.mark.parametrize("name", sorted(bindings.ORACLE_SQL))
def test_query_gives_what_sql_gives(spark, sf_dir, name):
    same(bindings.QUERIES[name](spark, sf_dir), bindings.ORACLE_SQL[name], sf_dir)


def test_queries_without_sql_have_rows(spark, sf_dir):
    for name in set(bindings.QUERIES) - set(bindings.ORACLE_SQL):
        assert bindings.QUERIES[name](spark, sf_dir).count() > 0


def test_entry_has_rows_and_a_stable_schema(spark):
    import __spark_entry__ as entry

    a, b = entry.entry(spark), entry.entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
