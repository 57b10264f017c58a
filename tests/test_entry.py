"""The driver's contract."""

import __spark_entry__ as entry


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema
    assert first.columns == ["BRANCH_STATE", "total_number", "total_amount"]
    assert first.count() > 0


def test_core_queries_and_sql_go_together():
    assert entry.registered.QUERIES.keys() == entry.registered.SQL.keys()
    assert entry.registered.QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert all(callable(q) for q in entry.queries().values())
