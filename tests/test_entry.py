import __spark_entry__ as entry


def test_registry(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 80


def test_flagship(spark):
    import os

    import pytest

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no tables")
    assert entry.entry(spark).columns == ["page_id", "url", "name", "primary_class", "page_type", "role", "evidence", "reason", "rank"]
