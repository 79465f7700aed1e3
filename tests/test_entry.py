import __spark_entry__ as entry


def test_contract(spark):
    names, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(names)
    assert all(callable(f) for f in names.values())
    assert entry.entry(spark).columns == ["entity_id", "canonical_name", "province", "city", "composite", "sales_ready", "first_seen"]
