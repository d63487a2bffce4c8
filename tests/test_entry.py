"""The driver contract: entry(), queries() and oracle_sql() line up."""

import __spark_entry__ as E


def test_contract(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    from innkeeper.plans import catalog
    assert set(sqls) <= set(qs) and set(catalog.QUERIES) <= set(qs)
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL) and len(catalog.QUERIES) >= 36
    df = E.entry(spark)
    assert df.columns == ["file", "total_records", "valid_records", "invalid_records"]
    rows = df.collect()
    assert len(rows) == 4 and all(r.total_records >= r.valid_records + r.invalid_records for r in rows)
