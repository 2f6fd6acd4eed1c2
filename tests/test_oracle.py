"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

from oracle_compare import compare
from tierline.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_all_queries_match_oracle(spark):
    import oracle_compare
    oracle_compare.EXACT = True  # bit-identical doubles, equal decimals
    try:
        res = compare(spark, SF, list(QUERIES), verbose=False)
    finally:
        oracle_compare.EXACT = False
    bad = {k: v for k, v in res.items() if v[0] == "MISMATCH"}
    assert not bad, bad
    assert all(v[1] >= 0 for v in res.values())


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["event_date", "active_users", "total_events", "avg_conversion_rate"]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_column_types_equal_the_oracle_types(spark):
    import __spark_entry__ as e
    from oracle_compare import duck_conn
    con = duck_conn(SF)
    q = e.queries()
    for name, sql in ((n, s) for n, s in e.oracle_sql().items() if n in QUERIES):
        spark_types = {f.name: f.dataType.simpleString() for f in q[name](spark, SF).schema.fields}
        rel = con.sql(sql)
        duck_types = dict(zip(rel.columns, [str(t).replace(" ", "") for t in rel.types]))
        want = {c: (t.upper().replace(" ", "") if t.startswith("decimal") else SPARK_TO_DUCK[t])
                for c, t in spark_types.items()}
        assert want == duck_types, name
