"""Every registered query against its independent SQL on DuckDB at sf0.01 (row count, schema, values)."""

import pytest

from conftest import SF01
from oracle_compare import compare


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["total_customers"] == 1500


def test_every_query_has_sql_or_is_documented(spark):
    import __spark_entry__ as E

    missing = {name for name in E.queries() if name not in E.oracle_sql()}
    assert not {name for name in missing if name.startswith("q_")}


@pytest.mark.slow
def test_queries_match_oracle(spark):
    import __spark_entry__ as E

    # the other queries have tests of their own
    results = compare(spark, SF01, [n for n in E.queries() if n.startswith("q_")], verbose=False)
    bad = {n: r for n, r in results.items() if not r["ok"]}
    assert not bad, bad
