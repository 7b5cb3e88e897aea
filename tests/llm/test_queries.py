"""The registered queries with SQL against DuckDB (the entry without this subpackage: tests/test_entry.py)."""

from conftest import SF01
from oracle_compare import compare


def test_queries_match_their_sql(spark):
    from strata.llm import queries

    results = compare(spark, SF01, sorted(queries.ORACLE_SQL), verbose=False)
    assert not {n: r for n, r in results.items() if not r["ok"]}
    assert set(queries.ORACLE_SQL) < set(queries.QUERIES)
    numbers = {name.split("_")[0] for name in queries.QUERIES}
    assert numbers == {f"op{n}" for n in range(1, 14)}
