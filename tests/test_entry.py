"""Driver contract: smoke entry on sf0.001; every query against its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as entry
from paths import SF_CHECK
from oracle_harness import compare  # noqa: E402

NAMES = sorted(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "o_custkey"
    assert len({r["o_custkey"] for r in rows}) == len(rows)


def test_every_query_has_a_docstring_and_oracle_names_are_known():
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(oracles) >= 50
    for name, fn in qs.items():
        assert fn.__doc__, name


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_CHECK, [name], verbose=False)[name]
    assert res[0] in ("match", "rows-only"), res
