"""Registered queries against their SQL twins.

By default a cross-section runs; REGIONLEDGER_ALL=1 runs every query (minutes).
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from regionledger import registry
from tools.check import TABLES, plain

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "pl23_benchmark_fact", "pl22_state_totals", "jn1_full_outer_sources", "dq10_reconcile_survey", "dq11_reconcile_payroll",
    "dq14_export_sanity_suite", "pf11_flat_profile", "wn9_percentile_bin", "ag16_exact_quantiles", "src5_ragged_tsv", "src13_csv_after_preamble", "snk2_years_stacked", "snk5_latest_run",
    "pf2_field_counts", "pf8_definition_autofill", "so7_integer_gaps", "so8_overrides_win", "jn10_outer_compare",
]
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()
CHOSEN = sorted(QUERIES) if os.environ.get("REGIONLEDGER_ALL") else SAMPLE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry_registers_the_library():
    assert set(QUERIES) <= set(entry.queries())
    assert all(entry.oracle_sql()[n] == sql for n, sql in ORACLE.items())


def test_every_query_has_a_twin_and_every_operator_a_query():
    assert set(QUERIES) == set(ORACLE)
    sizes = dict(src=13, snk=8, prj=15, flt=20, jn=16, ag=24, wn=12, st=5, so=8, sc=28, pl=29, dq=23, pf=11)
    for prefix, n in sizes.items():
        for i in range(1, n + 1):
            assert any(q.startswith(f"{prefix}{i}_") for q in QUERIES), f"{prefix}{i}"


@pytest.mark.parametrize("name", CHOSEN)
def test_matches_twin(spark, duck, name):
    if not os.path.isdir(SF):
        pytest.skip("provided tables not present")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = duck.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = sorted(tuple(plain(r[i]) for i in order) for r in cur.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == want
