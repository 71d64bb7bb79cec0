"""The order level sums: tasks follow the line items, results do not depend on them."""

import datetime as dt
import re
from collections import defaultdict

import pytest

from regionledger.registry import tables


@pytest.fixture
def folder(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))

    write("region", [(0, "EAST")], "r_regionkey int, r_name string")
    write("nation", [(0, "N0", 0), (1, "N1", 0)], "n_nationkey int, n_name string, n_regionkey int")
    write("customer", [(c, c % 2) for c in range(8)] + [(8, None)], "c_custkey long, c_nationkey int")
    write("part", [(p, f"Brand#{p + 1}") for p in range(6)], "p_partkey long, p_brand string")
    orders = [(o, o % 9, dt.datetime(1996 + o % 2, 1, 1)) for o in range(30)] + [(30, None, None), (None, 1, dt.datetime(1996, 1, 1))]
    write("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp")
    lines = [(o, p, 100.0 + o, 0.05) for o in range(31) for p in (o % 6, (o + 1) % 6, o % 6)] + [(None, 1, 5.0, 0.1), (3, None, 5.0, 0.1)]
    write("lineitem", lines, "l_orderkey long, l_partkey long, l_extendedprice double, l_discount double")
    return str(tmp_path)


def by_hand(spark, d):
    rows = lambda t: spark.read.parquet(f"{d}/{t}.parquet").collect()
    nation = {r.c_custkey: r.c_nationkey for r in rows("customer") if r.c_nationkey is not None and r.c_nationkey % 9 != 4}
    part = {r.p_partkey: tables.INDUSTRIES[int(r.p_brand[6:]) - 1] for r in rows("part")}
    label = lambda code: "31-33" if code in ("31", "32", "33") else code
    firms, orders, receipts = defaultdict(set), defaultdict(set), defaultdict(int)
    of = {r.o_orderkey: r for r in rows("orders") if r.o_orderkey is not None}
    for x in rows("lineitem"):
        o = of.get(x.l_orderkey)
        if o is None or o.o_custkey not in nation or x.l_partkey not in part:
            continue
        key = (o.o_orderdate.year, f"01{nation[o.o_custkey] + 1:03}", label(part[x.l_partkey]))
        firms[key].add(o.o_custkey)
        orders[key].add(x.l_orderkey)
        receipts[key] += round(x.l_extendedprice * 100)
    return {k: (len(v), len(orders[k]), receipts[k] / 100) if len(v) >= 3 else (None, None, None) for k, v in firms.items()}


@pytest.mark.parametrize("lines", [2, 250_000])
def test_tasks_follow_the_lines(spark, folder, monkeypatch, lines):
    monkeypatch.setattr(tables, "LINES_PER_TASK", lines)
    cells = tables.survey_cells(spark, folder)
    found = {
        (r.year_num, r.state_cnty_fips_cd, r.naics2_sector_cd):
        (r.abs_firm_num, r.abs_emp_num, None if r.abs_rcpt_usd_amt is None else float(r.abs_rcpt_usd_amt))
        for r in cells.collect()
    }
    assert found == by_hand(spark, folder)
    # 95 lines: 48 tasks of two, or else one for each core.
    tasks = 48 if lines == 2 else spark.sparkContext.defaultParallelism
    plan = cells._jdf.queryExecution().executedPlan().toString()
    for key in ("l_orderkey", "c_custkey"):
        assert re.search(rf"hashpartitioning\([^)]*{key}#\d+L, {tasks}\)", plan), key
