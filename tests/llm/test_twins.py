"""The registered queries against their SQL twins, and their columns."""

import os

import duckdb
import pytest

from regionledger.llm import registry

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    2: ["doc_id", "n_tokens", "closed"],
    3: ["doc_id", "n_words", "n_removed", "kept_sha256"],
    4: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    5: ["doc_id", "contaminated", "item_ids", "copied"],
    6: ["doc_id", "held_out", "score", "predicted"],
    7: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"],
    8: ["doc_id", "source", "epoch", "block"],
    9: ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    10: ["doc_id", "n_shingles", "component_id"],
}


def test_one_query_per_operator():
    assert sorted(q.split("_")[0] for q in registry.queries()) == sorted(f"op{n}" for n in COLUMNS)
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("n", COLUMNS)
def test_query(spark, n):
    if not os.path.isdir(SF):
        pytest.skip("provided tables not present")
    name, f = next((k, v) for k, v in registry.queries().items() if k.startswith(f"op{n}_"))
    df = f(spark, SF)
    assert df.columns == COLUMNS[n]
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    if name in registry.oracle_sql():
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        cur = con.execute(registry.oracle_sql()[name])
        order = [[d[0] for d in cur.description].index(c) for c in df.columns]
        assert got == sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr)
    elif n != 8:
        assert len(got) == 200
