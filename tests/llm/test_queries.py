"""The registered queries cover their whole table with the contracted columns, and give what their SQL gives."""

import duckdb
import pytest

from foliary.llm import queries as Q

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op2_sharding": {"doc_id": "bigint", "slot": "int", "shard": "string"},
    "op3_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op5_packing": {"doc_id": "bigint", "n_words": "bigint", "bucket_len": "bigint", "batch_id": "string", "batch_pos": "int"},
    "op6_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op7_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op8_mixing": {"doc_id": "bigint", "source": "string", "mix_phase": "int", "mix_block": "bigint", "mix_release": "bigint", "mix_due": "bigint", "mix_slot": "bigint", "mix_pos": "int"},
    "op9_secrets": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op10_quality_classifier": {"doc_id": "bigint", "text_score": "double", "meta_score": "double", "score": "double", "kept": "boolean"},
}


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    df = Q.queries()[name](spark, SF)
    assert dict(df.dtypes) == COLUMNS[name]
    rows = df.collect()
    ids = [r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in rows) == sorted(ids)
    if sql := Q.oracle_sql().get(name):
        con = duckdb.connect()
        for t in ("documents", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        cols = sorted(COLUMNS[name])
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert sorted(tuple(r[c] for c in cols) for r in rows) == sorted(want)


def test_all_are_registered():
    assert list(Q.queries()) == list(COLUMNS)
