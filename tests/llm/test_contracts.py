"""Columns, types and rows of the registered corpus queries."""

import zlib

import pytest

import __spark_entry__ as entry
from bookweave.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_surrogates": {"doc_id": "bigint", "text": "string"},
    "op2_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3_fingerprints": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op4_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op5_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op6_decontamination": {"doc_id": "bigint", "contaminated": "boolean", "coverage": "double"},
    "op7_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8_jaccard": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op9_licenses": {"doc_id": "bigint", "license": "string", "score": "double"},
    "op10_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
}


def test_all_are_registered():
    found = entry.queries()
    assert set(queries.QUERIES) == set(COLUMNS) and set(COLUMNS) | {"pipeline"} <= set(found)
    assert set(entry.oracle_sql()) <= set(found)


@pytest.mark.parametrize("name", COLUMNS)
def test_contract(spark, name):
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    out = entry.queries()[name](spark, SF)
    assert {c: t for c, t in out.dtypes if c in COLUMNS[name]} == COLUMNS[name]
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == ids
    if "held_out" in out.columns:
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
