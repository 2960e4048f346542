"""The registered queries: their columns, and their rows against SQL or brute force."""

import hashlib

import duckdb
import numpy as np
import pytest
from test_bpe import LIBRARY, ids_of
from test_suffix_dedup import brute as brute_suffix

import __spark_entry__ as E
from tallyspark.llm import queries

SF = "/root/testdata/sf0.001"
# Contract columns, first in each result.
COLUMNS = {
    "op1_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op2_paragraph_dedup": {"doc_id": "bigint", "first_word": "bigint", "n_words": "bigint", "first_doc_id": "bigint"},
    "op3_pstable_lsh": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op4_setsketch": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op5_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op6_langid": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op7_license_scan": {"doc_id": "bigint", "sentence_ids": "string", "licences": "string"},
    "op8_secret_scan": {"doc_id": "bigint", "start": "bigint", "n_chars": "bigint", "value_sha256": "string", "score": "double", "is_secret": "boolean"},
    "op9_quality_mcd": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
                        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op10_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op11_collocations": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint",
                          "score": "bigint"},
    "op12_hard_negatives": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint",
                            "negative_score": "bigint"},
    "op13_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
}


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_all_are_registered():
    assert set(COLUMNS) == set(queries.QUERIES) and set(COLUMNS) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert dict(queries.QUERIES[name](spark, SF).dtypes) == COLUMNS[name]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_rows_equal_the_sql(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{SF}/{name_}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    columns = ", ".join(got.columns)
    want = con.execute(f"SELECT {columns} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_op1_equals_the_library(spark, documents):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for doc, text in documents:
        ids = ids_of(text or "")
        want.append((doc, len(ids), sha(np.asarray(ids, "<u4").tobytes()), sha(LIBRARY.decode(ids, skip_special_tokens=False).encode())))
    assert sorted(map(tuple, queries.QUERIES["op1_bpe"](spark, SF).collect())) == sorted(want)


def test_op10_equals_all_windows(spark, documents):
    got = queries.QUERIES["op10_suffix_dedup"](spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_suffix(documents)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_empty_tables(spark, tmp_path, name):
    for t in ("documents", "embeddings", "pages"):
        spark.read.parquet(f"{SF}/{t}.parquet").filter("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []
