"""The queries on the smallest table: against SQL where SQL can express them, else for their columns and rows."""

import pytest
from compare import duck_rows, spark_rows

from corpusloom.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op2": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op3": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op4": {"doc_id", "fingerprint", "component_id"},
    "op5": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op6": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op7": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op8": {"vec_id", "n_links", "component_id", "kept"},
    "op9": {"page_id", "host", "path", "rule", "verdict"},
    "op10": {"doc_id", "held_out", "lang_pred", "score"},
    "op11": {"item_id", "rank", "doc_id", "score"},
    "op12": {"vec_id", "code", "error", "label_error", "codebooks_sha256"},
    "op13": {"doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"},
}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF)
    columns, rows = spark_rows(df)
    assert COLUMNS[name.split("_")[0]] <= set(columns)
    table = {"op8": "embeddings", "op9": "pages", "op12": "embeddings"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert len(rows) == n or name.startswith(("op2_", "op11_"))
    if name in queries.ORACLES:
        assert (columns, rows) == duck_rows(queries.ORACLES[name], SF)


def test_all_are_there():
    assert {n.split("_")[0] for n in queries.QUERIES} == set(COLUMNS)
