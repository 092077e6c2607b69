"""The registered queries of the subpackage next to their SQL twins, and the shape of those without one."""

import pytest

from tesselar.llm.queries import ORACLE, QUERIES
from tests.session import assert_same_rows, duckdb_tables

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op3_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op4_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op6_ngram_join": ["doc_id", "class_id", "n_links", "group_id"],
    "op7_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op8_quality": ["doc_id", "held_out", "score", "predicted"],
    "op9_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op11_vector_links": ["vec_id", "n_links", "component_id", "kept"],
}


def test_one_query_an_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) | set(COLUMNS) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    assert_same_rows(QUERIES[name](spark, SF_DIR), duckdb_tables(SF_DIR).execute(ORACLE[name]).df())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert QUERIES[name](spark, SF_DIR).columns == COLUMNS[name]
