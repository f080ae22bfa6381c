"""The training-data queries against their SQL, and that the others run on the smallest tables."""

import pytest

from quillstream.llm import queries

from ..oracle import FOLDER, compare


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    compare(spark, queries.QUERIES, queries.SQL, name)


COLUMNS = {
    "p1_found": {"text_file": "string", "line_no": "int"},
    "p2_found": {"page_id": "string", "line_no": "int", "lang": "string"},
    "p3_found": {"source_file": "string", "line_no": "int"},
    "p4_found": {"file": "string", "line_no": "int", "kind": "string"},
    "p5_found": {"page_id": "string", "boundary": "string"},
    "p6_found": {"doc_id": "bigint", "item_id": "bigint"},
    "p7_found": {"source": "string"},
    "p8_found": {"doc_id": "bigint"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_found_queries_have_their_columns_and_no_row_twice(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert dict(df.dtypes) == COLUMNS[name]
    rows = df.collect()
    assert rows and len(rows) == len(set(rows))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL) - set(COLUMNS)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, FOLDER).count() > 0
