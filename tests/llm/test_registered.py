"""Registered queries of the package beside their SQL, and that each reads its whole table."""

import pytest
from compare import connect, difference

from grainmill.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", SQL)
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in SQL])
def test_one_row_per_document(spark, name):
    rows = QUERIES[name](spark, SF)
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert "doc_id" in rows.columns and set(QUERIES) >= set(SQL)
