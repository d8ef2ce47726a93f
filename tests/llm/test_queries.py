"""Every registered query over the smallest tables, with SQL where there is some."""

import os

import pytest

import __spark_entry__ as entry_points
from agora.catalog.compare import connect
from agora.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_queries_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(queries.ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_rows(spark, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    if name in queries.ORACLES:
        cursor = connect(SF_DIR).execute(queries.ORACLES[name])
        columns = [d[0] for d in cursor.description]
        wanted = sorted(cursor.fetchall())
        assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == wanted and wanted
    else:
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        assert found.count() == docs.count()
        assert found.join(docs, "doc_id", "left_anti").count() == 0
