"""The queries that have SQL against it, on the smallest test tables."""

import os

import pytest
from compare import compare, connect
from conftest import TESTDATA
from wardflow.llm.queries import ORACLES, QUERIES, warc

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, TESTDATA), connect(TESTDATA), ORACLES[name]) == []


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


def test_whole_records_cross_in_small_batches(spark):
    rows = {}
    for name in ("op5_warc", "op6_html_text"):
        QUERIES[name](spark, TESTDATA)
        rows[name] = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    assert rows == {"op5_warc": 256, "op6_html_text": 2048}


def test_pages_are_read_few_at_a_time_for_archives(spark, monkeypatch):
    key, seen = "spark.sql.parquet.columnarReaderBatchSize", []
    before = spark.conf.get(key)
    monkeypatch.setattr(warc, "archive_round_trip", lambda df: seen.append(spark.conf.get(key)) or df)
    assert QUERIES["op5_warc"](spark, TESTDATA).count() > 0
    assert seen == ["512"] and spark.conf.get(key) == before
