"""Ingest runs both trained models; its rows are compared with SQL in test_queries."""

import pytest

import __spark_entry__ as entry
from newsloom.catalog import analysis_queries


@pytest.fixture(scope="module")
def ingested(spark, small):
    df = entry.queries()["ingest_pipeline"](spark, small)
    return df.columns, [tuple(r) for r in df.collect()]


def test_both_models_run(ingested):
    names, rows = ingested
    spoken, scores = names.index("langue"), names.index("sentiment_score")
    assert {r[spoken] for r in rows} == {"fr", "mg"}
    assert any(r[scores] != 0.0 for r in rows if r[spoken] == "fr")


@pytest.mark.parametrize("name", ["ingest_counters", "ingest_pipeline"])
def test_a_batch_is_produced_once(spark, small, monkeypatch, name):
    made, produced = [], analysis_queries.produced
    monkeypatch.setattr(analysis_queries, "produced", lambda tables: made.append(1) or produced(tables))
    assert entry.queries()[name](spark, small).count() > 0
    assert len(made) == 1
