"""Every registered query that has SQL against DuckDB; the others must return rows."""

import pytest

import oracle
from loglake import registry

QUERIES, ORACLES = registry.queries(), registry.oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_check_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, con, name):
    assert oracle.difference(spark, sf_dir, QUERIES[name], ORACLES[name], con) is None


@pytest.mark.parametrize("name", ["nlp_analysis", "aggregates_json", "file_manifest", "file_metadata", "report_document"])
def test_returns_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_roundtrips(spark, sf_dir):
    rows = QUERIES["anomaly_model_roundtrip"](spark, sf_dir)
    assert rows.where("abs(anomaly_score - score_before) > 1e-9 or is_anomaly <> label_before").isEmpty()
