import oracle
from loglake.registry import invariants


def test_summary_gathers_no_cluster_and_agrees_with_sql(spark, sf_dir):
    rows = invariants.summary_checked(spark, sf_dir)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan
    sql = invariants.ORACLES["pattern_summary_checked"]
    assert oracle.difference(spark, sf_dir, lambda *_: rows, sql, oracle.connect(sf_dir)) is None
