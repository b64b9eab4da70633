"""Percentiles by refined histograms against sorted lists."""

import math
import random

import pytest

from loglake.operators import percentiles
from loglake.operators.percentiles import exact_percentiles, linear_bucket

WANTED = {"p0": 0.0, "p1": 0.01, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


def expected(values):
    values = sorted(values)
    out = {}
    for name, p in WANTED.items():
        spot = (len(values) - 1) * p
        low, high = values[math.floor(spot)], values[math.ceil(spot)]
        out[name] = low if spot == math.floor(spot) else low + (high - low) * (spot - math.floor(spot))
    return out


def cases():
    draw = random.Random(5)
    yield "one log bucket", [1000 + draw.randrange(50_000) * 1e-9 for _ in range(12_000)]
    yield "one bucket and a hot value", [5.0] * 9000 + [5 + draw.random() * 1e-6 for _ in range(9000)]
    yield "one value", [7.25] * 10_000
    yield "negative and tiny", [draw.choice([-1, 1]) * 10 ** draw.uniform(-320, 300) for _ in range(9000)] + [0.0, -0.0, 5e-324, -5e-324]
    yield "smallest numbers", [draw.choice([0.0, 5e-324, 1e-323]) for _ in range(9000)]
    yield "whole range", [draw.choice([-1.7e308, 1.7e308, 3.0]) for _ in range(9000)]
    yield "infinite", [float("inf")] * 5 + [float("-inf")] * 5 + [1.0, 2.0]
    yield "few", [3.0, 1.0, 2.0]


@pytest.mark.parametrize("name, values", list(cases()))
def test_equals_a_sorted_list(spark, name, values):
    df = spark.createDataFrame([(v,) for v in values + [None]], "x double").repartition(4)
    bucket = linear_bucket(1e300) if "tiny" in name or "smallest" in name else percentiles.log_bucket
    got = exact_percentiles(df, [], "x", WANTED, bucket).first().asDict()
    for column, value in expected(values).items():
        # between the infinities there is no value
        assert got[column] == pytest.approx(value, rel=1e-12, abs=0, nan_ok=True) or got[column] == value


def test_by_key_with_many_cuts(spark, monkeypatch):
    """Every bucket is cut again and again, down to three rows."""
    monkeypatch.setattr(percentiles, "FEW", 3)
    monkeypatch.setattr(percentiles, "CUTS", 4)
    draw = random.Random(9)
    rows = [(k, draw.choice([draw.gauss(k, 1), float(k), 1e-3 * draw.randrange(40)])) for k in range(3) for _ in range(200)]
    got = {r.k: r.asDict() for r in exact_percentiles(spark.createDataFrame(rows, "k int, x double"), ["k"], "x", WANTED, linear_bucket(50.0)).collect()}
    for k in range(3):
        for column, value in expected([x for own, x in rows if own == k]).items():
            assert got[k][column] == pytest.approx(value, rel=1e-12)


def test_no_exchange_by_value(spark, monkeypatch):
    """Neither the result's plan nor any table written on the way deals rows out by their value."""
    plans = []
    keep = percentiles.written
    monkeypatch.setattr(percentiles, "written", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df, name))
    df = spark.range(20_000).selectExpr("id % 2 as k", "1000 + (id % 15000) * 1e-7 as x")
    result = exact_percentiles(df, ["k"], "x", WANTED)
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    exchanges = [line for p in plans for line in p.splitlines() if "hashpartitioning" in line]
    assert len(plans) >= 4 and exchanges
    assert not any("_value" in line.split("hashpartitioning(")[1].split(")")[0] for line in exchanges)
    assert not any("rangepartitioning" in p for p in plans)


def test_no_rows(spark):
    none = spark.createDataFrame([(1, None)], "k int, x double")
    assert exact_percentiles(none, ["k"], "x", WANTED).count() == 0
    assert exact_percentiles(none, [], "x", WANTED).first().p50 is None
