"""Exact quantiles against brute force."""

import math
import random

import pytest

from tillwise.operators import quantiles as Q

PROBABILITIES = (0.25, 0.5, 0.75)


def brute(values, probabilities):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    if not kept:
        return []
    # the probabilities used here are exact in binary, except 0.1 which divides evenly
    return [kept[max(1, math.ceil(round(p * len(kept), 9))) - 1] for p in probabilities]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(3)


CASES = {
    "one to thousand": [float(i) for i in range(1, 1001)],
    "four values": [4.0, 1.0, 3.0, 2.0],
    "single": [7.5],
    "all equal": [3.25] * 50,
    "nulls and nan": [None, float("nan"), 1.0, 2.0, None, 3.0],
    "only nulls": [None, None],
    "empty": [],
    "negative and zero": [-5.0, -0.5, 0.0, -0.0, 0.25, 12.0, -1e-300, 1e-300],
    "a third in one value": [2.0] * 40 + [float(i) for i in range(80)],
    "many magnitudes": [10.0**e for e in range(-30, 31)],
    "close neighbours": [1.0 + i * 2.0**-50 for i in range(200)],
    "infinite": [float("inf"), 1.0, 2.0, float("-inf")],
}


@pytest.mark.parametrize("case", CASES)
def test_matches_sorting(spark, case):
    values = CASES[case]
    assert Q.exact_quantiles(frame(spark, values), "x", PROBABILITIES) == brute(values, PROBABILITIES)


@pytest.mark.parametrize("seed", range(3))
def test_random_values_with_forced_narrowing(spark, monkeypatch, seed):
    monkeypatch.setattr(Q, "COUNTED_ONE_BY_ONE", 5)
    monkeypatch.setattr(Q, "SLOTS_PER_OCTAVE", 1)
    monkeypatch.setattr(Q, "LINEAR_SLOTS", 8)
    source = random.Random(seed)
    values = [round(source.lognormvariate(3, 2), 3) for _ in range(700)]
    probabilities = (0.1, 0.25, 0.5, 0.75, 1.0)
    assert Q.exact_quantiles(frame(spark, values), "x", probabilities) == brute(values, probabilities)


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_agrees_with_the_builtin(spark, conf, limit):
    """Small inputs are counted value by value, larger ones by slot."""
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    df = spark.range(5000).selectExpr("pow(id % 977, 1.7) - 300 AS x")
    want = df.selectExpr(
        *[f"percentile_disc({p}) WITHIN GROUP (ORDER BY x)" for p in PROBABILITIES]
    ).first()
    assert Q.exact_quantiles(df, "x", PROBABILITIES) == list(want)


def test_approximate_is_within_its_error(spark):
    df = spark.range(1, 1001).selectExpr("double(id) AS x").repartition(5)
    for cut, p in zip(Q.approximate_quantiles(df, "x", PROBABILITIES, 0.05), PROBABILITIES):
        assert abs(cut - 1000 * p) <= 50


def test_infinity_beside_the_largest_double(spark, monkeypatch):
    from tillwise.operators import quantiles

    monkeypatch.setattr(quantiles, "COUNTED_ONE_BY_ONE", 5)
    monkeypatch.setattr(quantiles, "COUNTED_AT_ONCE", -1)
    values = spark.range(40).selectExpr("IF(id < 20, 1.7976931348623157E308D, CAST('Infinity' AS DOUBLE)) AS v")
    assert quantiles.exact_quantiles(values, "v", [0.25, 0.75]) == [1.7976931348623157e308, float("inf")]
