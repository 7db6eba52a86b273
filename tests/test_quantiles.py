import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftwell.functions import quantiles as q

PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 1.0]


def brute(values, p):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[max(1, math.ceil(p * len(kept))) - 1]


def check(spark, values, partitions=4):
    frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(partitions)
    found = q.quantiles(frame, ["v"], PROBABILITIES, 0)["v"]
    assert found == [brute(values, p) for p in PROBABILITIES]


def test_small_and_special_values(spark):
    check(spark, [1.0, 2.0, 3.0, 4.0, None])
    check(spark, [5.0])
    check(spark, [float("nan"), 1.0, None, 2.0])
    inf = float("inf")
    check(spark, [-inf, -inf, 1.0, inf])


def test_all_null_column_has_no_quantiles(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2)], "a double, b int")
    assert q.quantiles(frame, ["a", "b"], [0.5], 0) == {"a": [], "b": [1.0]}
    assert q.quantiles(frame, ["a", "b"], [0.5], 0.01) == {"a": [], "b": [1.0]}


@pytest.mark.parametrize("rankable", [1_000_000, 50, 1])
def test_exact_by_narrowing(spark, monkeypatch, rankable):
    """Few rankable rows force several rounds of narrowing."""
    monkeypatch.setattr(q, "RANKABLE_ROWS", rankable)
    rng = random.Random(7)
    check(spark, [rng.gauss(0, 1) for _ in range(20_000)], partitions=8)


def test_exact_beside_a_hot_value(spark, monkeypatch):
    """A value on a third of all rows sits next to the wanted rank."""
    monkeypatch.setattr(q, "RANKABLE_ROWS", 20)
    rng = random.Random(3)
    n = 9_000
    values = [0.5] * (n // 3) + [rng.random() for _ in range(2 * n // 3)]
    check(spark, values)
    # Just below the hot value.
    check(spark, [0.9] * (n // 3) + [i / n * 0.89 for i in range(2 * n // 3)])


def test_exact_even_when_a_bracket_misses(spark, monkeypatch):
    """Sketch errors change the number of rounds, never the answer."""
    original, calls = q._sketch, []

    def skewed(df, values, whole, ranks, error):
        calls.append(1)
        shift = 0.2 if len(calls) <= 2 else 0.0
        wrong = [[min(1.0, r + shift) for r in rs] for rs in ranks]
        return original(df, values, whole, wrong, error)

    monkeypatch.setattr(q, "_sketch", skewed)
    monkeypatch.setattr(q, "RANKABLE_ROWS", 200)
    rng = random.Random(5)
    check(spark, [rng.random() for _ in range(3_000)])


def test_sketch_stays_within_its_error(spark):
    frame = spark.range(200_000).select(F.shuffle(F.array("id")).getItem(0).alias("v"))
    found = q.quantiles(frame.repartition(16), ["v"], [0.25, 0.5, 0.75], 0.01)["v"]
    for value, p in zip(found, [0.25, 0.5, 0.75]):
        assert abs((value + 1) / 200_000 - p) <= 0.01


def test_negative_error_is_refused(spark):
    with pytest.raises(ValueError):
        q.quantiles(spark.range(3), ["id"], [0.5], -1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float)), min_size=1, max_size=40)
       .filter(lambda vs: any(v is not None for v in vs)))
def test_exact_on_arbitrary_lists(spark, values):
    check(spark, values, partitions=2)
