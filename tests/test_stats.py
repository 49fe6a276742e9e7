from __future__ import annotations

import random
import statistics

import pytest

from probity.operators import stats


def frame(spark, numbers):
    return spark.createDataFrame([(x,) for x in numbers], "x double").repartition(5)


@pytest.mark.parametrize(
    "numbers",
    [
        [1.0],
        [1.0, 2.0],
        [3.0, 3.0, 3.0],
        [-5.0, 0.0, 1e300, -1e300],
        [0.0, 5e-324],
        [1.0, 1.0, 1.0, 2.0, 1e9],
        [-1.7e308, 1.7e308, 1.6e308, -1.6e308, 0.5],
    ],
)
@pytest.mark.parametrize("few_rows", [0, 50_000])
def test_median_of_small_sets(spark, numbers, few_rows):
    assert stats.exact_median(frame(spark, numbers), "x", few_rows) == statistics.median(numbers)


@pytest.mark.parametrize("seed", range(4))
def test_median_equals_sorting_for_any_shape(spark, seed):
    rnd = random.Random(seed)
    numbers = [
        float(rnd.choice([rnd.gauss(0, 1), rnd.paretovariate(0.3), rnd.randrange(3), -rnd.expovariate(1e-6), 7.25]))
        for _ in range(3000 + seed)
    ]
    assert stats.exact_median(frame(spark, numbers), "x", few_rows=10) == statistics.median(numbers)


def test_one_value_may_hold_a_third_of_all_rows(spark):
    numbers = [1.0] * 1000 + [float(i) for i in range(2, 2001)]
    assert stats.exact_median(frame(spark, numbers), "x", few_rows=1) == statistics.median(numbers)


def test_what_is_no_number_is_left_out(spark):
    numbers = [1.0, None, float("nan"), float("inf"), 4.0, 2.0]
    assert stats.exact_median(frame(spark, numbers), "x") == 3.0
    assert stats.exact_median(frame(spark, [None]), "x") is None


def test_infinite_values_have_a_rank(spark):
    inf = float("inf")
    for few in (50_000, 1):
        median = lambda numbers: stats.exact_median(frame(spark, numbers), "x", few_rows=few)  # noqa: B023, E731
        assert median([1.0, 2.0, inf]) == 2.0
        assert median([-inf, -inf, 5.0, inf]) == -inf
        assert median([1.0, inf]) == inf
        assert median([inf] * 3) == inf
        assert median([-inf, 1e300, -1e300, inf, 7.0]) == 7.0


def test_median_and_mad(spark):
    numbers = [1.0, 2.0, 3.0, 4.0, 100.0]
    assert stats.median_and_mad(frame(spark, numbers), "x") == (3.0, 1.0)
    assert stats.median_and_mad(frame(spark, [None]), "x") == (None, None)
    median, mad = stats.median_and_mad(frame(spark, [float(i) for i in range(1001)]), "x", approx=True)
    assert abs(median - 500) <= 5 and abs(mad - 250) <= 5
