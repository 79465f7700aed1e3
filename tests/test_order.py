"""Order statistics of skewed values: exact, from a small bracket."""

import random

import pytest
from pyspark.sql import functions as F

from quillstone.operators import profile


def shapes():
    r = random.Random(3)
    yield "outlier", [r.random() for _ in range(20_000)] + [1e15]
    yield "both ends", [r.gauss(0, 1) for _ in range(9_999)] + [-1e300, 1e300, float("inf")]
    yield "few values", [float(r.randrange(3)) for _ in range(5_000)]
    yield "one value", [7.0] * 4_000
    yield "half alike", [1.0] * 5_000 + [r.random() * 1e9 for _ in range(5_000)]
    yield "exponents", [10 ** r.uniform(-300, 300) for _ in range(5_000)]
    yield "small", [3.0, 1.0, 2.0]
    yield "single", [4.5]
    yield "none", []


@pytest.mark.parametrize(("name", "values"), list(shapes()), ids=[n for n, _ in shapes()])
@pytest.mark.parametrize("share", [0.5, 0.0, 0.99])
def test_order_statistic(spark, name, values, share):
    rows = spark.createDataFrame([(v, "clash") for v in [*values, None]], "x double, rank string").repartition(4)
    got = profile.order_statistic(rows, share, "value").collect()
    want = sorted(values)[int(len(values) * share)] if values else None
    assert [r["value"] for r in got] == [want]


def test_a_bracket_is_a_small_share(spark):
    """An outlier does not put all values in one place: of 20,001 values some thirty are sorted."""
    values = next(v for n, v in shapes() if n == "outlier")
    inside = profile.bracketed(spark.createDataFrame([(v,) for v in values], "x double"), 0.5)
    assert 0 < inside.count() < 60 and inside.select("before").distinct().count() == 1
    row = profile.numeric_profile(spark.createDataFrame([(str(v),) for v in values] + [("n/a",), (None,)], "v string"), F.col("v")).first()
    assert (row["n_given"], row["n_numeric"], row["upper_median"], row["max_value"]) == (20_002, 20_001, sorted(values)[10_000], 1e15)
