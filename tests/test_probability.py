import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from yieldlens.functions import probability as pr


def evaluate(spark, expression, values, schema="x double"):
    rows = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema)
    return [r.y for r in rows.select(expression.alias("y")).collect()]


def test_normal_quantile(spark):
    ps = [1e-300, 1e-12, 0.01, 0.074, 0.076, 0.3, 0.5, 0.9, 0.999]
    expected = [NormalDist().inv_cdf(p) for p in ps]
    assert evaluate(spark, pr.normal_quantile(F.col("x")), ps) == pytest.approx(expected, rel=1e-12, abs=1e-14)


def test_erfc(spark):
    xs = [0.0, 0.2, 0.46875, 0.5, 1.0, 3.9, 4.0, 4.1, 12.0]
    assert evaluate(spark, pr.erfc(F.col("x")), xs) == pytest.approx([math.erfc(x) for x in xs], rel=1e-13)


def test_chi2_upper_tail_at_tabulated_critical_values(spark):
    values = [(3.841458820694124, 1), (5.991464547107979, 2), (7.814727903251179, 3), (11.070497693516351, 5), (18.307038053275146, 10)]
    found = evaluate(spark, pr.chi2_upper_tail(F.col("x"), F.col("k")), values, "x double, k int")
    assert found == pytest.approx([0.05] * 5, rel=1e-12)


def test_chi2_upper_tail_with_many_degrees_of_freedom(spark):
    """Wilson and Hilferty's cube-root rule is good to a few digits there."""
    values = [(4000.0 + d, 4000) for d in (-150.0, 0.0, 200.0)]
    found = evaluate(spark, pr.chi2_upper_tail(F.col("x"), F.col("k")), values, "x double, k int")
    for (x, k), p in zip(values, found):
        z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
        assert p == pytest.approx(1 - NormalDist().cdf(z), abs=1e-4)


def test_t5_upper_tail(spark):
    ts = [0.0, 0.5, 2.5, 30.0, 300.0]

    def integral(t):
        # density of t with 5 degrees of freedom, Simpson on u = atan(x / sqrt 5)
        a, b, n = math.atan(t / math.sqrt(5)), math.pi / 2, 20000
        h = (b - a) / n
        f = lambda u: 8 / (3 * math.pi) * math.cos(u) ** 4
        return h / 3 * (f(a) + f(b) + 4 * sum(f(a + h * i) for i in range(1, n, 2)) + 2 * sum(f(a + h * i) for i in range(2, n, 2)))

    assert evaluate(spark, pr.t5_upper_tail(F.col("x")), ts) == pytest.approx([integral(t) for t in ts], rel=1e-6)
