import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldlens.operators import ordered, spc

rng = np.random.default_rng(21)
DATA = np.round(np.exp(rng.normal(-2.0, 0.9, 31)), 3).tolist()
USL = float(np.sort(DATA)[-3])  # two values are above it


def brute(x):
    """Q values, moving-range mean and X-MR limit by their definitions, one row at a time."""
    mean = lambda v: sum(v) / len(v)
    trailing = lambda v, i: v[max(0, i - 4) : i + 1]
    bars = [mean(trailing(x, i)) for i in range(len(x))]
    s = [float(np.std(trailing(x, i))) for i in range(len(x))]
    s_bars = [mean(trailing(s, i)) for i in range(len(x))]
    q = []
    for k in range(len(x)):
        if k < 2 or s_bars[k] == 0:
            q.append(0.0)
            continue
        t = (k / (k + 1)) ** 0.5 * (x[k] - bars[k - 1]) / s_bars[k]
        # the tail of Student's t with 5 degrees by Simpson's rule, in u = 1 / (1 + t)
        u = np.linspace(0, 1 / (1 + abs(t)), 20_001)[1:]
        w = (1 - u) / u
        density = 8 / (3 * math.pi * 5**0.5) * (1 + w * w / 5) ** -3 / u**2
        tail = float(np.trapezoid(np.append(0.0, density), np.append(0.0, u)))
        q.append(math.copysign(-NormalDist().inv_cdf(tail), t))
    mr = mean([abs(b - a) for a, b in zip(x, x[1:])])
    return q, mr, mean(x)


def series(spark, values=DATA, key="A"):
    return spark.createDataFrame([(key, i, f"sheet{i}", float(v)) for i, v in enumerate(values)], "line string, seq int, sheet string, data double")


def order():
    return [F.col("seq").asc()]


@pytest.mark.parametrize("limits", [{}, {"max_group_rows": 4, "block_rows": 9}])
def test_against_definitions(spark, limits):
    rows = spc.spc_table(series(spark), ["line"], order(), "sheet", "data", usl=USL, **limits).orderBy("ordinal").collect()
    q, mr, mean = brute(DATA)
    assert [r["Q-value"] for r in rows] == pytest.approx(q, abs=2e-6)
    flagged = lambda c: [r["ordinal"] for r in rows if r[c]]
    z = NormalDist().inv_cdf(0.975)
    assert flagged("Out of Q control limit") == [i for i, v in enumerate(q) if v > z]
    assert flagged("Out of X-MR control limit") == [i for i, v in enumerate(DATA) if v > mr + 3 * mr / 1.128]
    assert flagged("Out of X-MR spec line") == [i for i, v in enumerate(DATA) if v > USL]


def test_limits(spark):
    _, mr, mean = brute(DATA)
    row = spc.xmr_limits(series(spark), ["line"], order(), "data").first()
    assert (row.mr_bar, row.ucl, row.cl) == pytest.approx((mr, mr + 3 * mr / 1.128, mean))
    centred = spc.xmr_limits(series(spark), ["line"], order(), "data", center="mean").first()
    assert centred.ucl == pytest.approx(mean + 3 * mr / 1.128)
    assert spc.q_limits()["UCL"] == pytest.approx(NormalDist().inv_cdf(0.975))


def test_blocks_equal_one_long_window(spark):
    """One series holds nearly all rows; blocks of every small size give the same values."""
    df = spark.range(997).select(
        F.when(F.col("id") % 50 == 0, "cold").otherwise("hot").alias("line"), F.col("id").alias("seq"),
        F.concat(F.lit("s"), "id").alias("sheet"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 7.0).alias("data"),
    ).repartition(8)
    whole = spc.q_statistic(df, ["line"], order(), "data").orderBy("line", "seq").collect()
    for block in (9, 64, 500):
        cut = spc.q_statistic(df, ["line"], order(), "data", max_group_rows=10, block_rows=block).orderBy("line", "seq").collect()
        assert [tuple(r)[:3] for r in cut] == [tuple(r)[:3] for r in whole]
        assert [r.q_value for r in cut] == pytest.approx([r.q_value for r in whole], abs=1e-9)
        assert [r.ordinal for r in cut] == [r.ordinal for r in whole]


def test_short_and_flat_series(spark):
    df = series(spark, [5.0], "one").unionByName(series(spark, [2.0] * 8, "flat")).unionByName(series(spark, [1.0, 4.0], "two"))
    rows = spc.spc_table(df, ["line"], order(), "sheet", "data").collect()
    assert len(rows) == 11 and all(r["Q-value"] == 0 for r in rows)
    assert all(r["Out of X-MR spec line"] is None for r in rows)


def test_extreme_jump(spark):
    df = series(spark, [1.0, 1.0001, 1.0, 1.0002, 1.0001, 1.0, 1e9])
    exact = {r.seq: r.q_value for r in spc.q_statistic(df, ["line"], order(), "data").collect()}
    compat = {r.seq: r.q_value for r in spc.q_statistic(df, ["line"], order(), "data", compat=True).collect()}
    assert exact[6] > 0
    steep = series(spark, [1.0] * 3 + [1.0 + 1e-9] + [1.0] * 6 + [1.0 + 1e-9, 50.0])
    assert compat.keys() == exact.keys() and spc.q_statistic(steep, ["line"], order(), "data").count() == 12


def test_chart_tables(spark):
    points, lines = spc.chart_tables(series(spark), ["line"], order(), "sheet", "data", usl=0.6)
    colours = {r.ordinal: (r.q_color, r.x_color) for r in points.collect()}
    q, mr, _ = brute(DATA)
    assert colours == {
        i: ("red" if v > NormalDist().inv_cdf(0.975) else "black", "red" if x > mr + 3 * mr / 1.128 else "black")
        for i, (v, x) in enumerate(zip(q, DATA))
    }
    assert lines.first().x_usl == 0.6


def test_runs_and_adjacent_repeats_in_blocks(spark):
    df = spark.range(300).select(F.lit("k").alias("k"), F.col("id"), F.floor(F.sqrt(F.col("id"))).alias("v")).repartition(6)
    plain = ordered.run_ids(df, ["k"], [F.col("id").asc()], ["v"]).orderBy("id").collect()
    cut = ordered.run_ids(df, ["k"], [F.col("id").asc()], ["v"], max_group_rows=10, block_rows=7).orderBy("id").collect()
    assert [r.run_id for r in cut] == [r.run_id for r in plain] == [r.v + 1 for r in plain]
    kept = ordered.drop_adjacent_repeats(df, ["k"], [F.col("id").asc()], ["v"], max_group_rows=10, block_rows=7)
    assert sorted(r.id for r in kept.collect()) == [i * i for i in range(18)]


def test_null_keys_are_a_series_of_their_own(spark):
    df = spark.createDataFrame([(None, i) for i in range(20)] + [("a", i) for i in range(20)], "k string, id long")
    found = ordered.with_ordinal(df, ["k"], [F.col("id").asc()], max_group_rows=5).collect()
    assert len(found) == 40 and all(r.id == r.ordinal for r in found)
