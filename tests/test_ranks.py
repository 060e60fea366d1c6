import random

import pytest

from yieldlens.operators import ranks as rk, values as va

SCHEMA = "Method string, OPID_TOOLID string, IndexValue double"


def order():
    return rk.ranking("IndexValue", "OPID_TOOLID")



def lists(spark, **named):
    return spark.createDataFrame([(m, f"f{i:03d}", float(v)) for m, values in named.items() for i, v in enumerate(values)], SCHEMA)


def paper_knee(values):
    """The published steps on one falling, convex list."""
    y = sorted(values, reverse=True)
    n = len(y)
    if n < 2 or y[0] == y[-1]:
        return None
    d = [1 - (v - y[-1]) / (y[0] - y[-1]) - i / (n - 1) for i, v in enumerate(y)]
    side = lambda i, j: d[j] if 0 <= j < n else d[i]
    threshold = knee = None
    for i in range(n - 1):
        high = d[i] >= side(i, i - 1) and d[i] >= side(i, i + 1)
        low = d[i] <= side(i, i - 1) and d[i] <= side(i, i + 1)
        if high:
            threshold, knee = d[i] - 1 / (n - 1), i + 1
        if low and knee:
            threshold = 0.0
        if knee and d[i + 1] < threshold:
            return knee
    return None


def knees(spark, df):
    return {r.Method: r.knee for r in rk.kneedle(df, ["Method"], "IndexValue", order()).select("Method", "knee").distinct().collect()}


def test_worked_list(spark):
    df = lists(spark, worked=[10, 5, 2, 1, 0.5, 0], flat=[3] * 7, one=[1])
    assert knees(spark, df) == {"worked": 3, "flat": None, "one": None}
    ranked = rk.kneedle(df, ["Method"], "IndexValue", order())
    size = lambda d: {r.Method: r["count"] for r in d.groupBy("Method").count().collect()}
    assert size(rk.cut_inclusive(ranked)) == {"worked": 3, "flat": 7, "one": 1}
    assert size(rk.cut_exclusive(ranked)) == {"worked": 2, "flat": 5, "one": 1}


def test_random_lists_follow_the_paper(spark):
    draw = random.Random(5)
    named = {}
    for k in range(60):
        n = draw.randrange(2, 40)
        kind = draw.choice(["power", "steps", "uniform", "line"])
        named[f"m{k}"] = [
            {"power": draw.random() ** 6, "steps": float(draw.randrange(4)), "uniform": draw.random(), "line": float(-i)}[kind] for i in range(n)
        ]
    found = knees(spark, lists(spark, **named))
    assert found == {m: paper_knee(v) for m, v in named.items()}


def test_fractions(spark):
    df = lists(spark, m=range(10), short=[1, 2, 3])
    names = lambda **o: {m: sorted(r.IndexValue for r in rk.top_fraction(df, ["Method"], "IndexValue", "OPID_TOOLID", **o).collect() if r.Method == m) for m in ("m", "short")}
    assert names(fraction=0.25) == {"m": [8, 9], "short": []}
    assert names(fraction=0.25, end="tail") == {"m": [0, 1], "short": [1, 2, 3]}
    assert names(fraction=1.0)["m"] == list(range(10))
    assert names(fraction=0.5, max_group_rows=2) == {"m": [5, 6, 7, 8, 9], "short": [3]}


def test_top_k_and_order(spark):
    df = lists(spark, m=[1, 3, 3, 2], n=[5])
    assert [(r.OPID_TOOLID) for r in rk.top_k(df, [], order(), 2).collect()] == ["f000", "f001"]
    assert rk.top_k(df, ["Method"], order(), 2).count() == 3
    assert [r.OPID_TOOLID for r in rk.sort_ranks(df.where("Method = 'm'"), "IndexValue", "OPID_TOOLID").collect()] == ["f001", "f002", "f003", "f000"]


def test_combination(spark):
    df = lists(spark, Lasso=[0.9, 0.5, 0.01, 0.008, 0.005], RF=[0.02, 0.7, 0.01, 0.01, 0.01])
    found = {r.OPID_TOOLID: (r.Inter_count, r.weight_IndexValue) for r in rk.combine_methods(df).collect()}
    assert found["f001"][0] == 2 and found["f001"][1] == pytest.approx(0.7 / 0.15)
    assert rk.label_frequency([df.where("Method = 'RF'"), df]).first().IndexValue == 3


def test_negative_weights_keep_their_order(spark):
    df = lists(spark, Lasso=[0.5, -0.9, -0.2])
    ours = {r.OPID_TOOLID: r.weight for r in va.scale_importance(df, ["Method"], "IndexValue").collect()}
    compat = {r.OPID_TOOLID: r.weight for r in va.scale_importance(df, ["Method"], "IndexValue", compat=True).collect()}
    assert ours["f000"] > 0 > ours["f001"] and compat["f000"] < 0 < compat["f001"]
