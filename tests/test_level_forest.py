import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldlens.operators import importance as im, level_forest as lf


def rows_of(spark, n=400, columns=3, levels=5, parts=4, seed=3):
    """Coded rows and the same as arrays: ids by row, number of equal rows, targets (class, value)."""
    rng = np.random.default_rng(seed)
    starts = [levels * i for i in range(columns + 1)]
    ids = [[int(levels * c + v) for c in range(columns) if (v := rng.integers(-1, levels)) >= 0] for _ in range(n)]
    label = [float(2 in x) if rng.random() < 0.8 else float(rng.integers(0, 3)) for x in ids]
    value = [float(7 in x) * 3 + float(rng.random()) for x in ids]
    copies, draw = rng.integers(1, 90, n), rng.integers(-(2**62), 2**62, n)
    data = [(x, int(c), int(d), [a, b]) for x, c, d, a, b in zip(ids, copies, draw, label, value)]
    frame = spark.createDataFrame(data, "ids array<int>, n long, draw long, y array<double>").repartition(parts)
    return frame, starts, ids, copies, draw, np.array([label, value])


def error(y, w, classes):
    if not w.sum():
        return 0.0
    if classes:
        return w.sum() - sum(w[y == k].sum() ** 2 for k in range(classes)) / w.sum()
    return (w * (y - (w @ y) / w.sum()) ** 2).sum()


def test_regression_trees_are_those_of_trying_every_split(spark):
    frame, starts, ids, copies, draw, y = rows_of(spark)
    width = starts[-1]
    splits = lf.grow(frame.withColumn("y", F.slice("y", 2, 1)), starts, [0], 3, 4, 5)
    holds = np.array([[i in x for i in range(width)] for x in ids])
    own = lf.hash_bits((5 * 1_000_003 + np.arange(3) + 1).astype(np.uint64))
    weights = lf.poisson(copies, draw.astype(np.int64).view(np.uint64), own)
    expected = {}

    def descend(tree, path, at, depth):
        w = weights[:, tree] * at
        if depth == 4 or w.sum() < 2:
            return
        whole = error(y[1], w, 0)
        gains = [round(whole - error(y[1], w * holds[:, i], 0) - error(y[1], w * ~holds[:, i], 0), 6) for i in range(width)]
        gains = [g if 0 < (w * holds[:, i]).sum() < w.sum() else 0 for i, g in enumerate(gains)]
        best = int(np.argmax(gains))
        if gains[best] > 1e-5:
            expected[tree, path] = (best, gains[best])
            descend(tree, 2 * path, at & holds[:, best], depth + 1)
            descend(tree, 2 * path + 1, at & ~holds[:, best], depth + 1)

    for tree in range(3):
        descend(tree, 1, np.ones(len(ids), bool), 0)
    got = {(r.tree, r.path): (r.id, r.gain) for r in splits.itertuples()}
    assert set(got) == set(expected) and len(got) > 20
    for key, (best, gain) in expected.items():
        assert got[key][0] == best and got[key][1] == pytest.approx(gain, abs=1e-5)


def test_classes_lower_gini_and_partitions_do_not_matter(spark, monkeypatch):
    frame, starts, ids, copies, draw, y = rows_of(spark)
    one = frame.withColumn("y", F.slice("y", 1, 1))
    splits = lf.grow(one, starts, [3], 4, 3, 1)
    own = lf.hash_bits((1_000_003 + np.arange(4) + 1).astype(np.uint64))
    weights = lf.poisson(copies, draw.astype(np.int64).view(np.uint64), own)
    for r in splits[splits["path"] == 1].itertuples():
        has, w = np.array([r.id in x for x in ids]), weights[:, r.tree]
        assert r.gain == pytest.approx(error(y[0], w, 3) - error(y[0], w * has, 3) - error(y[0], w * ~has, 3))
    # small runs, other partitions, and another target beside it: the same trees
    monkeypatch.setattr(lf, "HELD", 50)
    monkeypatch.setattr(lf, "WALKED", 100)
    monkeypatch.setattr(lf, "TREES", 3)
    both = lf.grow(frame.repartition(7), starts, [3, 0], 4, 3, 1)
    again = both[both["target"] == 0].sort_values(["tree", "path"])
    assert again[["tree", "path", "id"]].values.tolist() == splits.sort_values(["tree", "path"])[["tree", "path", "id"]].values.tolist()
    found = lf.importances(both)
    assert found.groupby("target")["importance"].sum().tolist() == pytest.approx([1, 1])


def test_draws_have_the_mean_and_spread_of_a_poisson():
    rng = np.random.default_rng(1)
    own = lf.hash_bits(np.arange(1, 41, dtype=np.uint64))
    for size in (1, 7, 64, 65, 1000):
        got = lf.poisson(np.full(2000, size), rng.integers(0, 2**63, 2000, dtype=np.uint64), own)
        assert got.mean() == pytest.approx(size, rel=0.02) and got.var() == pytest.approx(size, rel=0.05)


@pytest.mark.parametrize("task", ["classification", "regression"])
def test_any_number_of_levels(spark, task):
    n = 20_000
    df = spark.range(n).select(
        F.concat(F.lit("L"), F.pmod(F.xxhash64("id"), F.lit(3000))).alias("lot.no"), F.concat(F.lit("T"), F.col("id") % 7).alias("tool"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 2).alias("half"), F.when((F.col("id") % 7 == 3) & (F.col("id") % 13 < 12), 1).otherwise(0).alias("Y"),
    )
    found = im.rank_features_forest(df, ["lot.no", "tool", "half"], "Y", task, trees=10, max_depth=3).collect()
    assert found[0].OPID_TOOLID == "tool_T3"
    if task == "regression":  # a node of a classification tree sees 55 of 3,008 levels
        assert found[0].IndexValue > 0.5
    unit = im.rank_features_forest(df.withColumn("unit", F.monotonically_increasing_id().cast("string")), ["unit", "tool"], "Y", "regression", trees=2, max_depth=2)
    assert unit.first().OPID_TOOLID == "tool_T3"


def test_odd_tables(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("b", None, 1.0), (None, 0.0, None), ("a", 1.0, 0.0)], "x string, y1 double, y2 double")
    first, second = im.rank_features_forest_each(df, ["x"], ["y1", "y2"], trees=20, max_depth=2)
    assert first.collect() == []  # x = b is left out, no level tells the others apart
    assert [r.OPID_TOOLID for r in second.collect()] == ["x_b"]
    assert im.rank_features_forest(df.where("false"), ["x"], "y1").collect() == []
    assert im.rank_features_forest(df.withColumn("x", F.lit(1)), ["x"], "y1").collect() == []
    with pytest.raises(ValueError):
        im.rank_features_forest(df, ["x"], "y1", "ranking")
