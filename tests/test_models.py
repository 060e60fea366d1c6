import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldlens.operators import compare as cm, importance as im, knn, metrics as me, recommend as rc, tuning as tu, values as va


def uniform(k):
    return F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10_000)) / 10_000.0


def factory(spark, n=600):
    tool = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5))
    return spark.range(n).select(
        "id", F.concat(F.lit("T"), tool).alias("tool"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(3)).alias("step"),
        (uniform(3) + F.when(tool == 2, 3.0).otherwise(0.0)).alias("loss"), F.when((tool == 2) | (uniform(4) > 0.9), 1).otherwise(0).alias("Y"),
    )


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 1.0, 1, 1), (2.0, 1.0, 1, 0), (4.0, 5.0, 0, 0), (-1.0, -1.0, 0, 1)], "y double, p double, a int, b int")
    row = me.mape(df, [("y", "p")]).first()
    assert row.mape == pytest.approx(25.0) and row.zero_targets == 1
    assert me.mean_error(df, [("y", "p")], True).first().mse == pytest.approx(0.75)
    assert me.mean_error(df, [("y", "p")], False).first().mae == pytest.approx(0.75)
    assert me.f1(df, "a", "b").first().f1 == pytest.approx(0.5)
    assert me.f1(df.where("a = 0 and b = 0"), "a", "b").first().f1 == 0.0


def dense_lasso(x, z, penalty, positive):
    """Proximal gradient on the full matrix."""
    n = len(z)
    w, rate = np.zeros(x.shape[1]), n / np.linalg.norm(x, 2) ** 2
    for _ in range(5000):
        w = w - rate * x.T @ (x @ w - z) / n
        w = np.maximum(w - rate * penalty, 0) if positive else np.sign(w) * np.maximum(np.abs(w) - rate * penalty, 0)
    return w


def test_lasso_solver_against_the_dense_matrix():
    draw = np.random.default_rng(1)
    x = (draw.random((300, 6)) < 0.4).astype(float)
    y = 2 * x[:, 0] + 0.5 * x[:, 1] - x[:, 2] + draw.normal(size=300) * 0.3
    z = (y - y.mean()) / y.std()
    for positive in (True, False):
        for penalty in (0.3, 0.05, 0.001):
            ours = im.coordinate_descent(x.T @ x, x.T @ z, 300 * penalty, positive, np.zeros(6))
            assert ours == pytest.approx(dense_lasso(x, z, penalty, positive), abs=1e-5)


def dense_cv(x, z, folds, positive):
    """Weights at the penalty with the least mean fold error, on the full matrix; centred unless positive."""
    def fit(x, z, alpha, start):
        shift = 0 if positive else x.mean(axis=0)
        return im.coordinate_descent((x - shift).T @ (x - shift), (x - shift).T @ (z - (0 if positive else z.mean())), len(z) * alpha, positive, start)

    grid = np.abs(x.T @ z).max() / len(z) * np.logspace(0, np.log10(im.ALPHA_RATIO), im.ALPHAS)
    errors = np.zeros(len(grid))
    for f in np.unique(folds):
        held, w = folds == f, np.zeros(x.shape[1])
        for k, alpha in enumerate(grid):
            w = fit(x[~held], z[~held], alpha, w)
            b = 0 if positive else z[~held].mean() - x[~held].mean(axis=0) @ w
            errors[k] += np.mean((z[held] - x[held] @ w - b) ** 2)
    return fit(x, z, grid[int(np.argmin(errors))], np.zeros(x.shape[1]))


def test_lasso_with_an_intercept_against_the_dense_matrix(spark):
    """Every level pulls downwards, so the fit is repeated with an intercept."""
    tool, step = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(3))
    df = spark.range(300).select("id", tool.alias("tool"), step.alias("step"), (9.0 - F.when(tool > 0, 4 + tool).otherwise(0) - F.when(step > 0, 3).otherwise(0) + uniform(5)).alias("y"))
    got = {r.OPID_TOOLID: r.IndexValue for r in im.rank_features_lasso(df, ["tool", "step"], "y", order=[F.col("id").asc()]).collect()}
    rows = df.orderBy("id").collect()
    x = np.array([[float(r.tool == k) for k in (1, 2, 3)] + [float(r.step == k) for k in (1, 2)] for r in rows])
    y = np.array([r.y for r in rows])
    names = ["tool_1", "tool_2", "tool_3", "step_1", "step_2"]
    z = (y - y.mean()) / y.std()
    folds = np.repeat(np.arange(5), 60)
    assert not dense_cv(x, z, folds, positive=True).any() and min(got.values()) < 0
    weights = dense_cv(x, z, folds, positive=False)
    assert got == pytest.approx({c: w for c, w in zip(names, weights) if round(float(w), 4) != 0}, abs=1e-4)


@pytest.mark.parametrize("levels", [3_000, 100_000])
def test_lasso_of_many_levels(spark, levels):
    """As many levels as a column may have; a third of the rows hold one value, and one tool is planted."""
    lot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(levels)))
    tool = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5))
    df = spark.range(2 * levels).select("id", lot.alias("lot"), tool.alias("tool"), (uniform(3) + F.when(tool == 2, 3.0).otherwise(0.0)).alias("loss"))
    best = im.rank_features_lasso(df, ["lot", "tool"], "loss", key=["id"]).first()
    assert best.OPID_TOOLID == "tool_2" and best.IndexValue > 1


@pytest.mark.parametrize("positive", [True, False])
def test_block_descent_against_the_dense_matrix(positive):
    draw = np.random.default_rng(2)
    picked = [draw.integers(-1, 4, 200), draw.integers(-1, 3, 200)]  # -1: the level left out
    x = np.hstack([picked[0][:, None] == np.arange(4), picked[1][:, None] == np.arange(3)]).astype(float)
    z = x @ draw.normal(size=7) + draw.normal(size=200)
    gram = x.T @ x
    i, j = np.nonzero(np.triu(gram))
    block = im.BlockGram([0, 4, 7], i, j, gram[i, j])
    w = block.lasso(x.T @ z, np.full(7, 5.0), positive, np.zeros(7))
    assert w == pytest.approx(im.coordinate_descent(gram, x.T @ z, 5.0, positive, np.zeros(7)), abs=1e-7)
    pull = x.T @ z - gram @ w  # the conditions of an optimum
    assert (pull[w == 0] <= 5 + 1e-6).all() and pull[w != 0] == pytest.approx(5 * np.sign(w[w != 0]), abs=1e-5)
    assert block.times(w) == pytest.approx(gram @ w)


@pytest.mark.parametrize("ordered", [True, False])
def test_lasso_finds_the_planted_tool(spark, ordered):
    df = factory(spark)
    split = {"order": [F.col("id").asc()]} if ordered else {"key": ["id"]}
    found = im.rank_features_lasso(df, ["tool", "step"], "loss", **split).collect()
    assert found[0].OPID_TOOLID == "tool_T2" and all(r.IndexValue > 0 for r in found)
    if ordered:  # the same answer from the rows themselves
        rows = df.orderBy("id").collect()
        names = [f"tool_T{i}" for i in range(1, 5)] + ["step_1", "step_2"]
        x = np.array([[float(f"tool_{r.tool}" == c or f"step_{r.step}" == c) for c in names] for r in rows])
        y = np.array([r.loss for r in rows])
        folds = np.repeat(np.arange(5), len(rows) // 5)
        weights = dense_cv(x, (y - y.mean()) / y.std(), folds, positive=True)
        got = {r.OPID_TOOLID: r.IndexValue for r in found}
        assert got == {c: round(float(w), 4) for c, w in zip(names, weights) if round(float(w), 4) != 0}


def test_lasso_falls_back_when_all_weights_would_be_negative(spark):
    df = spark.range(200).select("id", (F.col("id") % 2).alias("a"), (5.0 - 4 * (F.col("id") % 2) + uniform(1) / 10).alias("y"))
    # without intercept and with a centred response, the only indicator pulls downwards
    found = im.rank_features_lasso(df, ["a"], "y", key=["id"]).collect()
    assert [r.OPID_TOOLID for r in found] == ["a_1"] and found[0].IndexValue < 0


def test_forest_and_factor_selection(spark):
    df = factory(spark)
    forest = im.rank_features_forest(df.drop("id", "loss"), ["tool", "step"], "Y", trees=10, max_depth=4).collect()
    assert forest[0].OPID_TOOLID == "tool_T2"
    ranks, factors = im.select_factors(df.drop("loss"), "Y", key=["id"], trees=10, max_depth=4)
    assert {r.Method for r in ranks.collect()} == {"Lasso", "RF"}
    best = factors.orderBy(F.desc("Inter_count"), F.desc("weight_IndexValue")).first()
    assert (best.OPID_TOOLID, best.Inter_count) == ("tool_T2", 2)
    empty = im.select_factors(df.select("id", F.lit(1).alias("only"), "Y"), "Y", key=["id"])
    assert [t.count() for t in empty] == [0, 0]
    importance = im.rank_features_rf(df.withColumn("noise", uniform(9)).withColumn("loss2", F.col("step") * 5.0), ["step", "noise"], ["loss2"], trees=8, max_depth=4).collect()
    assert importance[0].feature == "step" and sum(r.importance for r in importance) == pytest.approx(100)


def measures(spark, n=500):
    return spark.range(n).select(uniform(1).alias("a"), uniform(2).alias("b"), uniform(3).alias("c"))


SMALL = {"rounds": 3, "trees": 5, "depth": 3, "iterations": 50}


def test_classifier_comparison(spark):
    df = measures(spark).withColumn("Y", (F.col("a") > 0.7).cast("int"))
    split = cm.split_rows(df, "Y").groupBy("Y").agg(F.count("*").alias("n"), F.count_if("_test").alias("t")).collect()
    assert all(r.t == -(-3 * r.n // 10) for r in split)  # ceil(0.3 n)
    found = cm.compare_classifiers(df, **SMALL)
    assert set(found.scores) == {"Logit", "SVM", "XGB", "RF"} and max(found.scores.values()) > 0.95
    assert found.features[0] == "a" and found.table.where("Features = 'Accuracy'").count() == 4
    assert found.best.columns == ["Model", "Features", "Inter_count", "weight_Value"]
    with pytest.raises(ValueError):
        cm.compare_classifiers(df.withColumn("Y", F.lit(1)), **SMALL)


def test_regressor_comparison(spark):
    df = measures(spark).select("a", "b", "c", (2 * F.col("a") + 0.1).alias("Ylabel_one"), (3 * F.col("a")).alias("Ylabel_two"), F.lit(4.0).alias("Ylabel_flat"))
    found = cm.compare_regressors(df, **SMALL)
    assert found.features[0] == "a" and min(found.scores.values()) < 1e-6
    worst = max(found.scores, key=found.scores.get)
    assert cm.compare_regressors(df, compat=True, **SMALL).best.first().Model == worst


@pytest.mark.parametrize("options", [{}, {"broadcast_cells": 300}, {"broadcast_cells": 1, "block_rows": 16, "pivots": 5}])
def test_neighbours_against_brute_force(spark, options):
    """A third of the training rows are copies of one point."""
    draw = np.random.default_rng(3)
    train = draw.normal(size=(240, 4)).round(2)
    train[:80] = train[0]
    test = draw.normal(size=(60, 4)).round(2)
    test[:20] = train[0]
    y = draw.random(240)
    t = spark.createDataFrame([(i, [float(v) for v in r], float(v)) for i, (r, v) in enumerate(zip(train, y))], "id long, features array<double>, y double").repartition(5)
    q = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(test)], "id long, features array<double>").repartition(3)
    found = {r.id: r.prediction for r in knn.knn_regress(t, q, 5, **options).collect()}
    for i, r in enumerate(test):
        order = np.lexsort((np.arange(240), ((train - r) ** 2).sum(axis=1)))[:5]
        assert found[i] == pytest.approx(y[order].mean())
    own = {r.id: r.prediction for r in knn.knn_regress(t, t.drop("y"), 3, leave_out=True, **options).collect()}
    for i in (0, 79, 100, 239):
        gaps = ((train - train[i]) ** 2).sum(axis=1)
        gaps[i] = np.inf
        assert own[i] == pytest.approx(y[np.lexsort((np.arange(240), gaps))[:3]].mean())


def test_neighbours_of_a_crowded_cell_in_several_stripes(spark, monkeypatch):
    """No stripe holds over 16 rows, though a third of the rows lie in one place; answers stay those of brute force."""
    monkeypatch.setattr(knn, "STRIPE_CELLS", 64)
    draw = np.random.default_rng(5)
    x = np.concatenate([np.tile(draw.normal(size=4), (80, 1)), draw.normal(size=(160, 4))]).round(2)
    y = draw.random(240)
    t = spark.createDataFrame([(i, [float(v) for v in r], float(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, features array<double>, y double").repartition(5)
    found = {r.id: r.prediction for r in knn.knn_regress(t, t, 5, leave_out=True, broadcast_cells=1, block_rows=7, pivots=9).collect()}
    for i in range(240):
        gaps = ((x - x[i]) ** 2).sum(axis=1)
        gaps[i] = np.inf
        assert found[i] == pytest.approx(y[np.lexsort((np.arange(240), gaps))[:5]].mean())


def test_stripes_are_bounded_and_hold_every_cell():
    draw = np.random.default_rng(6)
    size = draw.integers(1, 90, 40)
    first, parts, stripes = knn._stripes(np.arange(40), size, draw.normal(size=(40, 3)), 30)
    held = np.zeros(stripes)
    for f, p, n in zip(first, parts, size):
        held[f : f + p] += n / p
    assert held.max() <= 30 and held.min() > 0 and stripes <= 2 * size.sum() / 30 + 1


def test_generated_model_is_saved_and_used(spark, tmp_path):
    df = measures(spark, 300).select("a", "b", (1 + 2 * F.col("a")).alias("y1"), (5 - F.col("b")).alias("y2"))
    made = tu.generate_model(
        df, ["a", "b"], ["y1", "y2"], names=["KNN", "Lasso Regression"], params={"Lasso Regression": {"alpha": 0.0001}},
        folds=2, repeats=1, trials=2, tune_folds=2, space={"alpha": 0.0002},
    )
    assert made.name == "Lasso Regression" and made.mape < 1
    made.model.save(str(tmp_path / "model"))
    again = tu.FittedRegressor.load(spark, str(tmp_path / "model"))
    rows = made.predict(df.limit(20)).collect()
    assert all(abs(r.prediction_y1 - r.y1) < 0.05 for r in rows)
    vectors = im.assemble(df, ["a", "b"], scaler=made.scaler)
    assert again.transform(vectors).agg(F.max(F.abs(F.col("prediction_y2") - F.col("y2")))).first()[0] < 0.05
    assert set(tu.draw_params("XGBoost", __import__("random").Random(1))) == {"depth", "trees", "rate"}


def line_model(spark):
    df = spark.range(400).select((uniform(1) * 10).alias("a"), (uniform(2) * 4 + 1).alias("b")).withColumn("y", 2 * F.col("a") + 3 * F.col("b"))
    scaler = va.fit_scaler(df, ["a", "b"])
    return df, scaler, tu.fit("Lasso Regression", {"alpha": 0.0}, im.assemble(df, ["a", "b"], scaler=scaler), ["y"])


def test_recommendation_reaches_a_known_optimum(spark):
    df, scaler, model = line_model(spark)
    goals = spark.createDataFrame([(1, 20.0), (2, 200.0)], "target_id long, y double")
    args = (model, scaler, ["a", "b"], ["a"], [[0.0, 1.0], [10.0, 5.0]], goals, ["y"], df)
    costs = {}
    for rounds in (1, 3, 7):
        for r in rc.search(*args, restarts=2, candidates=80, rounds=rounds).collect():
            costs.setdefault((r.target_id, r.restart), []).append(r.cost)
    assert all(c == sorted(c, reverse=True) for c in costs.values())  # never worse with more rounds
    found = {(r.target_id, r.feature): r for r in rc.recommend_values(*args, all_parameters=True, candidates=150, rounds=8).collect()}
    b = df.agg(F.avg("b")).first()[0]
    assert found[1, "b"].Recommendation == pytest.approx(b, abs=0.2) and not found[1, "b"].self_controled
    assert 2 * found[1, "a"].Recommendation + 3 * found[1, "b"].Recommendation == pytest.approx(20, abs=0.3)
    assert found[2, "a"].Recommendation == pytest.approx(10, abs=0.05)  # out of reach: at the bound
    only = rc.recommend_values(*args, candidates=20, rounds=2)
    assert only.columns == ["target_id", "feature", "Recommendation", "cost"] and {r.feature for r in only.collect()} == {"a"}
    every = rc.search(*args[:3], ["a", "b"], *args[4:], restarts=1, candidates=50, rounds=3)
    assert every.where("cost is null").count() == 0  # all controlled: no history term
    assert rc.search(*args, restarts=2, candidates=30, rounds=2).exceptAll(rc.search(*args[:5], goals.repartition(7), *args[6:], restarts=2, candidates=30, rounds=2)).isEmpty()


def test_intervals(spark):
    rows = [(1, i, "a", float(v), 0.1 * (i + 1)) for i, v in enumerate([4, 5, 6])] + [(1, i, "b", 2.0, 0.3) for i in range(3)]
    df = spark.createDataFrame(rows, "target_id long, restart int, feature string, value double, cost double")
    found = {r.feature: r for r in rc.ranges(df, ["a", "b"], [[4.5, 0.0], [100.0, 5.0]]).collect()}
    assert found["a"].Lower_bound == 4.5 and found["a"].Upper_bound == pytest.approx(5 + 1.959964 * np.std([4, 5, 6]))
    assert (found["b"].Lower_bound, found["b"].Upper_bound) == (2.0, 2.0) and found["a"].best_cost == pytest.approx(0.1)


class Columnwise:
    """A model that isn't known to be lines."""

    def __init__(self, model):
        self.transform = model.transform


def test_rounds_on_arrays_give_the_rows_of_rounds_on_columns(spark, monkeypatch):
    """Repeated, null and negative ids, goals that are null, zero, not a number or out of reach."""
    df, scaler, _ = line_model(spark)
    df = df.withColumn("z", F.col("a") - F.col("b"))
    model = tu.fit("Lasso Regression", {"alpha": 0.01}, im.assemble(df, ["a", "b"], scaler=scaler), ["y", "z"])
    nan = float("nan")
    rows = [(1, 20.0, 1.0), (1, 9.0, 2.0), (-7, 11.0, 0.5), (None, 14.0, 3.0), (2**40, 25.0, -1.0), (5, None, 1.0), (6, -rc.EPSILON, 1.0), (7, nan, 1.0), (7, None, 1.0), (8, 0.0, 1e9)]
    goals = spark.createDataFrame(rows, "target_id long, y double, z double")
    for controls, seed, scale in ((["a"], rc.SEED, scaler), (["a", "b"], 2**35, scaler), ([], -3, None)):
        args = (scale, ["a", "b"], controls, [[0.0, 1.0], [10.0, 5.0]], goals, ["z", "y"], df)
        for effort in ({"restarts": 3, "candidates": 30, "rounds": 4}, {"restarts": 1, "candidates": 1, "rounds": 1}):
            old = rc.search(Columnwise(model), *args, seed=seed, **effort)
            with monkeypatch.context() as m:
                m.setattr(rc, "AT_ONCE", 64)
                new = rc.search(model, *args, seed=seed, **effort)
                assert new.columns == old.columns and sorted(map(str, new.collect())) == sorted(map(str, old.collect()))


def test_line_models_write_no_candidates(spark, monkeypatch):
    """Each candidate was a row, sorted and shuffled by target, in every round."""
    df, scaler, model = line_model(spark)
    goals = spark.createDataFrame([(1, 20.0)], "target_id long, y double")
    made = []
    monkeypatch.setattr(rc, "cut_lineage", lambda d: made.append(d) or d)
    found = rc.search(model, scaler, ["a", "b"], ["a"], [[0.0, 1.0], [10.0, 5.0]], goals, ["y"], df, rounds=6)
    assert len(made) == 1 and found.count() == rc.RESTARTS
