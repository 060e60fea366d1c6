"""Key factors by forest importance and by non-negative lasso."""

from __future__ import annotations

import functools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from yieldlens.operators import columns as co, level_forest as lf, ordered, ranks as rk, statistics as st, trees as tr, values as va
from yieldlens.session import cut_lineage, importable

# Forest sizes and seeds, lasso grid and folds.
RANK_TREES, RANK_SEED = 1024, 42
SELECT_TREES, SELECT_SEED = 100, 11850
ALPHAS, ALPHA_RATIO, FOLDS = 100, 1e-3, 5

RANK_SCHEMA = f"{rk.METHOD} string, {rk.LABEL} string, {rk.VALUE} double"


def assemble(df: DataFrame, features: Sequence[str], output: str = "features", scaler: va.Scaler | None = None) -> DataFrame:
    """Add the feature columns, scaled when asked, as one vector."""
    cells = {c: st.quoted(c).cast("double") for c in features}
    if scaler is not None:
        cells = {c: (v - F.lit(scaler.means[c])) / F.lit(scaler.stds[c]) for c, v in cells.items()}
    safe = [f"_x{i}" for i in range(len(features))]  # feature names may hold dots
    renamed = df.select("*", *[cells[c].alias(s) for c, s in zip(features, safe)])
    return VectorAssembler(inputCols=safe, outputCol=output).transform(renamed).drop(*safe)


def rank_features_rf(
    df: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    trees: int = RANK_TREES,
    max_depth: int = 10,
    seed: int = RANK_SEED,
) -> DataFrame:
    """feature, importance in percent, falling: one forest whose trees split for all targets together.

    Trees split on order only, so the features need no scaling; targets weigh the same. Bootstrap samples are
    hashes of the rows' values, so equal rows are drawn alike and the result doesn't depend on partitioning. Rows with a null target are left out.
    """
    vector = F.array(*[st.quoted(c).cast("double") for c in features])
    draw = F.xxhash64(*[st.quoted(c) for c in [*features, *targets]])
    binned = tr.bin_rows(df, vector, features, targets, draw)
    nodes = tr.grow(binned, [tr.Spec(tuple(range(len(targets))), trees, max_depth, seed=seed)])
    return rk.sort_ranks(tr.importances(nodes, features).select("feature", "importance"), "importance", "feature")


# ---- lasso on indicator columns


def _fold(df: DataFrame, order: Sequence[Column] | None, key: Sequence[str] | None, folds: int) -> DataFrame:
    """Fold number: contiguous stretches of the ordered rows, or a hash of the key."""
    if order is not None:
        placed = ordered.with_ordinal(df, [], order, "_place")
        n = df.count()
        long_folds, size = n % folds, n // folds
        edge = long_folds * (size + 1)
        fold = F.when(F.col("_place") < edge, F.floor(F.col("_place") / (size + 1))).otherwise(
            long_folds + F.floor((F.col("_place") - edge) / max(size, 1))
        )
        return placed.withColumn("_fold", fold.cast("int")).drop("_place")
    if key is None:
        raise ValueError("the folds need row order columns or a row key")
    return df.withColumn("_fold", F.pmod(F.xxhash64(*[st.quoted(c) for c in key]), F.lit(folds)).cast("int"))


def _facts(rows: DataFrame, folds: int, sums: Sequence[str]) -> DataFrame:
    """i, j (i <= j) of every two ids that a row holds, with n0.. rows by fold and, where i = j, the sums s0.. of each target by fold.

    ``rows``: _fold, ids (the indicators that are 1, rising), n and ``sums``. Map-side combined aggregations.
    """

    def by_fold(c: str) -> list[Column]:
        return [F.sum(F.when(F.col("_fold") == f, F.col(c)).otherwise(0)).alias(f"{c}_{f}") for f in range(folds)]

    pairs = F.flatten(
        F.transform("ids", lambda x, i: F.transform(F.slice("ids", i + 1, F.size("ids")), lambda y: F.struct(x.alias("i"), y.alias("j"))))
    )
    counts = rows.select("_fold", "n", F.explode(pairs).alias("pair")).groupBy("pair.i", "pair.j").agg(*by_fold("n"))
    singles = rows.select("_fold", *sums, F.explode("ids").alias("i")).groupBy("i").agg(*[c for s in sums for c in by_fold(s)])
    return counts.join(singles.withColumn("j", F.col("i")), ["i", "j"], "left")


def coordinate_descent(gram, cross, penalty: float, positive: bool, start, max_iterations: int = 10_000, tolerance: float = 1e-9):
    """Lasso weights for 1/2 w'Gw - c'w + penalty |w| (Friedman, Hastie, Tibshirani 2010)."""
    w = start.copy()
    slack = cross - gram @ w
    diagonal = np.diag(gram)
    live = np.flatnonzero(diagonal > 0)
    for _ in range(max_iterations):
        moved = 0.0
        for j in live:
            pull = slack[j] + diagonal[j] * w[j]
            size = pull if positive else abs(pull)
            new = max(size - penalty, 0.0) / diagonal[j] * (1.0 if positive else np.sign(pull))
            if new != w[j]:
                step = new - w[j]
                slack -= gram[:, j] * step
                w[j] = new
                moved = max(moved, abs(step))
        if moved <= tolerance * max(1.0, np.abs(w).max(initial=0.0)):
            break
    return w


class BlockGram:
    """Cross products of indicators: none inside a column but the diagonal, across columns the pairs that occur.

    ``starts`` are the columns' first ids and the number of ids. With ``ones`` (rows) there is one more
    indicator that is always 1, for the intercept.
    """

    def __init__(self, starts: Sequence[int], i: np.ndarray, j: np.ndarray, n: np.ndarray, ones: float | None = None):
        p = starts[-1]
        edges = np.unique(np.asarray(starts if ones is None else [*starts, p + 1]))
        self.size = int(edges[-1])
        self.diagonal = np.zeros(self.size)
        same = i == j
        self.diagonal[i[same]] = n[same]
        i, j, n = i[~same], j[~same], n[~same].astype(float)
        if ones is not None:
            every = np.flatnonzero(self.diagonal)
            i, j, n = np.r_[i, every], np.r_[j, np.full(len(every), p)], np.r_[n, self.diagonal[every]]
            self.diagonal[p] = ones
        rows, columns, values = np.r_[i, j], np.r_[j, i], np.r_[n, n]
        order = np.argsort(columns, kind="stable")
        rows, columns, values = rows[order], columns[order], values[order]
        cuts = np.searchsorted(columns, edges)
        self.blocks = [
            (a, b, rows[u:v], columns[u:v] - a, values[u:v]) for a, b, u, v in zip(edges[:-1], edges[1:], cuts[:-1], cuts[1:])
        ]

    def times(self, w: np.ndarray) -> np.ndarray:
        out = self.diagonal * w
        for a, b, rows, columns, values in self.blocks:
            out += np.bincount(rows, weights=values * w[a:b][columns], minlength=self.size)
        return out

    def lasso(self, cross, penalty, positive: bool, start, max_iterations: int = 10_000, tolerance: float = 1e-9) -> np.ndarray:
        """Lasso weights for 1/2 w'Gw - c'w + penalty |w|, ``penalty`` by indicator.

        Indicators of one column never meet in a row, so a column's weights are solved all at once, exactly.
        """
        w = start.copy()
        slack = cross - self.times(w)
        for _ in range(max_iterations):
            moved = 0.0
            for a, b, rows, columns, values in self.blocks:
                d = self.diagonal[a:b]
                pull = slack[a:b] + d * w[a:b]
                size = pull if positive else np.abs(pull)
                new = np.divide(np.maximum(size - penalty[a:b], 0.0), d, out=np.zeros(b - a), where=d > 0)
                if not positive:
                    new *= np.sign(pull)
                step = new - w[a:b]
                if step.any():
                    slack[a:b] -= d * step
                    slack -= np.bincount(rows, weights=values * step[columns], minlength=self.size)
                    w[a:b] = new
                    moved = max(moved, float(np.abs(step).max()))
            if moved <= tolerance * max(1.0, float(np.abs(w).max(initial=0.0))):
                break
        return w


def _cv_lasso(facts: DataFrame, sizes: dict, starts: Sequence[int], positive: bool, intercept: bool) -> DataFrame:
    """id, w: weights other than 0 at the penalty with the least mean fold error.

    ``facts``: see ``_facts``; ``sizes``: rows, sum and sum of squares of y by fold. A task solves the path of one
    left-out fold on the sparse cross products; the driver sees the errors, folds x penalties numbers.
    """
    spark = facts.sparkSession
    folds = [f for f in sizes if sizes[f][0]]
    n, total, square = (sum(sizes[f][k] for f in folds) for k in range(3))
    mean = total / n
    std = float(np.sqrt(max(square / n - mean**2, 0.0))) or 1.0
    p = starts[-1]

    def scaled(count, s, ss):  # z = (y - mean) / std: sum, sum of squares
        return (s - mean * count) / std, (ss - 2 * mean * s + count * mean**2) / std**2

    def all_of(name: str) -> Column:
        return functools.reduce(Column.__add__, [F.col(f"{name}{f}") for f in folds])

    pull = F.abs((all_of("s") - F.lit(mean) * all_of("n")) / F.lit(std))
    top = (facts.where("i = j").agg(F.max(pull)).first()[0] or 0.0) / n
    if top <= np.finfo(float).eps:
        return spark.createDataFrame([], "id int, w double")
    grid = top * np.logspace(0, np.log10(ALPHA_RATIO), ALPHAS)
    free = np.r_[np.ones(p), 0.0] if intercept else np.ones(p)  # the intercept has no penalty

    def system(i, j, count, s, rows, z):
        gram = BlockGram(starts, i, j, count, rows if intercept else None)
        cross = np.zeros(gram.size)
        same = i == j
        cross[i[same]] = (s[same] - mean * count[same]) / std
        if intercept:
            cross[p] = z
        return gram, cross

    def path(part: pd.DataFrame) -> pd.DataFrame:
        f = int(part["task"].iloc[0])
        i, j = part["i"].to_numpy(), part["j"].to_numpy()
        rows, s, ss = sizes[f]
        z, zz = scaled(rows, s, ss)
        own, own_cross = system(i, j, part["own_n"].to_numpy(), part["own_s"].to_numpy(), rows, z)
        rest = part["all_n"].to_numpy() - part["own_n"].to_numpy()
        gram, cross = system(i, j, rest, part["all_s"].to_numpy() - part["own_s"].to_numpy(), n - rows, scaled(n, total, square)[0] - z)
        w, errors = np.zeros(gram.size), []
        for alpha in grid:
            w = gram.lasso(cross, (n - rows) * alpha * free, positive, w)
            errors.append((zz - 2 * (w @ own_cross) + w @ own.times(w)) / rows)
        return pd.DataFrame({"task": [f], "errors": [errors]})

    own = [F.when(F.col("task") == f, F.struct(F.col(f"n{f}").alias("n"), F.col(f"s{f}").alias("s"))) for f in folds]
    dealt = (
        facts.select("*", F.explode(F.array(*[F.lit(f) for f in folds])).alias("task"), all_of("n").alias("all_n"), all_of("s").alias("all_s"))
        .withColumn("_own", F.coalesce(*own))
        .select("task", "i", "j", "all_n", "all_s", F.col("_own.n").alias("own_n"), F.col("_own.s").alias("own_s"))
        .repartitionByRange(len(folds), "task")  # a given number of tasks, which aren't merged again
    )
    if len(folds) > 1:
        found = dealt.groupBy("task").applyInPandas(path, "task int, errors array<double>").collect()
        best = grid[int(np.argmin(np.mean([r["errors"] for r in sorted(found)], axis=0)))]
    else:
        best = grid[0]  # nothing to judge by

    def whole(part: pd.DataFrame) -> pd.DataFrame:
        z = scaled(n, total, square)[0]
        gram, cross = system(*[part[c].to_numpy() for c in ("i", "j", "all_n", "all_s")], n, z)
        w = gram.lasso(cross, n * best * free, positive, np.zeros(gram.size))[:p]
        held = np.flatnonzero(w)
        return pd.DataFrame({"id": held.astype("int32"), "w": w[held]})

    everything = facts.select(F.lit(0).alias("task"), "i", "j", all_of("n").alias("all_n"), all_of("s").alias("all_s"))
    return cut_lineage(everything.groupBy("task").applyInPandas(whole, "id int, w double"))


def rank_features_lasso_each(
    df: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    order: Sequence[Column] | None = None,
    key: Sequence[str] | None = None,
    folds: int = FOLDS,
) -> list[DataFrame]:
    """``rank_features_lasso`` of each target; pairs of levels are counted once for all targets, beside each target's sums."""
    spark = df.sparkSession
    importable(spark)
    safe, cells = _cells(df, features)
    levels = va.level_table(df.select(*cells), safe, drop_first=True)
    if not levels.width:
        return [spark.createDataFrame([], RANK_SCHEMA) for _ in targets]
    ys = [f"_y{t}" for t in range(len(targets))]
    moments = [
        column for t, y in enumerate(ys) for column in (F.sum(y).alias(f"s{t}"), F.sum(F.col(y) * F.col(y)).alias(f"ss{t}"))
    ]
    patterns = (
        _fold(df, order, key, folds).select("_fold", *cells, *[st.quoted(t).cast("double").alias(y) for t, y in zip(targets, ys)])
        .groupBy("_fold", *safe).agg(F.count(F.lit(1)).alias("n"), *moments)
    )
    sums = [f"s{t}" for t in range(len(targets))]
    rows = cut_lineage(va.encode_levels(patterns, safe, levels).select("_fold", "ids", "n", *sums, *[f"s{s}" for s in sums]))
    found = sorted(rows.groupBy("_fold").agg(*[F.sum(c).alias(c) for c in rows.columns if c not in ("_fold", "ids")]).collect())
    facts = cut_lineage(_facts(rows.fillna(0.0, sums), folds, sums))
    ranks = []
    for s in sums:
        sizes = {r["_fold"]: (r["n"], r[s] or 0.0, r[f"s{s}"] or 0.0) for r in found}
        own = facts.select(
            "i", "j", *[F.col(f"n_{f}").alias(f"n{f}") for f in range(folds)],
            *[F.coalesce(f"{s}_{f}", F.lit(0.0)).alias(f"s{f}") for f in range(folds)],
        )
        weights = _cv_lasso(own, sizes, levels.starts, positive=True, intercept=False)
        if weights.isEmpty():
            weights = _cv_lasso(own, sizes, levels.starts, positive=False, intercept=True)
        ranks.append(_ranked("Lasso", weights, levels, features))
    return ranks


def rank_features_lasso(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    order: Sequence[Column] | None = None,
    key: Sequence[str] | None = None,
    folds: int = FOLDS,
) -> DataFrame:
    """Method, OPID_TOOLID, IndexValue: cross-validated lasso weights of the indicator columns.

    Every distinct value of every feature, numbers too, is an indicator, the first sorted
    level left out; there may be any number. Weights are kept non-negative; when all are 0 the fit is repeated
    unconstrained with an intercept. Equal rows collapse, the rows are read once, and all folds and penalties work
    on the counts of the pairs of levels that occur. A task holds those pairs, 24 bytes each.
    """
    return rank_features_lasso_each(df, features, [target], order, key, folds)[0]


def _cells(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[Column]]:
    safe = [f"_c{i}" for i in range(len(features))]  # feature names may hold dots
    return safe, [st.quoted(c).alias(s) for c, s in zip(features, safe)]


def _ranked(method: str, found: DataFrame, levels: va.Levels, features: Sequence[str]) -> DataFrame:
    """Method, OPID_TOOLID, IndexValue of ``found`` (id, w): rounded to 4 digits, zeros out, falling by size."""
    names = F.create_map(*[F.lit(x) for i, c in enumerate(features) for x in (f"_c{i}", c)])
    label = F.concat(names[F.col("column_name")], F.lit("_"), F.col("value"))
    ranks = found.join(levels.table, "id").select(F.lit(method).alias(rk.METHOD), label.alias(rk.LABEL), F.bround("w", 4).alias(rk.VALUE))
    return rk.sort_ranks(ranks.where(F.col(rk.VALUE) != 0), rk.VALUE, rk.LABEL, absolute=True)


# Fixed value: more classes than this are no classes.
MAX_CLASSES = 100


def _class_numbers(df: DataFrame, target: str) -> tuple[Column, int]:
    """0 for the smallest label, and so on; null stays null. And the number of labels."""
    label = st.quoted(target).cast("double")
    rows = df.where(label.isNotNull()).select(label.alias("y")).distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"target {target} has more than {MAX_CLASSES} classes")
    found = sorted(r["y"] for r in rows)
    place = F.array_position(F.array(*[F.lit(v) for v in found]).cast("array<double>"), label) - 1
    return F.when(label.isNotNull(), place).cast("double"), len(found)


def rank_features_forest_each(
    df: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    task: str = "classification",
    trees: int = SELECT_TREES,
    max_depth: int = 10,
    seed: int = SELECT_SEED,
) -> list[DataFrame]:
    """``rank_features_forest`` of each target; the trees of all targets share every pass over the rows."""
    if task not in ("classification", "regression"):
        raise ValueError("task must be 'classification' or 'regression'")
    spark = df.sparkSession
    empty = spark.createDataFrame([], RANK_SCHEMA)
    safe, cells = _cells(df, features)
    levels = va.level_table(df.select(*cells), safe, drop_first=True)
    if not levels.width:
        return [empty for _ in targets]
    if task == "classification":
        numbers = [_class_numbers(df, t) for t in targets]
        classes, ys = [k for _, k in numbers], [c for c, _ in numbers]
    else:
        names = list(targets)
        scale = st.summarise(df, names, mean=lambda c: F.avg(c.cast("double")), std=lambda c: F.stddev_pop(c.cast("double")))
        classes = [0] * len(names)
        ys = [(st.quoted(t).cast("double") - F.lit(scale["mean"][t])) / F.lit(scale["std"][t] or 1.0) for t in names]
    y = F.array(*[F.coalesce(c, F.lit(float("nan"))) for c in ys])
    rows = st.collapse(df.select(*cells, y.alias("y")))
    coded = va.encode_levels(rows, safe, levels).select("ids", F.col("_w").alias("n"), F.xxhash64("ids", "y").alias("draw"), "y")
    cores = spark.sparkContext.defaultParallelism
    found = lf.importances(lf.grow(cut_lineage(coded.repartition(cores, "draw")), levels.starts, classes, trees, max_depth, seed))
    if found.empty:
        return [empty for _ in targets]
    weights = spark.createDataFrame(found, "target int, id int, w double")
    return [_ranked("RF", weights.where(F.col("target") == i).select("id", "w"), levels, features) for i in range(len(targets))]


def rank_features_forest(df: DataFrame, features: Sequence[str], target: str, task: str = "classification", **forest) -> DataFrame:
    """Method, OPID_TOOLID, IndexValue: forest importances of the indicator columns.

    Every distinct value of every feature is an indicator, the first sorted level left out; there may be any
    number. ``forest``: trees, max_depth, seed. A node of a classification tree looks at about the square root of all
    indicators, of a regression tree at all. Rows with a null target are left out; null features have no level.
    """
    return rank_features_forest_each(df, features, [target], task, **forest)[0]


# Fixed value: how the names of targets begin.
TARGET_PREFIX = "Ylabel_"


def _factor_lists(df: DataFrame, targets: Sequence[str], task: str, order, key, forest: dict) -> list[tuple[DataFrame, DataFrame]]:
    features = [c for c in df.columns if c not in targets and c not in (key or []) and not c.startswith(TARGET_PREFIX)]
    spark = df.sparkSession
    if len(features) == 1 and features[0] in co.constant_columns(df, features, nulls="value"):
        none = spark.createDataFrame([], f"{rk.METHOD} string, {rk.LABEL} string, Inter_count long, weight_IndexValue double")
        return [(spark.createDataFrame([], RANK_SCHEMA), none) for _ in targets]
    lassos = rank_features_lasso_each(df, features, targets, order, key)
    forests = rank_features_forest_each(df, features, targets, task, **forest)
    ranks = [a.unionByName(b) for a, b in zip(lassos, forests)]
    return [(r, rk.combine_methods(r)) for r in ranks]


def select_factors(
    df: DataFrame,
    target: str,
    task: str = "classification",
    order: Sequence[Column] | None = None,
    key: Sequence[str] | None = None,
    **forest,
) -> tuple[DataFrame, DataFrame]:
    """(rank lists of lasso and forest, key factors). A single constant factor gives two empty tables.

    ``key`` names the row key; it is not a factor, and neither are other targets (``Ylabel_`` columns).
    """
    return _factor_lists(df, [target], task, order, key, forest)[0]


def select_factors_each(
    df: DataFrame,
    targets: Sequence[str] | None = None,
    task: str = "classification",
    order: Sequence[Column] | None = None,
    key: Sequence[str] | None = None,
    **forest,
) -> tuple[DataFrame, DataFrame]:
    """``select_factors`` for each target (default: all ``Ylabel_`` columns), with the target's name in column ``target``.

    Levels are numbered, their pairs counted and the rows passed over by trees once for all targets.
    """
    targets = list(targets if targets is not None else [c for c in df.columns if c.startswith(TARGET_PREFIX)])
    if not targets:
        raise ValueError("there is no target")
    named = [
        [part.withColumn("target", F.lit(t)) for part in parts]
        for t, parts in zip(targets, _factor_lists(df, targets, task, order, key, forest))
    ]
    return tuple(functools.reduce(DataFrame.unionByName, parts) for parts in zip(*named))
