"""Recommended set-points and intervals for many targets at once.

Every (target, restart) searches on its own: candidate rows are drawn inside the
bounds, scored by the model in one pass, and the next round draws around the best.
Draws are hashes of the row's identity, so they do not depend on partitioning.
Where the model is a line for each target, a task makes all rounds of its rows on arrays, and no candidate is written.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from yieldlens.operators import statistics as st, values as va
from yieldlens.operators.guards import check_bounds
from yieldlens.operators.importance import assemble
from yieldlens.session import cut_lineage, importable

# Loss weights, machine epsilon, search effort, and the interval's quantile.
TARGET_SHARE, HISTORY_SHARE, EPSILON = 0.8, 0.2, 2.220446049250313e-16
CANDIDATES, ROUNDS, RESTARTS, SEED = 100, 6, 10, 66
SHRINK = 0.5

ROWS_PER_TASK = 500_000
#: Candidates a task holds as arrays at once, and its candidates of a round.
AT_ONCE, ARRAYS_PER_TASK = 1 << 14, 4_000_000
INTERVAL = NormalDist().inv_cdf(0.975)


def history_means(history: DataFrame, features: Sequence[str]) -> dict[str, float]:
    return st.summarise(history, list(features), mean=F.avg)["mean"]


def _uniform(*identity: Column) -> Column:
    """A number in [0, 1) fixed by the row's identity."""
    return F.pmod(F.xxhash64(*identity), F.lit(1 << 52)).cast("double") / float(1 << 52)


# The constants of xxHash64.
_P1, _P2, _P3, _P4, _P5 = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(h: np.ndarray, bits: int) -> np.ndarray:
    high = h >> np.uint64(64 - bits)
    h <<= np.uint64(bits)
    h |= high
    return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    h ^= h >> np.uint64(32)
    return h


def _hash_int(value: int | np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of an int after the columns whose hash is ``seed``."""
    value = np.asarray(value, np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF)
    h = (seed + (_P5 + np.uint64(4))) ^ (value * _P1)
    h = _turned(h, 23)
    h *= _P2
    h += _P3
    return _mixed(h)


def _hash_long(value: int | np.ndarray, seed: np.ndarray) -> np.ndarray:
    """The same of a long."""
    word = _turned(np.asarray(value, np.int64).astype(np.uint64).reshape(-1) * _P2, 31)
    h = (seed + (_P5 + np.uint64(8))) ^ (word * _P1)
    h = _turned(h, 27)
    h *= _P1
    h += _P4
    return _mixed(h)


class Lines:
    """The rounds of ``search`` on arrays: the steps, draws and costs of its columns, for models that are a line for each target."""

    def __init__(self, weights, intercepts, scaler, features, free, lower, upper, means, candidates: int, seed: int):
        self.weights, self.intercepts = np.asarray(weights, float), np.asarray(intercepts, float)
        self.scales = None if scaler is None else [(scaler.means[c], scaler.stds[c]) for c in features]
        self.free = [(features.index(c), float(means[c])) for c in free]
        self.bounds = list(zip(lower, upper))
        self.candidates, self.seed = candidates, seed

    def hashes(self, target: np.ndarray, known: np.ndarray, restart: np.ndarray) -> np.ndarray:
        """Of target and restart; a null leaves the hash as it is."""
        h = np.full(len(target), 42, np.uint64)
        return _hash_int(restart, np.where(known, _hash_long(target, h), h))

    def without(self, goals: pa.ListArray) -> np.ndarray:
        """Rows without a cost: a goal is null or, like a mean of the history, what is divided by is 0."""
        flat = goals.flatten()
        none = flat.is_null().to_numpy(zero_copy_only=False) | (flat.fill_null(0).to_numpy() + EPSILON == 0)
        return none.reshape(len(goals), -1).any(axis=1) | any(mean + EPSILON == 0 for _, mean in self.free)

    def costs(self, x: list[np.ndarray], goals: np.ndarray) -> np.ndarray:
        """By row and candidate; not a number where there is none."""
        scaled = x if self.scales is None else [(v - m) / s for v, (m, s) in zip(x, self.scales)]
        miss = 0.0
        for i, (w, b) in enumerate(zip(self.weights, self.intercepts)):
            value = scaled[0] * w[0]
            for v, k in zip(scaled[1:], w[1:]):
                value += v * k
            value += b
            goal, below = goals[:, i, None], goals[:, i, None] + EPSILON
            miss = miss + np.abs((value - goal) / np.where(below == 0, np.nan, below))
        cost = TARGET_SHARE * miss / len(self.weights)
        drift = 0.0
        for j, mean in self.free:
            drift = drift + np.abs((x[j] - mean) / (mean + EPSILON if mean + EPSILON else np.nan))
        return cost + HISTORY_SHARE * drift / len(self.free) if self.free else cost

    def round(self, hashed: np.ndarray, x: np.ndarray, goals: np.ndarray, r: int, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best candidate of each row: its cost, number and place. Of equal ones the first."""
        number = _hash_int(np.arange(self.candidates)[None, :], hashed[:, None])
        own = -(1 << 31) <= self.seed < 1 << 31
        places = []
        for j, (a, b) in enumerate(self.bounds):
            h = _hash_int(r, _hash_int(j, number))
            h = _hash_int(self.seed, h) if own else _hash_long(self.seed, h)
            h &= np.uint64((1 << 52) - 1)
            moved = h.astype(float)
            moved /= float(1 << 52)
            moved -= 0.5
            moved *= (b - a) * width
            moved += x[:, j, None]
            np.minimum(np.maximum(moved, float(a), out=moved), float(b), out=moved)
            if r:
                moved[:, 0] = x[:, j]
            places.append(moved)
        cost = self.costs(places, goals)
        best = np.where(np.isnan(cost), np.inf, cost).argmin(axis=1)
        rows = np.arange(len(x))
        return cost[rows, best], best, np.stack([p[rows, best] for p in places], axis=1)


_FOUND = "target_id long, restart int, cost double, candidate int, x array<double>, goals array<double>"


def _rounds(state: DataFrame, lines: Lines, first: int, last: int, width: float) -> DataFrame:
    """``state`` after the rounds from ``first`` up to ``last``, each row by itself."""
    importable(state.sparkSession)
    shared = state.sparkSession.sparkContext.broadcast(lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = shared.value
        step = max(AT_ONCE // lines.candidates, 1)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids, restart = batch.column("target_id"), batch.column("restart").to_numpy()
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            hashed = lines.hashes(ids.fill_null(0).to_numpy(), known, restart)
            x, goals = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1) for c in ("x", "goals"))
            x, cost, best = x.copy(), np.empty(n), np.zeros(n, np.int32)
            for start in range(0, n, step):
                part, wide = slice(start, start + step), width
                with np.errstate(all="ignore"):
                    for r in range(first, last):
                        cost[part], best[part], x[part] = lines.round(hashed[part], x[part], goals[part], r, wide)
                        wide *= SHRINK if r else 1.0
            ends = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
            places = pa.ListArray.from_arrays(ends, pa.array(x.reshape(-1)))
            none = lines.without(batch.column("goals"))
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column("restart"), pa.array(np.where(none, 0.0, cost), mask=none), pa.array(best), places, batch.column("goals")],
                names=[c.split()[0] for c in _FOUND.split(", ")],
            )

    return state.select("target_id", "restart", "x", "goals").mapInArrow(run, _FOUND)


def _relative(value: Column, goal: Column) -> Column:
    return F.abs(F.try_divide(value - goal, goal + F.lit(EPSILON)))


def search(
    model,
    scaler: va.Scaler | None,
    features: Sequence[str],
    controls: list[str],
    bounds: list[list[float]],
    targets: DataFrame,
    target_names: Sequence[str],
    history: DataFrame,
    restarts: int = RESTARTS,
    candidates: int = CANDIDATES,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> DataFrame:
    """target_id, restart, cost, x (array in feature order): the best candidate of each restart.

    ``targets`` has target_id and one column per name in ``target_names``; ``model`` adds
    ``prediction_<name>`` to rows with a ``features`` vector.
    """
    features, target_names = list(features), list(target_names)
    check_bounds(features, controls, bounds, None, restarts=restarts, candidates=candidates, rounds=rounds)
    free = [c for c in features if c not in controls]
    means = history_means(history, free)
    empty = [c for c in free if means[c] is None]
    if empty:
        raise ValueError(f"the history of {empty} has no value")
    lower, upper = bounds

    goals = F.array(*[st.quoted(t).cast("double") for t in target_names])
    state = targets.select(F.col("target_id").cast("long"), goals.alias("goals")).withColumn(
        "restart", F.explode(F.sequence(F.lit(0), F.lit(restarts - 1)))
    )
    middle = F.array(*[F.lit((a + b) / 2.0) for a, b in zip(lower, upper)])
    state = state.withColumn("x", middle).withColumn("cost", F.lit(None).cast("double"))
    width = 1.0
    spark = targets.sparkSession
    rows = targets.count() * restarts * candidates

    def scored(placed: DataFrame) -> tuple[DataFrame, Column]:
        """Rows with predictions at their ``x``, and the cost there."""
        named = placed.select("*", *[F.col("x")[j].alias(c) for j, c in enumerate(features)])
        miss = sum((_relative(st.quoted(f"prediction_{t}"), F.col("goals")[i]) for i, t in enumerate(target_names)), F.lit(0.0))
        drift = sum((_relative(F.col("x")[features.index(c)], F.lit(means[c])) for c in free), F.lit(0.0))
        cost = TARGET_SHARE * miss / len(target_names) + (HISTORY_SHARE * drift / len(free) if free else F.lit(0.0))
        return model.transform(assemble(named, features, scaler=scaler)), cost

    planes = model.planes(target_names) if hasattr(model, "planes") else None
    if planes is not None and rounds:
        lines = Lines(*planes, scaler, features, free, lower, upper, means, candidates, seed)
        tasks = max(spark.sparkContext.defaultParallelism, rows // ARRAYS_PER_TASK)
        found = _rounds(state.repartition(tasks, "target_id", "restart"), lines, 0, 1, width)
        # rows of one target with several goals are one from here on
        best = F.min(F.struct(F.col("cost").isNull().alias("none"), "cost", "candidate", "x", "goals"))
        state = found.groupBy("target_id", "restart").agg(best.alias("best")).select("target_id", "restart", "best.x", "best.goals")
        state = _rounds(state, lines, 1, rounds, width) if rounds > 1 else state
        found, cost = scored(state.select("target_id", "restart", "x", "goals"))
        return cut_lineage(found.select("target_id", "restart", cost.alias("cost"), "x"))
    tasks = max(spark.sparkContext.defaultParallelism, rows // ROWS_PER_TASK)
    for r in range(rounds):
        # the state is small but each row of it becomes many: deal it out before drawing
        drawn = state.repartition(tasks, "target_id", "restart").withColumn("candidate", F.explode(F.sequence(F.lit(0), F.lit(candidates - 1))))
        place = []
        for j, (a, b) in enumerate(zip(lower, upper)):
            u = _uniform(F.col("target_id"), F.col("restart"), F.col("candidate"), F.lit(j), F.lit(r), F.lit(seed))
            moved = F.col("x")[j] + (u - 0.5) * ((b - a) * width)
            kept = F.least(F.greatest(moved, F.lit(float(a))), F.lit(float(b)))
            # candidate 0 is the best so far, so the cost never rises
            place.append(F.when(F.col("candidate") == 0, F.col("x")[j]).otherwise(kept) if r else kept)
        number = (F.col("target_id") * restarts + F.col("restart")) * candidates + F.col("candidate")
        placed = drawn.select(number.alias("id"), "target_id", "restart", "candidate", "goals", F.array(*place).alias("x"))
        tried, cost = scored(placed)
        best = F.min(F.struct(cost.isNull().alias("none"), cost.alias("cost"), "candidate", "x", "goals"))
        state = cut_lineage(
            tried.groupBy("target_id", "restart").agg(best.alias("best")).select("target_id", "restart", "best.cost", "best.x", "best.goals")
        )
        if r:
            width *= SHRINK
    return state.select("target_id", "restart", "cost", "x")


def _long(found: DataFrame, features: Sequence[str], controls: Sequence[str], all_parameters: bool) -> DataFrame:
    """One row per feature: target_id, restart, cost, feature, value, self_controled."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col("x")[j].alias("value"), F.lit(c in controls).alias("self_controled"))
            for j, c in enumerate(features)
            if all_parameters or c in controls
        ]
    )
    return found.select("target_id", "restart", "cost", F.explode(cells).alias("cell")).select("target_id", "restart", "cost", "cell.*")


def recommend_values(
    model, scaler, features, controls, bounds, targets, target_names, history, all_parameters: bool = False, **effort
) -> DataFrame:
    """target_id, feature, Recommendation (and self_controled with ``all_parameters``): the best restart."""
    found = search(model, scaler, features, controls, bounds, targets, target_names, history, **{"restarts": 1, **effort})
    best = found.groupBy("target_id").agg(F.min(F.struct(F.col("cost").isNull().alias("none"), "cost", "restart", "x")).alias("best"))
    best = best.select("target_id", "best.restart", "best.cost", "best.x")
    cells = _long(best, list(features), controls, all_parameters)
    flag = ["self_controled"] if all_parameters else []
    return cells.select("target_id", "feature", F.col("value").alias("Recommendation"), *flag, "cost")


def recommend_ranges(
    model, scaler, features, controls, bounds, targets, target_names, history, all_parameters: bool = False, **effort
) -> DataFrame:
    """target_id, feature, Upper_bound, Lower_bound, best_cost: 95 % normal interval over the restarts."""
    found = search(model, scaler, features, controls, bounds, targets, target_names, history, **effort)
    return ranges(_long(found, list(features), controls, all_parameters), list(features), bounds, all_parameters)


def ranges(restarts: DataFrame, features: Sequence[str], bounds: list[list[float]], all_parameters: bool = False) -> DataFrame:
    """Interval of ``value`` per target and feature, clipped to the bounds; equal restarts give their value."""
    limits = F.coalesce(
        *[
            F.when(F.col("feature") == c, F.struct(F.lit(float(a)).alias("low"), F.lit(float(b)).alias("high")))
            for c, a, b in zip(features, *bounds)
        ]
    )
    half = F.lit(INTERVAL) * F.col("std")
    flag = ["self_controled"] if all_parameters else []
    return (
        restarts.groupBy("target_id", "feature", *flag)
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("cost").alias("best_cost"))
        .withColumn("_limits", limits)
        .select(
            "target_id",
            "feature",
            F.least(F.col("mean") + half, F.col("_limits.high")).alias("Upper_bound"),
            F.greatest(F.col("mean") - half, F.col("_limits.low")).alias("Lower_bound"),
            *flag,
            "best_cost",
        )
    )
