"""Forests on the levels of columns, for any number of levels and several targets at once.

A row is the ids of its levels (``values.encode_levels``), one a column at most; a node asks whether a row has one id.
Equal rows are one row with their number, whose bootstrap weight is a Poisson draw of that mean. All trees in flight are
grown together, a depth a pass: tasks send sums for the (node, id) pairs that occur, these are added up and turned into
one split a node on executors. What a node's rows without an id add up to is the node's total less the id's sums, so
work grows with the cells that hold a value, not with the levels.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from yieldlens.operators.trees import hash_bits
from yieldlens.session import importable

#: Trees grown together; (row, tree) pairs walked at once in a task; sums a task holds before it sends them on.
TREES, WALKED, HELD = 256, 1 << 17, 1 << 20
#: A split must lower the squared error by this share of the node's weight.
LEAST_GAIN = 1e-9
#: Up to this many equal rows the Poisson draw is exact, beyond it is a rounded normal one.
EXACT_DRAWS = 64


@functools.lru_cache(maxsize=EXACT_DRAWS)
def _cumulated(mean: int) -> np.ndarray:
    k = np.arange(1, mean + int(12 * mean**0.5) + 12)
    logs = np.concatenate([[0.0], np.cumsum(np.log(mean / k))]) - mean
    return np.cumsum(np.exp(logs))


def poisson(rows: np.ndarray, draw: np.ndarray, own: np.ndarray) -> np.ndarray:
    """How often each of ``rows`` equal rows together are in each tree's sample, by hashes of the row and the tree."""
    bits = hash_bits(draw[:, None] ^ own[None, :])
    u = (bits >> np.uint64(11)) / float(1 << 53)
    out = np.empty(u.shape)
    for size in np.unique(rows[rows <= EXACT_DRAWS]):
        at = rows == size
        out[at] = np.searchsorted(_cumulated(int(size)), u[at], side="right")
    at = rows > EXACT_DRAWS
    if at.any():
        v = (hash_bits(~bits[at]) >> np.uint64(11)) / float(1 << 53)
        normal = np.sqrt(-2 * np.log1p(-u[at])) * np.cos(2 * np.pi * v)
        mean = rows[at][:, None].astype(float)
        out[at] = np.maximum(np.rint(mean + np.sqrt(mean) * normal), 0)
    return out


@dataclass
class Nodes:
    """Flat nodes of all trees in flight: the id asked for (-1: a leaf) and the children of rows with and without it."""

    id: np.ndarray
    yes: np.ndarray
    no: np.ndarray
    tree: np.ndarray
    path: np.ndarray  # 1 at the root, then 2p and 2p + 1
    gain: np.ndarray

    @classmethod
    def roots(cls, trees: int) -> "Nodes":
        none = np.full(trees, -1, np.int64)
        return cls(none, none.copy(), none.copy(), np.arange(trees), np.ones(trees, np.int64), np.zeros(trees))

    def split(self, node: np.ndarray, ids: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """Add two children to each node; returns their numbers, those with the id first."""
        first, k = len(self.id), len(node)
        self.id[node], self.gain[node] = ids, gain
        self.yes[node], self.no[node] = first + np.arange(k), first + k + np.arange(k)
        none = np.full(2 * k, -1, np.int64)
        self.id, self.yes, self.no = (np.concatenate([x, none]) for x in (self.id, self.yes, self.no))
        self.tree = np.concatenate([self.tree, self.tree[node], self.tree[node]])
        self.path = np.concatenate([self.path, 2 * self.path[node], 2 * self.path[node] + 1])
        self.gain = np.concatenate([self.gain, np.zeros(2 * k)])
        return first + np.arange(2 * k)

    def walk(self, codes: np.ndarray, column_of: np.ndarray, depth: int) -> np.ndarray:
        """The node of every row in every tree; ``codes`` has a row's id in each column, -1 for none."""
        trees = int((self.path == 1).sum())
        node = np.broadcast_to(np.arange(trees), (len(codes), trees)).copy()
        row = np.arange(len(codes))[:, None]
        for _ in range(depth):
            asked = self.id[node]
            has = codes[row, column_of[asked]] == asked
            node = np.where(asked < 0, node, np.where(has, self.yes[node], self.no[node]))
        return node


def dense_codes(ids: Sequence[np.ndarray], starts: np.ndarray) -> np.ndarray:
    """rows x columns: the row's id in the column, -1 for none."""
    codes = np.full((len(ids), len(starts) - 1), -1, np.int64)
    sizes = np.array([len(x) for x in ids])
    if sizes.sum():
        flat = np.concatenate(ids).astype(np.int64)
        codes[np.repeat(np.arange(len(ids)), sizes), np.searchsorted(starts, flat, side="right") - 1] = flat
    return codes


def summed(key: np.ndarray, stat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(key, return_inverse=True)
    return found, np.stack([np.bincount(at, weights=s, minlength=len(found)) for s in stat.T], axis=1)


def _statistics(weight: np.ndarray, y: np.ndarray, classes: np.ndarray, width: int) -> np.ndarray:
    """Weight and, by class or for the value, its share of the target."""
    stat = np.zeros((len(weight), width + 1))
    stat[:, 0] = weight
    if width:
        named = classes > 0
        stat[np.flatnonzero(named), 1 + y[named].astype(int)] = weight[named]
        stat[~named, 1] = weight[~named] * y[~named]
    return stat


def _sums(rows: DataFrame, nodes: Nodes, open_: np.ndarray, depth: int, starts, classes, owner, own, totals: bool) -> DataFrame:
    """slot (place in ``open_``), id, v0..: sums over the sampled rows of open nodes, by the ids they hold.

    With ``totals`` each row counts once, under id 0.
    """
    edges, width = np.asarray(starts), 1 if totals else starts[-1]
    outputs = max(max(classes), 1)
    kinds = np.asarray(classes)
    column_of = np.searchsorted(edges, np.arange(starts[-1]), side="right") - 1
    slots = np.full(len(nodes.id), -1, np.int64)
    slots[open_] = np.arange(len(open_))
    step = max(WALKED // len(owner), 1)
    names = [f"v{k}" for k in range(outputs + 1)]

    def table(key: np.ndarray, stat: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"slot": (key // width).astype("int32"), "id": (key % width).astype("int32"), **dict(zip(names, stat.T))})

    def of_rows(part: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        codes = dense_codes(list(part["ids"]), edges)
        place = slots[nodes.walk(codes, column_of, depth)]
        y = np.stack(part["y"].to_list())[:, owner]
        weight = poisson(part["n"].to_numpy(), part["draw"].to_numpy().view(np.uint64), own)
        row, tree = np.nonzero((place >= 0) & (weight > 0) & ~np.isnan(y))
        place, stat = place[row, tree], _statistics(weight[row, tree], y[row, tree], kinds[owner[tree]], outputs)
        if totals:
            yield summed(place, stat)
            return
        for column in range(codes.shape[1]):
            code = codes[row, column]
            held = np.flatnonzero(code >= 0)
            if len(held):
                yield summed(place[held] * width + code[held], stat[held])

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in frames:
            for a in range(0, len(frame), step):
                for key, stat in of_rows(frame.iloc[a : a + step]):
                    held.append((key, stat))
                    size += len(key)
                    if size > HELD:
                        held = [summed(np.concatenate([k for k, _ in held]), np.concatenate([s for _, s in held]))]
                        size = len(held[0][0])
                        if size > HELD // 2:
                            yield table(*held[0])
                            held, size = [], 0
        if held:
            yield table(*summed(np.concatenate([k for k, _ in held]), np.concatenate([s for _, s in held])))

    schema = ", ".join(["slot int", "id int", *[f"{v} double" for v in names]])
    return rows.mapInPandas(partial, schema).groupBy("slot", "id").agg(*[F.sum(v).alias(v) for v in names])


def _side(cells: Sequence[Column]) -> Column:
    return functools.reduce(Column.__add__, [c * c for c in cells[1:]]) / cells[0]


def _best(sums: DataFrame, limits: pd.DataFrame, outputs: int, seed: int) -> list:
    """One row a node that can be split: slot, id, gain, v0.. of the rows with the id.

    A node looks at the ids that a hash gives it, a ``share`` of all; if none of these splits it, at the
    one id of smallest hash that does.
    """
    v = [F.col(f"v{k}") for k in range(outputs + 1)]
    t = [F.col(f"t{k}") for k in range(outputs + 1)]
    rest = [b - a for a, b in zip(v, t)]
    gain = F.round(_side(v) + _side(rest) - _side(t), 9)
    luck = F.pmod(F.xxhash64(F.lit(seed), "number", "path", "id"), F.lit(1 << 30)) / float(1 << 30)
    tried = (
        sums.join(F.broadcast(sums.sparkSession.createDataFrame(limits)), "slot")
        .where((t[0] - v[0] > 0) & (v[0] > 0)).withColumn("gain", gain).where(F.col("gain") > LEAST_GAIN * t[0])
        .withColumn("luck", luck).withColumn("given", F.col("luck") < F.col("share"))
    )
    order = F.when(F.col("given"), F.col("gain")).otherwise(-F.col("luck"))
    best = F.max(F.struct("given", order.alias("order"), (-F.col("id")).alias("less"), "gain", *v)).alias("best")
    return tried.groupBy("slot").agg(best).select("slot", "best.*").collect()  # one row a node


def _grow(rows: DataFrame, starts, classes, owner: np.ndarray, number: np.ndarray, max_depth: int, seed: int) -> pd.DataFrame:
    outputs, width = max(max(classes), 1), starts[-1]
    own = hash_bits((seed * 1_000_003 + number + 1).astype(np.uint64))
    kinds = np.asarray(classes)[owner]
    share = np.where(kinds > 0, np.ceil(np.sqrt(width)) / width, 1.0)
    nodes, open_ = Nodes.roots(len(owner)), np.arange(len(owner))
    found = _sums(rows, nodes, open_, 0, starts, classes, owner, own, totals=True).collect()  # one row a tree
    total = np.zeros((len(open_), outputs + 1))
    for r in found:
        total[r["slot"]] = [r[f"v{k}"] for k in range(outputs + 1)]
    for depth in range(max_depth):
        pure = (kinds[nodes.tree[open_]] > 0) & (total[:, 1:].max(axis=1) >= total[:, 0])
        live = (total[:, 0] >= 2) & ~pure
        open_, total = open_[live], total[live]
        if not len(open_):
            break
        tree = nodes.tree[open_]
        limits = pd.DataFrame({
            "slot": np.arange(len(open_), dtype="int32"), "number": number[tree], "path": nodes.path[open_], "share": share[tree],
            **{f"t{k}": total[:, k] for k in range(outputs + 1)},
        })
        sums = _sums(rows, nodes, open_, depth, starts, classes, owner, own, totals=False)
        splits = sorted(_best(sums, limits, outputs, seed), key=lambda r: r["slot"])
        if not splits:
            break
        slot = np.array([r["slot"] for r in splits])
        with_id = np.array([[r[f"v{k}"] for k in range(outputs + 1)] for r in splits])
        ids, gain = np.array([-r["less"] for r in splits]), np.array([r["gain"] for r in splits])
        parents = total[slot]
        open_ = nodes.split(open_[slot], ids, gain)
        total = np.concatenate([with_id, parents - with_id])
    cut = nodes.id >= 0
    return pd.DataFrame({"target": owner[nodes.tree[cut]], "tree": number[nodes.tree[cut]], "path": nodes.path[cut], "id": nodes.id[cut], "gain": nodes.gain[cut]})


def grow(rows: DataFrame, starts: Sequence[int], classes: Sequence[int], trees: int, max_depth: int, seed: int) -> pd.DataFrame:
    """target, tree, path, id, gain: the splits of ``trees`` trees for each target, at most 2^max_depth a tree.

    ``rows``: ids, n (equal rows), draw (a hash of the row), y (a class number or a value for each target; null or NaN
    leaves the row out of the target's trees). ``classes``: by target their number, 0 for a target to be
    regressed. Store ``rows`` first: every pass reads them. The same trees come out at any partitioning.
    """
    importable(rows.sparkSession)
    owner = np.repeat(np.arange(len(classes)), trees)
    number = np.tile(np.arange(trees), len(classes))
    parts = [
        _grow(rows, list(starts), list(classes), owner[a : a + TREES], number[a : a + TREES], max_depth, seed)
        for a in range(0, len(owner), TREES)
    ]
    return pd.concat(parts, ignore_index=True)


def importances(splits: pd.DataFrame) -> pd.DataFrame:
    """target, id, importance: the gain of an id as a share of its tree's, its mean over the trees; sums to 1 a target."""
    share = splits["gain"] / splits.groupby(["target", "tree"])["gain"].transform("sum")
    found = share.groupby([splits["target"], splits["id"]]).sum().rename("importance").reset_index()
    found["importance"] /= found.groupby("target")["importance"].transform("sum")
    return found
