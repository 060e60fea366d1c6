"""Approximate nearest neighbours: stable projections to few dimensions, a kd-tree there, a chi-square stop."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from yieldlens.llm.blocks import against
from yieldlens.llm.common import stored, finite_vectors, in_arrow, vectors_of
from yieldlens.llm.topk import numbered, ranked

#: Vectors the cells are learned from, at most. Every vector is indexed, whatever the sample.
SAMPLE = 20_000
#: Cells of the top tree, at most; a cell is cut into blocks, so this bounds no cell's rows.
MAX_CELLS = 4_096
LEAF = 128


def chi_square_quantile(p: float, m: int) -> float:
    """The value a chi-square variable of ``m`` degrees (even) stays below with probability ``p``."""

    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 20.0 * m + 200
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def _projection(dim: int, m: int, seed: int) -> np.ndarray:
    """Independent standard normal (2-stable) entries, the same on every machine."""
    return np.random.Generator(np.random.PCG64([seed, dim, m])).standard_normal((dim, m))


def _kd_leaves(points: np.ndarray, leaf: int) -> np.ndarray:
    """The points in kd-tree order: each run of ``leaf`` points is a leaf of a tree of median cuts."""
    order = np.arange(len(points))
    stack = [(0, len(points))]
    while stack:
        a, b = stack.pop()
        if b - a <= leaf:
            continue
        own = order[a:b]
        spans = np.ptp(points[own], axis=0)
        middle = a + leaf * max(1, (b - a) // leaf // 2)
        cut = np.argpartition(points[own, int(spans.argmax())], middle - a - 1 if middle > a else 0)
        order[a:b] = own[cut]
        stack += [(a, middle), (middle, b)]
    return order


def _top_tree(sample: np.ndarray, cells: int) -> list[tuple[int, float, int, int]]:
    """Median cuts until there are ``cells`` leaves: nodes (axis, cut, left, right), leaves (-1, 0, cell, 0)."""
    nodes: list = [None]
    todo, made = [(0, sample)], 1
    queue = 0
    while queue < len(todo):
        at, own = todo[queue]
        queue += 1
        spans = np.ptp(own, axis=0) if len(own) > 1 else np.zeros(sample.shape[1])
        axis = int(spans.argmax())
        cut = float(np.median(own[:, axis])) if len(own) else 0.0
        left, right = own[own[:, axis] < cut], own[own[:, axis] >= cut]
        if made >= cells or spans[axis] <= 0 or not len(left):
            continue
        nodes[at] = (axis, cut, len(nodes), len(nodes) + 1)
        nodes += [None, None]
        todo += [(len(nodes) - 2, left), (len(nodes) - 1, right)]
        made += 1
    cell = 0
    for i, node in enumerate(nodes):
        if node is None:
            nodes[i] = (-1, 0.0, cell, 0)
            cell += 1
    return nodes


def _cell_of(points: np.ndarray, tree: list) -> np.ndarray:
    """The cell of each point."""
    found = np.zeros(len(points), dtype=np.int32)
    stack = [(0, np.arange(len(points)))]
    while stack:
        at, own = stack.pop()
        axis, cut, left, right = tree[at]
        if axis < 0:
            found[own] = left
        elif len(own):
            low = points[own, axis] < cut
            stack += [(left, own[low]), (right, own[~low])]
    return found


def _boxes(tree: list, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper corners of the cells; the outer sides are open."""
    cells = sum(n[0] < 0 for n in tree)
    low, high = np.full((cells, m), -np.inf), np.full((cells, m), np.inf)
    stack = [(0, np.full(m, -np.inf), np.full(m, np.inf))]
    while stack:
        at, a, b = stack.pop()
        axis, cut, left, right = tree[at]
        if axis < 0:
            low[left], high[left] = a, b
        else:
            b_left, a_right = b.copy(), a.copy()
            b_left[axis], a_right[axis] = cut, cut
            stack += [(left, a, b_left), (right, a_right, b)]
    return low, high


def _box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes."""
    gap = np.maximum(low[None, :, :] - points[:, None, :], points[:, None, :] - high[None, :, :])
    return np.square(np.maximum(gap, 0)).sum(axis=2)


def _unit(v: np.ndarray) -> np.ndarray:
    scaled = v / np.abs(v).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.square(scaled).sum(axis=1, keepdims=True))


def _search(k: int, m: int, seed: int, stop: float):
    """For a chunk of queries and a block of rows: the k nearest of each, by incremental projected neighbours."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        none = np.zeros(0, dtype=np.int64)
        if not queries.num_rows or not rows.num_rows:
            return pa.table({"row": none, "query_id": none, "id": none, "score": none.astype(float)})
        x, ids = vectors_of(rows["v"], np.float64), rows["id"].to_numpy()
        q, q_ids = vectors_of(queries["v"], np.float64), queries["id"].to_numpy()
        bound = queries["bound"].to_numpy().copy()
        xu, qu = _unit(x), _unit(q)
        project = _projection(x.shape[1], m, seed)
        xp, qp = xu @ project, qu @ project
        order = _kd_leaves(xp, LEAF)
        xu, xp, ids = xu[order], xp[order], ids[order]
        starts = np.arange(0, len(xp), LEAF)
        low, high = np.minimum.reduceat(xp, starts), np.maximum.reduceat(xp, starts)
        far = _box_distance(qp, low, high)
        turn = np.argsort(far, axis=1, kind="stable")
        best = np.full((len(q), k), -np.inf)
        best_id = np.full((len(q), k), np.iinfo(np.int64).max)
        active = np.arange(len(q))
        for step in range(len(starts)):
            leaf = turn[active, step]
            # the next neighbour by projected distance is at least as far as this leaf's box
            going = far[active, leaf] < stop * bound[active]
            active, leaf = active[going], leaf[going]
            if not len(active):
                break
            by_leaf = np.argsort(leaf, kind="stable")
            cuts = np.flatnonzero(np.diff(leaf[by_leaf])) + 1
            for own in np.split(by_leaf, cuts):
                a, at = active[own], slice(starts[leaf[own[0]]], starts[leaf[own[0]]] + LEAF)
                near = (
                    np.square(qp[a]).sum(1)[:, None] + np.square(xp[at]).sum(1)[None, :] - 2 * qp[a] @ xp[at].T
                ) < stop * bound[a][:, None]
                near &= ids[at][None, :] != q_ids[a][:, None]
                score = np.where(near, qu[a] @ xu[at].T, -np.inf)
                all_scores = np.concatenate([best[a], score], axis=1)
                all_ids = np.concatenate([best_id[a], np.broadcast_to(ids[at], score.shape)], axis=1)
                pick = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
                best[a] = np.take_along_axis(all_scores, pick, axis=1)
                best_id[a] = np.take_along_axis(all_ids, pick, axis=1)
                kth = best[a][:, -1]
                bound[a] = np.where(np.isfinite(kth), np.minimum(bound[a], 2 - 2 * kth + 1e-12), bound[a])
        at_q, at_k = np.nonzero(np.isfinite(best))
        rows_of = queries["row"].to_numpy()[at_q]
        return pa.table({"row": rows_of, "query_id": q_ids[at_q], "id": best_id[at_q, at_k], "score": best[at_q, at_k]})

    return run


def nearest(
    queries: DataFrame, rows: DataFrame, k: int = 5, id_column: str = "vec_id", vector: str = "embedding",
    m: int = 16, probability: float = 0.985, sample: int = SAMPLE, cell_rows: int = 8192, seed: int = 17,
) -> DataFrame:
    """``query_id, rank, id, score``: for each query the ``k`` rows of largest cosine that were found.

    Unit vectors are projected to ``m`` dimensions with standard normal entries, where a
    squared distance is the true one times a chi-square variable of ``m`` degrees. Median cuts
    learned from at most ``sample`` vectors make the upper kd-tree; its cells, cut into blocks,
    have kd-trees of their own. A query first searches its own cell, taking projected neighbours in order of
    distance and verifying them with exact cosines until the chi-square test holds: a point
    nearer than its k-th best would, with the given probability, have come by now. With that
    k-th distance as a bound it then visits only those other cells that the same test doesn't
    rule out, and the k best are merged: highest cosine first, ties to the smaller id.

    Vectors that are null, zero, empty or hold null or non-finite components take no part.
    A row with the query's id is not its candidate. Vectors of different lengths are not
    compared. Repeated rows are rows of their own, and each repeated query gets its k rows. A query with fewer than k candidates gets
    all of them. Empty tables give an empty result; other columns are not read.
    """
    stop = chi_square_quantile(probability, m)
    nonzero = F.exists("v", lambda x: x != 0)
    there = finite_vectors(rows, id_column, vector).where(nonzero).withColumn("dim", F.size("v"))
    asked = numbered(finite_vectors(queries, id_column, vector).where(nonzero).withColumn("dim", F.size("v")))
    count = there.count()
    cells = min(MAX_CELLS, max(1, count // cell_rows))
    drawn = there.where(F.rand(seed) < min(1.0, 0.9 * sample / max(1, count))).limit(sample) if cells > 1 else None
    trees: dict[int, list] = {}
    if drawn is not None:
        table = drawn.select("dim", "v").toArrow()
        dims = table.column("dim").to_numpy()
        for d in map(int, np.unique(dims)):
            vectors = vectors_of(table.column("v").filter(pa.array(dims == d)), np.float64)
            trees[d] = _top_tree(_unit(vectors) @ _projection(d, m, seed), cells)
    alone = [(-1, 0.0, 0, 0)]

    def place(batch: pa.RecordBatch):
        dims = batch.column("dim").to_numpy()
        for d in np.unique(dims):
            part = batch.filter(pa.array(dims == d))
            points = _unit(vectors_of(part.column("v"), np.float64)) @ _projection(int(d), m, seed)
            cell = _cell_of(points, trees.get(int(d), alone))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell)], names=[*part.schema.names, "cell"])

    def visits(batch: pa.RecordBatch):
        dims = batch.column("dim").to_numpy()
        for d in np.unique(dims):
            part = batch.filter(pa.array(dims == d))
            points = _unit(vectors_of(part.column("v"), np.float64)) @ _projection(int(d), m, seed)
            low, high = _boxes(trees.get(int(d), alone), m)
            bound, own = part.column("bound").to_numpy(), part.column("cell").to_numpy()
            for first in range(0, len(points), 256):
                take = slice(first, first + 256)
                go = _box_distance(points[take], low, high) < stop * bound[take, None]
                go[np.arange(len(go)), own[take]] = False
                who, cell = np.nonzero(go)
                who += first
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(pa.array(who)) for c in ("row", "id", "v", "dim", "bound")]
                    + [pa.array(cell.astype(np.int32))],
                    names=["row", "id", "v", "dim", "bound", "cell"],
                )

    placed = in_arrow(there, place, "id long, v array<double>, dim int, cell int")
    started = in_arrow(asked, place, "id long, v array<double>, dim int, row long, cell int").withColumn("bound", F.lit(float("inf")))
    run, schema = _search(k, m, seed, stop), "row long, query_id long, id long, score double"
    most = max(1, len(trees)) * cells
    first = stored(against(started, placed, most, run, schema, ["dim"], block=cell_rows))
    if cells == 1:
        return _result(first, k, id_column)
    kth = ranked(first, k).where(F.col("rank") == k).select(
        "row", (2 - 2 * F.col("score") + 1e-12).alias("kth")
    )
    # stored: queries are dealt by their place in the table, which a join does not give again
    bounded = stored(
        started.drop("bound").join(kth, "row", "left")
        .withColumn("bound", F.coalesce("kth", F.lit(float("inf")))).select("row", "id", "v", "dim", "cell", "bound")
    )
    going = in_arrow(bounded, visits, "row long, id long, v array<double>, dim int, bound double, cell int")
    second = against(going, placed, most, run, schema, ["dim"], block=cell_rows)
    return _result(first.unionByName(second), k, id_column)


def _result(found: DataFrame, k: int, id_column: str) -> DataFrame:
    return ranked(found, k).select("query_id", "rank", F.col("id").alias(id_column), "score")
