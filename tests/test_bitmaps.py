import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldlens.operators import bitmaps as bm, rules as ru


def coded(spark, n=500, items=12, seed=1):
    rng = np.random.default_rng(seed)
    rows = [
        (g, ["neg", "pos", "other"][rng.integers(3)], int(rng.integers(1, 1000)), sorted(int(i) for i in np.flatnonzero(rng.random(items) < 0.4)))
        for g in rng.choice(["a", "b"], n)
    ]
    rows = [(str(g), y, w, ids) for g, y, w, ids in rows]
    return rows, spark.createDataFrame(rows, "_by string, _y string, _w long, ids array<int>").repartition(3)


def counted(rows, size):
    found = {}
    for g, y, w, ids in rows:
        for combo in itertools.combinations(ids, size):
            n = found.setdefault((g, combo), dict.fromkeys(("all", "neg", "pos"), 0))
            n["all"] += w
            if y in n:
                n[y] += w
    return {k: (n["all"], n["neg"], n["pos"]) for k, n in found.items()}


def read(df):
    return {(r["_by"], tuple(r["ids"])): (r["all"], r["neg"], r["pos"]) for r in df.collect()}


@pytest.mark.parametrize("small", [False, True])
def test_counts_against_brute_force(spark, monkeypatch, small):
    if small:  # many blocks, steps, sendings and chunks
        for name, value in (("BLOCK_BYTES", 64), ("STEP_BYTES", 16), ("HELD", 20), ("CHUNK", 10)):
            monkeypatch.setattr(bm, name, value)
    rows, df = coded(spark)
    stored = bm.blocks(df)
    assert read(bm.count_pairs(stored)) == counted(rows, 2)
    for size in (3, 4):
        frequent = spark.createDataFrame([(g, list(ids)) for g, ids in counted(rows, size - 1)], "_by string, ids array<int>")
        parts = bm.chunks(bm.candidates(frequent, size))
        assert read(bm.count_sets(stored.join(parts, "_by"), size)) == counted(rows, size)


def test_candidates_have_only_frequent_parts(spark):
    pairs = [("g", [0, 1]), ("g", [0, 2]), ("g", [1, 2]), ("g", [1, 3]), ("g", [2, 4]), ("h", [2, 3])]
    found = bm.candidates(spark.createDataFrame(pairs, "_by string, ids array<int>"), 3).collect()
    assert [tuple(r) for r in found] == [("g", [0, 1, 2])]


def test_rows_without_items_and_no_rows(spark):
    df = spark.createDataFrame([("", "neg", 3, []), ("", "pos", 1, [5])], "_by string, _y string, _w long, ids array<int>")
    for frame in (df, df.where("false")):
        assert bm.count_pairs(bm.blocks(frame)).collect() == []


def test_a_thousand_columns(spark):
    rng = np.random.default_rng(2)
    cells = (rng.random((300, 1000)) < rng.uniform(0.3, 0.9, 1000)).astype(int)
    cells[:, 7] = cells[:, 8] = 1
    y = rng.integers(0, 2, 300)
    columns = [f"c{i:03}" for i in range(1000)]
    df = spark.createDataFrame([(x.tolist(), int(k)) for x, k in zip(cells, y)], "cells array<int>, Y int")
    df = df.select("Y", *[F.col("cells")[i].alias(c) for i, c in enumerate(columns)])
    found = ru.frequent_itemsets(df, columns, "Y", 0.75, 2).where("size = 2").collect()
    expected = {}
    both = np.concatenate([cells, 1 - cells], axis=1)
    names = [f"{c}=1" for c in columns] + [f"{c}=0" for c in columns]
    for k in (0, 1):
        part = both[y == k]
        together = part.T @ part
        for i, j in zip(*np.nonzero(np.triu(together >= 0.75 * len(part), 1))):
            expected[k, tuple(sorted((names[i], names[j])))] = together[i, j]
    assert {(r.Y, tuple(r["items"])): r.n for r in found} == expected and len(expected) > 1000
