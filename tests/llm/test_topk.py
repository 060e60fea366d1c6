import math

import numpy as np
from helpers import with_clashing

from yieldlens.llm.topk import BitSlices, top_by_product

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors, queries, k, scale=1024):
    x = {i: [math.floor(scale * float(np.float32(c))) for c in v] for i, v in vectors}
    out = []
    for q in queries:
        scored = sorted((-sum(a * b for a, b in zip(x[q], v)), i) for i, v in x.items() if i != q and len(v) == len(x[q]))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_scores_by_bitmaps():
    rng = np.random.default_rng(1)
    x = rng.integers(-700, 700, (333, 9))
    index = BitSlices(x)
    for q in (rng.integers(-900, 900, 9), np.zeros(9, int), np.full(9, -1), np.full(9, 1023)):
        sums = index.scores(q)
        digits = np.stack([np.unpackbits(b.view(np.uint8), bitorder="little")[:333] for b in sums]).astype(np.int64)
        value = (digits << np.arange(len(sums))[:, None]).sum(axis=0)
        assert len(set(value - x @ q)) == 1


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, (rng.integers(-3, 4, 6) / 4).tolist()) for i in range(300)]  # many ties
    vectors += [(i, rng.standard_normal(6).tolist()) for i in range(300, 400)]
    vectors += [(400 + i, [1.0, 2.0]) for i in range(3)]
    odd = [(500, None), (501, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (504, []), (None, [1.0] * 6)]
    rows = with_clashing(spark.createDataFrame(vectors + odd, SCHEMA)).repartition(5)
    queries = [*range(0, 400, 20), 401]
    found = top_by_product(rows.where("vec_id in (%s) or vec_id >= 500" % ",".join(map(str, queries))), rows, k=5, chunk=7, block=64)
    assert sorted(tuple(r) for r in found.collect()) == brute(vectors, queries, 5)


def test_few_and_none(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5])], SCHEMA)
    assert sorted(tuple(r) for r in top_by_product(rows, rows, k=10).collect()) == [(1, 1, 2, 524288), (2, 1, 1, 524288)]
    none = rows.where("vec_id > 5")
    assert top_by_product(none, rows).count() == 0
    assert top_by_product(rows, none).count() == 0


def test_repeated_queries(spark):
    """Each of two equal query rows has its own k rows."""
    rng = np.random.default_rng(3)
    vectors = [(i, (rng.integers(-9, 10, 5) / 8).tolist()) for i in range(200)]
    rows = spark.createDataFrame([*vectors, vectors[0]], SCHEMA)
    found = top_by_product(rows.where("vec_id in (0, 20)"), rows, k=5, chunk=1, block=64).collect()
    x = [(i, [math.floor(1024 * c) for c in v]) for i, v in [*vectors, vectors[0]]]
    for q, times in ((0, 2), (20, 1)):
        scored = sorted((-sum(a * b for a, b in zip(dict(x)[q], v)), i) for i, v in x if i != q)[:5]
        want = sorted([(n + 1, i, -s) for n, (s, i) in enumerate(scored)] * times)
        assert sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q) == want
