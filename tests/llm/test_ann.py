import numpy as np
from helpers import with_clashing

from yieldlens.llm.ann import chi_square_quantile, nearest

SCHEMA = "vec_id long, embedding array<double>"


def exact(vectors, queries, k):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        order = np.lexsort((ids, -s))[:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in order if np.isfinite(s[j])]
    return out


def test_quantile():
    # fixed values: the chi-square distribution's 95 % points for 2 and 10 degrees
    assert abs(chi_square_quantile(0.95, 2) - 5.991464547) < 1e-6
    assert abs(chi_square_quantile(0.95, 10) - 18.307038053) < 1e-6


def test_recall_and_scores(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 32))
    vectors = [(i, (centres[i % 12] + 0.6 * rng.standard_normal(32)).tolist()) for i in range(3000)]
    rows = with_clashing(spark.createDataFrame(vectors, SCHEMA)).repartition(4)
    queries = list(range(0, 3000, 50))
    want = exact(vectors, queries, 5)
    got = {}
    for r in nearest(rows.where("vec_id % 50 = 0"), rows, k=5, cell_rows=300).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in queries)
    assert hits / (5 * len(queries)) >= 0.95
    assert all(len(v) == 5 and [s for _, s in v] == sorted((s for _, s in v), reverse=True) for v in got.values())
    for q in queries:
        scores = dict(want[q])
        assert all(abs(s - scores[i]) < 1e-9 for i, s in got[q] if i in scores)


def test_odd_vectors_and_copies(spark):
    same = [(i, [1.0, 1.0, 0.0]) for i in range(40)]
    odd = [(100, None), (101, [0.0, 0.0, 0.0]), (102, [float("nan"), 1.0, 1.0]), (103, [None, 1.0, 1.0]), (104, [1e300, 1e300, 0.0]), (None, [1.0, 1.0, 0.0]), (105, [1.0])]
    rows = spark.createDataFrame(same + odd, SCHEMA)
    found = nearest(rows.where("vec_id in (0, 100, 101, 102, 103, 104, 105)"), rows, k=3, cell_rows=10)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found.collect())
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (104, 1, 0), (104, 2, 1), (104, 3, 2)]
    assert nearest(rows.where("vec_id > 999"), rows).count() == 0
    assert nearest(rows, rows.where("vec_id > 999")).count() == 0


def test_repeated_queries(spark):
    """Each of two equal query rows has its own k neighbours, in one cell and in many."""
    rng = np.random.default_rng(9)
    vectors = [(i, rng.standard_normal(8).tolist()) for i in range(600)]
    rows = spark.createDataFrame([*vectors, vectors[0], vectors[40]], SCHEMA)
    queries = rows.where("vec_id in (0, 40, 80)")
    for cell_rows in (50, 5000):
        found = nearest(queries, rows, k=4, cell_rows=cell_rows, probability=0.9999).collect()
        for q, times in ((0, 2), (40, 2), (80, 1)):
            want = sorted([(n + 1, i) for n, (i, _) in enumerate(exact_rows(rows, q, 4))] * times)
            assert sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == q) == want


def exact_rows(rows, q, k):
    """The k nearest rows of a table in which ids repeat."""
    table = [(r["vec_id"], np.array(r["embedding"])) for r in rows.collect()]
    own = next(v for i, v in table if i == q)
    scored = [(-float(v @ own / np.linalg.norm(v) / np.linalg.norm(own)), i) for i, v in table if i != q]
    return [(i, s) for s, i in sorted(scored)[:k]]
