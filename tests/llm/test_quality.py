import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, with_clashing

from yieldlens.llm import quality
from yieldlens.llm.common import text_buffer


def brute_marginals(emit, move):
    """All state sequences of one chain."""
    n = len(emit)
    total, good = 0.0, np.zeros(n)
    for code in range(1 << n):
        states = [code >> t & 1 for t in range(n)]
        value = np.prod([emit[t, s] for t, s in enumerate(states)]) * np.prod([move[a, b] for a, b in zip(states, states[1:])])
        total += value
        good += value * np.array(states)
    return good / total, np.log(total)


def test_marginals_of_chains():
    rng = np.random.default_rng(2)
    bounds = np.array([0, 1, 6, 6 + 3, 9 + 8])
    emit, move = rng.random((17, 2)) + 0.05, rng.random((2, 2)) + 0.1
    prob, _, norm = quality.Chains(bounds).marginals(emit, move)
    logs = 0.0
    for a, b in zip(bounds, bounds[1:]):
        good, log = brute_marginals(emit[a:b], move)
        assert np.allclose(prob[a:b, 1], good)
        logs += log
    assert np.isclose(norm, logs)


def test_gradient_finds_the_slope():
    rng = np.random.default_rng(1)
    bounds = np.array([0, 3, 4, 9])
    x, labels = rng.standard_normal((9, 4)), np.array([1, 0, 1])
    seen = {}

    def record(loss, p, steps):
        seen["loss"] = loss
        return p

    old, quality._minimise = quality._minimise, record
    try:
        quality.LineField.fit(x, bounds, labels)
    finally:
        quality._minimise = old
    p = rng.standard_normal(9) * 0.3
    value, grad = seen["loss"](p)
    for i in range(9):
        step = np.zeros(9)
        step[i] = 1e-5
        assert abs((seen["loss"](p + step)[0] - seen["loss"](p - step)[0]) / 2e-5 - grad[i]) < 1e-5


def test_lines_and_neighbours():
    data, at = text_buffer(pa.array(["ab\nCD!\n", None, "x x x", "q\nq"]))
    lines = quality.Lines(data, at)
    assert lines.bounds.tolist() == [0, 3, 4, 5, 7]
    assert lines.length.tolist() == [2, 4 - 1, 0, 0, 5, 1, 1]
    assert lines.x[:, -2].tolist() == [0, 0, 0, 0, 0, 0, 1]  # an equal line before
    assert np.allclose(lines.x[:, -1], [0, 0, 0, 0, 2 / 3, 0, 0])  # equal words in a row
    wide = lines.features()
    own = quality.OWN
    assert np.array_equal(wide[1, own : 2 * own], lines.x[0]) and np.array_equal(wide[0, 2 * own :], lines.x[1])
    assert not wide[4, own:].any()


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)

    def word():
        return "".join(r.choices("abcdefghij", k=r.randint(2, 8)))

    out, labels = [], []
    for i in range(400):
        lines = [" ".join(word() for _ in range(r.randint(4, 20))).capitalize() + "." for _ in range(r.randint(1, 6))]
        good = r.random() < 0.8
        if not good:
            junk = r.choice([lambda: word().upper() + "!!", lambda: word() + "$$$", lambda: word() + " |"])
            lines = lines[:1] + [" ".join(junk() for _ in range(20)) for _ in range(len(lines))]
        out.append((i, "\n".join(lines)))
        labels.append((i, int(good)))
    return out, labels


def test_held_out_accuracy(spark, rows):
    docs = with_clashing(documents(spark, rows[0])).repartition(3)
    labels = spark.createDataFrame([*rows[1], (None, 1), (3, None), (99999, 0)], "doc_id long, quality int")
    found = {r["doc_id"]: r["score"] for r in quality.score(docs, quality.train(docs, labels, sample=100)).collect()}
    out = [(i, y) for i, y in rows[1] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((found[i] >= 0.5) == y for i, y in out) / len(out) >= 0.97
    assert all(0 <= s <= 1 for s in found.values())


def test_odd_texts(spark, rows):
    docs = documents(spark, rows[0])
    field = quality.train(docs, spark.createDataFrame(rows[1], "doc_id long, quality int"), sample=50)
    odd = [(1, None), (2, ""), (3, "\n" * 20_000), (4, "a" * 300_000), (5, "x"), (5, "x"), (None, "x")]
    found = quality.score(documents(spark, odd), field).collect()
    assert len(found) == len(odd) and all(0 <= r["score"] <= 1 for r in found)
    assert quality.score(documents(spark, []), field).count() == 0


def test_nothing_learned(spark):
    docs = documents(spark, [(1, "a")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(docs, none) is None
    assert quality.score(docs, None).first()["score"] == 0.5
