import re
from collections import Counter

import numpy as np
import pytest
from helpers import documents, with_clashing
from pyspark.sql import functions as F

from yieldlens.llm import doc_rules
from yieldlens.llm.common import held_out
from yieldlens.llm.queries import op13_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated), failed,
    )


COLUMNS = [*doc_rules.STATISTICS, "base_failed"]


def awkward():
    r = np.random.default_rng(3)
    words = ["the", "réunion", "日本", "a#b", "||", "<p>", "\n", "\r\n", "\t", "\x0b", "x1", "🙂", " ", "the the the", "\x00"]
    rows = [(i, " ".join(r.choice(words, r.integers(0, 200)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "\n" * 3000), (203, "same a b"), (203, "same a b"), (None, "no id"), (204, "a" * 5000)]
    return [*rows, (205, "l1 a\nl1 a\n \n \nl1 a"), (206, "long " * 40000), (207, " ".join(map(str, range(60)))), (208, "a b c a b"), (209, "a b c a b c")]


def test_against_brute_force(spark):
    rows = awkward()
    found = doc_rules.judge(with_clashing(documents(spark, rows).repartition(4)), None)
    assert {tuple(r) for r in found.select("doc_id", *COLUMNS).collect()} == {(i, *brute(t)) for i, t in rows}
    assert found.count() == len(rows)
    assert all(r["kept"] == (not r["base_failed"]) and r["score"] == 0.5 for r in found.collect())


@pytest.mark.parametrize("run", [7, 64, 1000])
def test_slices_of_long_texts(run):
    """Wherever a buffer is cut, statistics and features are the same."""
    raw = [(t or "").encode() for _, t in awkward() if t is None or len(t) < 4000]
    data, at = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    whole, cut = doc_rules.Profile(data, at), doc_rules.Profile(data, at, run)
    assert np.array_equal(whole.features(), cut.features())
    for c in doc_rules.STATISTICS:
        assert np.array_equal(getattr(whole, c), getattr(cut, c)), c


def walk(trees, row):
    total = trees.base
    for node in trees.roots:
        while trees.left[node] != node:
            node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
        total += trees.value[node]
    return total


def test_flat_trees_are_the_trees():
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(int)
    trees = doc_rules.Trees.fit(x, y, np.zeros(4))
    assert np.allclose(trees.margin(x[:50]), [walk(trees, row) for row in x[:50]])
    assert ((trees.score(x) >= 0.5) == y).mean() > 0.97


def test_first_tree_splits_where_all_splits_say():
    """The root of the first tree is the best of all splits, tried one by one."""
    r = np.random.default_rng(6)
    x = r.integers(0, 12, (80, 3)).astype(float)
    y = (x[:, 1] + r.normal(size=80) > 6).astype(int)
    trees = doc_rules.Trees.fit(x, y, np.zeros(3), trees=1, depth=1, least_weight=0.0)
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * 80
    g, h = share * (0.5 - y), share * 0.25
    gains = {}
    for f in range(3):
        for t in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= t
            gains[f, t] = sum(g[m].sum() ** 2 / (h[m].sum() + 1) for m in (left, ~left))
    assert max(gains, key=gains.get) == (trees.feature[0], trees.threshold[0])


@pytest.mark.parametrize("sign", [-1, 1])
def test_monotone(sign):
    """Against the labels' own direction a constrained feature still never moves the score the wrong way."""
    r = np.random.default_rng(2)
    x = r.uniform(size=(800, 3))
    y = (np.sin(7 * x[:, 0]) + x[:, 1] + 0.3 * r.normal(size=800) > 0.5).astype(int)
    trees = doc_rules.Trees.fit(x, y, np.array([sign, 0, 0]), depth=4)
    grid = np.repeat(r.uniform(size=(40, 3)), 50, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 50), 40)
    steps = np.diff(trees.margin(grid).reshape(40, 50), axis=1)
    assert (sign * steps >= -1e-9).all()
    free = doc_rules.Trees.fit(x, y, np.zeros(3), depth=4)
    assert (sign * np.diff(free.margin(grid).reshape(40, 50), axis=1) < -1e-3).any()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = doc_rules.judge(docs, doc_rules.train(docs, labels))
    out = found.where(held_out("doc_id")).join(labels, "doc_id").select("quality", "score", "base_failed").collect()
    right = np.mean([(r["score"] >= 0.5) == (r["quality"] == 1) for r in out])
    assert len(out) > 80 and right > 0.95


def test_query(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    found = op13_rules(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r[c] for c in COLUMNS) == brute(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_empty_and_unlabelled(spark):
    none = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert doc_rules.train(none, labels) is None
    assert doc_rules.judge(none, None).count() == 0
    one = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    docs = documents(spark, [(i, "text") for i in range(9)])
    assert doc_rules.train(docs, one.withColumn("text", F.lit("x"))) is None
