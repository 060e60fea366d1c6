import random

import numpy as np
from helpers import documents, with_clashing

from yieldlens.llm.neardup import Shingles, WeightedSampler, inverse_frequencies, near_duplicates


def text_of(r, n):
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 7))) for _ in range(n))


def edited(r, text, changes):
    words = text.split()
    for at in r.sample(range(len(words)), changes):
        words[at] = "zz" + "".join(r.choices("xyz", k=6))
    return " ".join(words)


def brute(rows, threshold=0.8):
    """Weighted Jaccard over all pairs of different texts, with the operator's weights."""
    from yieldlens.llm.common import Words
    from yieldlens.llm.neardup import PLACES

    data = [(t or "").encode() for _, t in rows]
    at = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    whole = np.frombuffer(b"".join(data), np.uint8)
    words = Words(whole, at)
    place = (words.hashes() >> np.uint64(44)).astype(np.int64)
    counts, texts = np.zeros(PLACES, np.int64), 0
    for d in range(len(rows)):
        own = set(place[words.bounds[d] : words.bounds[d + 1]])
        counts[list(own)] += 1
        texts += bool(own)
    s = Shingles(whole, at, inverse_frequencies(texts, counts))
    sets = [dict(zip(s.hash[a:b].tolist(), s.weight[a:b].tolist())) for a, b in zip(s.bounds, s.bounds[1:])]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, _) in enumerate(rows):
        for m, (j, _) in enumerate(rows[:n]):
            a, b = sets[n], sets[m]
            if i is None or j is None or not a or not b:
                continue
            both = sum(min(w, b.get(k, 0)) for k, w in a.items())
            if both >= threshold * (sum(a.values()) + sum(b.values()) - both) * (1 - 1e-6):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def test_sampler_estimates_weighted_jaccard():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**63, 400).astype(np.uint64)
    a, b = rng.random(400).astype(np.float32) + 0.1, rng.random(400).astype(np.float32) + 0.1
    sampler = WeightedSampler(2000)
    x = sampler.sample(hashes, a, np.array([0, 400]))
    y = sampler.sample(hashes, b, np.array([0, 400]))
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((x == y).mean() - true) < 0.04


def test_against_brute_force(spark):
    r = random.Random(9)
    rows = []
    for i in range(60):
        text = text_of(r, r.randint(20, 200))
        rows.append((10 * i, text))
        if i % 2:
            rows.append((10 * i + 1, text))  # an exact copy
        if i % 3 == 0:
            rows += [(10 * i + 2 + k, edited(r, text, 1)) for k in range(3)]
        if i % 5 == 0:
            rows.append((10 * i + 6, edited(r, text, 12)))
    base = text_of(r, 300)
    rows += [(5000 + k, edited(r, base, 2)) for k in range(40)]  # many near copies of each other
    rows += [(9000, None), (9001, ""), (9002, " \n"), (9003, "one two"), (9004, "one two"), (9005, "one two three"), (None, base)]
    found = near_duplicates(with_clashing(documents(spark, rows)).repartition(5)).collect()
    assert len(found) == len(rows)
    got = {x["doc_id"]: x["class_id"] for x in found}
    assert got.pop(None) is None
    assert got == brute(rows)
    assert got[9004] == 9003 and got[9001] == 9001


def test_repeated_rows_and_empty(spark):
    r = random.Random(4)
    a, b = text_of(r, 60), text_of(r, 60)
    rows = [(7, a), (7, a), (8, b), (8, a), (9, b), (10, b + " more")]
    got = sorted(tuple(x) for x in near_duplicates(documents(spark, rows)).collect())
    assert got == [(7, 7), (7, 7), (8, 7), (8, 7), (9, 7), (10, 7)]
    assert near_duplicates(documents(spark, [])).count() == 0
    assert [tuple(x) for x in near_duplicates(documents(spark, [(3, None)])).collect()] == [(3, 3)]


def test_lower_thresholds_find_all(spark):
    from yieldlens.llm.neardup import agreeing_for, bands_for

    assert (bands_for(0.8), agreeing_for(0.8)) == ((16, 4), 41)
    r = random.Random(2)
    rows = []
    for i in range(120):
        text = text_of(r, 100)
        rows += [(10 * i, text), (10 * i + 1, edited(r, text, 5))]
    got = {x["doc_id"]: x["class_id"] for x in near_duplicates(documents(spark, rows), threshold=0.6).collect()}
    expected = brute(rows, 0.6)
    assert sum(expected[i] != i for i in expected) > 60
    assert got == expected


def test_prefixes_meet_for_all_similar_pairs(spark):
    """Sets of weighted shingles: every pair at or over the threshold shares a prefix feature; heavily edited ones meet nobody."""
    from yieldlens.llm.neardup import weighted_prefixes

    r = np.random.default_rng(7)
    base = {int(f): float(w) for f, w in zip(range(60), r.uniform(0.5, 2, 60))}
    sets = {}
    for i in range(90):
        own = dict(base)
        for f in r.choice(60, int(r.integers(0, 40)), replace=False):
            own[1000 + 100 * i + int(f)] = own.pop(int(f))
        sets[i] = own
    rows = [(i, f, w) for i, own in sets.items() for f, w in own.items()]
    found = {}
    for x in weighted_prefixes(spark.createDataFrame(rows, "id long, feature long, weight double"), 0.8).collect():
        found.setdefault(x["id"], set()).add(x["feature"])
    similar = met = 0
    for i in sets:
        for j in range(i):
            a, b = sets[i], sets[j]
            both = sum(min(w, b[f]) for f, w in a.items() if f in b)
            share = bool(found.get(i, set()) & found.get(j, set()))
            met += share
            if both >= 0.8 * (sum(a.values()) + sum(b.values()) - both):
                similar += 1
                assert share
    assert similar > 20 and met < 0.4 * 90 * 89 / 2


def test_heavily_edited_groups_by_prefixes(spark, monkeypatch):
    """No leader turns at all: every link comes through prefixes and their reach; classes are those of all pairs."""
    from yieldlens.llm import links

    r = random.Random(4)
    base = text_of(r, 120).split()
    rows = []
    for i in range(60):
        own = list(base)
        for j in r.sample(range(120), r.randint(0, 9)):
            own[j] = "x" + str(1000 * i + j)
        rows.append((i, " ".join(own)))
    usual = sorted(map(tuple, near_duplicates(documents(spark, rows)).collect()))
    monkeypatch.setattr(links, "PAIRS_PER_MEMBER", -1)
    monkeypatch.setattr(links, "LEADERS", 0)
    assert sorted(map(tuple, near_duplicates(documents(spark, rows)).collect())) == usual
    classes = [c for _, c in usual]
    assert 1 < len(set(classes)) < 60
