import random

from yieldlens.llm import links


def brute(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 130)] + [(r.randint(200, 400), r.randint(200, 400)) for _ in range(60)]
    edges = [(a, b) for a, b in edges if a != b]
    df = spark.createDataFrame([*edges, (5, 5), (None, 3), *edges[:5]], "a long, b long")
    got = {r["id"]: r["root"] for r in links.components(df).collect()}
    assert got == brute(edges)
    assert links.components(df.where("a > 999")).count() == 0


def test_links_across_a_large_bucket(spark, monkeypatch):
    # in one bucket: numbers that are similar when they differ by 1; a chain that no single leader sees
    monkeypatch.setattr(links, "PAIRS_PER_MEMBER", 0)
    monkeypatch.setattr(links, "LEADERS", 2)
    members = [(1, i) for i in [*range(0, 10), *range(20, 24), 99]] + [(2, 99), (2, 200), (3, 9), (3, 20)]
    df = spark.createDataFrame(members, "key long, id long")
    shared = links.shared_buckets(df)
    assert shared.count() == len(members)
    found = links.link(shared, lambda pairs: pairs.where("abs(a - b) = 1 OR abs(a - b) = 11"))
    got = {r["id"]: r["root"] for r in found.collect()}
    want = brute([(i, i + 1) for i in range(9)] + [(i, i + 1) for i in range(20, 23)] + [(9, 20)])
    assert got == {k: v for k, v in want.items() if k != v}


def test_buckets_of_one(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 5), (2, 6)], "key long, id long")
    assert sorted(tuple(r) for r in links.shared_buckets(df).collect()) == [(2, 5), (2, 6)]
    assert links.link(links.shared_buckets(df.where("key = 1")), lambda p: p).count() == 0
