import hashlib
import zlib

import numpy as np
import pytest
from helpers import with_clashing

from yieldlens.llm import conversation_trie as trie
from yieldlens.llm.queries import op11_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def order(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    return turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def rebuilt(rows):
    """Every conversation's turns by the contract's words."""
    own = {}
    for row in sorted((r for r in rows if r[0] is not None), key=order):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(talks):
    members = {}
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {p: [q for q in members if q[: len(p)] == p] for p in members}
    out = []
    for p, convs in members.items():
        children = {q for q in below[p] if len(q) == len(p) + 1}
        leaves = [q for q in below[p] if not any(len(r) > len(q) for r in below[q])]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below[p] if q)
        ends = ",".join(map(str, sorted(c for c in convs if len(talks[c]) == len(p))))
        out.append((
            min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), len(children), len(leaves), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: (r[1], r[0]))


def awkward(seed=1, convs=60):
    r = np.random.default_rng(seed)
    rows = [
        (int(c), t, ["user", "assistant", None][r.integers(3)], ["a", "é", "", None, "bb", "日本"][r.integers(6)])
        for c in range(convs) for t in range(r.integers(0, 14))
    ]
    rows += [(c, None, "system", "hello") for c in (3, 5, 7, 10, 11, 12)] + [(None, 1, "user", "no id")]
    rows += [(1000, 1, "u", "x"), (1000, 1, "u", "x"), (1000, 1, "a", "y"), (-7, 1, "u", "minus"), (-5, 1, "u", "first"), (-5, 2, "u", "n")]
    return [*rows, (2**40, 0, "u", "far"), (2**40 + 1, 0, "u", "w" * 50000)]


def result(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA)
    with_clashing(df).repartition(7).write.parquet(f"{tmp_path}/conversations.parquet")
    return sorted(map(tuple, op11_trie(spark, str(tmp_path)).select(*COLUMNS).collect()), key=lambda r: (r[1], r[0]))


def test_against_brute_force(spark, tmp_path):
    rows = awkward()
    assert result(spark, rows, tmp_path) == brute(rebuilt(rows))


def test_many_shards(spark, tmp_path, monkeypatch):
    """Small shards and parts: workers see the settings through the function they run."""
    rows = awkward(2, 40) + [(400 + k, t, "u", f"{t % 3}") for k in range(3) for t in range(40)]
    rows += [(500, t, "u", f"{t % 3}" if t < 70 else str(t)) for t in range(90)]
    talks = rebuilt(rows)
    monkeypatch.setattr(trie, "PART", 16)
    turns = trie.share_openings(trie.numbered_turns(spark.createDataFrame(rows, SCHEMA)))
    nodes, ends = trie.prefix_trie(turns)
    found = nodes.join(trie.end_digests(ends), ["k1", "k2"], "left").fillna(hashlib.sha256().hexdigest(), ["ends_sha256"])
    assert sorted(map(tuple, found.select(*COLUMNS).collect()), key=lambda r: (r[1], r[0])) == brute(talks)
    assert trie.shard_nodes(turns).where("part > 1").count() > 0


@pytest.mark.parametrize("convs,turns", [(1, 3), (3, 10), (1000, 1000)])
def test_shards_cut_anywhere(convs, turns, monkeypatch):
    """However batches and shards fall, the counts of all shards together are the same."""
    import pyarrow as pa

    monkeypatch.setattr(trie, "SHARD_CONVS", convs)
    monkeypatch.setattr(trie, "SHARD_TURNS", turns)
    r = np.random.default_rng(4)
    conv = np.repeat(np.arange(50), r.integers(1, 9, 50))
    place = np.concatenate([np.arange(n) for n in np.bincount(conv)])
    z = np.where(place == 0, 0, r.integers(0, 2**60, (9, 3))[place, r.integers(0, 3, len(place))])
    rows = pa.table({
        "conv": conv, "part": np.full(len(conv), -1, np.int32), "place": place, "z1": z, "z2": z * 7,
        "bytes": np.ones(len(conv), np.int64), "total": np.zeros(len(conv), np.int64), "head": place == 0,
    })
    counts = {}
    for batch in trie._cut_into_shards(iter(rows.to_batches(max_chunksize=13))):
        for k, n, d, ends in zip(*(batch.column(c).to_pylist() for c in ("k1", "n", "depth", "ends"))):
            have = counts.setdefault((k, d), [0, []])
            have[0] += n
            have[1] += ends
    expected = {}
    for c in range(50):
        own, key = z[conv == c], 0
        for d, x in enumerate(own):
            key ^= int(x)
            have = expected.setdefault((key, d), [0, []])
            have[0] += 1
            if d == len(own) - 1:
                have[1].append(c)
    assert counts == expected


def test_hot_copies_and_empty(spark, tmp_path):
    rows = [(c, t, "u", f"t{t}") for c in range(5, 405) for t in range(3)]
    (tmp_path / "a").mkdir()
    assert result(spark, rows, tmp_path / "a") == brute(rebuilt(rows))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert op11_trie(spark, str(tmp_path)).count() == 0
