import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import documents, with_clashing
from tokenizers import Tokenizer

from yieldlens.llm import alignment
from yieldlens.llm.queries import op12_alignment


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_table():
    """Characters of byte-level vocabularies and the bytes they stand for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def brute(rows, both):
    """Groups by the definition, links pair by pair."""
    first, second = both
    table = byte_table()
    vocabulary = {i: bytes(table[c] for c in t) for t, i in first.get_vocab().items() if i != 50256}
    groups = []
    for _, text in rows:
        whole = b" " + (text or "").encode()
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        piece = [
            bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, second.id_to_piece(i)) for i in b)
        ]
        if not text or b"".join(vocabulary[i] for i in a) != whole or b"".join(piece) != whole:
            groups.append([])
            continue
        ends_a, ends_b = np.cumsum([len(vocabulary[i]) for i in a]), np.cumsum([len(p) for p in piece])
        cuts = sorted(set(ends_a) & set(ends_b))
        own, start = [], 0
        for cut in cuts:
            own.append(([i for i, e in zip(a, ends_a) if start < e <= cut], [i for i, e in zip(b, ends_b) if start < e <= cut]))
            start = cut
        groups.append(own)
    counts = Counter(p for own in groups for p in {(x, y) for g in own for x in g[0] for y in g[1]})
    top = {}
    for (x, _), n in counts.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for (i, _), own in zip(rows, groups):
        links = [(x, y) for g in own for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in own)
        out.append((
            i, sum(len(g[0]) for g in own), sum(len(g[1]) for g in own), len(own), len(links),
            sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if own else "",
        ))
    return out


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(5)
    words = ["the", "réunion", "ation", "日本語", "\n", "\t\t", "<|endoftext|>", "<s>", "x1", "3.14", "🙂", "na ïve", "<0x41>", "zzzzzz", "\u0000"]
    rows = [(i, " ".join(r.choice(words, r.integers(1, 60)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " "), (103, "a ▁ b"), (104, "  lead"), (105, "same"), (105, "same"), (None, "no id"), (106, "é")]
    return [*rows, (107, "long " * 1500 + "日本語" * 500)]


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def by_null(found):
    return sorted(found, key=lambda r: (r[0] is not None, r))


def test_against_brute_force(spark, both, rows, monkeypatch, tmp_path):
    documents(spark, rows).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = op12_alignment(spark, str(tmp_path)).select(*COLUMNS).collect()
    assert by_null(map(tuple, found)) == by_null(brute(rows, both))


def test_rare_pairs_by_join(spark, both, rows):
    """With few broadcast pairs the others are joined; sums are the same."""
    from pyspark.sql import functions as F

    found = alignment.align(documents(spark, rows), columns=alignment.PAIRS)
    aligned = alignment.stored(found.withColumn("row", F.monotonically_increasing_id()))
    counts = alignment.stored(alignment.link_counts(aligned, both[1].vocab_size()))
    one, few = (sorted(map(tuple, alignment.link_scores(aligned, counts, n).collect())) for n in (1 << 19, 8))
    assert one == few and len(one) > 80


def test_tokens_and_sizes(spark, both):
    (r,) = alignment.align(documents(spark, [(1, "a réunion of tokens 日本")])).collect()
    assert r["a"] == both[0].encode(" a réunion of tokens 日本").ids and r["b"] == both[1].encode("a réunion of tokens 日本")
    assert sum(r["a_sizes"]) == len(r["a"]) and sum(r["b_sizes"]) == len(r["b"]) and len(r["a_sizes"]) == len(r["b_sizes"]) > 3


def test_slices_of_large_groups(monkeypatch):
    """Rows over the bound are expanded in ranges of ids; the pairs are the same."""
    r = np.random.default_rng(2)
    a_sizes, b_sizes = np.array([300, 2, 1]), np.array([200, 1, 4])
    a, b = r.integers(0, 90, 303), r.integers(0, 50, 205)
    rows = alignment.Aligned(a, np.array([302, 0, 1]), b, np.array([201, 0, 4]), a_sizes, b_sizes, np.array([2, 0, 1]))
    whole = [tuple(map(int, x)) for part in rows.pairs(50) for x in zip(*part)]
    monkeypatch.setattr(alignment, "EXPAND", 500)
    parts = list(rows.pairs(50))
    assert sorted(tuple(map(int, x)) for part in parts for x in zip(*part)) == sorted(whole)
    assert len(parts) > 4 and sum(w[2] for w in whole) == 300 * 200 + 2 + 4


@pytest.mark.parametrize("blank", [" ", "\n", "\u3000"])
@pytest.mark.parametrize("end", ["", "x", "\t", "'s", "!"])
def test_long_blank_runs(both, monkeypatch, blank, end):
    """Runs that the fast library can't search have the ids of the other."""
    from yieldlens.llm import common

    paths = (*map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    first = alignment.First(*paths)
    for text in ("a" + blank * 20000 + end, blank * 17000 + end + blank * 17000 + "b " + end):
        assert first.encode(text).tolist() == both[0].encode(" " + text, add_special_tokens=False).ids
    assert len(first.encode(blank * 1_000_000 + end)) > 1000
    assert common.LONG_BLANKS <= 17000


def test_components_of_long_chains():
    """Tokens that overlap in turn over the whole text are one group."""
    n = 5000
    ends_a = np.append(np.arange(2, 2 * n, 2), 2 * n)
    ends_b = np.append(np.arange(1, 2 * n, 2), 2 * n)
    assert set(alignment.components(ends_a, ends_b)) == {n}
    same = np.arange(1, 50)
    assert list(alignment.components(same, same)) == [*range(49), *range(49)]


def test_empty_and_clashing(spark):
    assert alignment.align_corpus(documents(spark, [])).count() == 0
    rows = [(1, "a clash"), (2, None)]
    plain = sorted(map(tuple, alignment.align_corpus(documents(spark, rows)).collect()))
    assert sorted(map(tuple, alignment.align_corpus(with_clashing(documents(spark, rows))).collect())) == plain
