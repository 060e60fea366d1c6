import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, with_clashing
from tokenizers import Tokenizer

from yieldlens.llm.packing import Slots, pack


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_slots_hold_each_rank_once():
    rng = np.random.default_rng(4)
    for lengths in (rng.integers(1, 65, 900), np.full(100, 33), np.full(100, 64), np.array([1])):
        histogram = Counter(map(int, lengths))
        slots = Slots(histogram, 64)
        packs = [[] for _ in range(slots.packs)]
        ranks = Counter()
        for length, rank, many, first, offset in slots.rows:
            ranks[length] += many
            for i in range(many):
                packs[first + i].append((offset, length))
        assert ranks == histogram
        for pack_ in packs:
            at = 0
            for offset, length in sorted(pack_):
                assert offset == at
                at += length
            assert 0 < at <= 64


def check(rows, found, tokenizer, capacity=2048):
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for i, t in rows}
    pieces = Counter()
    sequences = {}
    for r in found:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]] += r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    times = Counter(i for i, _ in rows)
    assert pieces == {i: len(own) * times[i] for i, own in ids.items()}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces(spark, tokenizer):
    r = np.random.default_rng(8)
    words = ["the", "re", "ation", "of", "é", "日", "\n", "<|endoftext|>", "x1"]
    rows = [(i, " ".join(r.choice(words, r.integers(0, 300)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "word " * 9000), (203, "same"), (203, "same"), (None, "no id")]
    found = pack(with_clashing(documents(spark, rows))).collect()
    sequences = check(rows, found, tokenizer)
    tokens = sum(x["length"] for x in found)
    assert sequences <= -(-tokens // 2048) + 1


def test_short_capacity_and_hot_length(spark, tokenizer):
    rows = [(i, "a b c") for i in range(300)] + [(1000 + i, "a " * (i % 40)) for i in range(100)]
    found = pack(documents(spark, rows).repartition(7), capacity=16).collect()
    check(rows, found, tokenizer, 16)


def test_empty(spark):
    assert pack(documents(spark, [])).count() == 0


def test_blank_runs_of_any_length(spark):
    (r,) = pack(documents(spark, [(1, "a" + " " * 1_000_000)]), capacity=1 << 21).collect()
    assert r["doc_tokens"] == 1_000_002


def test_added_tokens_have_their_ids(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["end <|endoftext|> next", "<|endoftext|>", "a<|endoftext|><|endoftext|>b", "<|endoftext", " <|endoftext|>\n\n x", "é<|endoftext|>日 <|END|>"]
    blanks = " " * 20000
    texts += [f"a{blanks}<|endoftext|>{blanks}b{blanks}", f"\n{blanks}x"]
    rows = list(enumerate(texts))
    assert 50256 in plain.encode(texts[0], add_special_tokens=False).ids
    check(rows, pack(documents(spark, rows)).collect(), plain)
