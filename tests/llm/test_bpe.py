import base64
import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from helpers import documents, with_clashing

from yieldlens.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)
ODD = [
    "", " ", "\n", "<|endoftext|> a", "日本語 テスト　 \x1c\x1d ² Ⅷ ½ é́ 👩‍👩‍👧 \n\n x", " " * 300 + "a", "a" * 5000, "ab" * 3000, "=" * 4000,
    "I'll we've IT'S 'quoted' 1234567890", "\t\r\n \x00\x01 ÿ\ufeff",
]


@pytest.fixture(scope="module")
def own():
    return bpe.model(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def test_pieces_like_the_merges(own, library):
    r = random.Random(7)
    tokens = list(own.ranks)
    for _ in range(3000):
        piece = b"".join(r.choices(tokens, k=r.randint(1, 5)))
        assert own.encode_piece(piece) == library._encode_single_piece(piece)
        if len(piece) < 40 and piece not in own.ranks:
            assert own.encode_piece(piece) == own.merged(piece)


def test_texts_like_the_library(own, library):
    for text in ODD:
        ids = struct.unpack(f"<{len(own.encode(text)) // 4}I", own.encode(text))
        assert list(ids) == library.encode_ordinary(text), text[:20]


def test_round_trip(spark, library):
    rows = [(i, t) for i, t in enumerate([*ODD, None])] + [(0, ""), (None, "x")]
    docs = with_clashing(documents(spark, rows))
    found = {}
    for r in bpe.round_trip(docs).collect():
        found.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]))
    assert len(found[0]) == 2 and len(found[None]) == 1
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        data = struct.pack(f"<{len(ids)}I", *ids)
        assert found[i][0] == (len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_encode_then_decode(spark):
    docs = documents(spark, [(i, t) for i, t in enumerate(ODD)])
    back = {r["doc_id"]: bytes(r["data"]).decode() for r in bpe.decode(bpe.encode(docs)).collect()}
    assert back == dict(enumerate(ODD))
    assert bpe.encode(docs.where("doc_id > 99")).count() == 0


def test_memory_of_pieces_does_not_matter(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    small = bpe.ByteBpe(PATH, public_tokenizers.PATTERN)
    text = "one two three four five six seven eight nine ten " * 5
    assert small.encode(text) == struct.pack(f"<{len(library.encode_ordinary(text))}I", *library.encode_ordinary(text))


def test_file_has_base64_tokens():
    with open(PATH, "rb") as lines:
        assert base64.b64decode(next(lines).split()[0])
