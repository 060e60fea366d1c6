"""Byte-level BPE by longest-match backtracking over an Aho-Corasick automaton, and decoding."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, functions as F

from yieldlens.llm.common import in_arrow

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: A worker remembers this many pieces of text and as many from before; results don't depend on it.
REMEMBERED = 1 << 18
#: Pieces longer than this many bytes are encoded each time.
SHORT = 64


class ByteBpe:
    """Encoder and decoder for a rank file (a token in base64 and its rank on each line).

    The bytes of a piece are read as Latin-1, one character a byte, so that the automaton
    works on bytes. A piece is encoded from the left with the longest token; a token is kept
    if it is compatible with the one before it, that is if merging the bytes of both gives
    back just these two. Where nothing fits, the last token is given up for its next
    shorter prefix token, and places from which no encoding goes on are marked. The only
    sequence of which all adjacent tokens are compatible is the one the merges make, and
    each place is left once at most, so the work is linear. Compatibility of two tokens is
    memoised.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.compatible: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.made: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        size = max(self.tokens) + 1
        self.lengths = np.zeros(size, dtype=np.int64)
        for rank, token in self.tokens.items():
            self.lengths[rank] = len(token)
        self.begin = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.flat = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(size)), dtype=np.uint8)

    def merged(self, data: bytes) -> list[int]:
        """The plain definition: merge the adjacent pair of lowest rank, leftmost first, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            options = [(self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(options)
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def last_merge(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        pair = self.halves.get(token, 0)
        if pair == 0:
            data, pair = self.tokens[token], None
            for cut in range(1, len(data)) if self.reachable(token) else ():
                left, right = self.ranks.get(data[:cut]), self.ranks.get(data[cut:])
                if left is not None and right is not None and self.fits(left, right, token):
                    pair = (left, right)
                    break
            self.halves[token] = pair
        return pair

    def reachable(self, token: int) -> bool:
        """Whether the merges of a token's bytes end in the token (else it only stands for a whole piece)."""
        answer = self.made.get(token)
        if answer is None:
            answer = self.made[token] = self.merged(self.tokens[token]) == [token]
        return answer

    def fits(self, left: int, right: int, below: int = 1 << 60) -> bool:
        """Whether the merges of rank under ``below`` of both tokens' bytes leave just the two.

        The merges of either side are undone, the latest first. If the tokens that then meet
        at the border have a merge of lower rank than the one undone last, that merge would
        have come first and crossed the border.
        """
        if not (self.reachable(left) and self.reachable(right)):
            return False
        tokens, rank_of = self.tokens, self.ranks.get
        limit = below
        while True:
            across = rank_of(tokens[left] + tokens[right])
            if across is not None and across < limit:
                return False
            a, b = len(tokens[left]) > 1, len(tokens[right]) > 1
            if a and (left > right or not b):
                # merges of equal rank run from the left: the left side's came before one across
                limit, left = left, self.last_merge(left)[1]
            elif b:
                limit, right = right + 1, self.last_merge(right)[0]
            else:
                return True

    def compatible_pair(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        answer = self.compatible.get(pair)
        if answer is None:
            if len(self.compatible) >= 2 * REMEMBERED:
                self.compatible.clear()
            answer = self.compatible[pair] = self.fits(left, right)
        return answer

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n, fits = len(data), self.compatible_pair
        # tokens that begin at each place, the longest last
        begin: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (rank, length) in self.automaton.iter(data.decode("latin-1")):
            begin[end + 1 - length].append((length, rank))
        out: list[int] = []
        tried: list[int] = []  # of each kept token, which of those at its place it is
        dead = bytearray(n + 1)
        at, which = 0, len(begin[0]) - 1
        while at < n:
            options = begin[at]
            while which >= 0:
                length, rank = options[which]
                if not dead[at + length] and (not out or fits(out[-1], rank)):
                    break
                which -= 1
            if which >= 0:
                out.append(rank)
                tried.append(which)
                at += length
                which = len(begin[at]) - 1 if at < n else -1
            else:
                dead[at] = 1
                if not out:
                    raise ValueError("the vocabulary lacks single bytes")
                at -= len(self.tokens[out.pop()])
                which = tried.pop() - 1
        return out

    def _new(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            encoded = self.encode_piece(piece.encode())
            ids = struct.pack(f"<{len(encoded)}I", *encoded)
        if len(piece) <= SHORT:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; each match of the pattern by itself."""
        known, new = self.known.get, self._new
        return b"".join([known(piece) or new(piece) for piece in self.find(text)])

    def decode(self, ids: np.ndarray, most: int = 1 << 16) -> Iterator[bytes]:
        """Bytes of the ids, in parts."""
        for first in range(0, len(ids), most):
            part = ids[first : first + most]
            lengths = self.lengths[part]
            ends = np.cumsum(lengths)
            at = np.arange(ends[-1]) + np.repeat(self.begin[part] - (ends - lengths), lengths)
            yield self.flat[at].tobytes()


_MODELS: dict[tuple[str, str], ByteBpe] = {}


def model(path: str, pattern: str) -> ByteBpe:
    """The encoder of a file; each worker process builds it once."""
    key = (path, pattern)
    if key not in _MODELS:
        _MODELS[key] = ByteBpe(path, pattern)
    return _MODELS[key]


def encode(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``id, ids binary``: the ids of each text as little-endian unsigned 32-bit integers.

    No special tokens: their strings are ordinary text. A null or empty text has no ids;
    repeated rows each get a row; other columns are not read; an empty table gives no rows.
    Texts are taken one at a time, so a very long one costs memory in proportion to itself only.
    """
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN

    def run(batch: pa.RecordBatch):
        encoder = model(path, pattern)
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            ids = [encoder.encode(t.as_py() or "") for t in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["id", "ids"])

    return in_arrow(_read(docs, id_column, text), run, "id long, ids binary").withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, id_column: str = "doc_id", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``id, data binary``: the bytes of each list of ids; null ids give no bytes."""
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN

    def run(batch: pa.RecordBatch):
        decoder = model(path, pattern)
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            data = [b"".join(decoder.decode(np.frombuffer(x.as_py() or b"", dtype="<u4"))) for x in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(data, pa.binary())], names=["id", "data"])

    renamed = encoded.select(F.col(f"`{id_column}`").alias("id"), "ids")
    return in_arrow(renamed, run, "id long, data binary").withColumnRenamed("id", id_column)


def round_trip(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256``: each text encoded and its ids decoded again, in one pass.

    Digests are lowercase hex, of the ids as little-endian unsigned 32-bit integers and of
    the decoded bytes. Nulls, empty texts and repeated rows as in ``encode``.
    """
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN

    def run(batch: pa.RecordBatch):
        coder = model(path, pattern)
        counts, of_ids, of_bytes = [], [], []
        for t in batch.column(1):
            data = coder.encode(t.as_py() or "")
            counts.append(len(data) // 4)
            of_ids.append(hashlib.sha256(data).hexdigest())
            decoded = hashlib.sha256()
            for part in coder.decode(np.frombuffer(data, dtype="<u4")):
                decoded.update(part)
            of_bytes.append(decoded.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes)],
            names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return in_arrow(_read(docs, id_column, text), run, schema).withColumnRenamed("id", id_column)


def _read(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
