"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often two ids meet."""

from __future__ import annotations

import base64
import json
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, Window, functions as F

from yieldlens.llm.common import encode_ordinary, in_arrow, pieces, stored, text_buffer

#: First tokenizer: its definition, and the same vocabulary as a rank file, which a faster library reads.
DEFINITION, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Second tokenizer.
PIECES = "piece_bpe_32k.model"
#: Bytes of text that are aligned at once, and id pairs that are expanded at once.
RUN, EXPAND = 1 << 18, 1 << 18
#: Id pairs that are broadcast, at most.
COMMON = 1 << 18
#: Bits of an id pair's number.
_KEY_BITS = 43

#: Columns of an aligned row: ids and group sizes; its numbers and its groups as text; its id pairs and their links.
TOKENS = {"a": "array<int>", "b": "array<int>", "a_sizes": "array<int>", "b_sizes": "array<int>"}
NUMBERS = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups": "string"}
PAIRS = {"keys": "array<long>", "links": "array<long>"}


class First:
    """The byte-level tokenizer: ids of a text with a blank before it, and each id's bytes."""

    def __init__(self, definition: str, ranks: str, pattern: str):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        with open(definition, encoding="utf-8") as file:
            self.size = 1 + max(max(json.load(file)["model"]["vocab"].values()), max(table.values()))
        self.bytes = [b""] * self.size
        for token, i in table.items():
            self.bytes[i] = token
        self.lengths = np.array([len(t) for t in self.bytes], np.int64)
        self.encoding = tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return encode_ordinary(self.encoding, " " + text)


class Second:
    """The piece tokenizer, which puts a blank before a text itself."""

    def __init__(self, model: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.size = self.model.vocab_size()
        self.bytes = [self._bytes(i) for i in range(self.size)]
        self.lengths = np.array([len(t) for t in self.bytes], np.int64)

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> np.ndarray:
        return np.array(array("i", self.model.encode(text, num_threads=1)), dtype=np.int64)


@cache
def tokenizers(first: str, ranks: str, pattern: str, second: str) -> tuple[First, Second]:
    return First(first, ranks, pattern), Second(second)


def components(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For each token, first all of A and then all of B, the B token that ends its group.

    Tokens are consecutive and cover the same bytes; ``ends`` are the bytes' places where they end. A
    token points to the overlapping token that ends farthest right, one that no other outreaches to itself
    (an A token that ends with a B token to that one). Doubling the steps leads each token to the last of its group.
    """
    n = len(ends_a)
    over_a = n + np.searchsorted(ends_b, ends_a, side="left")
    over_b = np.searchsorted(ends_a, ends_b, side="left")
    level = ends_a[over_b] == ends_b if n else np.zeros(0, bool)
    after = np.concatenate([over_a, np.where(level, n + np.arange(len(ends_b)), over_b)])
    while True:
        further = after[after]
        if np.array_equal(further, after):
            return after - n
        after = further


def _ragged(values: np.ndarray, sizes: np.ndarray, dtype) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(_bounds(sizes).astype(np.int32)), pa.array(values.astype(dtype)))


def _bounds(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _edges(sorted_: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else np.zeros(0, np.int64)


def _encoded(raw: bytes, first: First, second: Second) -> tuple[np.ndarray, np.ndarray] | None:
    """Both tokenizers' ids; None if one of them doesn't give the bytes back. Byte-level ids do for every string."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    a, b = first.encode(text), second.encode(text)
    if first.lengths[a].sum() != len(raw) + 1 or b"".join(map(second.bytes.__getitem__, b.tolist())) != b" " + raw:
        return None
    return a, b


class Aligned:
    """Texts end to end: ids ``a`` and ``b``, how many of each a group has, and how many of all these a text has (``n_...``)."""

    def __init__(self, a, n_a, b, n_b, a_sizes, b_sizes, n_groups):
        self.a, self.n_a, self.b, self.n_b = a, n_a, b, n_b
        self.a_sizes, self.b_sizes, self.n_groups = a_sizes, b_sizes, n_groups
        self.rows = len(n_a)
        total = _bounds(a_sizes * b_sizes)
        self.n_links = np.diff(total[_bounds(n_groups)])

    @classmethod
    def of(cls, texts: list[bytes], first: First, second: Second) -> "Aligned":
        none = np.zeros(0, np.int64)
        ids: tuple[list, list] = ([none], [none])
        for raw in texts:
            both = _encoded(raw, first, second) if raw else None
            for side, x in zip(ids, both or (none, none)):
                side.append(x)
        (a, n_a), (b, n_b) = ((np.concatenate(side), np.array([len(x) for x in side[1:]], np.int64)) for side in ids)
        last = components(np.cumsum(first.lengths[a]), np.cumsum(second.lengths[b]))
        ends = last[len(a) :] == np.arange(len(b))
        group = (np.cumsum(ends) - 1)[last]
        groups = int(ends.sum())
        sizes = [np.bincount(g, minlength=groups) for g in (group[: len(a)], group[len(a) :])]
        # a group's text is that of its last token
        per_text = np.bincount(np.repeat(np.arange(len(texts)), n_b)[ends], minlength=len(texts))
        return cls(a, n_a, b, n_b, *sizes, per_text)

    def group_texts(self, size_a: int, size_b: int) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each text: the ids of each group."""
        words = _number_words(max(size_a, size_b))
        before_a, before_b = _bounds(self.a_sizes), _bounds(self.b_sizes)
        n = len(self.a_sizes)
        # places of words: each number stands there with each of the marks , | ;
        order = np.empty(before_a[-1] + before_b[-1], np.int64)
        order[np.arange(len(self.a)) + np.repeat(before_b[:-1], self.a_sizes)] = self.a * 3
        order[np.arange(len(self.b)) + np.repeat(before_a[1:], self.b_sizes)] = self.b * 3
        order[before_a[1:] + before_b[:-1] - 1] += 1
        order[before_a[1:] + before_b[1:] - 1] += 2
        cuts = _bounds(self.n_a + self.n_b)
        parts = order.tolist()
        return ["".join([words[i] for i in parts[x:y]])[:-1] for x, y in zip(cuts.tolist(), cuts[1:].tolist())]

    def pairs(self, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Texts' numbers, id pairs ``a * width + b`` and their links, once for each text and pair; texts in order.

        Equal ids of a group are counted before they are paired. Texts with many pairs are
        dealt in ranges of ``a``, so no more than about ``EXPAND`` pairs are there at once.
        """
        total = _bounds(self.n_links)
        first = 0
        while first < self.rows:
            last = min(self.rows, max(first + 1, int(np.searchsorted(total, total[first] + EXPAND, side="right")) - 1))
            yield from self._pairs(first, last, width)
            first = last

    def _pairs(self, first: int, last: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        g0, g1 = self.n_groups[:first].sum(), self.n_groups[:last].sum()
        sizes_a, sizes_b = self.a_sizes[g0:g1], self.b_sizes[g0:g1]
        a = self.a[self.n_a[:first].sum() : self.n_a[:last].sum()]
        b = self.b[self.n_b[:first].sum() : self.n_b[:last].sum()]
        doc_of = np.repeat(np.arange(first, last), self.n_groups[first:last])
        group_a, a, times_a = _counted(np.repeat(np.arange(len(sizes_a)), sizes_a), a)
        group_b, b, times_b = _counted(np.repeat(np.arange(len(sizes_b)), sizes_b), b)
        many = np.bincount(group_b, minlength=len(sizes_b))
        start = _bounds(many)
        shares = 1 + int(many[group_a].sum()) // EXPAND
        cuts = np.quantile(a, np.arange(1, shares) / shares).astype(np.int64) if shares > 1 else np.zeros(0, np.int64)
        share = np.searchsorted(cuts, a, side="right")
        for s in range(shares):
            chosen = np.flatnonzero(share == s)
            fan = many[group_a[chosen]]
            left = np.repeat(chosen, fan)
            right = start[group_a[left]] + np.arange(len(left)) - np.repeat(np.cumsum(fan) - fan, fan)
            key = (doc_of[group_a[left]] << _KEY_BITS) + a[left] * width + b[right]
            order = np.argsort(key, kind="stable")
            key, links = key[order], (times_a[left] * times_b[right])[order]
            edge = _edges(key)
            if len(edge):
                yield key[edge] >> _KEY_BITS, key[edge] & ((1 << _KEY_BITS) - 1), np.add.reduceat(links, edge)


def _counted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id) with the times each occurs, by group."""
    key = np.sort((group << 32) + ids)
    edge = _edges(key)
    return key[edge] >> 32, key[edge] & 0xFFFFFFFF, np.diff(np.append(edge, len(key)))


@cache
def _number_words(size: int) -> list[str]:
    return [f"{i}{mark}" for i in range(size) for mark in ",|;"]


def _paths(first: str | None, ranks: str | None, pattern: str | None, second: str | None) -> tuple[str, str, str, str]:
    return (
        first or public_tokenizers.path(DEFINITION), ranks or public_tokenizers.path(RANKS),
        pattern or public_tokenizers.PATTERN, second or public_tokenizers.path(PIECES),
    )


def align(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", columns: dict[str, str] = TOKENS,
    first: str | None = None, ranks: str | None = None, pattern: str | None = None, second: str | None = None,
) -> DataFrame:
    """One row per document: ``id`` and ``columns``, any of TOKENS, NUMBERS and PAIRS.

    Both tokenizers see the whole text with one blank before it and no special tokens. A group ends where
    tokens of both end at the same byte: the first ``a_sizes[0]`` ids of ``a`` and the first ``b_sizes[0]`` ids of ``b`` are
    the first group; ``groups`` writes them ``a1,a2|b1;a3|b2,b3``. Links are the pairs of an A and a B token of one group;
    ``keys`` are the document's different id pairs ``a * size of B + b`` and ``links`` their links. Null and empty texts have no
    tokens, and no more have texts whose bytes one of the tokenizers doesn't give back. Null ids and repeated rows are documents
    of their own; other columns are not read; an empty table gives no rows.
    """
    paths = _paths(first, ranks, pattern, second)

    def values(name: str, rows: Aligned, a: First, b: Second) -> pa.Array:
        if name == "groups":
            return pa.array(rows.group_texts(a.size, b.size), pa.string())
        if name in NUMBERS:
            return pa.array(getattr(rows, name))
        sizes = rows.n_groups if name.endswith("_sizes") else getattr(rows, f"n_{name}")
        return _ragged(getattr(rows, name), sizes, np.int32)

    def run(batch: pa.RecordBatch):
        data, at = text_buffer(batch.column(1))
        a, b = tokenizers(*paths)
        for begin, end in pieces(at, RUN):
            rows = Aligned.of([data[at[i] : at[i + 1]].tobytes() for i in range(begin, end)], a, b)
            made = {c: values(c, rows, a, b) for c in columns if c not in PAIRS}
            if set(columns) & set(PAIRS):
                parts = list(rows.pairs(b.size)) or [(np.zeros(0, np.int64),) * 3]
                doc, key, links = (np.concatenate(x) for x in zip(*parts))
                per_doc = np.bincount(doc, minlength=rows.rows)
                made |= {"keys": _ragged(key, per_doc, np.int64), "links": _ragged(links, per_doc, np.int64)}
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(begin, end - begin), *(made[c] for c in columns)], names=["id", *columns]
            )

    read = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return in_arrow(read, run, ", ".join(["id long", *(f"{c} {t}" for c, t in columns.items())]))


def link_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``key, n, best``: how many rows have each id pair linked, and whether no pair with the same a has more.

    Pairs are counted before they are shuffled. The window over one ``a`` has a row for each id of B at most.
    """
    counts = aligned.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    top = F.max("n").over(Window.partitionBy("a"))
    return counts.withColumn("a", F.expr(f"key div {width}")).select("key", "n", (F.col("n") == top).alias("best"))


def link_scores(aligned: DataFrame, counts: DataFrame, common: int = COMMON) -> DataFrame:
    """``row, n_best, count_sum``: a row's links that are best for their a, and the counts of all its links' pairs.

    ``aligned`` has a column ``row`` that tells its rows apart. A pair that more than one in ``common`` of all (row, pair) are is
    joined by broadcast, as there are fewer than ``common`` of these; no other pair has rows enough to fill a task, so
    the others are shuffled. Rows without links are left out.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    least = total // common
    seen = aligned.select("row", F.explode(F.arrays_zip("keys", "links")).alias("pair")).select(
        "row", F.col("pair.keys").alias("key"), F.col("pair.links").alias("links")
    )
    often = F.broadcast(counts.where(F.col("n") > least))

    def summed(joined: DataFrame) -> DataFrame:
        return joined.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("links")).alias("count_sum")
        )

    parts = summed(seen.join(often, "key"))
    if least:
        rare = seen.join(often, "key", "left_anti").join(counts.where(F.col("n") <= least), "key")
        parts = parts.unionByName(summed(rare)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return parts


def align_corpus(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", groups: Column | None = None, **paths: str
) -> DataFrame:
    """Per document ``n_a, n_b, n_groups, n_links, groups, n_best, count_sum``; see ``align``.

    An id pair counts once for each document that has it linked. A link is best if no other pair with its A id counts
    more. ``groups`` is an expression over that column to return in its place, so that a digest need not carry the text along.
    """
    width = sentencepiece.SentencePieceProcessor(model_file=_paths(None, None, None, paths.get("second"))[3]).vocab_size()
    found = align(docs, id_column, text, {**NUMBERS, **PAIRS}, **paths)
    own = [F.col("id").alias("id_"), *list(NUMBERS)[:-1], F.col("groups") if groups is None else groups]
    aligned = stored(found.select(F.monotonically_increasing_id().alias("row"), *own, *PAIRS))
    counts = stored(link_counts(aligned, width))
    shown = aligned.drop(*PAIRS)
    sums = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return shown.join(link_scores(aligned, counts), "row", "left").select(F.col("id_").alias(id_column), *shown.columns[2:], *sums)
