"""Substring deduplication: Rabin-Karp hashes of all word windows, counted across documents."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from yieldlens.llm.common import Words, importable, in_arrow, mix64, partitions, pieces, release, stored, text_buffer

WINDOW = 20
#: Rows of documents for each bucket of window hashes, about.
ROWS_PER_BUCKET = 5_000
_ODD = 0xD1342543DE82EF95
#: Bytes of a window's hash that travel; its highest byte decides the bucket.
_SENT = 7


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """Rabin-Karp hash of each run of ``window`` word hashes, modulo 2**64: prefix sums of powers, one pass."""
    n = len(words)
    if n < window:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        up = np.full(n, _ODD, dtype=np.uint64)
        up[0] = 1
        up = np.multiply.accumulate(up)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words * up, out=total[1:])
        down = np.full(n - window + 1, pow(_ODD, -1, 1 << 64), dtype=np.uint64)
        down[0] = 1
        down = np.multiply.accumulate(down)
        return mix64((total[window:] - total[:-window]) * down)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
    return starts, np.diff(np.append(starts, len(values)))


def _planes(x: np.ndarray) -> bytes:
    """Bytes of unsigned 32-bit numbers, lowest bytes of all first: shuffles compress the high ones away."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


_SENT_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("docs", pa.binary()), ("tags", pa.binary()), ("counts", pa.binary()),
     ("places", pa.binary()), ("hashes", pa.binary())]
)


class _Batch:
    """Windows of a run of texts, in (document id, place) order, ready to be sent to their buckets."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, at: np.ndarray, window: int):
        words = Words(data, at)
        hashes = window_hashes(words.hashes(), window)
        starts = np.flatnonzero(words.doc[: len(hashes)] == words.doc[window - 1 :]) if len(hashes) else np.zeros(0, np.int64)
        self.hashes = hashes[starts]
        self.doc = words.doc[starts]
        self.place = starts - words.bounds[self.doc]
        self.ids = ids
        raw = memoryview(np.ascontiguousarray(data))
        needed = np.unique(self.doc)
        self.tags = np.zeros(len(ids), dtype=np.uint32)
        for d in needed:
            self.tags[d] = zlib.crc32(raw[at[d] : at[d + 1]])

    def repeats(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each hash the earliest window, and all later windows that start elsewhere."""
        order = np.argsort(self.hashes, kind="stable")
        h = self.hashes[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        first = order[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))] if len(h) else order
        later = order[~new]
        of = first[~new]
        # an equal row has the same id and place: its window is the same start, not a later one
        apart = (self.ids[self.doc[later]] != self.ids[self.doc[of]]) | (self.place[later] != self.place[of])
        return np.sort(order[new]), np.sort(later[apart])

    def row(self, bucket: int, own: np.ndarray, hashes: bytes) -> tuple:
        starts, counts = _runs(self.doc[own])
        docs = self.doc[own][starts]
        return (
            bucket, self.ids[docs].astype("<i8").tobytes(), self.tags[docs].astype("<u4").tobytes(), _planes(counts),
            _planes(self.place[own]), hashes,
        )


def _send(window: int, buckets: int):
    def run(batch: pa.RecordBatch):
        ids = batch.column(0).fill_null(-(2**63)).to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        data, at = text_buffer(batch.column(1).take(pa.array(order)))
        for first, last in pieces(at, 2 << 20):
            own = _Batch(ids[first:last], data[at[first] : at[last]], at[first : last + 1] - at[first], window)
            once, later = own.repeats()
            top = (own.hashes[once] >> np.uint64(56)).astype(np.uint32)
            bucket = (top * buckets >> 8) if buckets <= 256 else (own.hashes[once] >> np.uint64(32)) % np.uint64(buckets)
            sent = _SENT if buckets <= 256 else 8
            by = np.argsort(bucket.astype(np.uint32), kind="stable")
            rows = []
            starts, counts = _runs(bucket[by])
            for s, c in zip(starts, counts):
                mine = once[by[s : s + c]]
                low = own.hashes[mine].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :sent]
                rows.append(own.row(int(bucket[by[s]]), mine, low.tobytes()))
            if len(later):
                rows.append(own.row(int(ids[first] % buckets), later, b""))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _SENT_SCHEMA)], schema=_SENT_SCHEMA
                )

    return run


def _meet(buckets: int):
    sent = _SENT if buckets <= 256 else 8

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table[c].to_pylist() for c in ("docs", "tags", "counts", "places", "hashes")}
        ids = np.concatenate([np.frombuffer(x, "<i8") for x in columns["docs"]])
        tags = np.concatenate([np.frombuffer(x, "<u4") for x in columns["tags"]])
        counts = np.concatenate([_from_planes(x) for x in columns["counts"]])
        places = np.concatenate([_from_planes(x) for x in columns["places"]])
        doc = np.repeat(np.arange(len(ids)), counts)
        known = np.concatenate(
            [np.full(len(p) // 4, bool(h)) for p, h in zip(columns["places"], columns["hashes"])]
        )  # without a hash: repeats that their batch had found
        wide = np.zeros((int(known.sum()), 8), np.uint8)
        wide[:, :sent] = np.frombuffer(b"".join(columns["hashes"]), np.uint8).reshape(-1, sent)
        del columns
        hashes, at = wide.view("<u8").ravel(), np.flatnonzero(known)
        order = np.argsort(hashes)
        h = hashes[order]
        same = h[1:] == h[:-1]
        twice = np.zeros(len(h), bool)
        twice[1:] |= same
        twice[:-1] |= same
        order, h = order[twice], h[twice]
        rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
        key = (rank[doc[at[order]]] << 32) | places[at[order]]
        by = np.lexsort((key, h))
        order, h, key = order[by], h[by], key[by]
        starts, lengths = _runs(h)
        later = at[order[key > np.repeat(key[starts], lengths)]]
        marked = np.sort(np.concatenate([later, np.flatnonzero(~known)]))
        # the marks go to their documents' places, a row for each place
        to = (mix64(ids.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)[doc[marked]]
        by = np.argsort(to, kind="stable")
        rows = []
        for start, length in zip(*_runs(to[by])):
            own = marked[by[start : start + length]]
            firsts, counts = _runs(doc[own])
            docs = doc[own][firsts]
            rows.append((
                int(to[by[start]]), ids[docs].astype("<i8").tobytes(), tags[docs].astype("<u4").tobytes(), _planes(counts),
                _planes(places[own]),
            ))
        names = _SENT_SCHEMA.names[:-1]
        return pa.table({n: pa.array([r[i] for r in rows], _SENT_SCHEMA.field(n).type) for i, n in enumerate(names)})

    return run


def _gather(window: int):
    """The marks of documents as word intervals: a row for each document, overlapping windows merged."""

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table[c].to_pylist() for c in ("docs", "tags", "counts", "places")}
        ids = np.concatenate([np.frombuffer(x, "<i8") for x in columns["docs"]])
        tags = np.concatenate([np.frombuffer(x, "<u4") for x in columns["tags"]]).astype(np.int64)
        counts = np.concatenate([_from_planes(x) for x in columns["counts"]])
        places = np.concatenate([_from_planes(x) for x in columns["places"]]).astype(np.int64)
        order = np.lexsort((tags, ids))
        new = np.ones(len(order), bool)
        new[1:] = (ids[order][1:] != ids[order][:-1]) | (tags[order][1:] != tags[order][:-1])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        key = np.sort((np.repeat(number, counts) << 32) | places)
        # a window that starts after the end of the one before it opens an interval
        opens = np.ones(len(key), bool)
        opens[1:] = key[1:] - key[:-1] > window
        firsts = np.flatnonzero(opens)
        lasts = np.append(firsts[1:], len(key)) - 1
        doc, starts = key[firsts] >> 32, (key[firsts] & 0xFFFFFFFF).astype(np.int32)
        ends = ((key[lasts] & 0xFFFFFFFF) + window).astype(np.int32)
        at, _ = _runs(doc)
        offsets = pa.array(np.append(at, len(doc)).astype(np.int32))
        picked = order[new]
        return pa.table(
            {
                "id_": ids[picked], "tag_": tags[picked],
                "starts": pa.ListArray.from_arrays(offsets, pa.array(starts)),
                "ends": pa.ListArray.from_arrays(offsets, pa.array(ends)),
            }
        )

    return run


def repeated_windows(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``id_, tag_, starts, ends``: for each document with repeated windows, the word intervals they cover.

    ``tag_`` is the text's crc32; null ids are the least long.
    """
    spark = docs.sparkSession
    importable(spark)
    buckets = max(partitions(spark), docs.count() // ROWS_PER_BUCKET)
    read = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    sent = in_arrow(
        read, _send(window, buckets), "bucket int, docs binary, tags binary, counts binary, places binary, hashes binary"
    )
    met = sent.groupBy("bucket").applyInArrow(
        _meet(buckets), "bucket int, docs binary, tags binary, counts binary, places binary"
    )
    return met.groupBy("bucket").applyInArrow(_gather(window), "id_ long, tag_ long, starts array<int>, ends array<int>")


def _cut(spaces: bool):
    def run(batch: pa.RecordBatch):
        data, at = text_buffer(batch.column(0))
        n = batch.num_rows
        words_n, removed_n, texts = np.zeros(n, np.int64), np.zeros(n, np.int64), []
        for first, last in pieces(at, 1 << 20):
            own, places = data[at[first] : at[last]], at[first : last + 1] - at[first]
            words = Words(own, places)
            edge = np.zeros(len(words) + 1, np.int64)
            for column, step in ((1, 1), (2, -1)):
                mine = batch.column(column).slice(first, last - first)
                base = np.repeat(words.bounds[:-1], np.diff(mine.offsets.to_numpy()))
                np.add.at(edge, base + mine.flatten().to_numpy(zero_copy_only=False), step)
            gone = np.cumsum(edge[:-1]) > 0
            keep = ~gone
            words_n[first:last] = np.diff(words.bounds)
            removed_n[first:last] = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.bounds])
            # a kept word's bytes and one blank after it, or what stood there
            if spaces:
                ends = np.append(words.starts[1:], len(own))
                ends = np.minimum(ends, places[1:][words.doc]) if len(words) else ends[:0]
            else:
                ends = words.ends
            size = (ends - words.starts)[keep]
            total = size + (0 if spaces else 1)
            out_end = np.cumsum(total)
            out = np.full(int(out_end[-1]) if len(out_end) else 0, 0x20, np.uint8)
            begin = out_end - total
            flat = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            out[np.repeat(begin, size) + flat] = own[np.repeat(words.starts[keep], size) + flat]
            kept_before = np.concatenate([[0], np.cumsum(keep)])[words.bounds]
            ends_at = np.concatenate([[0], out_end])
            raw = out.tobytes()
            for d in range(last - first):
                a, b = ends_at[kept_before[d]], ends_at[kept_before[d + 1]]
                if spaces and removed_n[first + d] == 0:
                    texts.append(own[places[d] : places[d + 1]].tobytes())
                else:
                    texts.append(raw[a : b - (0 if spaces or b == a else 1)])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[3:], pa.array(words_n), pa.array(removed_n), pa.array(texts, pa.binary()).cast(pa.string())],
            names=[*batch.schema.names[3:], "n_words", "n_removed", "kept"],
        )

    return run


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, spaces: bool = False
) -> DataFrame:
    """All rows of ``docs`` (the id column and, with ``spaces``, all others) with ``n_words, n_removed, kept``.

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if it is covered by a window of ``window``
    words of its document whose words also start earlier, that is in a document of
    smaller id or earlier in the same document; windows are judged on the input. ``kept`` has the
    words that stay, joined by one space; with ``spaces`` it has what followed each
    word in the text, and an untouched text as it was.

    Every window's hash is formed in one pass. A batch of texts sends the earliest window
    of each hash to the hash's bucket and knows by itself that later ones are repeats, so a
    frequent passage comes once a batch. A bucket marks all but the earliest; the marks of a
    document meet and merge into maximal intervals, which are joined to its text.

    A null text has no words; texts under ``window`` words stay whole. Rows with an equal id
    are one document for the order and are cut each by its own text; a null id is the
    smallest. With ``spaces``, columns named ``n_words, n_removed, kept`` are replaced. An empty table gives no rows.
    """
    # the windows' shuffle files go before the texts are shuffled
    marks = stored(repeated_windows(docs, id_column, text, window)).withColumnsRenamed({"starts": "starts_", "ends": "ends_"})
    release(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept")] if spaces else [id_column]
    named = docs.select(
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text_"),
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(-(2**63))).alias("id_"),
        *[F.col(f"`{c}`").alias(f"c{i}_") for i, c in enumerate(others)],
    ).withColumn("tag_", F.crc32("text_"))
    joined = named.join(marks.hint("merge"), ["id_", "tag_"], "left").select(
        "text_", *[F.coalesce(c, F.array().cast("array<int>")).alias(c) for c in ("starts_", "ends_")],
        *[f"c{i}_" for i in range(len(others))],
    )
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"c{i}_ {kinds[c]}" for i, c in enumerate(others)), "n_words long, n_removed long, kept string"])
    cut = in_arrow(joined, _cut(spaces), schema)
    return cut.select(*[F.col(f"c{i}_").alias(c) for i, c in enumerate(others)], "n_words", "n_removed", "kept")
