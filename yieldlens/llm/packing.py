"""Packing documents into sequences: shortest-pack-first over the histogram of piece lengths."""

from __future__ import annotations

import base64
import heapq
import json
import re
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from yieldlens.llm.common import encode_ordinary, stored, in_arrow, partitions, spread

CAPACITY = 2048
END_ID = 1
#: The vocabulary of byte_bpe_50k.json as ranks: the same ids, encoded several times faster.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Its added tokens, which the rank file doesn't hold, are read from here.
DEFINITION = "byte_bpe_50k.json"


class Slots:
    """Places for all pieces of a histogram ``{length: count}``, found shortest pack first.

    Packs with equal contents (a packing pattern) are one range of numbers. Lengths are placed
    longest first; each goes to the shortest packs, those with the most room, and a new pattern
    is opened when the piece fits none. ``rows`` has, for each length, runs of ranks:
    (length, first rank, how many, first pack, offset in the pack).
    """

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.packs = 0
        room: list[tuple[int, int, int]] = []  # heap of (-room, first pack, packs)
        for length in sorted(histogram, reverse=True):
            rank, left = 0, histogram[length]
            while left:
                if room and -room[0][0] >= length:
                    space, first, packs = heapq.heappop(room)
                    space, taken = -space, min(left, packs)
                    if taken < packs:
                        heapq.heappush(room, (-space, first + taken, packs - taken))
                else:
                    space, first, taken = capacity, self.packs, left
                    self.packs += taken
                self.rows.append((length, rank, taken, first, capacity - space))
                if space > length:
                    heapq.heappush(room, (length - space, first, taken))
                rank, left = rank + taken, left - taken


_ENCODINGS: dict[tuple, tiktoken.Encoding] = {}


def added_tokens(path: str) -> dict[str, int]:
    """Strings that are one token wherever a text holds them, and their ids."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    odd = [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if odd:
        raise ValueError(f"added tokens {odd} aren't plain strings")
    return {t["content"]: t["id"] for t in added}


def encoding(path: str, pattern: str, added: dict[str, int]) -> tiktoken.Encoding:
    key = (path, pattern, *sorted(added.items()))
    if key not in _ENCODINGS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        _ENCODINGS[key] = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    return _ENCODINGS[key]


def _ids(encoder: tiktoken.Encoding, added: dict[str, int], text: str) -> np.ndarray:
    """Ids of a text with blank runs of any length; an added token has its own id wherever the text holds it."""
    if not any(token in text for token in added):
        return encode_ordinary(encoder, text)
    longest_first = "|".join(map(re.escape, sorted(added, key=len, reverse=True)))
    parts = re.split(f"({longest_first})", text)
    return np.concatenate([[added[p]] if i % 2 else encode_ordinary(encoder, p) for i, p in enumerate(parts)])


def pieces_of(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    path: str | None = None, pattern: str | None = None, added: dict[str, int] | None = None,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, copy``: each document's ids, closed by id 1, cut at every ``capacity``.

    ``copy`` tells rows with equal ids apart. ``added`` are the strings with an id of their own, those of
    ``DEFINITION`` by default (none for another ``path``).
    """
    if added is None:
        added = {} if path else added_tokens(public_tokenizers.path(DEFINITION))
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN

    def run(batch: pa.RecordBatch):
        encode = partial(_ids, encoding(path, pattern, added), added)
        out: list[tuple[int, int, int, int, int]] = []
        for i, t in enumerate(batch.column(1)):
            ids = np.array([*encode(t.as_py() or ""), END_ID], dtype="<u4")
            for start in range(0, len(ids), capacity):
                part = ids[start : start + capacity]
                out.append((i, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
        table = np.array(out, dtype=np.int64).reshape(-1, 5)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(table[:, 0])), *(pa.array(table[:, j]) for j in range(1, 5))],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
        )

    read = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return in_arrow(read, run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    path: str | None = None, pattern: str | None = None, added: dict[str, int] | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document's ids (null text: none) are those of the tokenizers library on ``DEFINITION`` without special tokens
    around a text; a text that holds an added token has its id. They end with id 1. They are cut at each ``capacity`` ids, so a
    document has full pieces, which are sequences of their own, and one shorter rest. The rests'
    histogram, at most ``capacity - 1`` numbers, is packed on the driver; its runs of ranks
    are broadcast and give each rest a sequence and an offset by its rank among the rests of
    its length. Ranks are counted in even shares of the rows, so a length that a third of all
    documents have is no one task's work.

    Null ids and repeated rows are documents of their own; empty texts are the single id 1;
    other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    shares = partitions(spark)
    # written once: the deal into shares must be the same in both uses
    cut = stored(
        pieces_of(docs, id_column, text, capacity, path, pattern, added).withColumn("share", spread(shares))
    )
    counts = cut.groupBy("length", "share").agg(F.count("*").alias("n"))
    # ranks of a share's rows of a length follow those of the shares before it; the table of
    # counts has capacity x shares rows at most, a window over one length has one row a share
    before = counts.withColumn(
        "before", F.sum("n").over(Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1))
    ).select("length", "share", F.coalesce("before", F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = np.array(Slots(histogram, capacity).rows, dtype=np.int64).reshape(-1, 5)
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    most = 1 + max((histogram[k] for k in histogram), default=0)
    keys, first_rank, first_pack, offset = slots[:, 0] * most + slots[:, 1], slots[:, 1], slots[:, 3], slots[:, 4]
    broadcast = spark.sparkContext.broadcast((keys, first_rank, first_pack, offset))

    def place(batch: pa.RecordBatch):
        keys, first_rank, first_pack, offset = broadcast.value
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        at = np.searchsorted(keys, length * most + rank, side="right") - 1
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array(first_pack[at] + rank - first_rank[at]), pa.array(offset[at])],
            names=[*names, "sequence_id", "offset"],
        )

    own = Window.partitionBy("length", "share").orderBy("doc_id", "start")
    ranked = (
        cut.withColumn("own", F.row_number().over(own) - 1)
        .join(before, ["length", "share"])
        .withColumn("rank", (F.col("before") + F.col("own")).cast("long"))
    )
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    return in_arrow(ranked, place, schema).withColumnRenamed("doc_id", id_column)
