"""Helpers the operators of this folder share: text blocks as numpy arrays, blocked comparisons, settings."""

from __future__ import annotations

import gc
import os
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from yieldlens.session import cut_lineage, discard, stored  # noqa: F401  (re-exported for this folder)

#: Bytes that end a word: blank, and tab to carriage return.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
HELD_OUT_PARTS = 3
HELD_OUT_PART = 1


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column | str) -> Column:
    """True for the rows no model may learn from: crc32 of the id's digits, modulo 3, is 1."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % HELD_OUT_PARTS == HELD_OUT_PART, F.lit(False))


def spread(parts: int, seed: int = 7) -> Column:
    """A part number for each row that no value of the row decides, so equal rows go apart.

    The numbers depend on the row's place in its partition only, so a task that runs
    again gives them again.
    """
    return F.floor(F.rand(seed) * parts).cast("int")


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, for ``n`` places at least."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", inverse)):
                row = np.full(size, base, dtype=np.uint64)
                row[0] = 1
                _POWERS[name] = np.multiply.accumulate(row)
    return _POWERS["up"], _POWERS["down"]


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range ``data[start:end]``; equal bytes give equal hashes."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
        return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow column end to end, and the n + 1 places where texts begin and end; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if len(column) else pa.array([], pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return bytes_[at[0] : at[-1]], at - at[0]


def pieces(at: np.ndarray, most: int = 1 << 20, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Cut texts into runs ``(first, last + 1)`` of about ``most`` bytes and at most ``rows`` texts; a longer text stands alone."""
    first, n = 0, len(at) - 1
    while first < n:
        last = int(np.searchsorted(at, at[first] + most, side="right")) - 1
        last = min(n, max(first + 1, last), first + rows)
        yield first, last
        first = last


#: Blank runs of this length are encoded as the one piece they are: the library's own search runs out of stack on very long ones.
LONG_BLANKS = 1 << 14
_LONG_BLANKS = regex.compile(rf"(?<!\p{{White_Space}})\p{{White_Space}}{{{LONG_BLANKS},}}+")


def encode_ordinary(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a text without special tokens, blank runs of any length included.

    Holds for patterns that, as PATTERN does, take a run of blanks but for the last one, if something follows, as one match.
    """
    def plain(part: str) -> np.ndarray:
        return np.array(array("i", encoding.encode_ordinary(part)), dtype=np.int64)

    if len(text) < LONG_BLANKS:
        return plain(text)
    out, at = [], 0
    for run in _LONG_BLANKS.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += [plain(text[at : run.start()]), np.array(encoding._encode_single_piece(text[run.start() : end]), np.int64)]
        at = end
    return np.concatenate([*out, plain(text[at:])])


class Words:
    """Words of a run of texts: byte ranges ``starts``, ``ends`` and the number of each word's text, ``doc``.

    Words are ``[^\\x20\\x09-\\x0D]+`` and never reach over the end of a text. ``bounds``
    has the n + 1 places where texts begin and end in the list of words.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at = data, at
        inside = np.zeros(len(data) + 2, dtype=np.int8)
        inside[1:-1] = ~_IS_SPACE[data]
        edge = np.diff(inside)
        starts = np.flatnonzero(edge == 1)
        ends = np.flatnonzero(edge == -1)
        # a text that ends in a word touches the next one: cut there
        cuts = at[1:-1]
        cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
        cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
        if len(cuts):
            starts = np.sort(np.concatenate([starts, cuts]))
            ends = np.sort(np.concatenate([ends, cuts]))
        self.starts, self.ends = starts, ends
        self.bounds = np.searchsorted(starts, at, side="left")
        self.bounds[-1] = len(starts)
        self.doc = np.repeat(np.arange(len(at) - 1), np.diff(self.bounds))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        return hash_ranges(self.data, self.starts, self.ends)


def vectors_of(column: pa.Array, dtype) -> np.ndarray:
    """A list column whose rows all have the same length, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(n, len(flat) // n if n else 0)


def finite_vectors(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``id long, v array<double>``, without vectors that are null, empty or hold null or non-finite components."""
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(f"`{id_column}`").cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & (F.size("v") > 0) & ~F.coalesce(bad, F.lit(True))
    )


def release(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs deleted.

    Spark deletes them when the driver's JVM collects what planned these jobs. A driver with room to spare
    does so seldom, and until then the files of all jobs lie on the executors' disks together.
    """
    gc.collect()  # Python's handles on the plans
    spark._jvm.System.gc()


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it; a cluster has it installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, environment.get("PYTHONPATH")]))


def in_arrow(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with a function from one record batch to record batches or nothing."""

    def run(batches):
        for batch in batches:
            yield from function(batch)

    importable(df.sparkSession)
    return df.mapInArrow(run, schema)
