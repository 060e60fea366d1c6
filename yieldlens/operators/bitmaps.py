"""Counts of item sets from vertical bitmaps.

A block of rows is one bitmap an item; the rows of a class and a binary place of their weights are further bitmaps.
A set's weighted count in a block is a sum of population counts of intersections. Pairs are counted for all items of a
block, longer sets only for candidates all of whose parts are frequent; candidates of one prefix share its intersection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from yieldlens.operators.level_forest import summed
from yieldlens.session import cut_lineage, importable

CLASSES = ["neg", "pos", "other"]
#: Bytes of a block's bitmaps; bytes of intersections at once; counts a task holds before it sends them on.
BLOCK_BYTES, STEP_BYTES, HELD = 1 << 22, 1 << 24, 1 << 20
#: Candidate sets that travel to a block in one row.
CHUNK = 1 << 14

BLOCK_SCHEMA = "_by string, items binary, bits binary, masks binary, places binary"


def _packed(cells: np.ndarray) -> np.ndarray:
    """Boolean rows as 64-bit words."""
    pad = -cells.shape[1] % 64
    return np.packbits(np.pad(cells, ((0, 0), (0, pad))), axis=1).view(np.uint64)


def _block(by: str, part: pd.DataFrame) -> dict:
    ids = part["ids"].to_list()
    sizes = np.array([len(x) for x in ids])
    items, place = np.unique(np.concatenate(ids), return_inverse=True)
    cells = np.zeros((len(items), len(part)), bool)
    cells[place, np.repeat(np.arange(len(part)), sizes)] = True
    weight, kind = part["_w"].to_numpy(), part["_y"].map(CLASSES.index).to_numpy()
    masks, places = [], []
    for c in range(len(CLASSES)):
        for b in range(int(weight.max()).bit_length()):
            mask = (kind == c) & (weight >> b & 1 == 1)
            if mask.any():
                masks.append(mask)
                places.append((c, b))
    return {
        "_by": by, "items": items.astype(np.int32).tobytes(), "bits": _packed(cells).tobytes(),
        "masks": _packed(np.array(masks)).tobytes(), "places": np.array(places, np.int32).tobytes(),
    }


def blocks(rows: DataFrame) -> DataFrame:
    """``rows`` (_by, _y, _w, ids rising) as bitmaps, in stored blocks; rows without items have no place in them.

    Groups are sorted inside a partition only, so a group of any size stays spread.
    """
    importable(rows.sparkSession)

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame[frame["ids"].map(len) > 0]
            for by, part in frame.groupby("_by", sort=False):
                items = len(np.unique(np.concatenate(part["ids"].to_list())))
                step = max(8 * BLOCK_BYTES // items // 64 * 64, 64)
                yield pd.DataFrame([_block(by, part.iloc[a : a + step]) for a in range(0, len(part), step)])

    return cut_lineage(rows.select("_by", "_y", "_w", "ids").sortWithinPartitions("_by").mapInPandas(build, BLOCK_SCHEMA))


def _unpacked(items, bits, masks, places) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    items = np.frombuffer(items, np.int32)
    bits = np.frombuffer(bits, np.uint64).reshape(len(items), -1)
    return items, bits, np.frombuffer(masks, np.uint64).reshape(-1, bits.shape[1]), np.frombuffer(places, np.int32).reshape(-1, 2)


def _weighed(sets: np.ndarray, masks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """sets x classes: the weight of the rows in each bitmap."""
    out = np.zeros((len(sets), len(CLASSES)))
    for mask, (kind, bit) in zip(masks, places):
        out[:, kind] += np.bitwise_count(sets & mask).sum(axis=1, dtype=np.int64) * float(1 << int(bit))
    return out


def _pairs_of(items, bits, masks, places) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    step = max(STEP_BYTES // bits[0].nbytes, 1)
    for i in range(len(items) - 1):
        for a in range(i + 1, len(items), step):
            n = _weighed(bits[a : a + step] & bits[i], masks, places)
            some = n.any(axis=1)
            yield (np.int64(items[i]) << 32) + items[a : a + step][some], n[some]


def _sets_of(wanted: np.ndarray, items, bits, masks, places) -> np.ndarray:
    """Counts of the sets ``wanted`` (sets x length)."""
    at = np.minimum(np.searchsorted(items, wanted), len(items) - 1)
    held = (items[at] == wanted).all(axis=1)
    out = np.zeros((len(wanted), len(CLASSES)))
    prefix, own = np.unique(at[held, :-1], axis=0, return_inverse=True)
    last, found = at[held, -1], np.flatnonzero(held)
    if not len(found):
        return out
    own = own.reshape(-1)
    order = np.argsort(own, kind="stable")
    step = max(STEP_BYTES // bits[0].nbytes, 1)
    for a in range(0, len(order), step):
        some = order[a : a + step]
        first, end = own[some[0]], own[some[-1]] + 1
        shared = np.bitwise_and.reduce(bits[prefix[first:end]], axis=1)
        out[found[some]] = _weighed(shared[own[some] - first] & bits[last[some]], masks, places)
    return out


def _batch(by: str, ids: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, ids.size + 1, ids.shape[1], dtype=np.int32)), pa.array(ids.reshape(-1).astype(np.int32)))
    counts = [pa.array(n[:, k].astype(np.int64)) for k in range(len(CLASSES))]
    return pa.RecordBatch.from_arrays([pa.array([by] * len(ids), pa.string()), lists, *counts], ["_by", "ids", *CLASSES])


def _added(frame: DataFrame, run) -> DataFrame:
    parts = frame.mapInArrow(run, "_by string, ids array<int>, neg long, pos long, other long")
    sums = parts.groupBy("_by", "ids").agg(*[F.sum(c).alias(c) for c in CLASSES])
    return sums.select("_by", "ids", (F.col("neg") + F.col("pos") + F.col("other")).alias("all"), "neg", "pos")


def count_pairs(stored: DataFrame) -> DataFrame:
    """_by, ids, all, neg, pos of every two items that a row holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def merged(by: str) -> tuple[np.ndarray, np.ndarray]:
            return summed(np.concatenate([k for k, _ in held[by]]), np.concatenate([n for _, n in held[by]]))

        def out() -> Iterator[pa.RecordBatch]:
            for by in held:
                key, n = merged(by)
                if len(key):
                    yield _batch(by, np.stack([key >> 32, key & 0xFFFFFFFF], axis=1), n)

        for batch in batches:
            for by, *block in zip(*[batch.column(c).to_pylist() for c in ("_by", "items", "bits", "masks", "places")]):
                for key, n in _pairs_of(*_unpacked(*block)):
                    held.setdefault(by, []).append((key, n))
                    size += len(key)
                    if size > HELD:
                        for g in held:
                            held[g] = [merged(g)]
                        size = sum(len(parts[0][0]) for parts in held.values())
                        if size > HELD // 2:
                            yield from out()
                            held, size = {}, 0
        yield from out()

    return _added(stored, run)


def candidates(frequent: DataFrame, size: int) -> DataFrame:
    """_by, ids: sets of ``size`` items all of whose subsets of one item less are in ``frequent`` (_by, ids rising)."""
    head = F.slice("ids", 1, size - 2)
    left = frequent.select("_by", head.alias("_head"), F.element_at("ids", -1).alias("_x"))
    right = left.withColumnRenamed("_x", "_z")
    both = left.join(right, ["_by", "_head"]).where("_x < _z").select("_by", F.concat("_head", F.array("_x", "_z")).alias("ids"))
    for drop in range(size - 2):  # the two sets that were joined are the ones without one of the last two
        both = both.withColumn("_part", F.concat(F.slice("ids", 1, drop), F.slice("ids", drop + 2, size)))
        both = both.join(frequent.select("_by", F.col("ids").alias("_part")), ["_by", "_part"], "left_semi").drop("_part")
    return both


def chunks(sets: DataFrame) -> DataFrame:
    """_by, _sets (a flat array), _size in bytes: a group's candidates in rows of about ``CHUNK`` sets."""
    many = sets.groupBy("_by").agg(F.ceil(F.count("*") / CHUNK).alias("_n"))
    dealt = sets.join(many, "_by").withColumn("_chunk", F.pmod(F.xxhash64(F.slice("ids", 1, 2)), "_n"))
    return dealt.groupBy("_by", "_chunk").agg(F.flatten(F.collect_list("ids")).alias("_sets")).select("_by", "_sets", (4 * F.size("_sets") + 64).alias("_size"))


def count_sets(beside: DataFrame, length: int) -> DataFrame:
    """_by, ids, all, neg, pos of the candidates; ``beside``: each block with each chunk of its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            sets = batch.column("_sets")
            for row, (by, *block) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("_by", "items", "bits", "masks", "places")])):
                wanted = sets[row].values.to_numpy(zero_copy_only=False).reshape(-1, length)
                n = _sets_of(wanted, *_unpacked(*block))
                key = (by, wanted.tobytes())
                held[key] = held[key] + n if key in held else n
                if sum(len(v) for v in held.values()) > HELD:
                    yield from out(held)
                    held = {}
        yield from out(held)

    def out(held: dict) -> Iterator[pa.RecordBatch]:
        for (by, sets), n in held.items():
            some = n.any(axis=1)
            if some.any():
                yield _batch(by, np.frombuffer(sets, np.int32).reshape(-1, length)[some], n[some])

    return _added(beside.select("_by", "items", "bits", "masks", "places", "_sets"), run)
