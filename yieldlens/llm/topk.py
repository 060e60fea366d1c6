"""Exact top-k by inner product over a bit-sliced index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from yieldlens.llm.blocks import against
from yieldlens.llm.common import finite_vectors, stored, vectors_of

SCALE = 1024
WORD = 64


def quantised(df: DataFrame, id_column: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``id, v array<long>, dim``: components ``floor(scale * x)`` of the vectors that take part."""
    whole = finite_vectors(df, id_column, vector)
    return whole.select(
        "id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("v"), F.size("v").alias("dim")
    )


class BitSlices:
    """Bitmaps of the binary digits of each attribute over a block of rows.

    Attribute ``d`` is kept as ``x - low[d]``, which is never negative; ``slices[d]`` has one
    bitmap for each binary digit, the lowest first.
    """

    def __init__(self, x: np.ndarray):
        self.rows = len(x)
        self.words = -(-self.rows // WORD)
        self.low = x.min(axis=0)
        moved = (x - self.low).astype(np.uint64)
        self.slices = []
        for d in range(x.shape[1]):
            digits = max(1, int(moved[:, d].max()).bit_length())
            bits = ((moved[:, d][None, :] >> np.arange(digits, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(np.uint8)
            self.slices.append(self._packed(bits))

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        wide = np.zeros((bits.shape[0], self.words * WORD), dtype=np.uint8)
        wide[:, : self.rows] = bits
        return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)

    def bits(self, bitmap: np.ndarray) -> np.ndarray:
        """Row numbers set in a bitmap."""
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[: self.rows])

    def ones(self) -> np.ndarray:
        return self._packed(np.ones((1, self.rows), dtype=np.uint8))[0]

    def scores(self, q: np.ndarray) -> np.ndarray:
        """Bitmaps of ``sum q[d] * x[d]`` less its least possible value, the highest digit last.

        A slice set times 2**b is the same set b digits higher, so a product is a sum of shifted
        sets for the binary digits of ``|q[d]|``. Where q is negative the complemented slices are
        added (``top - x`` instead of ``x``), which keeps every term non-negative. All terms go
        through carry-save adders: bitmap operations only.
        """
        digits = 1 + int(sum(abs(int(a)) * ((1 << len(s)) - 1) for a, s in zip(q, self.slices))).bit_length()
        total = np.zeros((digits, self.words), dtype=np.uint64)
        carry = np.zeros((digits, self.words), dtype=np.uint64)
        for a, s in zip(q, self.slices):
            a = int(a)
            if not a:
                continue
            term = ~s if a < 0 else s
            left, shift = abs(a), 0
            while left:
                if left & 1:
                    at, end = shift, shift + len(term)
                    # sum and carry sets: total + carry + term, digit by digit
                    t, c = total[at:end], carry[at:end]
                    either = t ^ c
                    over = (t & c) | (either & term)
                    np.bitwise_xor(either, term, out=total[at:end])
                    # a carry set is empty where a digit's carry has moved up
                    above = carry[at + 1 : end + 1]
                    rest = above[-1].copy()
                    carry[at] = 0
                    above[:] = over
                    self._add_at(total, carry, end, rest)
                left >>= 1
                shift += 1
        self._ripple(total, carry)
        return total

    @staticmethod
    def _add_at(total: np.ndarray, carry: np.ndarray, digit: int, bitmap: np.ndarray) -> None:
        """Add one bitmap at a digit whose carry place is taken."""
        while digit < len(total) and bitmap.any():
            over = total[digit] & bitmap
            total[digit] ^= bitmap
            bitmap, digit = over, digit + 1

    @staticmethod
    def _ripple(total: np.ndarray, carry: np.ndarray) -> None:
        over = np.zeros(total.shape[1], dtype=np.uint64)
        for i in range(len(total)):
            t, c = total[i].copy(), carry[i]
            either = t ^ c
            total[i] = either ^ over
            over = (t & c) | (either & over)
        carry[:] = 0

    def top(self, sums: np.ndarray, k: int, allowed: np.ndarray) -> np.ndarray:
        """Rows that can be among the k highest: all surely above the boundary and all on it."""
        surely, maybe = np.zeros_like(allowed), allowed.copy()
        need = k
        for bitmap in sums[::-1]:
            upper = maybe & bitmap
            count = int(np.bitwise_count(upper).sum())
            if count > need:
                maybe = upper
            else:
                surely |= upper
                need -= count
                maybe &= ~bitmap
                if not need:
                    return self.bits(surely)
        return self.bits(surely | maybe)


def _block_top(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if queries.num_rows and rows.num_rows:
            ids = rows["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            x, ids = vectors_of(rows["v"], np.int64)[order], ids[order]
            index = BitSlices(x)
            everything = index.ones()
            asked = zip(queries["row"].to_numpy(), queries["id"].to_numpy(), vectors_of(queries["v"], np.int64))
            for row, q_id, q in asked:
                allowed = everything
                own = np.arange(*np.searchsorted(ids, [q_id, q_id + 1]))
                if len(own):
                    allowed = everything.copy()
                    np.bitwise_and.at(allowed, own // WORD, ~(np.uint64(1) << (own % WORD).astype(np.uint64)))
                rows_in = index.top(index.scores(q), k, allowed)
                score = x[rows_in] @ q  # boundary rows are settled by their exact products
                best = np.lexsort((ids[rows_in], -score))[:k]
                found.append((np.full(len(best), row), np.full(len(best), q_id), ids[rows_in][best], score[best]))
        parts = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, dtype=np.int64)] * 4
        return pa.table(dict(zip(("row", "query_id", "id", "score"), parts)))

    return run


def numbered(queries: DataFrame) -> DataFrame:
    """Queries with a number ``row`` each, so that repeated ones stay apart; stored, as a task that runs again must give it again."""
    return stored(queries.withColumn("row", F.monotonically_increasing_id()))


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query row: highest score first, ties to the smaller id."""
    best = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)


def top_by_product(
    queries: DataFrame, rows: DataFrame, k: int = 10, id_column: str = "vec_id", vector: str = "embedding",
    scale: int = SCALE, chunk: int = 512, block: int = 16384,
) -> DataFrame:
    """``query_id, rank, id, score``: for each query the ``k`` rows of highest integer inner product.

    Components are ``floor(scale * x)`` with x as double. Rows lie in blocks, each a bit-sliced
    index; a query adds the slices of all attributes by bitmap arithmetic, walks the sum's
    slices from the highest down to the rows above and on the boundary of the k highest, and
    settles the boundary by exact products, ties to the smaller id. The blocks' k best are merged.

    Vectors that are null, empty or hold null or non-finite components take no part, neither
    as query nor as row. A row with the query's id is not its candidate. Vectors of different
    lengths are not compared. Repeated rows are rows of their own, and each repeated query gets its k rows. Scores must fit a long.
    Empty tables give an empty result; other columns are not read.
    """
    one = F.lit(0).alias("cell")
    asked = numbered(quantised(queries, id_column, vector, scale).select("*", one))
    there = quantised(rows, id_column, vector, scale).select("*", one)
    schema = "row long, query_id long, id long, score long"
    found = against(asked, there, 1, _block_top(k), schema, ["dim"], chunk, block)
    return ranked(found, k).select("query_id", "rank", F.col("id").alias(id_column), "score")
