"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles, banded, then verified."""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from yieldlens.llm.common import Words, discard, stored, importable, in_arrow, mix64, pieces, text_buffer
from yieldlens.llm.links import components, link, shared_buckets, small

SHINGLE = 5
SIMILARITY = 0.8
SAMPLES = 64
#: A pair of exactly the threshold is missed by all bands, and by the count of agreeing samples, with at most this probability each.
MISSED = 0.0004
PLANES = 4
#: Words are counted in this many hashed places, so the table of document frequencies has a fixed size.
PLACES = 1 << 20
_CHUNK = 1 << 14


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts with words, and in how many of them each hashed word occurs (``PLACES`` counts)."""
    parts = 64
    width = PLACES // parts

    def count(batches):
        total, texts = np.zeros(PLACES, np.int64), 0
        for batch in batches:
            data, at = text_buffer(batch.column(0))
            for first, last in pieces(at, 2 << 20):
                words = Words(data[at[first] : at[last]], at[first : last + 1] - at[first])
                place = (words.hashes() >> np.uint64(44)).astype(np.int64)
                seen = np.unique(words.doc * PLACES + place)
                total += np.bincount(seen % PLACES, minlength=PLACES)
                texts += int((np.diff(words.bounds) > 0).sum())
        rows = [(i, total[i * width : (i + 1) * width]) for i in range(parts)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in rows], pa.int32()),
                pa.array([texts if i == 0 else 0 for i, _ in rows], pa.int64()),
                pa.array([part.astype("<i8").tobytes() for _, part in rows], pa.binary()),
            ],
            names=["part", "texts", "counts"],
        )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for x in table["counts"]:
            total += np.frombuffer(x.as_py(), "<i8")
        texts = int(table["texts"].to_numpy().sum())
        return pa.table({"part": [table["part"][0]], "texts": [texts], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, texts long, counts binary"
    rows = docs.select("text").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
    total = np.zeros(PLACES, np.int64)
    for r in rows:
        total[r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(bytes(r["counts"]), "<i8")
    return sum(r["texts"] for r in rows), total


def inverse_frequencies(texts: int, counts: np.ndarray) -> np.ndarray:
    return (np.log((texts + 1) / (counts + 1)) + 1).astype(np.float32)


class Shingles:
    """Weighted shingles of a run of texts, each once a text: ``doc``, ``hash`` and ``weight``, in text order.

    A shingle is five consecutive words (all words of a shorter text). Its weight is how often the
    text has it times its idf, the mean of its words' idf: nearly all shingles are
    unique, so their own document frequency would only tell apart how often a passage was copied.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, idf: np.ndarray):
        words = Words(data, at)
        sizes = np.diff(words.bounds)
        n = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
        doc = np.repeat(np.arange(len(sizes)), n)
        start = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + words.bounds[:-1][doc]
        length = np.minimum(SHINGLE, sizes[doc])
        hashes = words.hashes()
        own = idf[(hashes >> np.uint64(44)).astype(np.int64)].astype(np.float64)
        code, weight = np.zeros(len(doc), np.uint64), np.zeros(len(doc))
        last = max(len(hashes) - 1, 0)
        with np.errstate(over="ignore"):
            for i in range(SHINGLE):
                inside = i < length
                at_word = np.minimum(start + i, last)
                code = np.where(inside, code * np.uint64(0x9E3779B97F4A7C15) + hashes[at_word] if len(hashes) else code, code)
                weight += np.where(inside, own[at_word] if len(own) else 0.0, 0.0)
        code, weight = mix64(code), (weight / np.maximum(length, 1)).astype(np.float32)
        # equal shingles of a text become one, with the sum of their weights
        order = np.lexsort((code, doc))
        new = np.ones(len(order), bool)
        new[1:] = (code[order][1:] != code[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        firsts = np.flatnonzero(new)
        times = np.diff(np.append(firsts, len(order))).astype(np.float32)
        picked = order[firsts]
        self.doc, self.hash, self.weight = doc[picked], code[picked], weight[picked] * times
        self.bounds = np.searchsorted(self.doc, np.arange(len(sizes) + 1))


class WeightedSampler:
    """Improved consistent weighted sampling: equal samples with a probability that is the weighted Jaccard similarity.

    For each shingle and sample it needs r and c, both Gamma(2, 1), and a uniform beta, which depend on the
    shingle alone. A Gamma(2, 1) variable is a sum of two exponential ones; each is looked up with
    another 12 bits of the shingle's hash, as in tabulation hashing, and beta is a sum modulo 1.
    """

    def __init__(self, samples: int, seed: int = 29, bits: int = 12):
        rng = np.random.Generator(np.random.PCG64(seed))
        shape = (2, samples, 1 << bits)
        self.bits, self.samples = bits, samples
        self.r = rng.standard_exponential(shape).astype(np.float32)
        self.c = rng.standard_exponential(shape).astype(np.float32)
        self.beta = rng.random(shape).astype(np.float32)

    def _values(self, hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each sample and shingle: the level t and the logarithm of what is minimised."""
        mask = np.uint64((1 << self.bits) - 1)
        i = (hashes & mask).astype(np.int64)
        j = ((hashes >> np.uint64(self.bits)) & mask).astype(np.int64)
        r = np.take(self.r[0], i, axis=1)
        r += np.take(self.r[1], j, axis=1)
        beta = np.take(self.beta[0], i, axis=1)
        beta += np.take(self.beta[1], j, axis=1)
        beta -= beta >= 1
        c = np.take(self.c[0], i, axis=1)
        c += np.take(self.c[1], j, axis=1)
        np.log(c, out=c)
        t = np.log(weights)[None, :] / r
        t += beta
        np.floor(t, out=t)
        beta -= t
        beta -= 1
        beta *= r
        c += beta
        return t, c

    def sample(self, hashes: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """A 64-bit code of the sampled (shingle, level) for each text and sample; 0 for texts without shingles."""
        out = np.zeros((len(bounds) - 1, self.samples), np.uint64)
        least = np.full((len(bounds) - 1, self.samples), np.inf, np.float32)
        each = np.arange(self.samples)
        for first in range(0, len(hashes), _CHUNK // 4):
            last = min(first + _CHUNK // 4, len(hashes))
            t, value = self._values(hashes[first:last], weights[first:last])
            d = int(np.searchsorted(bounds, first, side="right")) - 1
            while d < len(bounds) - 1 and bounds[d] < last:
                a, b = max(bounds[d], first) - first, min(bounds[d + 1], last) - first
                if b > a:
                    at = value[:, a:b].argmin(axis=1) + a
                    low = value[each, at]
                    better = low < least[d]
                    code = hashes[first + at] ^ (t[each, at].astype(np.int64).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                    out[d] = np.where(better, code, out[d])
                    least[d] = np.minimum(low, least[d])
                d += 1
        return out


def bands_for(threshold: float) -> tuple[int, int]:
    """Bands and the samples in each: the longest bands of 64 samples that miss few pairs of similarity ``threshold``.

    At 0.8 these are 16 bands of 4, which miss a pair with probability 0.0002.
    """
    for rows in (4, 2, 1):
        if (1 - threshold**rows) ** (SAMPLES // rows) <= MISSED:
            return SAMPLES // rows, rows
    raise ValueError(f"{SAMPLES} samples are too few for similarities of {threshold}")


def agreeing_for(threshold: float) -> int:
    """Fewest samples that agree in their kept bits at ``threshold``, but for few pairs; 41 at 0.8, where 52 are expected."""
    p = threshold + (1 - threshold) / 2**PLANES
    below, fewest = 0.0, 0
    while fewest < SAMPLES:
        below += comb(SAMPLES, fewest) * p**fewest * (1 - p) ** (SAMPLES - fewest)
        if below > MISSED:
            break
        fewest += 1
    return fewest


def _band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each text and band."""
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(samples), bands)).copy()
        for i in range(rows):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + samples[:, i::rows][:, :bands])
    return key


def signatures(docs: DataFrame, idf, bands: int, rows: int) -> DataFrame:
    """``id, digest, keys, p0 ...``: a digest of the text, the keys of its bands (none without words), bits of its samples.

    Bit s of ``p0`` is the lowest bit of sample s, and so on.
    """

    def run(batch: pa.RecordBatch):
        sampler = WeightedSampler(SAMPLES)
        data, at = text_buffer(batch.column(1))
        for first, last in pieces(at, 1 << 20):
            own, places = data[at[first] : at[last]], at[first : last + 1] - at[first]
            shingles = Shingles(own, places, idf.value)
            samples = sampler.sample(shingles.hash, shingles.weight, shingles.bounds)
            keys = _band_keys(samples, bands, rows).view(np.int64)
            mixed = mix64(samples)
            planes = [
                np.packbits(((mixed >> np.uint64(p)) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little").view(np.int64).ravel()
                for p in range(PLANES)
            ]
            some = np.diff(shingles.bounds) > 0
            offsets = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
            raw = own.tobytes()
            digests = [hashlib.md5(raw[a:b]).digest() for a, b in zip(places, places[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first), pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[some].ravel())), *map(pa.array, planes),
                ],
                names=["id", "digest", "keys", *(f"p{p}" for p in range(PLANES))],
            )

    bits = ", ".join(f"p{p} long" for p in range(PLANES))
    return in_arrow(docs.select("id", "text"), run, f"id long, digest binary, keys array<long>, {bits}")


def _agree(a: str, b: str, fewest: int) -> Column:
    """Whether enough samples agree in all their kept bits."""
    differ = F.col(f"{a}p0").bitwiseXOR(F.col(f"{b}p0"))
    for p in range(1, PLANES):
        differ = differ.bitwiseOR(F.col(f"{a}p{p}").bitwiseXOR(F.col(f"{b}p{p}")))
    return SAMPLES - F.bit_count(differ) >= fewest


def _similar(idf, threshold: float):
    def run(batch: pa.RecordBatch):
        n = batch.num_rows
        keep = np.zeros(n, bool)
        for first in range(0, n, 128):
            last = min(n, first + 128)
            sides = []
            for c in (2, 3):
                data, at = text_buffer(batch.column(c).slice(first, last - first))
                sides.append(Shingles(data, at, idf.value))
            a, b = sides
            for d in range(last - first):
                x, y = slice(a.bounds[d], a.bounds[d + 1]), slice(b.bounds[d], b.bounds[d + 1])
                total = float(a.weight[x].sum(dtype=np.float64) + b.weight[y].sum(dtype=np.float64))
                _, i, j = np.intersect1d(a.hash[x], b.hash[y], assume_unique=True, return_indices=True)
                both = float(np.minimum(a.weight[x][i], b.weight[y][j]).sum(dtype=np.float64))
                keep[first + d] = total > 0 and both >= threshold * (total - both) * (1 - 1e-6)
        yield batch.select([0, 1]).filter(pa.array(keep))

    return run


def _shingle_rows(idf):
    def run(batch: pa.RecordBatch):
        ids = batch.column("id")
        data, at = text_buffer(batch.column("text"))
        for first, last in pieces(at, 1 << 20):
            own = Shingles(data[at[first] : at[last]], at[first : last + 1] - at[first], idf.value)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(own.doc + first)), pa.array(own.hash.view(np.int64)), pa.array(own.weight.astype(np.float64))],
                names=["id", "feature", "weight"],
            )

    return run


def weighted_prefixes(shingles: DataFrame, threshold: float) -> DataFrame:
    """``id, feature, before, whole``: of ``id, feature, weight`` the first shingles of each id, as many as weigh over ``1 - threshold`` of all.

    All ids have one order, the rarest shingles (among these ids) first. Two ids of weighted Jaccard similarity
    ``threshold`` or more have that share of either's weight in common, so the first shingle they share is among the
    first ones of both: exact, whatever the counts. Shingles that one id alone has count, but are not returned.
    """
    held = stored(shingles.groupBy("id", "feature").agg(F.max("weight").alias("weight")))
    shared = held.groupBy("feature").agg(F.count("*").alias("n")).where("n > 1")
    placed = held.join(shared, "feature", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    before = Window.partitionBy("id").orderBy("n", "feature").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("id")
    reached = placed.withColumn("before", F.coalesce(F.sum("weight").over(before), F.lit(0.0))).withColumn("all", F.sum("weight").over(whole))
    # a little more than the bound, for sums in another order
    return reached.where((F.col("before") <= F.col("all") * (1 - threshold + 1e-5)) & (F.col("n") > 1)).select(
        "id", "feature", "before", F.col("all").alias("whole")
    )


def _within_reach(threshold: float) -> Column:
    """What two ids can have in common from the first shingle they share on is enough for the threshold."""
    left = F.least(F.col("a_whole") - F.col("a_before"), F.col("b_whole") - F.col("b_before"))
    return left >= (F.col("a_whole") + F.col("b_whole")) * (threshold / (1 + threshold) * (1 - 1e-5))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = SIMILARITY
) -> DataFrame:
    """``id, class_id``: for each row the smallest id among the documents its text is linked to (its own if none).

    Two texts are linked if they are equal or their weighted Jaccard similarity over TF-IDF
    shingles is ``threshold`` or more and they share a band of samples; classes are connected
    components. A document stays if its id is its class id.

    Words are ``[^\\x20\\x09-\\x0D]+``. Document frequencies of all words go to a table of fixed size. Each text
    gives 64 weighted samples in bands; pairs of a band are compared if enough samples agree, both by ``threshold``. Of heavily edited groups, which
    no leader settles, only pairs are compared that share one of their rarest shingles and have weight enough from the first of these on (``weighted_prefixes``, exact). Equal texts are one node, their smallest id; texts that share
    a band are linked as in ``links.link``, verified on the texts themselves.

    A null or wordless text is in a class of its own unless ids repeat. Rows with an equal id are one
    node: what links one of their texts links them all. A row with a null id has a null class. Other columns are not
    read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bands, rows = bands_for(threshold)
    fewest = agreeing_for(threshold)
    importable(spark)
    named = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    idf = spark.sparkContext.broadcast(inverse_frequencies(*document_frequencies(named)))
    signed = stored(signatures(named, idf, bands, rows))
    worded = signed.where(F.col("id").isNotNull() & (F.size("keys") > 0))
    copies = stored(
        worded.groupBy("digest").agg(F.min("id").alias("rep"), F.max("id").alias("most")).where("rep <> most").drop("most")
    )
    marked = worded.join(small(copies, copies.count()), "digest", "left")
    member = stored(marked.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct())
    bits = [f"p{p}" for p in range(PLANES)]
    nodes = marked.where("rep IS NULL OR id = rep").select("id", "keys", *bits)
    shared = shared_buckets(nodes.select(F.explode("keys").alias("key"), "id"))
    sought = stored(shared.select("id").distinct())
    sought = small(sought, sought.count())
    texts = stored(named.join(sought, "id"))
    traits = stored(nodes.join(sought, "id").select("id", *bits).distinct())

    def similar(pairs: DataFrame) -> DataFrame:
        first = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")), "a")
        both = first.join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")
        return in_arrow(both, _similar(idf, threshold), "a long, b long").distinct()

    def prefixes(ids: DataFrame) -> DataFrame:
        return weighted_prefixes(in_arrow(texts.join(ids, "id"), _shingle_rows(idf), "id long, feature long, weight double"), threshold)

    # a copy hangs on its text's node
    roots = link(shared, similar, traits, lambda a, b: _agree(a, b, fewest), prefixes, _within_reach(threshold))
    if member.groupBy("a").count().where("count > 1").isEmpty() and member.join(nodes, F.col("a") == F.col("id")).isEmpty():
        onward = roots.select(F.col("id").alias("b"), "root")
        copied = member.join(onward, "b", "left").select(F.col("a").alias("id"), F.coalesce("root", "b").alias("class_"))
        classed = stored(roots.select("id", F.col("root").alias("class_")).union(copied))
    else:  # rows with an equal id and different texts tie classes together
        linked = roots.select(F.col("id").alias("a"), F.col("root").alias("b"))
        classed = components(linked.union(member)).withColumnRenamed("root", "class_")
    discard(texts)
    return (
        named.select("id").join(small(classed, classed.count()), "id", "left")
        .select(F.col("id").alias(id_column), F.coalesce("class_", "id").alias("class_id"))
    )
