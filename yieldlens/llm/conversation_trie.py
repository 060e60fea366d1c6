"""The trie of all conversations' openings, from vertical bitmaps of shards of conversations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from yieldlens.llm.common import importable, stored
from yieldlens.operators.ordered import with_ordinal

#: A shard's conversations and turns, at most.
SHARD_CONVS, SHARD_TURNS = 2048, 1 << 16
#: Conversations of more turns are cut into parts of this many; each part is a shard of its own.
PART = 4096
#: Ids of an end list that are handed on in one row.
LISTED = 256

#: A node of a shard: its place and its parent's in the shard's list, depth, key, members, smallest one, bytes of its last
#: text, whether it has children, and the members that end there.
SHARD_NODES = (
    "shard long, part int, node int, parent int, depth long, k1 long, k2 long, n long, least long, bytes long, "
    "inner boolean, ends array<long>"
)


def numbered_turns(
    conversations: DataFrame, id_column: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv, place, turn_id, bytes``: each turn's place from 1, a digest of role and text, and the text's UTF-8 bytes.

    Turns are in the order of ``turn``, null first; equal ones in that of their digest. Null roles and texts are empty; repeated rows are
    turns of their own; rows without a conversation id take no part. A conversation with very many turns is sorted by many tasks.
    """
    def cell(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))

    rows = conversations.select(
        F.col(f"`{id_column}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(cell(role)).cast("string"), F.lit(":"), cell(role), cell(text)))).alias("turn_id"),
        F.octet_length(cell(text)).cast("long").alias("bytes"),
    ).where("conv IS NOT NULL")
    placed = with_ordinal(rows, ["conv"], [F.col("turn").asc_nulls_first(), F.col("turn_id"), F.col("bytes")], "ordinal")
    return placed.select("conv", (F.col("ordinal") + 1).alias("place"), "turn_id", "bytes")


def share_openings(turns: DataFrame, group: int = 5, longest: int = 9) -> DataFrame:
    """Numbered turns of conversations that begin alike: each takes its first turns from the first of its ``group``.

    Of a conversation c, h = crc32(c) modulo ``longest`` turns come from conversation c - c % group, then its own after the first
    h. A row of ``place`` 0 stands for each conversation, so that those without turns are not lost.
    """
    turns = stored(turns)
    own = turns.groupBy("conv").agg(F.max("place").alias("own_turns"))
    known = own.select(
        "conv", "own_turns", (F.col("conv") - F.col("conv") % group).alias("first_conv"),
        (F.crc32(F.col("conv").cast("string")) % longest).alias("taken"),
    )
    lengths = own.select(F.col("conv").alias("first_conv"), F.col("own_turns").alias("first_turns"))
    plan = stored(
        known.join(lengths, "first_conv", "left")
        .withColumn("shared", F.least("taken", F.coalesce("first_turns", F.lit(0))))
        # rows of a conversation meet its plan part by part, however many they are
        .withColumn("parts", F.sequence(F.lit(0).cast("long"), F.expr(f"own_turns div {PART}")))
    )
    opening = turns.where(F.col("place") < longest).withColumnRenamed("conv", "first_conv")
    taken = plan.where("shared > 0").select("first_conv", "conv", "shared").join(opening, "first_conv").where("place <= shared")
    spread_plan = plan.select("conv", "taken", "shared", F.explode("parts").alias("part"))
    rest = turns.withColumn("part", F.expr(f"place div {PART}")).join(spread_plan, ["conv", "part"]).where("place > taken")
    columns = ["conv", "place", "turn_id", "bytes"]
    moved = rest.withColumn("place", F.col("place") - F.col("taken") + F.col("shared"))
    none = plan.select("conv", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("turn_id"), F.lit(0).cast("long").alias("bytes"))
    return taken.select(*columns).unionByName(moved.select(*columns)).unionByName(none)


def _bits(members: int) -> Iterator[int]:
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


class Shard:
    """Bitmaps of some conversations: which of them have a turn at a place, and which end there.

    ``convs`` ascend; conversation i has the turns ``first[i]`` to ``first[i + 1] - 1`` of ``turn`` (numbers that are equal
    for equal turns at equal places). The trie is made depth first from the bitmap of all: a node's children are its
    members' bitmap cut with that of the next turn of its smallest member left, and so on.
    """

    def __init__(self, convs: np.ndarray, first: np.ndarray, turn: np.ndarray):
        self.convs, self.first, self.turn = convs, first.tolist(), turn.tolist()
        self.lengths = np.diff(first).tolist()
        self.postings: dict[int, int] = {}
        self.ending: dict[int, int] = {}
        for i, length in enumerate(self.lengths):
            bit = 1 << i
            self.ending[length] = self.ending.get(length, 0) | bit
            for t in self.turn[self.first[i] : self.first[i + 1]]:
                self.postings[t] = self.postings.get(t, 0) | bit

    def nodes(self) -> Iterator[tuple[int, int, int, int, list[int]]]:
        """``(parent, depth, members, smallest, ends)`` of each node, parents and smaller members first; a shard has its root at least."""
        stack, made = [((1 << len(self.lengths)) - 1, 0, -1)], 0
        while stack:
            members, depth, parent = stack.pop()
            smallest = (members & -members).bit_length() - 1
            ends = members & self.ending.get(depth, 0)
            yield parent, depth, members.bit_count(), smallest, list(_bits(ends))
            children, rest = [], members ^ ends
            while rest:
                m = (rest & -rest).bit_length() - 1
                child = rest & self.postings[self.turn[self.first[m] + depth]]
                rest ^= child
                children.append((child, depth + 1, made))
            stack.extend(reversed(children))
            made += 1


def _numbers(z1: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """Equal numbers for rows that are equal in both."""
    order = np.lexsort((z2, z1))
    a, b = z1[order], z2[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
    out = np.empty(len(z1), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _shard_nodes(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """The nodes of consecutive rows ``conv, part, place, z1, z2, bytes, total`` in order.

    All rows are of part -1, whole conversations, or of one part of one conversation. A row of ``total`` places up
    that has no turn (``head``) brings the key of the turns before its part, or nothing.
    """
    head, conv, part = rows["head"], rows["conv"], int(rows["part"][0])
    turns = ~head
    convs, where = np.unique(conv, return_inverse=True)
    first = np.concatenate([[0], np.cumsum(np.bincount(where[turns], minlength=len(convs)))])
    z1, z2, bytes_ = (rows[c][turns] for c in ("z1", "z2", "bytes"))
    heads = np.flatnonzero(head)
    before = int(rows["place"][heads[0]]) if part > 0 else 0
    start1, start2 = (int(rows[c][heads[0]]) if part > 0 else 0 for c in ("z1", "z2"))
    parent, depth, n, smallest, ends = zip(*Shard(convs, first, _numbers(z1, z2)).nodes())
    parent, depth, n, smallest = (np.array(x, np.int64) for x in (parent, depth, n, smallest))
    # keys of prefixes: all turns' numbers up to there, combined by exclusive or
    keys = []
    for z, start in ((z1, start1), (z2, start2)):
        run = np.concatenate([[0], np.bitwise_xor.accumulate(z)]) if len(z) else np.zeros(1, np.int64)
        keys.append(run[first[smallest] + depth] ^ run[first[smallest]] ^ np.int64(start))
    last = bytes_[first[smallest] + depth - 1] if len(bytes_) else np.zeros(len(depth), np.int64)
    inner = np.zeros(len(parent), bool)
    inner[parent[parent >= 0]] = True
    real = np.ones(len(parent), bool)
    if part >= 0:
        # the node that a later part starts at is counted in the part before; who stops here goes on in the next part
        real[0] = part == 0
        stays = before + first[-1] < rows["total"][0]
    done = [[] if part >= 0 and stays else convs[e].tolist() for e in ends]
    size = len(parent)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(size, convs[0])), pa.array(np.full(size, part, np.int32)), pa.array(np.arange(size, dtype=np.int32)),
            pa.array(parent.astype(np.int32)), pa.array(depth + before), pa.array(keys[0]), pa.array(keys[1]),
            pa.array(np.where(real, n, 0)), pa.array(convs[smallest]), pa.array(np.where(real & (depth > 0), last, 0)),
            pa.array(inner), pa.array(done, pa.list_(pa.int64())),
        ],
        names=[field.split()[0] for field in SHARD_NODES.split(", ")],
    )


_ROWS = ("conv", "part", "place", "z1", "z2", "bytes", "total", "head")


def _cut_into_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive conversations of a sorted partition go into a shard until it is full."""
    held: list[dict[str, np.ndarray]] = []
    convs = turns = 0

    def flush() -> pa.RecordBatch:
        return _shard_nodes({c: np.concatenate([h[c] for h in held]) for c in _ROWS})

    for batch in batches:
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in _ROWS}
        if not batch.num_rows:
            continue
        change = (rows["conv"][1:] != rows["conv"][:-1]) | (rows["part"][1:] != rows["part"][:-1])
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        begin = 0
        for a, b in zip(cuts, cuts[1:]):
            conv, part = rows["conv"][a], rows["part"][a]
            earlier = {c: rows[c][begin:a] for c in _ROWS} if a > begin else (held[-1] if held else None)
            same = earlier is not None and earlier["conv"][-1] == conv and earlier["part"][-1] == part
            # a part is a shard of its own
            alone = earlier is not None and not same and (part >= 0 or earlier["part"][-1] >= 0)
            full = not same and (convs >= SHARD_CONVS or turns + (b - a) > SHARD_TURNS)
            if earlier is not None and (alone or full):
                if a > begin:
                    held.append({c: rows[c][begin:a] for c in _ROWS})
                yield flush()
                held, begin, convs, turns = [], a, 0, 0
            convs += not same
            turns += b - a
        if batch.num_rows > begin:
            held.append({c: rows[c][begin:] for c in _ROWS})
    if held:
        yield flush()


def _subtree_sums(table: pa.Table) -> pa.Table:
    """A shard's nodes with what their own subtrees in the shard hold: leaves, saved bytes, children."""
    table = table.sort_by("node")
    parent, depth = (table.column(c).to_numpy() for c in ("parent", "depth"))
    owner = table.column("owner").to_numpy(zero_copy_only=False)
    sums = [table.column(c).to_numpy().copy() for c in ("leaf", "saved")]
    child = np.zeros(len(parent), np.int64)
    own = np.flatnonzero(owner & (parent >= 0))
    np.add.at(child, parent[own], 1)
    # from the deepest nodes upwards, a depth at a time
    order = np.argsort(depth, kind="stable")
    edges = np.searchsorted(depth[order], np.arange(depth.min() + 1, depth.max() + 2))
    for low, high in zip(edges[-2::-1], edges[::-1]):
        level = order[low:high]
        for s in sums:
            np.add.at(s, parent[level], s[level])
    if table.column("part")[0].as_py() > 0:
        for s in sums:  # the first node is the last one of the part before, which has these sums too
            s[0] = 0
    least = table.column("least_all").to_numpy()
    parent_least = pa.array(np.where(parent >= 0, least[np.maximum(parent, 0)], 0), mask=parent < 0)
    return pa.table([
        table.column("k1"), table.column("k2"), table.column("depth"), table.column("n_all"), table.column("least_all"), parent_least,
        pa.array(sums[0]), pa.array(sums[1]), pa.array(child),
    ], names=["k1", "k2", "depth", "n_convs", "least", "parent_least", "n_leaves", "saved", "n_children"])


_SUMS = (
    "k1 long, k2 long, depth long, n_convs long, least long, parent_least long, n_leaves long, saved long, n_children long"
)


def shard_nodes(turns: DataFrame) -> DataFrame:
    """Nodes of the tries of all shards of ``conv, place, turn_id, bytes`` (place 0: the conversation, no turn); stored."""
    importable(turns.sparkSession)
    rows = stored(
        turns.withColumn("head", F.col("place") == 0)
        .withColumn("z1", F.when(F.col("place") == 0, 0).otherwise(F.xxhash64(F.lit(1), "place", "turn_id")))
        .withColumn("z2", F.when(F.col("place") == 0, 0).otherwise(F.xxhash64(F.lit(2), "place", "turn_id")))
        .withColumn("part", F.expr(f"greatest(place - 1, 0) div {PART}").cast("int"))
        .select("conv", "part", "place", "z1", "z2", "bytes", "head")
    )
    later = rows.where("part > 0").groupBy("conv").agg(F.max("place").alias("total"))
    if not later.isEmpty():
        rows = _with_heads(rows, stored(later))
    else:
        rows = rows.withColumn("part", F.lit(-1)).withColumn("total", F.lit(0).cast("long"))
    placed = rows.select(*_ROWS).repartitionByRange("conv", "part").sortWithinPartitions("conv", "part", "place", F.desc("head"))
    return stored(placed.mapInArrow(_cut_into_shards, SHARD_NODES))


def _with_heads(rows: DataFrame, long: DataFrame) -> DataFrame:
    """Parts of long conversations get a first row with the key of all turns before them; the others are whole (part -1).

    There is one row per ``PART`` turns at most in each table that is joined here.
    """
    parts = long.select("conv", "total", F.explode(F.sequence(F.lit(0), F.expr(f"((total - 1) div {PART})").cast("int"))).alias("part"))
    joined = rows.join(parts, ["conv", "part"], "left")
    whole = joined.where("total IS NULL").withColumn("part", F.lit(-1)).withColumn("total", F.lit(0).cast("long"))
    cut = stored(joined.where("total IS NOT NULL AND NOT head"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    keys = cut.groupBy("conv", "part").agg(F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"), F.max("total").alias("total"))
    heads = keys.select(
        "conv", "part", (F.col("part") * PART).cast("long").alias("place"),
        *[F.coalesce(F.bit_xor(z).over(earlier), F.lit(0)).alias(z) for z in ("z1", "z2")],
        F.lit(0).cast("long").alias("bytes"), F.lit(True).alias("head"), "total",
    )
    return whole.select(*_ROWS).unionByName(cut.select(*_ROWS)).unionByName(heads.select(*_ROWS))


def prefix_trie(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of all conversations, and who ends there.

    ``turns``: ``conv, place, turn_id, bytes``, places from 1 without gaps, and a row of place 0 for each conversation without
    turns (others may have one). Nodes: ``k1, k2`` (the prefix), ``depth``, ``conv_id`` (smallest member), ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves`` and ``saved_tokens`` (both of the subtree). Ends: ``k1, k2, first, ids``: ascending ids, lists of a
    node in the order of ``first``; no list has more than ``LISTED``.

    Conversations are range-partitioned by id and cut into shards. A shard's node is counted there and then
    summed by its key, so a prefix that all conversations have is one row a shard. A conversation of any length is cut in parts. What
    a subtree holds is the sum over shards of what the shard's subtree owns; a node is owned where its smallest member is.
    An empty table gives no rows, not even a root.
    """
    importable(turns.sparkSession)
    made = shard_nodes(turns)
    together = made.groupBy("k1", "k2").agg(
        F.sum("n").alias("n_all"), F.min("least").alias("least_all"), F.max("inner").alias("inner_all"), F.max("bytes").alias("bytes_all")
    )
    flags = stored(
        made.select("shard", "part", "node", "parent", "depth", "k1", "k2", "n", "least").join(together, ["k1", "k2"])
        .withColumn("owner", (F.col("n") > 0) & (F.col("least") == F.col("least_all")))
        .withColumn("leaf", (F.col("owner") & ~F.col("inner_all")).cast("long"))
        .withColumn("saved", F.when(F.col("owner"), (F.col("n_all") - 1) * F.col("bytes_all")).otherwise(0))
        .select("shard", "part", "node", "parent", "depth", "k1", "k2", "n_all", "least_all", "owner", "leaf", "saved")
    )
    long = flags.where("part >= 0")
    if not long.isEmpty():
        flags = _with_later(flags, long)
    sums = flags.groupBy("shard", "part").applyInArrow(_subtree_sums, _SUMS)
    nodes = sums.groupBy("k1", "k2").agg(
        F.first("depth").alias("depth"), F.first("least").alias("conv_id"), F.max("parent_least").alias("parent_conv_id"),
        F.first("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
    )
    lists = F.transform(F.sequence(F.lit(0), F.expr(f"(size(ends) - 1) div {LISTED}")), lambda i: F.slice("ends", i * LISTED + 1, F.lit(LISTED)))
    ends = made.where(F.size("ends") > 0).select("k1", "k2", F.explode(lists).alias("ids"))
    return nodes, ends.select("k1", "k2", F.col("ids")[0].alias("first"), "ids")


def _with_later(flags: DataFrame, long: DataFrame) -> DataFrame:
    """Adds to the last node of each part what all later parts of its conversation own."""
    held = long.groupBy("shard", "part").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"), F.max("node").alias("node"))
    after = Window.partitionBy("shard").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    later = held.select("shard", "part", "node", *[F.sum(c).over(after).alias(f"later_{c}") for c in ("leaf", "saved")])
    joined = flags.join(later, ["shard", "part", "node"], "left")
    for c in ("leaf", "saved"):
        joined = joined.withColumn(c, F.col(c) + F.coalesce(f"later_{c}", F.lit(0))).drop(f"later_{c}")
    return joined.select(*flags.columns)


def end_digests(ends: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256``: the digest of a node's ascending ids, joined by commas.

    Lists come sorted and pass one after another, so memory does not grow with a node's ids.
    """
    importable(ends.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()

        def closed(done: list) -> pa.RecordBatch:
            k1, k2, sha = zip(*done)
            return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sha)], names=["k1", "k2", "ends_sha256"])

        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                text = ",".join(map(str, ids)).encode()
                if key == (k1, k2):
                    state.update(b"," + text)
                    continue
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256(text)
            if done:
                yield closed(done)
        if key is not None:
            yield closed([(*key, state.hexdigest())])

    placed = ends.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return placed.select("k1", "k2", "ids").mapInArrow(run, "k1 long, k2 long, ends_sha256 string")
