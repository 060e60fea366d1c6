"""Groups of linked things: connected components, and links among the members of many buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from yieldlens.llm.common import discard, partitions, release, stored

#: Rows up to which a side of known size is broadcast; beyond it the join shuffles both sides.
BROADCAST_ROWS = 200_000
#: Rows of two or three numbers up to which a round is one task without shuffles; beyond it rounds are distributed.
ONE_TASK_ROWS = 200_000
#: Pairs across components that are compared at once, for each member row; above it another leader is tried first.
PAIRS_PER_MEMBER = 4
LEADERS = 6


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows, of bounded width, are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


class Kept:
    """Intermediate tables, which are deleted when nothing reads them any more."""

    def __init__(self, one: bool):
        #: Few rows were counted: tables are one partition, so that joins and sums need no shuffle.
        self.one = one
        self.tables: list[tuple[DataFrame, DataFrame]] = []

    def keep(self, df: DataFrame, spread: bool = False) -> DataFrame:
        one = self.one and not spread
        table = stored(df.coalesce(1)) if one else stored(df)
        if not self.one:
            release(df.sparkSession)
        shown = table.coalesce(1) if one else table
        self.tables.append((table, shown))
        return shown

    def drop_all_but(self, *needed: DataFrame) -> None:
        for table, shown in self.tables:
            if not any(shown is n for n in needed):
                discard(table)
        self.tables = [t for t in self.tables if any(t[1] is n for n in needed)]


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for every end of the edges ``a, b``: root is the smallest id its component holds.

    In each round every node points to its smallest neighbour if that is smaller than itself, pointers are
    followed to their ends, and each such tree becomes one node; edges inside it vanish. Every
    component at least halves in a round, so rounds grow with the logarithm of its size.
    Few edges are one task's work; of more, no task ever sees a whole component. Null ends and loops are dropped.
    """
    first = stored(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    rows = first.count()
    tables = Kept(rows <= ONE_TASK_ROWS)
    left = first.coalesce(1) if tables.one else first
    found = None
    while rows:
        both = left.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        up = both.groupBy("e.a").agg(F.min("e.b").alias("low")).select(F.col("a").alias("id"), F.least("a", "low").alias("root"))
        # follow two steps at once, and again until no pointer moves
        moving = True
        while moving:
            up = tables.keep(up)
            onward = up.select(F.col("id").alias("root"), F.col("root").alias("next"))
            jumped = tables.keep(up.join(onward, "root").select("id", "root", "next"))
            moving = not jumped.where("root <> next").isEmpty()
            up = jumped.select("id", F.col("next").alias("root"))
        if found is None:
            found = tables.keep(up)
        else:
            onward = up.select(F.col("id").alias("root"), F.col("root").alias("next"))
            found = tables.keep(found.join(onward, "root", "left").select("id", F.coalesce("next", "root").alias("root")))
        ends = left.join(up.select(F.col("id").alias("a"), F.col("root").alias("x")), "a").join(
            up.select(F.col("id").alias("b"), F.col("root").alias("y")), "b"
        )
        left = tables.keep(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        rows = left.count()
        tables.drop_all_but(found, left)
    if found is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("root"))
    discard(first)
    return found


def shared_buckets(members: DataFrame) -> DataFrame:
    """Of ``key, id`` the rows whose key has two ids at least, without repeats. A key's rows are counted, never gathered."""
    twice = members.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    return members_of(members, twice.select("key"))


def members_of(members: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows ``key, id`` of the given keys, without repeats."""
    keys = stored(keys)
    found = stored(members.join(small(keys, keys.count()), "key", "left_semi").distinct())
    discard(keys)
    return found


def link(
    members: DataFrame, similar: Callable[[DataFrame], DataFrame], traits: DataFrame | None = None,
    near: Callable[[str, str], Column] | None = None, prefixes: Callable[[DataFrame], DataFrame] | None = None,
    reach: Column | None = None, largest_first: bool = False, checks: int = PAIRS_PER_MEMBER,
) -> DataFrame:
    """``id, root`` of the linked ids: components over all similar pairs that share a bucket.

    ``members`` are ``key, id`` from ``shared_buckets``; ``similar`` keeps the similar ones of pairs
    ``a, b``. ``traits`` are numbers of the ids; ``near("a_", "b_")`` is a condition on the
    traits of both sides, under which a pair is compared at all. It is part of the joins, so other pairs are not written.
    ``prefixes(ids)`` gives ``id, feature, before, whole`` such that similar ids share a feature; ``before`` is what an id has
    ahead of it in one order of all features. ``reach`` is a condition on these numbers of both sides (``a_before`` ...) at the
    first feature they share.

    Comparing all pairs of a bucket of near copies would be quadratic, and most of
    them say nothing new. So first each bucket's members are compared with one leader,
    a different one in each turn; what is similar becomes one component. With ``largest_first`` a member meets in the first turn
    the leader of its largest bucket only, which is enough for copies that share all of theirs. Pairs within a
    component need no comparison, and buckets of one component are done. When few pairs across components
    are left (they are counted, not listed), all of them are compared, each once, so no link between components is lost. ``checks`` says
    how many pairs a member may be left after the second leader, where ``near`` settles most of them inside the join. If many
    are left after the last leader, only those that share a feature are, which loses none either.
    """
    rows = members.count()
    tables = Kept(rows <= ONE_TASK_ROWS)
    members = members.coalesce(1) if tables.one else members
    # who meets most others in its buckets stands most likely in the middle of its copies
    sizes = members.groupBy("key").agg(F.count("*").alias("n"))
    met = members.join(sizes, "key").groupBy("id").agg(F.sum("n").alias("met"))
    roots = tables.keep(members.select("id", F.col("id").alias("root")).distinct())
    with_traits = members.select("key", "id").join(met, "id")
    names = [c for c in traits.columns if c != "id"] if traits is not None else []
    members = tables.keep(with_traits.join(traits, "id") if names else with_traits)

    def side(df: DataFrame, name: str, root: str, *own: str) -> DataFrame:
        kept = [F.col(c) if c in by else F.col(c).alias(f"{name}_{c}") for c in own]
        return df.select(F.col("id").alias(name), F.col("root").alias(root), *kept, *[F.col(t).alias(f"{name}_{t}") for t in names])

    by = ("key", "feature")
    close = near("a_", "b_") if near is not None else F.lit(True)
    for turn in range(LEADERS + 1):
        placed = tables.keep(members.join(roots, "id"))
        counts = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
        left = counts.groupBy("key").agg(
            F.sum("n").alias("bucket_size"), ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs")
        )
        left = tables.keep(left.where("pairs > 0"))
        across = left.agg(F.sum("pairs")).first()[0]
        if not across:
            break
        placed = tables.keep(placed.join(left.select("key", "bucket_size"), "key"))
        tables.drop_all_but(placed, roots)
        members = placed.drop("root", "bucket_size")
        few = across <= PAIRS_PER_MEMBER * rows or (turn > 1 and across <= checks * rows)
        last = turn == LEADERS or (turn > 0 and few)
        if last:
            pairs = _all_pairs(placed, tables, side, close, prefixes if not few else None, reach)
        else:
            # first whoever meets most others leads, then the lowest scrambled id
            rank = F.xxhash64("id", F.lit(turn)) if turn else F.struct(-F.col("met"), "id")
            lead = placed.groupBy("key").agg(F.min_by(F.struct("id", "root", *names), rank).alias("lead")).select("key", "lead.*")
            asking = placed
            if largest_first and not turn:
                largest = F.min_by(F.struct("key", "root", *names), F.struct(-F.col("bucket_size"), "key"))
                asking = placed.groupBy("id").agg(largest.alias("own")).select("id", "own.*")
            pairs = side(asking, "a", "x", "key").join(side(lead, "b", "y", "key"), "key").where((F.col("x") != F.col("y")) & close)
        pairs = tables.keep(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if tables.one:  # the comparisons are work for all
            pairs = pairs.repartition(partitions(members.sparkSession))
        # new links tie the components found so far, so only their roots are edges
        new = similar(pairs).join(roots.select(F.col("id").alias("a"), F.col("root").alias("x")), "a")
        new = new.join(roots.select(F.col("id").alias("b"), F.col("root").alias("y")), "b")
        grouped = components(new.select(F.col("x").alias("a"), F.col("y").alias("b")))
        onward = grouped.select(F.col("id").alias("root"), F.col("root").alias("next"))
        roots = tables.keep(roots.join(onward, "root", "left").select("id", F.coalesce("next", "root").alias("root")))
        if last:
            break
        members = tables.keep(members)
        tables.drop_all_but(members, roots)
    tables.drop_all_but(roots)
    return roots.where("id <> root")


def _all_pairs(placed: DataFrame, tables: Kept, side: Callable, close: Column, prefixes: Callable | None, reach: Column | None) -> DataFrame:
    """Every pair of different components that shares a bucket and, if there are prefixes, a feature; each once."""
    keys = placed.groupBy("id").agg(F.array_sort(F.collect_list("key")).alias("keys"))  # as many as an id has bands
    held = placed.drop("key", "bucket_size").distinct().join(keys, "id")
    apart = F.col("x") < F.col("y")
    if prefixes is None:
        # comparing is the work here: spread it
        open_ = tables.keep(held.withColumn("key", F.explode("keys")), spread=True).repartition("key")
        met = side(open_, "a", "x", "key", "keys").join(side(open_, "b", "y", "key", "keys"), "key")
        # the smallest bucket they share names the pair
        return met.where(apart & close & (F.array_min(F.array_intersect("a_keys", "b_keys")) == F.col("key")))
    found = tables.keep(prefixes(held.select("id")), spread=True)
    ordered = F.array_sort(F.collect_list(F.struct("before", "feature")))
    features = found.groupBy("id").agg(F.transform(ordered, lambda f: f["feature"]).alias("features"))
    open_ = tables.keep(held.join(found, "id").join(features, "id"), spread=True)
    own = ("feature", "features", "keys", "before", "whole")
    met = side(open_, "a", "x", *own).join(side(open_, "b", "y", *own), "feature")
    first = F.get(F.array_intersect("a_features", "b_features"), F.lit(0)) == F.col("feature")
    reach = F.lit(True) if reach is None else reach
    return met.where(apart & close & reach & F.arrays_overlap("a_keys", "b_keys") & first)
