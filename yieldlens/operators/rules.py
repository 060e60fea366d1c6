"""Association rules between tool columns and defects.

Support, confidence, lift and defect ratio all come from one count table of item
sets: for each set the rows of every class that hold it. Rows are first pruned to
items that are frequent in some class. There are at most 1/min_support such items per
column, class and group. A group's items are one row of a table; the driver holds none.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from yieldlens.operators import bitmaps as bm, columns as co, ordered, statistics as st, values as va
from yieldlens.session import cut_lineage

# Default thresholds and the class labels.
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT, MAX_LENGTH = 0.5, 0.5, 1.000001, 3
NEGATIVE, POSITIVE = 0, 1

SETS_PER_ROW = 256
BROADCAST_RULES = 100_000
SALTS = 32


@dataclass(frozen=True)
class ItemCounts:
    """``table``: _by, ids, size, n_all, n_neg, n_pos; ``totals``: _by, rows_all, rows_neg, rows_pos.

    ``book``: _by and ``_items``, the group's frequent items (name, value), which ids number from 0.
    """

    table: DataFrame
    totals: DataFrame
    book: DataFrame

    def named(self, sets: DataFrame) -> DataFrame:
        """``sets`` with the items of their group."""
        return sets.join(self.book, "_by")


def item_texts(ids: Column) -> Column:
    return F.array_sort(F.transform(ids, lambda i: F.element_at(F.col("_items.name"), i + 1)))


def _class_counts() -> list[Column]:
    w = F.col("_w")
    return [
        F.sum(w).alias("all"),
        F.sum(F.when(F.col("_y") == "neg", w).otherwise(0)).alias("neg"),
        F.sum(F.when(F.col("_y") == "pos", w).otherwise(0)).alias("pos"),
    ]


def _named(prefix: str) -> list[Column]:
    return [F.col(c).alias(f"{prefix}_{c}") for c in ("all", "neg", "pos")]


def _frequent(min_support: float) -> Column:
    return (F.try_divide(F.col("n_neg"), F.col("rows_neg")) >= min_support) | (
        F.try_divide(F.col("n_pos"), F.col("rows_pos")) >= min_support
    )


def _subsets(ids: Column, size: int) -> Column:
    """Arrays of ``size`` ids in row order."""
    if size == 1:
        return F.transform(ids, lambda x: F.array(x))

    def extend(x: Column, i: Column) -> Column:
        return F.transform(_subsets(F.slice(ids, i + 2, F.size(ids)), size - 1), lambda s: F.concat(F.array(x), s))

    return F.flatten(F.transform(ids, extend))


def item_counts(
    df: DataFrame,
    item_columns: Sequence[str],
    y: str,
    min_support: float = MIN_SUPPORT,
    max_length: int = MAX_LENGTH,
    negative=NEGATIVE,
    positive=POSITIVE,
    by: str | None = None,
    sets_per_row: int = SETS_PER_ROW,
    broadcast_bytes: int = va.BROADCAST_BYTES,
    salts: int = SALTS,
) -> ItemCounts:
    """Counts of every item set of up to ``max_length`` items that is frequent in some class (and group).

    A group's frequent items, at most 2 / min_support a column, are one row of a table that
    joins the group's rows: broadcast where all groups' rows are counted to be at most ``broadcast_bytes``, else with salts.
    Where a row's sets are more than ``sets_per_row`` they aren't written but counted on bitmaps of blocks of rows (``bitmaps``).
    """
    label = st.quoted(y).cast("string")
    # collapse on the raw cells, then write them as text
    raw = st.collapse(df.select(*[st.quoted(c) for c in dict.fromkeys([*([by] if by else []), y, *item_columns])]))
    base = raw.select(
        (F.lit("") if by is None else st.quoted(by).cast("string")).alias("_by"),
        F.when(label == str(negative), "neg").when(label == str(positive), "pos").otherwise("other").alias("_y"),
        *[va.item_value(df, c).alias(f"_v{i}") for i, c in enumerate(item_columns)],
        "_w",
    )
    cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"_v{i}").alias("v")) for i in range(len(item_columns))])
    cell_counts = (
        base.select("_by", "_y", "_w", F.explode(cells).alias("cell"))
        .groupBy("_by", "cell.c", "cell.v")
        .agg(*_class_counts())
    )
    # every row has one value in the first column, so its counts add up to the class sizes
    totals = cell_counts.where("c = 0").groupBy("_by").agg(*[F.sum(c).alias(f"rows_{c}") for c in ("all", "neg", "pos")])
    singles = cell_counts.select("_by", "c", "v", *_named("n")).join(totals, "_by").where(_frequent(min_support))
    totals = cut_lineage(totals)
    found = F.sort_array(F.collect_list(F.struct("c", "v")))
    books = cut_lineage(singles.groupBy("_by").agg(found.alias("_found")))
    columns = F.array(*[F.lit(c) for c in item_columns])
    items = F.transform(
        "_found", lambda x: F.struct(F.concat(F.element_at(columns, x["c"] + 1), F.lit("="), x["v"]).alias("name"), x["v"].alias("value"))
    )
    book = books.select("_by", items.alias("_items"))
    # for each column the ids of its frequent values
    numbered = F.transform("_found", lambda x, i: F.struct(x["c"].alias("c"), x["v"].alias("v"), i.alias("i")))
    codes = F.transform(
        F.sequence(F.lit(0), F.lit(len(item_columns) - 1)),
        lambda c: F.map_from_entries(F.transform(F.filter(numbered, lambda x: x["c"] == c), lambda x: F.struct(x["v"], x["i"]))),
    )
    size = F.octet_length(F.array_join("_found.v", "")) + 64 * F.size("_found")
    coded = books.select("_by", codes.alias("_codes"), size.alias("_size"))
    ids = F.array_compact(F.array(*[F.try_element_at(F.col("_codes")[i], F.col(f"_v{i}")) for i in range(len(item_columns))]))
    pruned = _beside(base, coded, broadcast_bytes, salts).select("_by", "_y", "_w", ids.alias("ids"))

    def counted(frame: DataFrame, sizes: Sequence[int]) -> DataFrame:
        sets = F.concat(*[_subsets(F.col("ids"), k) for k in sizes])
        return (
            frame.select("_by", "_y", "_w", F.explode(sets).alias("ids"))
            .groupBy("_by", "ids")
            .agg(*_class_counts())
            .select("_by", "ids", F.size("ids").alias("size"), *_named("n"))
            .join(totals, "_by")
            .where(_frequent(min_support))
            .select("_by", "ids", "size", "n_all", "n_neg", "n_pos")
        )

    m = books.select(F.size(F.array_distinct("_found.c")).alias("m")).agg(F.max("m")).first()[0] or 0
    if sum(math.comb(m, k) for k in range(1, max_length + 1)) <= sets_per_row:
        return ItemCounts(counted(pruned, range(1, max_length + 1)), totals, book)

    # many columns: bitmaps; triples and longer only where all their parts are frequent
    def kept(counts: DataFrame, size: int) -> DataFrame:
        named = counts.select("_by", "ids", F.lit(size).alias("size"), *_named("n"))
        return named.join(totals, "_by").where(_frequent(min_support)).select("_by", "ids", "size", "n_all", "n_neg", "n_pos")

    pruned = cut_lineage(pruned)
    table = counted(pruned, [1])
    stored = bm.blocks(pruned) if max_length > 1 else None
    for size in range(2, max_length + 1):
        if size == 2:
            found = bm.count_pairs(stored)
        else:
            wanted = cut_lineage(bm.chunks(bm.candidates(last.select("_by", "ids"), size)))
            if wanted.isEmpty():
                break
            found = bm.count_sets(_beside(stored, wanted, broadcast_bytes, salts), size)
        last = cut_lineage(kept(found, size))
        table = table.unionByName(last)
    return ItemCounts(table, totals, book)


def _beside(rows: DataFrame, groups: DataFrame, broadcast_bytes: int, salts: int) -> DataFrame:
    """Each row with its group's row (_by, .., _size in bytes), which is broadcast if all are small together.

    Else the join is salted, since one group may be a third of all rows.
    """
    if (groups.agg(F.sum("_size")).first()[0] or 0) <= broadcast_bytes:
        return rows.join(F.broadcast(groups), "_by")
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    spread = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt).join(spread, ["_by", "_salt"]).drop("_salt")


def _per_class(counts: ItemCounts, min_support: float) -> DataFrame:
    """Item sets by class they are frequent in: _by, y, ids, size, n, rows, support, n_all, n_pos."""
    joined = counts.table.join(counts.totals, "_by")
    sides = F.array(
        F.struct(F.lit("neg").alias("y"), F.col("n_neg").alias("n"), F.col("rows_neg").alias("rows")),
        F.struct(F.lit("pos").alias("y"), F.col("n_pos").alias("n"), F.col("rows_pos").alias("rows")),
    )
    return (
        joined.select("_by", "ids", "size", "n_all", "n_pos", F.explode(sides).alias("side"))
        .select("_by", "side.*", "ids", "size", "n_all", "n_pos")
        .withColumn("support", F.try_divide(F.col("n"), F.col("rows")))
        .where(F.col("support") >= min_support)
    )


def frequent_itemsets(
    df: DataFrame,
    item_columns: Sequence[str],
    y: str,
    min_support: float = MIN_SUPPORT,
    max_length: int = MAX_LENGTH,
    negative=NEGATIVE,
    positive=POSITIVE,
    **options,
) -> DataFrame:
    """Per class: items, size, n, support, and NG_Ratio over the rows of all classes."""
    counts = item_counts(df, item_columns, y, min_support, max_length, negative, positive, **options)
    side = F.when(F.col("y") == "pos", F.lit(positive)).otherwise(F.lit(negative))
    return counts.named(_per_class(counts, min_support)).select(
        *_by_column(options),
        side.alias("Y"),
        item_texts(F.col("ids")).alias("items"),
        "size",
        "n",
        "support",
        (F.col("n_pos") / F.col("n_all")).alias("NG_Ratio"),
    )


def _by_column(options: dict) -> list[Column]:
    return [F.col("_by").alias(options["by"])] if options.get("by") else []


def association_rules(
    df: DataFrame,
    item_columns: Sequence[str],
    y: str,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
    max_length: int = MAX_LENGTH,
    max_consequent: int | None = None,
    zero_match: str | None = "exact",
    negative=NEGATIVE,
    positive=POSITIVE,
    **options,
) -> DataFrame:
    """Rules base -> add per class: item_base, item_add (arrays), Support, Confidence, Lift, NG_Ratio, Y.

    Item sets with an item of value 0 (operation not passed) make no rules.
    ``zero_match="substring"`` also treats values that merely start with 0 so; None keeps all.
    """
    counts = item_counts(df, item_columns, y, min_support, max_length, negative, positive, **options)
    # the small count table is read three times below: as rules, as bases and as additions
    counts = replace(counts, table=cut_lineage(counts.table))
    sets = _per_class(counts, min_support)
    zeros = {
        "exact": lambda item: item["value"] == "0",
        "substring": lambda item: item["name"].contains("=0"),
        None: lambda item: F.lit(False),
    }
    if zero_match not in zeros:
        raise ValueError("zero_match must be 'exact', 'substring' or None")
    whole = counts.named(sets.where("size >= 2")).where(~F.exists("ids", lambda i: zeros[zero_match](F.element_at("_items", i + 1)))).drop("_items")
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), F.col("size")).cast("int") - 2)
    split = whole.withColumn("_mask", F.explode(masks))

    def in_base(_, i: Column) -> Column:
        return F.getbit(F.col("_mask"), i) == 1

    split = split.withColumn("_base", F.filter("ids", in_base)).withColumn(
        "_add", F.filter("ids", lambda x, i: ~in_base(x, i))
    )
    if max_consequent is not None:
        split = split.where(F.size("_add") <= max_consequent)
    parts = sets.select("_by", "y", F.col("ids").alias("_part"), F.col("support").alias("_support"))
    bases = parts.withColumnsRenamed({"_part": "_base", "_support": "_base_support"})
    adds = parts.withColumnsRenamed({"_part": "_add", "_support": "_add_support"})
    confidence = F.col("support") / F.col("_base_support")
    found = (
        split.join(bases, ["_by", "y", "_base"])
        .join(adds, ["_by", "y", "_add"])
        .withColumn("Confidence", confidence)
        .withColumn("Lift", F.col("Confidence") / F.col("_add_support"))
        .where((F.col("Confidence") >= min_confidence) & (F.col("Lift") >= min_lift))
    )
    return counts.named(found).select(
        *_by_column(options),
        item_texts(F.col("_base")).alias("item_base"),
        item_texts(F.col("_add")).alias("item_add"),
        F.col("support").alias("Support"),
        "Confidence",
        "Lift",
        (F.col("n_pos") / F.col("n_all")).alias("NG_Ratio"),
        F.when(F.col("y") == "pos", F.lit(positive)).otherwise(F.lit(negative)).alias("Y"),
    )


def mine_rules(df: DataFrame, y: str = "Y", by: str | None = None, **options) -> DataFrame:
    """item_base, item_add, Lift, NG_Ratio, Y; both classes in one job, ordered by class and NG_Ratio."""
    df = co.drop_columns_like(df, "rework_flag")
    items = [c for c in df.columns if c not in (y, by)]
    if by is not None:
        options["by"] = by
    found = association_rules(df, items, y, **options)
    groups = [by] if by is not None else []
    return (
        found.withColumn("item_base", va.items_to_string(F.col("item_base")))
        .withColumn("item_add", va.items_to_string(F.col("item_add")))
        .withColumn("Lift", F.bround("Lift", 4))
        .select(*groups, "item_base", "item_add", "Lift", "NG_Ratio", "Y")
        .orderBy(*groups, "Y", "NG_Ratio", F.desc("Lift"), "item_base", "item_add")
    )


def mine_rules_flat(df: DataFrame, y: str = "Y", **options) -> DataFrame:
    """The older layout X1, X2, X3, Lift, NG_Ratio, Y: one-item consequents, longer rules first.

    A rule whose NG_Ratio equals that of the rule just before it is dropped.
    """
    limits = {k: options.pop(k) for k in ("max_group_rows", "block_rows") if k in options}
    df = co.drop_columns_like(df, "rework_flag")
    found = association_rules(
        df, [c for c in df.columns if c != y], y, max_consequent=1, zero_match="exact", **options
    )
    base = F.array_sort("item_base")
    flat = found.select(
        F.element_at(base, 1).alias("X1"),
        F.coalesce(F.try_element_at(base, F.lit(2)), F.lit("")).alias("X2"),
        F.element_at("item_add", 1).alias("X3"),
        F.bround("Lift", 4).alias("Lift"),
        F.bround("Confidence", 4).alias("_confidence"),
        "NG_Ratio",
        "Y",
    ).dropDuplicates()
    order = [
        (F.col("X2") == "").asc(), F.col("NG_Ratio").asc(), F.col("Lift").desc(), F.col("_confidence").desc(),
        F.col("X1").asc(), F.col("X2").asc(), F.col("X3").asc(),
    ]
    kept = ordered.drop_adjacent_repeats(flat, ["Y"], order, ["NG_Ratio"], **limits)
    return kept.orderBy("Y", *order).drop("_confidence")


def match_rules(
    rules: DataFrame,
    transactions: DataFrame,
    items: str,
    y: str,
    positive=POSITIVE,
    broadcast_rules: int = BROADCAST_RULES,
    salts: int = SALTS,
) -> DataFrame:
    """For each rule (rule_id, items): rows that hold all its items, those with the positive label, NG_Ratio.

    A row meets a rule only through the rule's rarest item, so no pair is written twice and an
    item that most rows have draws none.
    Rules are broadcast when counted to be few; otherwise the join is salted, since one
    item may be in a third of all rows.
    """
    # counted and joined twice, so written once
    wanted = cut_lineage(rules.select("rule_id", F.array_sort(F.array_distinct("items")).alias("rule_items")))
    # collapse on the arrays as they are; sorting and deduplicating them is left to the fewer rows
    held = cut_lineage(st.collapse(
        transactions.select(
            st.quoted(items).alias("row_items"), F.coalesce(st.quoted(y) == F.lit(positive), F.lit(False)).alias("_positive")
        )
    ))
    asked = wanted.select("rule_id", F.explode("rule_items").alias("_item"))
    often = held.select(F.explode(F.array_distinct("row_items")).alias("_item")).groupBy("_item").agg(F.count("*").alias("_often"))
    rarest = asked.join(often, "_item", "left").groupBy("rule_id").agg(
        F.min(F.struct(F.coalesce("_often", F.lit(0)).alias("_often"), "_item")).alias("_least")
    )
    anchored = cut_lineage(wanted.join(rarest, "rule_id").select("rule_id", "rule_items", F.col("_least._item").alias("_anchor")))
    rows = held.withColumn("_anchor", F.explode(F.array_distinct("row_items")))
    if wanted.limit(broadcast_rules + 1).count() <= broadcast_rules:
        joined = rows.join(F.broadcast(anchored), "_anchor")
    else:
        spread = anchored.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        joined = salted.join(spread, ["_anchor", "_salt"])
    hits = (
        joined.where(F.forall("rule_items", lambda i: F.array_contains("row_items", i)))
        .groupBy("rule_id")
        .agg(F.sum("_w").alias("all_count"), F.sum(F.when(F.col("_positive"), F.col("_w")).otherwise(0)).alias("ng_count"))
    )
    return (
        wanted.select("rule_id")
        .join(hits, "rule_id", "left")
        .na.fill(0, ["all_count", "ng_count"])
        .withColumn("NG_Ratio", F.try_divide(F.col("ng_count"), F.col("all_count")))
    )
