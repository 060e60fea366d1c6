"""Hierarchical defect ratios and the chi-squared test that points at suspicious children."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from yieldlens.functions.probability import chi2_upper_tail
from yieldlens.operators import ordered, statistics as st
from yieldlens.session import cut_lineage

# The text that marks an absent level, and the level lists of the three sites.
NO_LEVEL = "None"
SITE_LEVELS = {
    "ARRAY": ["Parameter", "tool_id", "chmb"],
    "CF": ["Parameter", "line_id", "tool_id"],
    "CELL": ["Parameter", "tool_id", "unit_name", "chmb"],
}

Levels = Sequence[str] | Mapping[str, Sequence[str]]


def level_columns(levels: Levels) -> list[str]:
    if not isinstance(levels, Mapping):
        return list(levels)
    return list(dict.fromkeys(c for names in levels.values() for c in names))


def _prefixes(levels: Sequence[str], every: Sequence[str], kinds: dict[str, str], longest: int) -> Column:
    """One struct per prefix of length 2 and more, as an array."""
    found = []
    for i in range(1, len(levels)):
        shown = [(st.quoted(c) if c in levels[: i + 1] else F.lit(None).cast(kinds[c])).alias(c) for c in every]
        path = [(st.quoted(levels[j]) if j <= i else F.lit(None)).alias(f"_path_{j}") for j in range(longest)]
        known = st.quoted(levels[i]).cast("string") != NO_LEVEL
        for c in levels[: i + 1]:
            known = known & st.quoted(c).isNotNull()
        found.append(F.struct(F.lit(i).alias("depth"), F.lit(levels[i]).alias("flag"), *shown, *path, known.alias("_known")))
    return F.array(*found)


def _level_table(df: DataFrame, levels: Levels) -> DataFrame:
    """Sums and ratio per prefix: depth, flag, level columns, _path_0.., site, NG_num, Total_num, NG_Ratio.

    The rows are summed once by all levels of their site; the shorter prefixes are summed
    from that small table. Columns outside a prefix are null.
    """
    every = level_columns(levels)
    kinds = dict(df.dtypes)
    if isinstance(levels, Mapping):
        df = df.where(F.col("site").isin(list(levels)))
        keys = [
            F.when(F.col("site").isin([s for s, names in levels.items() if c in names]), st.quoted(c)).alias(c) for c in every
        ]
        longest = max(len(names) for names in levels.values())
        prefixes = None
        for site, names in levels.items():
            found = _prefixes(names, every, kinds, longest)
            match = F.col("site") == site
            prefixes = F.when(match, found) if prefixes is None else prefixes.when(match, found)
    else:
        keys, longest = [st.quoted(c) for c in every], len(every)
        prefixes = _prefixes(every, every, kinds, longest)
    sums = [F.sum(c).alias(c) for c in ("NG_num", "Total_num")]
    base = df.where(F.col("site").isNotNull()).groupBy("site", *keys).agg(*sums)
    paths = [f"_path_{j}" for j in range(longest)]
    return (
        base.select("site", "NG_num", "Total_num", F.explode(prefixes).alias("_prefix"))
        .select("_prefix.*", "site", "NG_num", "Total_num")
        .where("_known")
        .groupBy("depth", "flag", *[st.quoted(c) for c in every], *paths, "site")
        .agg(*sums)
        .withColumn("NG_Ratio", F.bround(F.try_divide(F.col("NG_num") * 100.0, F.col("Total_num")), 2))
    )


def ng_ratio_levels(df: DataFrame, levels: Levels) -> DataFrame:
    """Defects, totals and ratio for every prefix of ``levels``; ``flag`` names its last level.

    ``levels`` is one list, or a list per site.
    """
    return _level_table(df, levels).select(
        *[st.quoted(c) for c in level_columns(levels)], "flag", "site", "NG_num", "Total_num", "NG_Ratio"
    )


def chi2_by_group(
    table: DataFrame,
    groups: Sequence[str],
    alpha: float = 0.05,
    ng: str = "NG_num",
    total: str = "Total_num",
    max_group_rows: int = ordered.MAX_GROUP_ROWS,
) -> DataFrame:
    """Pearson chi-squared test of equal defect ratios among the rows of each group.

    Groups of one row, and groups with a zero defect or pass count, are not tested.
    Two rows get the continuity correction. Adds children, pooled, chi2, dof, p_value
    (of every tested group), and for significant groups true_ng, expect_ng and flags.
    Groups are windows unless one is too long for a task; then sums are joined back.
    """
    joined = ordered.largest_group(table, groups) > max_group_rows

    def with_sums(rows: DataFrame, **sums: Column) -> DataFrame:
        if joined:
            return ordered.join_on(rows, rows.groupBy(*groups).agg(*[c.alias(n) for n, c in sums.items()]), groups)
        whole = Window.partitionBy(*groups)
        return rows.select("*", *[c.over(whole).alias(n) for n, c in sums.items()])

    o, n = F.col(ng).cast("double"), F.col(total).cast("double")
    rows = with_sums(
        table, children=F.count(F.lit(1)), _ng=F.sum(ng), _total=F.sum(total), _least=F.min(F.least(o, n - o))
    ).withColumn("pooled", F.try_divide(F.col("_ng").cast("double"), F.col("_total").cast("double")))
    gap = F.abs(o - n * F.col("pooled"))
    gap = F.when(F.col("children") == 2, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
    term = F.try_divide(gap * gap, n * F.col("pooled") * (1 - F.col("pooled")))
    tested = (F.col("children") > 1) & (F.col("_least") != 0)
    rows = with_sums(rows.withColumn("_term", F.when(tested, term)), chi2=F.sum("_term")).withColumn(
        "dof", F.when(tested, F.col("children") - 1)
    )
    # the tail is a sum over the degrees of freedom: once a group, not once a child
    tail = chi2_upper_tail(F.col("chi2"), F.col("dof"))
    if joined:
        tails = rows.groupBy(*groups).agg(F.max("chi2").alias("chi2"), F.max("dof").alias("dof")).select(
            *groups, F.when(F.col("dof").isNotNull(), tail).alias("p_value")
        )
        rows = ordered.join_on(rows, tails, groups)
    else:
        whole = Window.partitionBy(*groups)
        first = F.row_number().over(whole.orderBy(F.lit(0))) == 1
        rows = rows.withColumn("_first", first).withColumn("_tail", F.when(F.col("_first") & tested, tail))
        rows = rows.withColumn("p_value", F.max("_tail").over(whole)).drop("_first", "_tail")
    significant = F.coalesce(F.col("p_value") < alpha, F.lit(False))
    ratio = F.try_divide(o, n)
    return (
        rows.withColumn("sig_flag_p_value", F.when(significant, "Y").otherwise(""))
        .withColumn("true_ng", F.when(significant, ratio))
        .withColumn("expect_ng", F.when(significant, F.col("pooled")))
        .withColumn("sig_flag", F.when(significant & (ratio > F.col("pooled")), "Y").otherwise(""))
        .drop("_ng", "_total", "_least", "_term")
    )


def level_tests(
    df: DataFrame, levels: Levels, alpha: float = 0.05, grouping: str = "parent", **limits
) -> DataFrame:
    """All levels, tested inside their parent.

    ``grouping="parent"`` compares all children of a parent. ``"adjacent"`` compares only
    children that follow each other when the rows of a first-level value are sorted by
    falling ratio. The summed table is checkpointed: it is small, and read several times.
    """
    if grouping not in ("parent", "adjacent"):
        raise ValueError("grouping must be 'parent' or 'adjacent'")
    table = cut_lineage(_level_table(df, levels))
    paths = [c for c in table.columns if c.startswith("_path_")]
    parents = [f"_parent_{j}" for j in range(len(paths) - 1)]
    table = table.select("*", *[F.when(F.col("depth") > j, F.col(f"_path_{j}")).alias(p) for j, p in enumerate(parents)])
    groups = ["depth", "site", *parents]
    if grouping == "adjacent":
        order = [F.desc_nulls_last("NG_Ratio"), *[F.col(p).asc() for p in paths]]
        table = ordered.run_ids(table, ["depth", "site", "_path_0"], order, parents, "_run", **limits)
        groups = ["depth", "site", "_path_0", "_run"]
    size = {k: v for k, v in limits.items() if k == "max_group_rows"}
    return chi2_by_group(table, groups, alpha, **size).drop(*parents, *paths, "_run")


def proportion_test(
    df: DataFrame, levels: Levels, alpha: float = 0.05, grouping: str = "parent", **limits
) -> DataFrame:
    """Level columns, flag, site, NG_num, Total_num, NG_Ratio, p-value, sig_flag.

    The p-value is null where the group was not tested or is not significant.
    """
    tested = level_tests(df, levels, alpha, grouping, **limits)
    return tested.select(
        *[st.quoted(c) for c in level_columns(levels)],
        "flag",
        "site",
        "NG_num",
        "Total_num",
        "NG_Ratio",
        F.when(F.col("sig_flag_p_value") == "Y", F.col("p_value")).alias("p-value"),
        "sig_flag",
    )


def proportion_test_sites(
    df: DataFrame,
    site_levels: Mapping[str, Sequence[str]] = SITE_LEVELS,
    alpha: float = 0.05,
    grouping: str = "parent",
    **limits,
) -> DataFrame:
    """Each site with its own level list, all in one pass over the rows."""
    return proportion_test(df, site_levels, alpha, grouping, **limits)
