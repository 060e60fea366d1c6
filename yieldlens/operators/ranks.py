"""Rank lists: top cuts, knee detection and the combination of several methods.

A rank list has one row per feature of a table, so a list is as long as a schema is wide.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from yieldlens.operators import ordered, statistics as st, values as va

# List length before the knee search, and the fallback length.
TOP = 20
FALLBACK = 5

METHOD, LABEL, VALUE = "Method", "OPID_TOOLID", "IndexValue"


def ranking(value: str, label: str, absolute: bool = False) -> list[Column]:
    """Falling value, ties by label."""
    size = F.abs(st.quoted(value)) if absolute else st.quoted(value)
    return [size.desc_nulls_last(), st.quoted(label).asc()]


def sort_ranks(df: DataFrame, value: str, label: str, absolute: bool = False) -> DataFrame:
    return df.orderBy(*ranking(value, label, absolute))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First k rows per key; Spark keeps only k rows per key and task before the shuffle."""
    if not keys:
        return df.orderBy(*order).limit(k)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def top_fraction(
    df: DataFrame, keys: Sequence[str], value: str, label: str, fraction: float, end: str = "top", **limits
) -> DataFrame:
    """The floor(fraction x N) most important rows of each list.

    ``end="tail"`` takes that many from the other end, and all rows when the number is 0.
    """
    if end not in ("top", "tail"):
        raise ValueError("end must be 'top' or 'tail'")
    placed = ordered.with_ordinal(df, keys, ranking(value, label), "_place", **limits)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    joined = ordered.join_on(placed, sizes, keys)
    n = F.floor(F.lit(fraction) * F.col("_size"))
    keep = F.col("_place") < n if end == "top" else (n == 0) | (F.col("_place") >= F.col("_size") - n)
    return joined.where(keep).drop("_place", "_size")


def kneedle(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column], sensitivity: float = 1.0
) -> DataFrame:
    """Add ``rank`` (1..n) and ``knee`` of each convex, falling list (Satopaa et al. 2011).

    The knee is the first local maximum of the difference curve after which the curve
    falls below the maximum's threshold; null for flat lists and lists of one row.
    """
    in_order, whole = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys)
    v = st.quoted(value).cast("double")
    d, r, n = F.col("_curve"), F.col("rank"), F.col("_size")
    low, high = F.min(v).over(whole), F.max(v).over(whole)
    before, after = F.coalesce(F.col("_before"), d), F.coalesce(F.col("_after"), d)
    is_top = (d >= before) & (d >= after)
    is_bottom = (d <= before) & (d <= after)
    threshold = F.when(is_bottom, F.lit(0.0)).when(is_top, d - F.try_divide(F.lit(sensitivity), n - 1))
    falls = (r < n) & F.col("_top_rank").isNotNull() & (F.col("_after") < F.col("_threshold"))
    first = F.min(F.when(falls, F.struct("rank", "_top_rank"))).over(whole)
    return (
        df.withColumn("rank", F.row_number().over(in_order))
        .withColumn("_size", F.count(F.lit(1)).over(whole))
        .withColumn("_curve", 1.0 - F.try_divide(v - low, high - low) - F.try_divide(r - 1, n - 1))
        .withColumn("_before", F.lag("_curve").over(in_order))
        .withColumn("_after", F.lead("_curve").over(in_order))
        .withColumn("_threshold", F.last(threshold, ignorenulls=True).over(in_order))
        .withColumn("_top_rank", F.last(F.when(is_top, r), ignorenulls=True).over(in_order))
        .withColumn("knee", first["_top_rank"])
        .drop("_size", "_curve", "_before", "_after", "_threshold", "_top_rank")
    )


def cut_inclusive(ranked: DataFrame) -> DataFrame:
    """Rows up to the knee; all rows without one."""
    return ranked.where(F.col("knee").isNull() | (F.col("rank") <= F.col("knee")))


def cut_exclusive(ranked: DataFrame, fallback: int = FALLBACK) -> DataFrame:
    """Rows before the knee; the first ``fallback`` rows when there is none or it is the first row."""
    last = F.when(F.col("knee").isNull() | (F.col("knee") == 1), F.lit(fallback)).otherwise(F.col("knee") - 1)
    return ranked.where(F.col("rank") <= last)


def label_frequency(lists: Sequence[DataFrame], label: str = LABEL) -> DataFrame:
    """How many lists name each label, most frequent first."""
    united = functools.reduce(DataFrame.unionByName, [d.select(st.quoted(label).alias(LABEL)) for d in lists])
    counted = united.groupBy(LABEL).agg(F.count(F.lit(1)).alias(VALUE))
    return counted.select(F.lit("Kneedle").alias(METHOD), LABEL, VALUE).orderBy(F.desc(VALUE), LABEL)


def merge_ranks(df: DataFrame, label: str = LABEL, weight: str = "weight") -> DataFrame:
    """One row per label: in how many lists it is, and its largest weight."""
    return df.groupBy(st.quoted(label).alias(LABEL)).agg(
        F.count(F.lit(1)).alias("Inter_count"), F.max(weight).alias("weight_IndexValue")
    )


def combine_methods(ranks: DataFrame, top: int = TOP, compat: bool = False) -> DataFrame:
    """Key factors of several methods: weigh, cut each list at its knee, merge by label."""
    order = ranking(VALUE, LABEL)
    weighed = va.scale_importance(ranks, [METHOD], VALUE, compat).drop("percent")
    kept = cut_inclusive(kneedle(top_k(weighed, [METHOD], order, top), [METHOD], VALUE, order))
    return merge_ranks(kept).select(F.lit("Kneedle").alias(METHOD), LABEL, "Inter_count", "weight_IndexValue")
