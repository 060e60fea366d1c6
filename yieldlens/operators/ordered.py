"""Row positions and look-back windows that stay bounded when one key holds most rows.

A plain window sends all rows of a key to one task. Rows of keys over ``max_group_rows``
are range-sorted over all tasks instead, numbered by partition offsets, and cut in blocks
of equal length; each block also gets the ``look_back`` rows before it, so every window
value is the same as in one long window. All other keys keep the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from yieldlens.session import cut_lineage

MAX_GROUP_ROWS = 1_000_000
BLOCK_ROWS = 200_000


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    if not keys:
        return df.count()
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches null keys; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    if not keys:  # the right side is a total, one row
        renamed = F.broadcast(renamed)
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"`{k}`").eqNullSafe(F.col(f"`_right_{k}`"))
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def _cold_and_hot(df: DataFrame, keys: Sequence[str], max_group_rows: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of keys up to ``max_group_rows``, and rows of longer keys; None where there are none.

    There are at most rows / max_group_rows long keys.
    """
    if largest_group(df, keys) <= max_group_rows:
        return df, None
    if not keys:
        return None, df
    # a key is long only with max_group_rows rows, so there are few; broadcast, their rows stay where they are
    long_keys = F.broadcast(cut_lineage(df.groupBy(*keys).count().where(F.col("count") > max_group_rows).select(*keys)))
    return join_on(df, long_keys, keys, "left_anti"), join_on(df, long_keys, keys, "left_semi")


def _united(cold: DataFrame | None, hot: DataFrame | None) -> DataFrame:
    if cold is None or hot is None:
        return hot if cold is None else cold
    return cold.unionByName(hot)


def _range_ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    by = [*[F.col(f"`{k}`") for k in keys], *order]
    placed = cut_lineage(
        df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_position", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_position", 33))
    runs = placed.groupBy(*keys, "_part").agg(F.min("_position").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *keys, "_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    return (
        join_on(placed, runs, [*keys, "_part"])
        .withColumn(name, F.col("_position") + F.col("_shift"))
        .drop("_position", "_part", "_shift")
    )


def with_ordinal(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "ordinal",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """0-based position of each row inside its keys; ``order`` must leave no ties."""
    cold, hot = _cold_and_hot(df, keys, max_group_rows)
    if cold is not None:
        spec = Window.partitionBy(*keys).orderBy(*order)
        cold = cold.withColumn(name, F.row_number().over(spec).cast("long") - 1)
    if hot is not None:
        hot = _range_ordinal(hot, keys, order, name)
    return _united(cold, hot)


def look_back_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    look_back: int,
    build: Callable[[DataFrame, WindowSpec, WindowSpec | None], DataFrame],
    name: str = "ordinal",
    max_group_rows: int = MAX_GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Apply ``build(df, window, whole)`` where its columns read at most ``look_back`` earlier rows.

    ``whole`` is the window of a key's rows; it is None in blocks, where no task sees them
    all. Both calls must add the same columns.
    """
    cold, hot = _cold_and_hot(df, keys, max_group_rows)
    if cold is not None:
        spec = Window.partitionBy(*keys).orderBy(*order)
        numbered = cold.withColumn(name, F.row_number().over(spec).cast("long") - 1)
        cold = build(numbered, spec, Window.partitionBy(*keys))
    if hot is not None:
        placed = _range_ordinal(hot, keys, order, name)
        own = F.floor(F.col(name) / block_rows)
        reaches_next = F.pmod(F.col(name), F.lit(block_rows)) >= block_rows - look_back
        copies = F.when(reaches_next, F.array(own, own + 1)).otherwise(F.array(own))
        blocks = placed.withColumn("_block", F.explode(copies))
        built = build(blocks, Window.partitionBy(*keys, "_block").orderBy(name), None)
        hot = built.where(F.col("_block") == own).drop("_block")
    return _united(cold, hot)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    name: str,
    ordinal: str = "ordinal",
    max_group_rows: int = MAX_GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
    longest: int | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of the keys to this row, in ``ordinal`` order.

    ``longest``: rows of the longest key, where the caller has counted them on a cheaper table than ``df``.
    """
    if (largest_group(df, keys) if longest is None else longest) <= max_group_rows:
        spec = Window.partitionBy(*keys).orderBy(ordinal).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.sum(value).over(spec))
    # read twice below, and often the outcome of a sort
    blocks = cut_lineage(df.withColumn("_block", F.floor(F.col(ordinal) / block_rows)).withColumn("_value", value))
    sums = blocks.groupBy(*keys, "_block").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*keys, "_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_block").orderBy(ordinal).rowsBetween(Window.unboundedPreceding, 0)
    return (
        join_on(blocks, before, [*keys, "_block"])
        .withColumn(name, F.col("_before") + F.sum("_value").over(inside))
        .drop("_block", "_value", "_before")
    )


def run_ids(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    same: Sequence[str],
    name: str = "run_id",
    max_group_rows: int = MAX_GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Number the runs of consecutive rows with equal ``same`` columns."""

    def changed(frame: DataFrame, spec: WindowSpec, _whole) -> DataFrame:
        equal = F.lit(True)
        for c in same:
            equal = equal & F.lag(c).over(spec).eqNullSafe(F.col(f"`{c}`"))
        first = F.lag(F.lit(1)).over(spec).isNull()
        return frame.withColumn("_change", F.when(~first & equal, 0).otherwise(1))

    longest = largest_group(df, keys)
    marked = look_back_windows(df, keys, order, 1, changed, "_ordinal", max_group_rows, block_rows)
    return running_sum(marked, keys, F.col("_change"), name, "_ordinal", max_group_rows, block_rows, longest).drop(
        "_change", "_ordinal"
    )


def drop_adjacent_repeats(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    same: Sequence[str],
    max_group_rows: int = MAX_GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Drop each row whose ``same`` columns equal those of the row just before it."""

    def repeats(frame: DataFrame, spec: WindowSpec, _whole) -> DataFrame:
        equal = F.lag(F.lit(1)).over(spec).isNotNull()
        for c in same:
            equal = equal & F.lag(c).over(spec).eqNullSafe(F.col(f"`{c}`"))
        return frame.withColumn("_repeat", equal)

    marked = look_back_windows(df, keys, order, 1, repeats, "_ordinal", max_group_rows, block_rows)
    return marked.where(~F.col("_repeat")).drop("_repeat", "_ordinal")
