"""Column statistics: one aggregation for all columns, exact quantiles, modes."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from yieldlens.session import cut_lineage

SMALL_CELLS = 2_000_000
BRACKET_ROWS = 20_000
SKETCH = 10_000
COLLAPSE_SHARE = 0.1


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def orderable_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]


def summarise(df: DataFrame, columns: Sequence[str], **measures) -> dict[str, dict]:
    """Evaluate every measure on every column in one pass: ``{measure: {column: value}}``."""
    if not columns:
        return {m: {} for m in measures}
    expressions = [
        fn(quoted(c)).alias(f"{m}_{i}") for m, fn in measures.items() for i, c in enumerate(columns)
    ]
    row = df.agg(*expressions).first()
    return {m: {c: row[f"{m}_{i}"] for i, c in enumerate(columns)} for m in measures}


def null_ratios(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float]:
    columns = list(columns if columns is not None else df.columns)
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    row = row.first()
    return {c: (row["rows"] - row[f"c{i}"]) / row["rows"] if row["rows"] else 0.0 for i, c in enumerate(columns)}


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    small_cells: int = SMALL_CELLS,
    bracket_rows: int = BRACKET_ROWS,
    sketch: int = SKETCH,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of every column, exact at any size.

    Few cells: one ``percentile`` aggregation. Beyond that the wanted order statistics
    are bracketed by a quantile sketch, the brackets are counted exactly and narrowed
    again until each holds at most ``bracket_rows`` rows, and only those are sorted.
    Every pass is a map-side aggregation of the pruned columns; nothing is shuffled
    but the partial states.
    """
    columns = list(columns)
    if not columns:
        return {}
    counts = summarise(df, columns, n=F.count)["n"]
    if sum(counts.values()) <= small_cells:
        probes = F.array(*[F.lit(float(p)) for p in probabilities])
        found = summarise(df, columns, q=lambda c: F.percentile(c.cast("double"), probes))["q"]
        return {c: list(found[c]) if found[c] is not None else [None] * len(probabilities) for c in columns}

    wanted = {}
    for c in columns:
        for p in probabilities:
            position = p * (counts[c] - 1)
            for rank in {math.floor(position), math.ceil(position)}:
                if counts[c]:
                    wanted[c, rank] = None
    statistics = _order_statistics(df, wanted, counts, bracket_rows, sketch)
    result = {}
    for c in columns:
        result[c] = []
        for p in probabilities:
            if not counts[c]:
                result[c].append(None)
                continue
            position = p * (counts[c] - 1)
            low, high = math.floor(position), math.ceil(position)
            a, b = statistics[c, low], statistics[c, high]
            result[c].append(a + (b - a) * (position - low))
    return result


def _order_statistics(df, wanted, counts, bracket_rows, sketch) -> dict:
    """Exact values at 0-based ranks: ``{(column, rank): value}``."""
    done = {}
    # (column, rank) -> (low, high, rows below low, rows inside the closed bracket)
    open_brackets = {key: (None, None, 0, counts[key[0]]) for key in wanted}
    while open_brackets:
        ready = {k: b for k, b in open_brackets.items() if b[3] <= bracket_rows}
        if ready:
            keys = list(ready)
            row = df.agg(
                *[
                    F.element_at(
                        F.sort_array(F.collect_list(_inside(k[0], ready[k]))), int(k[1] - ready[k][2]) + 1
                    ).alias(f"v{i}")
                    for i, k in enumerate(keys)
                ]
            ).first()
            done.update({k: row[f"v{i}"] for i, k in enumerate(keys)})
        wide = {k: b for k, b in open_brackets.items() if k not in ready}
        if not wide:
            break
        keys = list(wide)
        probes = []
        for k in keys:
            inside = max(wide[k][3] - 1, 1)
            centre = (k[1] - wide[k][2]) / inside
            margin = 2.0 / sketch
            probes.append([max(0.0, centre - margin), min(1.0, centre + margin)])
        row = df.agg(
            *[
                F.percentile_approx(_inside(k[0], wide[k]), probes[i], sketch).alias(f"v{i}")
                for i, k in enumerate(keys)
            ]
        ).first()
        limits = {k: list(row[f"v{i}"]) for i, k in enumerate(keys)}
        cells = [quoted(k[0]).cast("double") for k in keys]
        row = df.agg(
            *[F.count_if(c < F.lit(limits[k][0])).alias(f"under_low_{i}") for i, (k, c) in enumerate(zip(keys, cells))],
            *[F.count_if(c <= F.lit(limits[k][0])).alias(f"to_low_{i}") for i, (k, c) in enumerate(zip(keys, cells))],
            *[F.count_if(c < F.lit(limits[k][1])).alias(f"under_high_{i}") for i, (k, c) in enumerate(zip(keys, cells))],
            *[F.count_if(c <= F.lit(limits[k][1])).alias(f"to_high_{i}") for i, (k, c) in enumerate(zip(keys, cells))],
        ).first()
        open_brackets = {}
        for i, k in enumerate(keys):
            low, high = limits[k]
            old_low, old_high, old_below, old_inside = wide[k]
            rank = k[1]
            if rank < row[f"under_low_{i}"]:
                bracket = (old_low, low, old_below, row[f"to_low_{i}"] - old_below)
            elif rank < row[f"to_low_{i}"]:
                done[k] = low
                continue
            elif rank < row[f"under_high_{i}"]:
                bracket = (low, high, row[f"under_low_{i}"], row[f"to_high_{i}"] - row[f"under_low_{i}"])
            elif rank < row[f"to_high_{i}"]:
                done[k] = high
                continue
            else:
                below = row[f"under_high_{i}"]
                bracket = (high, old_high, below, old_below + old_inside - below)
            if bracket[3] >= old_inside:
                sketch *= 10  # too coarse to narrow this bracket
            open_brackets[k] = bracket
    return done


def _inside(column: str, bracket) -> Column:
    value = quoted(column).cast("double")
    low, high = bracket[0], bracket[1]
    keep = F.lit(True)
    if low is not None:
        keep = keep & (value >= F.lit(low))
    if high is not None:
        keep = keep & (value <= F.lit(high))
    return F.when(keep, value)


def collapse(df: DataFrame, share: float = COLLAPSE_SHARE) -> DataFrame:
    """Equal rows become one row with their number ``_w``, where that pays.

    A distinct-count sketch decides: above ``share`` of the rows the shuffle would save
    nothing, and every row keeps ``_w`` = 1. The collapsed table is checkpointed, so
    several passes over it read the source once.
    """
    columns = [quoted(c) for c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(*columns)).alias("kinds")).first()
    if row["kinds"] > share * row["rows"]:
        return df.withColumn("_w", F.lit(1).cast("long"))
    return cut_lineage(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_w")))


def spread(df: DataFrame) -> DataFrame:
    """Persist, and deal a table of fewer partitions than cores out to all of them; training makes many passes."""
    kept = df.persist()
    kept.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if kept.rdd.getNumPartitions() >= cores:
        return kept
    dealt = kept.repartition(cores).persist()
    dealt.count()
    kept.unpersist()
    return dealt


def value_counts(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Long table (column_name, value, n) of the distinct non-null values, pre-aggregated per task."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), quoted(c).cast(kind).alias("value")) for c in columns]
    )
    return (
        df.select(F.explode(cells).alias("cell"))
        .select("cell.*")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(counts: DataFrame) -> DataFrame:
    """Per column the distinct count and the most frequent value, the smallest on a tie."""
    first = F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("value")))
    return (
        counts.groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n_distinct"), first.alias("first"))
        .select("column_name", "n_distinct", F.col("first.value").alias("mode"), (-F.col("first.n")).alias("mode_n"))
    )


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows, null ratio, distinct count, mode, and for numbers the five-figure summary."""
    columns = list(columns if columns is not None else orderable_columns(df))
    numeric = [c for c in numeric_columns(df) if c in columns]
    texts = [c for c in columns if c not in numeric]
    spark = df.sparkSession
    nulls = null_ratios(df, columns)
    spread = summarise(
        df, numeric, min=lambda c: F.min(c.cast("double")), max=lambda c: F.max(c.cast("double")),
        mean=F.avg, std=F.stddev_pop,
    )
    quartiles = exact_quantiles(df, numeric, [0.25, 0.75])
    figures = [
        (
            c, float(nulls[c]),
            *[spread[m].get(c) for m in ("min", "max", "mean", "std")],
            *quartiles.get(c, [None, None]),
        )
        for c in columns
    ]
    schema = "column_name string, null_ratio double, min double, max double, mean double, std double, q1 double, q3 double"
    table = spark.createDataFrame(figures, schema)
    found = None
    for group, kind in ((numeric, "double"), (texts, "string")):
        if group:
            part = modes(value_counts(df, group, kind)).withColumn("mode", F.col("mode").cast("string"))
            found = part if found is None else found.unionByName(part)
    return (
        table.join(found, "column_name", "left")
        .withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
        .select("column_name", "null_ratio", "n_distinct", "mode", "min", "max", "mean", "std", "q1", "q3")
    )
