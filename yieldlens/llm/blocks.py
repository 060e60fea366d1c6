"""A set of queries against all rows, block by block."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from yieldlens.llm.common import importable, spread


def _counts(df: DataFrame, cells: int) -> dict[int, int]:
    """Rows of each cell; there are ``cells`` at most."""
    return {r["cell"]: r["n"] for r in df.groupBy("cell").agg(F.count("*").alias("n")).limit(cells).collect()}


def against(
    queries: DataFrame, rows: DataFrame, cells: int, function: Callable, schema: str,
    also: list[str] | None = None, chunk: int = 512, block: int = 8192,
) -> DataFrame:
    """Run ``function(queries, rows)`` on each chunk of queries with each block of rows of the same cell.

    Both tables have a column ``cell`` with 0 to ``cells - 1``; columns ``also`` must agree as
    well. A cell's queries and rows are cut into shares of bounded size, dealt by row place and
    not by value, so that neither is ever whole in one task, however full a cell is. What is
    broadcast are the numbers of shares, one row for each cell.
    """
    spark = rows.sparkSession
    importable(spark)
    asked, there = _counts(queries, cells), _counts(rows, cells)
    plan = [
        (c, -(-asked[c] // chunk), -(-there[c] // block)) for c in sorted(asked) if c in there
    ]
    shares = F.broadcast(spark.createDataFrame(plan, "cell int, chunks int, blocks int"))
    left = (
        queries.withColumn("deal", spread(1 << 30, 11)).join(shares, "cell")
        .withColumn("chunk", F.col("deal") % F.col("chunks"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .drop("deal", "chunks", "blocks")
    )
    right = (
        rows.withColumn("deal", spread(1 << 30, 13)).join(shares, "cell")
        .withColumn("block", F.col("deal") % F.col("blocks"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .drop("deal", "chunks", "blocks")
    )
    by = ["cell", "chunk", "block", *(also or [])]

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return function(a, b)

    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, schema)
