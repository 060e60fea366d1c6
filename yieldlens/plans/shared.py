"""Inputs shared by the registered queries, and helpers for their SQL twins.

Column lists are written once, in the dialect both engines read, and used on both sides.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from yieldlens.functions import probability as pr
from yieldlens.session import cut_lineage  # noqa: F401  (re-exported for the plans)

DIGITS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round the fractional columns, so that the last bits of two engines' sums do not matter."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            F.round(F.col(f"`{c}`"), digits).alias(c) if kinds[c] in ("double", "float") else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def r6(expression: str, digits: int = DIGITS) -> str:
    return f"(round({expression}, {digits}) + 0.0)"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name in the shared checkpoint folder."""
    cut_lineage(spark.range(1))  # makes sure the folder is known
    return os.path.join(spark.sparkContext.getCheckpointDir(), f"table-{uuid.uuid4().hex}")


# lineitem as a wide process table with missing values and constants
PROCESS = [
    "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "CASE WHEN l_quantity > 45 THEN NULL ELSE l_extendedprice END AS some_holes",
    "CASE WHEN l_quantity > 25 THEN NULL ELSE l_discount END AS many_holes",
    "CASE WHEN l_quantity > 45 THEN NULL WHEN l_quantity < 5 THEN '' ELSE l_returnflag END AS grade",
    "7 AS fixed_number", "'line-1' AS fixed_text",
    "CASE WHEN l_quantity > 45 THEN NULL ELSE 1 END AS holed_constant",
    "CAST(NULL AS DOUBLE) AS empty_number",
    "l_linenumber AS station1_rework_flag",
]


def process(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*PROCESS)


PROCESS_SQL = f"(SELECT {', '.join(PROCESS)} FROM lineitem)"

# lineitem as one row per inspected unit on its way through the tools
STAR = "lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
UNITS = [
    "CASE r_regionkey % 3 WHEN 0 THEN 'ARRAY' WHEN 1 THEN 'CF' ELSE 'CELL' END AS site",
    "p_type AS Parameter",
    "concat('L', CAST(l_partkey % 3 AS STRING)) AS line_id",
    "concat('T', CAST(l_suppkey % 8 AS STRING)) AS tool_id",
    "concat('U', CAST(l_orderkey % 4 AS STRING)) AS unit_name",
    "CASE WHEN l_linenumber = 7 THEN 'None' ELSE concat('C', CAST(l_linenumber AS STRING)) END AS chmb",
    "CASE WHEN l_returnflag = 'R' OR (l_suppkey % 8 = 3 AND l_quantity > 45) THEN 1 ELSE 0 END AS NG_num",
    "1 AS Total_num",
]


def units(spark, sf_dir) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "part", "supplier", "nation", "region")}
    return (
        t["lineitem"]
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(*UNITS)
    )


UNITS_SQL = f"(SELECT {', '.join(UNITS)} FROM {STAR})"

# lineitem with its order and part as transactions; 0 stands for an operation that was not passed
ITEMS = ["l_linestatus", "o_orderstatus", "p_type", "o_orderpriority", "station"]
TRANSACTIONS = [
    "CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN 0 ELSE 2 END AS Y",
    "l_linestatus", "o_orderstatus",
    "CASE WHEN l_quantity > 45 THEN NULL ELSE p_type END AS p_type",
    "o_orderpriority",
    "CASE WHEN l_linenumber > 5 THEN 0 ELSE l_linenumber END AS station",
    "p_size AS station1_rework_flag",
]


def transactions(spark, sf_dir, *more: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "part")}
    return (
        t["lineitem"]
        .join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr(*TRANSACTIONS, *more)
    )


TRANSACTIONS_SQL = (
    f"(SELECT {', '.join(TRANSACTIONS)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN part ON l_partkey = p_partkey)"
)

# lineitem as an inspection export, orders as its process table
INSPECTION = [
    "CAST(l_orderkey AS STRING) AS sheet", "CAST(CAST(l_shipdate AS DATE) AS STRING) AS taken",
    "l_linestatus AS model", "CASE WHEN l_discount > 0.05 THEN 'LN' ELSE 'HI' END AS defect",
    "l_linenumber % 2 + 1 AS point", "CASE WHEN l_returnflag = 'R' THEN 'O' ELSE 'L' END AS judge",
    "CAST(l_quantity + l_tax AS STRING) AS result",
]
INSPECTION_NAMES = ["２次元CODE", "檢查日時", "品名", "缺陷種類", "SUB POINT NO.", "判定", "測定結果"]
SHEETS = [
    "CAST(o_orderkey AS STRING) AS sheet_id", "o_totalprice",
    "CASE WHEN o_totalprice > 450000 THEN NULL ELSE o_custkey END AS `customer no`",
    "CASE WHEN o_totalprice > 50000 THEN NULL ELSE o_totalprice END AS nearly_empty",
    "o_orderpriority", "3 AS fixed_number", "o_totalprice / 7 + o_custkey AS pressure",
]


def inspection(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*INSPECTION).toDF(*INSPECTION_NAMES)


def sheets(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*SHEETS)


INSPECTION_SQL = f"(SELECT {', '.join(INSPECTION)} FROM lineitem)"
SHEETS_SQL = "(SELECT " + ", ".join(SHEETS).replace("`customer no`", "customer_no") + " FROM orders)"


# revenue share as rank lists: one list per market, one label per nation and brand
def market_ranks(spark, sf_dir) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "supplier", "part")}
    return (
        t["lineitem"]
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_type").alias("Method"), F.col("p_brand").alias("OPID_TOOLID"))
        .agg(F.count_if(F.col("l_quantity") > 40).cast("double").alias("IndexValue"))
    )


RANKS_SQL = (
    "(SELECT p_type AS \"Method\", p_brand AS \"OPID_TOOLID\", "
    "CAST(count(*) FILTER (WHERE l_quantity > 40) AS DOUBLE) AS \"IndexValue\" "
    "FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"
)


def _sql_polynomial(x: str, coefficients) -> str:
    text = repr(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c!r})"
    return text


def _sql_ratio(x: str, pair) -> str:
    return f"({_sql_polynomial(x, pair[0])} / {_sql_polynomial(x, pair[1])})"


def sql_upper_quantile(p: str) -> str:
    """z with P(Z > z) = p, 0 < p <= 1/2."""
    q, r = f"(0.5 - {p})", f"sqrt(-ln({p}))"
    return (
        f"CASE WHEN {q} <= 0.425 THEN {q} * {_sql_ratio(f'(0.180625 - {q} * {q})', pr.NORMAL_CENTRE)} "
        f"WHEN {r} <= 5 THEN {_sql_ratio(f'({r} - 1.6)', pr.NORMAL_TAIL)} "
        f"ELSE {_sql_ratio(f'({r} - 5.0)', pr.NORMAL_FAR_TAIL)} END"
    )


def sql_t5_upper_tail(t: str) -> str:
    phi = f"atan(sqrt(5.0) / abs({t}))"
    return f"(({phi} - sin({phi}) * cos({phi}) * (1 + 2.0 / 3.0 * sin({phi}) * sin({phi}))) / pi())"


def sql_chi2_upper_tail(x: str, k: str) -> str:
    """One minus the series of the lower incomplete gamma function."""
    terms = f"list_transform(range(0, 400), lambda j: exp(({k} / 2.0 + j) * ln({x} / 2.0) - {x} / 2.0 - lgamma({k} / 2.0 + j + 1)))"
    return f"CASE WHEN {x} <= 0 THEN 1.0 ELSE 1 - list_sum({terms}) END"
