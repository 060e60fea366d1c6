"""Inspection measurements to targets, and targets to modelling tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from yieldlens.operators import columns as co, rows as ro, statistics as st, values as va
from yieldlens.operators.guards import InputError, check_xy_inputs
from yieldlens.session import cut_lineage

# Column names and codes of the inspection export.
SHEET, TIME, MODEL = "sheet_id", "檢查日時", "model_no"
DEFECT, POINT, JUDGE, RESULT = "缺陷種類", "SUB POINT NO.", "判定", "測定結果"
KEY_NAMES = {"２次元CODE": SHEET, "品名": MODEL}
TARGETS = {
    "PSH": {"keep": {DEFECT: "HI", POINT: 1}, "pivot": JUDGE, "names": {"L": "Main_PSH", "O": "Sub_PSH"}},
    "CD": {"keep": {DEFECT: "LN", JUDGE: "L"}, "pivot": POINT, "names": {"1": "CDx", "2": "CDy"}},
}


def group_mean(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean per key combination; rows with a null key do not form groups."""
    return (
        df.na.drop("any", subset=[f"`{k}`" if "." in k else k for k in keys])
        .groupBy(*[st.quoted(k).alias(k) for k in keys])
        .agg(F.avg(st.quoted(value)).alias(value))
    )


def pivot_mean(df: DataFrame, key: str, pivot: str, value: str, names: Sequence, max_columns: int = 10_000) -> DataFrame:
    """One column per pivot value holding the mean; absent combinations are null.

    The pivot values are passed in, so no extra job lists them. A table can't have more than some thousand
    columns; ``group_mean`` with both keys gives the same means as rows, for any number of pivot values.
    """
    if len(names) > max_columns:
        raise ValueError(f"{len(names)} pivot columns; at most {max_columns} are allowed, group_mean gives them as rows")
    return df.groupBy(st.quoted(key).alias(key)).pivot(pivot, list(names)).agg(F.avg(st.quoted(value)))


def pivot_values(df: DataFrame, pivot: str, max_columns: int = 10_000) -> list:
    rows = df.select(st.quoted(pivot).alias("v")).where("v is not null").distinct().limit(max_columns + 1).collect()
    if len(rows) > max_columns:
        raise ValueError(f"more than {max_columns} values in {pivot}")
    return sorted(r["v"] for r in rows)


def measure_targets(inspection: DataFrame, target: str) -> DataFrame:
    """One row per sheet with the target columns; sheets that miss one are dropped.

    ``inspection`` has the real column names (see ``sources.headers``). A target whose
    data hold a single category keeps one column.
    """
    if target not in TARGETS:
        raise InputError(f"unknown target {target!r}; known: {sorted(TARGETS)}")
    rule = TARGETS[target]
    df = co.rename(inspection, KEY_NAMES)
    missing = [c for c in [SHEET, TIME, MODEL, DEFECT, POINT, JUDGE, RESULT] if c not in df.columns]
    if missing:
        raise InputError(f"the inspection table lacks columns {missing}")
    for c, v in rule["keep"].items():
        df = df.where(st.quoted(c).cast("string") == F.lit(str(v)))
    df = df.select(
        SHEET, TIME, MODEL, st.quoted(rule["pivot"]).cast("string").alias("_category"),
        st.quoted(RESULT).cast("double").alias("_result"),
    )
    means = group_mean(df, [SHEET, TIME, MODEL, "_category"], "_result")
    wide = pivot_mean(means, SHEET, "_category", "_result", pivot_values(df, "_category"))
    return co.rename(wide.na.drop("any"), rule["names"])


def join_xy(y: DataFrame, x: DataFrame, on: str = SHEET) -> DataFrame:
    """Inner join, target columns first."""
    return y.join(x, on, "inner")


def prepare_xy(
    x: DataFrame,
    inspection: DataFrame,
    target: str,
    max_null_ratio: float = 0.75,
    low: float = 0.025,
    high: float = 0.975,
) -> tuple[DataFrame, DataFrame]:
    """(X, Y) ready for modelling: join, sparse columns out, means in, numeric only, tails set, constants out.

    The joined table is checkpointed because four statistics passes read it.
    """
    check_xy_inputs(x, inspection)
    y = measure_targets(inspection, target)
    targets = [c.replace(" ", "_") for c in y.columns if c != SHEET]
    joined = co.rename(join_xy(y, x), replace=(" ", "_")).drop(SHEET)
    return finish_xy(joined, targets, max_null_ratio, low, high)


def finish_xy(
    joined: DataFrame, targets: Sequence[str], max_null_ratio: float = 0.75, low: float = 0.025, high: float = 0.975
) -> tuple[DataFrame, DataFrame]:
    joined = cut_lineage(joined)
    if joined.isEmpty():
        raise InputError("no sheet is in both tables")
    df = co.select_by_type(co.drop_null_columns(joined, max_null_ratio), "numerical")
    df = va.winsorize(va.impute_mean(df), low=low, high=high)
    df = co.drop_constant(df, nulls="value")
    gone = [c for c in targets if c not in df.columns]
    if gone:
        raise InputError(f"targets are empty or constant: {gone}")
    return co.split_xy(df, list(targets))
