"""The cleaning sequence: sparse columns, constants, outlier rows, scaling, indicators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from yieldlens.operators import columns as co, rows as ro, values as va

STEPS: tuple[Callable[[DataFrame], DataFrame], ...] = (
    co.drop_null_columns,
    co.drop_constant,
    ro.drop_iqr_outliers,
    va.zscore,
    va.one_hot,
)


def clean(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]] = STEPS) -> DataFrame:
    """Apply the steps in order; each reads its statistics in one pass and stays a projection or filter."""
    for step in steps:
        df = df.transform(step)
    return df
