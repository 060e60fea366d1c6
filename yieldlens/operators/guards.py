"""Input checks that raise before any heavy job starts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


class InputError(ValueError):
    """The tables or arguments cannot be analysed."""


# The first columns that tell the two uploads apart.
PROCESS_FIRST = "sheet_id"
INSPECTION_FIRST = ("PS　特性檢查機", "２次元CODE")


def check_xy_inputs(x: DataFrame, y: DataFrame, compare_rows: bool = False) -> None:
    """Raise when X and Y are the same table or are swapped.

    Sameness is judged by schema; ``compare_rows`` also compares the rows.
    """
    same = x.schema == y.schema
    if same and compare_rows:
        same = x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()
    if same and x.columns[0] == PROCESS_FIRST:
        raise InputError("both tables are process tables (X)")
    if same and x.columns[0] in INSPECTION_FIRST:
        raise InputError("both tables are inspection tables (Y)")
    if x.columns[0] in INSPECTION_FIRST and y.columns[0] == PROCESS_FIRST:
        raise InputError("the process table and the inspection table are swapped")


def check_bounds(
    features: Sequence[str],
    controls: Sequence[str],
    bounds: Sequence[Sequence[float]],
    targets: Sequence[float] | None = None,
    **positive: int,
) -> None:
    """Types and lengths of the recommendation arguments."""
    if not isinstance(controls, list):
        raise TypeError("controls must be a list")
    if not isinstance(bounds, list):
        raise TypeError("bounds must be a list")
    if len(bounds) != 2:
        raise ValueError("bounds must hold the lower and the upper list")
    if len(bounds[0]) != len(bounds[1]):
        raise ValueError("the lower and the upper bounds differ in length")
    if len(bounds[0]) != len(features):
        raise ValueError("bounds and features differ in length")
    if any(a > b for a, b in zip(*bounds)):
        raise ValueError("a lower bound is above its upper bound")
    unknown = [c for c in controls if c not in features]
    if unknown:
        raise ValueError(f"unknown controls: {unknown}")
    if targets is not None and not isinstance(targets, list):
        raise TypeError("targets must be a list")
    for name, value in positive.items():
        if not isinstance(value, int) or isinstance(value, bool):
            raise TypeError(f"{name} must be an integer")
        if value < 1:
            raise ValueError(f"{name} must be at least 1")
