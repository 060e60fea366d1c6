"""Column selection, renames and type changes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from yieldlens.operators import statistics as st


def cast_all_string(df: DataFrame) -> DataFrame:
    return df.select(*[st.quoted(c).cast("string").alias(c) for c in df.columns])


def drop_columns_like(df: DataFrame, text: str = "rework_flag") -> DataFrame:
    return df.select(*[st.quoted(c) for c in df.columns if text not in c])


def rename(df: DataFrame, mapping: Mapping[str, str] | None = None, replace: tuple[str, str] | None = None) -> DataFrame:
    """Rename by mapping, then replace a substring in every name (for example blanks)."""
    names = [(mapping or {}).get(c, c) for c in df.columns]
    if replace is not None:
        names = [n.replace(*replace) for n in names]
    return df.toDF(*names)


def select_by_type(df: DataFrame, kind: str, override: Sequence[str] | None = None) -> DataFrame:
    """Numeric or categorical columns in table order; ``override`` names that kind's columns instead."""
    if kind not in ("numerical", "categorical"):
        raise ValueError("kind must be 'numerical' or 'categorical'")
    return df.select(*[st.quoted(c) for c in columns_of_type(df, kind, override)])


def columns_of_type(df: DataFrame, kind: str, override: Sequence[str] | None = None) -> list[str]:
    if override is not None:
        return [c for c in df.columns if c in set(override)]
    numeric = set(st.numeric_columns(df))
    return [c for c in df.columns if (c in numeric) == (kind == "numerical")]


def drop_null_columns(df: DataFrame, max_ratio: float = 0.2, inclusive: bool = True) -> DataFrame:
    """Drop columns whose null ratio reaches ``max_ratio`` (``inclusive``) or exceeds it."""
    ratios = st.null_ratios(df)
    over = {c for c, r in ratios.items() if (r >= max_ratio if inclusive else r > max_ratio)}
    return df.select(*[st.quoted(c) for c in df.columns if c not in over])


def constant_columns(df: DataFrame, columns: Sequence[str], nulls: str = "ignore") -> list[str]:
    """Columns with one distinct value.

    ``nulls="ignore"`` counts non-null values only, so an all-null column is not constant;
    ``nulls="value"`` counts null as a value of its own.
    """
    if nulls not in ("ignore", "value"):
        raise ValueError("nulls must be 'ignore' or 'value'")
    found = st.summarise(df, columns, low=F.min, high=F.max, holes=lambda c: F.count_if(c.isNull()))
    constant = []
    for c in columns:
        low, high, holes = found["low"][c], found["high"][c], found["holes"][c] or 0
        if nulls == "ignore":
            same = low is not None and low == high
        else:
            distinct = 0 if low is None else (1 if low == high else 2)
            same = distinct + (holes > 0) <= 1
        if same:
            constant.append(c)
    return constant


def drop_constant(df: DataFrame, nulls: str = "ignore", kind: str | None = None) -> DataFrame:
    """Drop constant columns, of one ``kind`` (numerical, categorical) or of any."""
    checked = set(st.orderable_columns(df))
    if kind is not None:
        checked &= set(columns_of_type(df, kind))
    gone = set(constant_columns(df, [c for c in df.columns if c in checked], nulls))
    return df.select(*[st.quoted(c) for c in df.columns if c not in gone])


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Keep the first of equally named columns."""
    names = df.columns
    numbered = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return numbered.select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(names) if names.index(n) == i])


def target_columns(df: DataFrame, targets: str | Sequence[str] | Callable[[str], bool]) -> list[str]:
    """Target names given as one name, a list, or a test such as ``lambda c: "Ylabel_" in c``."""
    if callable(targets):
        return [c for c in df.columns if targets(c)]
    wanted = [targets] if isinstance(targets, str) else list(targets)
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"target columns are missing: {missing}")
    return wanted


def split_xy(df: DataFrame, targets: str | Sequence[str] | Callable[[str], bool]) -> tuple[DataFrame, DataFrame]:
    """(X, Y) by column name."""
    y = target_columns(df, targets)
    if not y:
        raise ValueError("no target column is left")
    return df.select(*[st.quoted(c) for c in df.columns if c not in y]), df.select(*[st.quoted(c) for c in y])
