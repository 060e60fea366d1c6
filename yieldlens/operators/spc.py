"""Control charts: Q chart (short runs) and X-MR chart (individuals)."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from yieldlens.functions.probability import normal_upper_quantile, t5_upper_tail
from yieldlens.operators import ordered, statistics as st

# Window length, normal alpha, and d2 for ranges of two.
WINDOW_ROWS = 5
ALPHA = 0.025
D2 = 1.128


def q_limits(alpha: float = ALPHA) -> dict[str, float]:
    upper = -NormalDist().inv_cdf(alpha)
    return {"UCL": upper, "CL": 0.0, "LCL": -upper}


def rolling_statistics(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, **limits
) -> DataFrame:
    """Add ordinal, x_bar, s, s_bar (trailing five rows) and the moving range."""
    return ordered.look_back_windows(
        df, keys, order, 2 * (WINDOW_ROWS - 1), lambda d, w, _whole: _rolling(d, w, value), **limits
    )


def _rolling(df: DataFrame, spec: WindowSpec, value: str) -> DataFrame:
    x = st.quoted(value).cast("double")
    trailing = spec.rowsBetween(-(WINDOW_ROWS - 1), 0)
    return (
        df.withColumn("x_bar", F.avg(x).over(trailing))
        .withColumn("s", F.stddev_pop(x).over(trailing))
        .withColumn("s_bar", F.avg("s").over(trailing))
        .withColumn("moving_range", F.abs(x - F.lag(x).over(spec)))
    )


def q_statistic(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: str,
    compat: bool = False,
    **limits,
) -> DataFrame:
    """Add the rolling statistics and ``q_value``.

    Rows 0 and 1 and rows whose mean deviation is zero get 0. ``compat`` also gives 0
    where a very large jump would round the t probability to one.
    """
    return _q_rows(df, keys, order, value, compat, **limits).drop("_mr_bar", "_cl", "_in_blocks")


def _q_rows(df, keys, order, value, compat, **limits) -> DataFrame:
    """``q_statistic``, with the series' means _mr_bar and _cl where one window holds the series."""
    x = st.quoted(value).cast("double")

    def build(d: DataFrame, spec: WindowSpec, whole: WindowSpec | None) -> DataFrame:
        k = F.col("ordinal").cast("double")
        jump = x - F.lag("x_bar").over(spec)
        t = F.when(F.col("ordinal") >= 2, F.try_divide(F.sqrt(k / (k + 1)) * jump, F.col("s_bar")))
        rows = _rolling(d, spec, value).withColumn("t_value", t)
        means = {"_mr_bar": F.avg("moving_range"), "_cl": F.avg(x)}
        if whole is None:
            return rows.withColumns({c: F.lit(None).cast("double") for c in means}).withColumn("_in_blocks", F.lit(True))
        return rows.withColumns({c: m.over(whole) for c, m in means.items()}).withColumn("_in_blocks", F.lit(False))

    rolled = ordered.look_back_windows(df, keys, order, 2 * (WINDOW_ROWS - 1), build, **limits)
    tail = F.col("_tail")
    q = F.signum("t_value") * normal_upper_quantile(tail)
    if compat:
        q = F.when((F.col("t_value") > 0) & (F.lit(1.0) - tail == 1.0), F.lit(0.0)).otherwise(q)
    return (
        rolled.withColumn("_tail", t5_upper_tail(F.col("t_value")))
        .withColumn("q_value", F.coalesce(q, F.lit(0.0)))
        .drop("_tail")
    )


def xmr_limits(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, center: str = "range", **limits
) -> DataFrame:
    """Per series: mean moving range, sigma, ucl and cl of the X-MR chart."""
    x = st.quoted(value).cast("double")
    ranges = ordered.look_back_windows(
        df, keys, order, 1, lambda d, w, _whole: d.withColumn("moving_range", F.abs(x - F.lag(x).over(w))), **limits
    )
    return _limits(ranges, keys, value, center)


def _upper_limit(mr_bar: Column, mean: Column, center: str) -> Column:
    if center not in ("range", "mean"):
        raise ValueError("center must be 'range' or 'mean'")
    return (mr_bar if center == "range" else mean) + 3 * (mr_bar / D2)


def _limits(ranges: DataFrame, keys: Sequence[str], value: str, center: str) -> DataFrame:
    return (
        ranges.groupBy(*keys)
        .agg(F.avg("moving_range").alias("mr_bar"), F.avg(st.quoted(value).cast("double")).alias("cl"))
        .withColumn("sigma", F.col("mr_bar") / D2)
        .withColumn("ucl", _upper_limit(F.col("mr_bar"), F.col("cl"), center))
        .select(*keys, "mr_bar", "sigma", "ucl", "cl")
    )


def spc_table(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sheet: str,
    value: str,
    usl: float | None = None,
    alpha: float = ALPHA,
    center: str = "range",
    compat: bool = False,
    **limits,
) -> DataFrame:
    """Per row: Q value, x value and the three out-of-limit flags (upper side only)."""
    rolled = _q_rows(df, keys, order, value, compat, **limits)
    # series cut in blocks get their limits from an aggregation; without any, this join folds away
    in_blocks = _limits(rolled.where("_in_blocks"), keys, value, center).select(*keys, F.col("ucl").alias("_blocks_ucl"))
    joined = ordered.join_on(rolled, in_blocks, keys, "left").withColumn(
        "ucl", F.coalesce("_blocks_ucl", _upper_limit(F.col("_mr_bar"), F.col("_cl"), center))
    )
    x = st.quoted(value)
    spec_flag = F.lit(None).cast("boolean") if usl is None else x > F.lit(usl)
    return joined.select(
        *keys,
        "ordinal",
        st.quoted(sheet).alias("sheet_id"),
        F.col("q_value").alias("Q-value"),
        x.alias("x-value"),
        (F.col("q_value") > q_limits(alpha)["UCL"]).alias("Out of Q control limit"),
        (x > F.col("ucl")).alias("Out of X-MR control limit"),
        spec_flag.alias("Out of X-MR spec line"),
    )


def chart_tables(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sheet: str,
    value: str,
    usl: float | None = None,
    alpha: float = ALPHA,
    center: str = "range",
    **limits,
) -> tuple[DataFrame, DataFrame]:
    """What the two charts draw: points with colours, and one row of limits per series."""
    table = spc_table(df, keys, order, sheet, value, usl, alpha, center, **limits)
    colour = lambda flag: F.when(st.quoted(flag), "red").otherwise("black")
    points = table.select(
        *keys,
        "ordinal",
        "sheet_id",
        F.col("`Q-value`").alias("q_value"),
        colour("Out of Q control limit").alias("q_color"),
        F.col("`x-value`").alias("x_value"),
        colour("Out of X-MR control limit").alias("x_color"),
    )
    q = q_limits(alpha)
    lines = xmr_limits(df, keys, order, value, center, **limits).select(
        *keys,
        F.lit(q["UCL"]).alias("q_ucl"),
        F.lit(q["CL"]).alias("q_cl"),
        F.lit(q["LCL"]).alias("q_lcl"),
        F.col("ucl").alias("x_ucl"),
        F.col("cl").alias("x_cl"),
        F.lit(usl).cast("double").alias("x_usl"),
    )
    return points, lines
