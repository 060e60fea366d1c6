"""Value transforms: outliers, missing values, scaling and encoding."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from yieldlens.operators import columns as co, statistics as st
from yieldlens.operators.ordered import join_on, with_ordinal
from yieldlens.session import cut_lineage

BROADCAST_BYTES = 32 << 20
SALTS = 32


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else st.quoted(c) for c in df.columns])


def winsorize(
    df: DataFrame, columns: Sequence[str] | None = None, low: float = 0.025, high: float = 0.975
) -> DataFrame:
    """Set values beyond the two quantiles to the quantile; nulls stay."""
    columns = list(columns if columns is not None else st.numeric_columns(df))
    limits = st.exact_quantiles(df, columns, [low, high])
    new = {}
    for c, (a, b) in limits.items():
        value = st.quoted(c).cast("double")
        new[c] = value if a is None else F.when(value < a, F.lit(a)).when(value > b, F.lit(b)).otherwise(value)
    return _replace(df, new)


def impute_mean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns if columns is not None else st.numeric_columns(df))
    found = st.summarise(df, columns, mean=F.avg, holes=lambda c: F.count_if(c.isNull()))
    new = {
        c: F.coalesce(st.quoted(c).cast("double"), F.lit(found["mean"][c]))
        for c in columns
        if found["holes"][c] and found["mean"][c] is not None
    }
    return _replace(df, new)


def impute_mode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """In columns that hold nulls, replace null and the empty string by the most frequent value.

    Ties go to the smallest value. Distinct values are counted with partial
    aggregation, so no task holds all values of a column.
    """
    columns = list(columns if columns is not None else st.orderable_columns(df))
    holes = st.summarise(df, columns, n=lambda c: F.count_if(c.isNull()))["n"]
    open_columns = [c for c in columns if holes[c]]
    types = {f.name: f.dataType for f in df.schema}
    by_kind: dict[str, list[str]] = {}
    for c in open_columns:
        t = types[c]
        kind = "string" if isinstance(t, T.StringType) else "double" if isinstance(t, (T.FloatType, T.DoubleType)) else t.simpleString()
        by_kind.setdefault(kind, []).append(c)
    new = {}
    for kind, group in by_kind.items():
        for r in st.modes(st.value_counts(df, group, kind)).collect():  # one row per column
            c = r["column_name"]
            value, fill = st.quoted(c), F.lit(r["mode"]).cast(types[c])
            missing = value.isNull() | (value == "") if kind == "string" else value.isNull()
            new[c] = F.when(missing, fill).otherwise(value)
    return _replace(df, new)


def impute_zero(df: DataFrame, text: str = "0") -> DataFrame:
    """Null becomes 0 in numeric columns and ``text`` in string columns."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    new = {c: F.coalesce(st.quoted(c), F.lit(0).cast(dict(df.dtypes)[c])) for c in st.numeric_columns(df)}
    new.update({c: F.coalesce(st.quoted(c), F.lit(text)) for c in texts})
    return _replace(df, new)


@dataclass(frozen=True)
class Scaler:
    """Means and population standard deviations, as applied to the training columns."""

    means: dict[str, float]
    stds: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return _replace(
            df,
            {
                c: (st.quoted(c).cast("double") - F.lit(m)) / F.lit(self.stds[c])
                for c, m in self.means.items()
                if c in df.columns and m is not None
            },
        )

    def save(self, spark, path: str) -> None:
        rows = [(c, m, self.stds[c]) for c, m in self.means.items()]
        spark.createDataFrame(rows, "feature string, mean double, std double").coalesce(1).write.parquet(path)

    @staticmethod
    def load(spark, path: str) -> "Scaler":
        rows = spark.read.parquet(path).collect()  # one row per column
        return Scaler({r.feature: r["mean"] for r in rows}, {r.feature: r["std"] for r in rows})


def fit_scaler(df: DataFrame, columns: Sequence[str] | None = None) -> Scaler:
    columns = list(columns if columns is not None else st.numeric_columns(df))
    found = st.summarise(df, columns, mean=lambda c: F.avg(c.cast("double")), std=lambda c: F.stddev_pop(c.cast("double")))
    return Scaler(found["mean"], {c: s if s else 1.0 for c, s in found["std"].items()})


def zscore(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column is only centred."""
    return fit_scaler(df, columns).transform(df)


def category_levels(df: DataFrame, columns: Sequence[str], max_levels: int = 1000) -> dict[str, list]:
    """Sorted distinct values of each column; raises beyond ``max_levels`` per column on average."""
    types = dict(df.dtypes)
    levels: dict[str, list] = {c: [] for c in columns}
    limit = max_levels * max(len(columns), 1)
    for kind in sorted({types[c] for c in columns}):
        group = [c for c in columns if types[c] == kind]
        rows = st.value_counts(df, group, kind).select("column_name", "value").limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"more than {max_levels} levels per column; raise max_levels or use sparse_one_hot")
        for r in rows:
            levels[r["column_name"]].append(r["value"])
    return {c: sorted(v) for c, v in levels.items()}


def level_text(value) -> str:
    return str(value)


def one_hot(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    prefix: Sequence[str] | None = None,
    drop_first: bool = False,
    max_levels: int = 1000,
) -> DataFrame:
    """Replace columns by 0/1 indicators ``column_level``, levels sorted; null gives all zeros."""
    columns = list(columns if columns is not None else co.columns_of_type(df, "categorical"))
    heads = dict(zip(columns, prefix or columns))
    levels = category_levels(df, columns, max_levels)
    dummies = [
        F.when(st.quoted(c) == F.lit(v), 1).otherwise(0).alias(f"{heads[c]}_{level_text(v)}")
        for c in columns
        for v in levels[c][1 if drop_first else 0 :]
    ]
    return df.select(*[st.quoted(c) for c in df.columns if c not in columns], *dummies)


@dataclass(frozen=True)
class Levels:
    """``table``: column_name, value (as text), id; the ids of a column are the next to those of the column before it.

    ``starts``: first id of each column and, last, the number of ids; ``size``: bytes of the texts by column.
    """

    table: DataFrame
    starts: list[int]
    size: dict[str, int]

    @property
    def width(self) -> int:
        return self.starts[-1]


def level_value(value: Column, kind: str) -> Column:
    """A value as text, so that equal values have equal texts; null stays null."""
    if kind in ("double", "float"):
        value = F.when(value == 0, F.lit(0.0).cast(kind)).otherwise(value)  # -0.0 equals 0.0
    text = value.cast("string")
    return F.initcap(text) if kind == "boolean" else text


def level_table(df: DataFrame, columns: Sequence[str], drop_first: bool = False) -> Levels:
    """Number the distinct values of all columns, in sorted order column by column; null is no value.

    Values are counted, sorted and numbered on executors, however many there are; the driver gets one
    row a column. ``drop_first`` leaves out the first value of each column.
    """
    types = dict(df.dtypes)
    parts = []
    for kind in sorted({types[c] for c in columns}):
        group = [c for c in columns if types[c] == kind]
        values = cut_lineage(st.value_counts(df, group, kind).drop("n"))
        placed = with_ordinal(values, ["column_name"], [F.col("value").asc()], "_rank")
        parts.append(placed.select("column_name", level_value(F.col("value"), kind).alias("value"), "_rank"))
    if not parts:
        return Levels(df.sparkSession.createDataFrame([], "column_name string, value string, id int"), [0], {})
    first = 1 if drop_first else 0
    ranked = cut_lineage(functools.reduce(DataFrame.unionByName, parts).where(F.col("_rank") >= first))
    rows = ranked.groupBy("column_name").agg(F.count("*").alias("n"), F.sum(F.octet_length("value") + 64).alias("size")).collect()
    counts, size = {r["column_name"]: r["n"] for r in rows}, {r["column_name"]: r["size"] for r in rows}
    starts = [0]
    for c in columns:
        starts.append(starts[-1] + counts.get(c, 0))
    offset = F.create_map(*[F.lit(x) for c, s in zip(columns, starts) for x in (c, s - first)])
    table = ranked.select("column_name", "value", (F.col("_rank") + offset[F.col("column_name")]).cast("int").alias("id"))
    return Levels(table, starts, size)


def encode_levels(
    df: DataFrame, columns: Sequence[str], levels: Levels, output: str = "ids",
    broadcast_bytes: int = BROADCAST_BYTES, salts: int = SALTS,
) -> DataFrame:
    """Add the rising ids of a row's values as one array; values that are null or not in ``levels`` have none.

    A column's levels are broadcast up to ``broadcast_bytes``, as counted; beyond, the join is salted by the
    row's other values, since one value may be in a third of all rows.
    """
    types = dict(df.dtypes)
    texts = {c: level_value(st.quoted(c), types[c]) for c in columns}
    salt = F.pmod(F.xxhash64(*[st.quoted(c) for c, kind in df.dtypes if not kind.startswith("map")]), F.lit(salts)).cast("int")
    coded = df.withColumns({f"_text{i}": text for i, text in enumerate(texts.values())}).withColumn("_salt", salt)
    for i, c in enumerate(columns):
        own = levels.table.where(F.col("column_name") == c).select(F.col("value").alias("_level"), F.col("id").alias(f"_id{i}"))
        match = F.col(f"_text{i}") == F.col("_level")
        if levels.size.get(c, 0) <= broadcast_bytes:
            own = F.broadcast(own)
        else:
            own = own.withColumn("_level_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            match = match & (F.col("_salt") == F.col("_level_salt"))
        coded = coded.join(own, match, "left").drop("_level", "_level_salt")
    ids = [F.col(f"_id{i}") for i in range(len(columns))]
    return coded.withColumn(output, F.array_compact(F.array(*ids) if ids else F.array().cast("array<int>"))).drop(
        "_salt", *[f"_text{i}" for i in range(len(columns))], *[f"_id{i}" for i in range(len(columns))]
    )


def sparse_one_hot(df: DataFrame, columns: Sequence[str], output: str = "features") -> tuple[DataFrame, Levels]:
    """Indicators as one sparse vector, for any number of levels: (frame, levels); null gives all zeros."""
    from pyspark.ml.linalg import Vectors, VectorUDT

    levels = level_table(df, columns)
    width = levels.width
    vector = F.udf(lambda ids: Vectors.sparse(width, ids, [1.0] * len(ids)), VectorUDT())
    coded = encode_levels(df, columns, levels, "_ids")
    return coded.withColumn(output, vector("_ids")).drop("_ids"), levels


def item_value(df: DataFrame, column: str) -> Column:
    """The cell as text; null reads ``nan``."""
    value = st.quoted(column)
    if dict(df.dtypes)[column] == "boolean":
        value = F.initcap(value.cast("string"))
    return F.coalesce(value.cast("string"), F.lit("nan"))


def item_text(df: DataFrame, column: str) -> Column:
    """``column=value``."""
    return F.concat(F.lit(f"{column}="), item_value(df, column))


def encode_items(df: DataFrame, columns: Sequence[str], output: str | None = None) -> DataFrame:
    """Write cells as items, in place or as one array column ``output``."""
    if output is not None:
        return df.withColumn(output, F.array(*[item_text(df, c) for c in columns]))
    return _replace(df, {c: item_text(df, c) for c in columns})


def items_to_string(items: Column) -> Column:
    return F.array_join(F.array_sort(items), ",")


def round_half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def scale_importance(df: DataFrame, keys: Sequence[str], value: str, compat: bool = False) -> DataFrame:
    """Add ``percent`` (x 100) and ``weight`` (value over the list's mean).

    The mean is of absolute values, so a list with negative entries keeps its order;
    ``compat`` divides by the signed mean.
    """
    size = st.quoted(value) if compat else F.abs(st.quoted(value))
    means = df.groupBy(*keys).agg(F.avg(size).alias("_mean"))
    weight = F.try_divide(st.quoted(value), F.col("_mean"))
    return (
        join_on(df, means, keys)
        .withColumn("percent", st.quoted(value) * 100)
        .withColumn("weight", weight)
        .drop("_mean")
    )
