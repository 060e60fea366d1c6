"""Tables whose real header, or column types, are in the first lines of the data."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from yieldlens.operators import statistics as st
from yieldlens.sources.tables import nan_to_null

# The type words of the header line.
CATEGORICAL, CONTINUOUS = "categorical", "continuous"


def _first_lines(spark: SparkSession, path: str, n: int) -> list[list[str]]:
    first = sorted(spark.read.text(path).inputFiles())[0]
    lines = [r.value for r in spark.read.text(first).take(n)]
    if len(lines) < n:
        raise ValueError(f"{path} has fewer than {n} header lines")
    return [next(csv.reader([line])) for line in lines]


def _without(df: DataFrame, row: Sequence[str | None], times: int = 1) -> DataFrame:
    """Drop ``times`` rows equal to ``row`` in every column (header lines); further equal rows are data and stay."""
    same = F.lit(True)
    for c, v in zip(df.columns, row):
        same = same & st.quoted(c).eqNullSafe(F.lit(v or None))
    rest, more = df.where(~same), df.where(same).count() - times
    if more <= 0:
        return rest
    again = df.sparkSession.range(more).select(*[F.lit(v or None).cast("string").alias(c) for c, v in zip(df.columns, row)])
    return rest.union(again)


def _files(spark: SparkSession, path: str) -> int:
    return len(spark.read.text(path).inputFiles())


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def read_promoted_header(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose first data row holds the column names; all columns are strings. Each file has both header lines."""
    outer, names = _first_lines(spark, path, 2)
    df = spark.read.schema(_strings(names)).csv(path, enforceSchema=True)
    files = _files(spark, path)
    return _without(_without(df, outer, files), names, files)


def promote_header(raw: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The first row by ``order`` becomes the header and is dropped."""
    names = [str(v) for v in raw.orderBy(*order).first()]
    return _without(raw.select(*[st.quoted(c).cast("string") for c in raw.columns]), names).toDF(*names)


def header_types(words: Sequence[str]) -> list[str]:
    """``categorical.1`` and the like without the number."""
    return [w.split(".")[0] for w in words]


def apply_type_header(df: DataFrame, words: Sequence[str]) -> DataFrame:
    """Cast columns by type word: categorical to string, continuous to double, others untouched."""
    kinds = {CATEGORICAL: "string", CONTINUOUS: "double"}
    casts = [
        st.quoted(c).cast(kinds[w]).alias(c) if w in kinds else st.quoted(c)
        for c, w in zip(df.columns, header_types(words))
    ]
    return nan_to_null(df.select(*casts))


def read_type_header(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a line of type words, then a line of names, then data; the two lines are there once."""
    words, names = _first_lines(spark, path, 2)
    df = spark.read.schema(_strings(names)).csv(path, enforceSchema=True)
    return apply_type_header(_without(_without(df, words), names), words)


def type_words(df: DataFrame, y_type: str | None = None) -> list[str]:
    return [y_type if y_type is not None and c == "Y" else CATEGORICAL for c in df.columns]


def write_type_header(df: DataFrame, path: str, y_type: str | None = None, mode: str = "error") -> None:
    """Write the type line, the name line and the data as CSV text; part 0 holds the two lines."""
    spark = df.sparkSession
    names = spark.createDataFrame([tuple(df.columns)], _strings(df.columns)).coalesce(1)
    words = spark.createDataFrame([tuple(type_words(df, y_type))], _strings(df.columns)).coalesce(1)
    rows = df.select(*[st.quoted(c).cast("string").alias(c) for c in df.columns])
    everything = words.union(names).coalesce(1).union(rows)
    everything.write.mode(mode).csv(path, header=False)


def add_type_header(df: DataFrame, y_type: str | None = None) -> tuple[list[str], DataFrame]:
    """Type words for the new header, and the rows as strings with the name row in front."""
    names = df.sparkSession.createDataFrame([tuple(df.columns)], _strings(df.columns)).coalesce(1)
    return type_words(df, y_type), names.union(df.select(*[st.quoted(c).cast("string") for c in df.columns]))
