"""Reading and writing plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from yieldlens.operators import statistics as st

FORMATS = ("csv", "parquet", "orc", "json")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null, so that every later operator sees one kind of missing value."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floats:
        return df
    return df.select(
        *[F.nanvl(st.quoted(c), F.lit(None)).alias(c) if c in floats else st.quoted(c) for c in df.columns]
    )


def read_table(spark: SparkSession, path: str, fmt: str = "csv", schema=None, **options) -> DataFrame:
    """A table from one file or folder. Without ``schema`` a CSV's types are inferred, which reads it twice."""
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    reader = spark.read.options(**options)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.format(fmt).load(path))


def read_dir(
    spark: SparkSession, path: str, fmt: str = "csv", schema=None, file_column: str = "file", folders: bool = False, **options
) -> DataFrame:
    """All files of a folder in one read, with the file name as a column to group by.

    ``folders``: each table is a folder of files itself, as Spark writes it, and the column holds the folder's name.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    reader = spark.read.options(**options)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2) if folders else F.col("_metadata.file_name")
    return nan_to_null(df.select("*", name.alias(file_column)))


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "error", partition_by: str | None = None) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.format(fmt).save(path)
