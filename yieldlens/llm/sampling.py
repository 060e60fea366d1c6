"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def label_sample(labelled: DataFrame, id_column: str, label: str, per_label: int) -> DataFrame:
    """``id, label``: at most ``per_label`` rows of each label, those whose ids hash lowest.

    The choice depends on the ids only. Labels are counted first, so that of a label that most
    rows have only hashes under a threshold, about three times the sample, are ranked.
    """
    rows = labelled.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull()
    )
    counts = rows.groupBy("label").agg(F.count("*").alias("n"))  # as many rows as there are labels
    hashed = rows.join(F.broadcast(counts), "label").withColumn("h", F.shiftrightunsigned(F.xxhash64("id"), 34))
    low = hashed.where(F.col("h") < F.lit(3.0 * per_label * 2**30) / F.col("n"))
    first = Window.partitionBy("label").orderBy("h", "id")
    return low.withColumn("place", F.row_number().over(first)).where(F.col("place") <= per_label).select("id", "label")


def with_text(sample: DataFrame, docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``id, label, text`` of a sample, which is small enough to broadcast by its bound."""
    texts = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return texts.join(F.broadcast(sample.dropDuplicates(["id"])), "id").dropDuplicates(["id"])
