"""Small tables with awkward rows."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
)
#: Columns whose names operators use inside; none of them may matter or crash.
CLASHING = (
    "id", "id_", "tag_", "c0_", "c0", "text_", "share", "bucket", "kind", "key", "host", "rule", "score", "rank", "line",
    "place", "length", "places_", "root", "class_", "class_id", "label", "gone", "mask", "cell", "dim",
)


def documents(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, lang)."""
    return spark.createDataFrame([(*r, None)[:3] for r in rows], DOCS)


def with_clashing(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING if c not in df.columns])
