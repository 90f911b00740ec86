"""Awkward rows that every operator has to bear."""

from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet " * 8000
TEXTS = [(1, None), (2, ""), (3, " \t\n "), (4, "Zeta eta theta."), (4, "Zeta eta theta."), (5, LONG), (None, "no id here at all"),
         (6, "x" * 30_000), (7, "ﬁ Å é日本😀\x00\r\n"), (8, "Zeta eta theta.")]


def documents(spark, rows=TEXTS):
    """With columns whose names operators use inside or return."""
    extra = ["lang", "source", "n_chars", "fp", "component_id", "gram", "spans", "score", "id", "key", "hash", "n_tokens", "ids", "kept"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())] + [T.StructField(c, T.StringType()) for c in extra])
    return spark.createDataFrame([(*r, *(None for _ in extra)) for r in rows], schema)


def table(spark, name, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")
