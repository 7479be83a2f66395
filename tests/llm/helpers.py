"""What the tests of this folder share."""

from pyspark.sql import types as T

ODD = ["", None, "One two three four five six seven.", "One two three four five six seven.", "é ñ ü " * 3, "x" * 50_000, "..."]


def documents(spark, texts, first=0):
    """A table of documents with the given texts, and columns whose names clash with those the operators use."""
    rows = [(first + i, t, "en", "s", len(t or ""), i, "x", True, 1.5, "y", "z", 7) for i, t in enumerate(texts)]
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
              ("n_chars", T.LongType()), ("row", T.IntegerType()), ("hits", T.StringType()), ("maybe", T.BooleanType()),
              ("score", T.DoubleType()), ("lang_pred", T.StringType()), ("_k", T.StringType()), ("text_hash", T.IntegerType())]
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, k) for n, k in fields]))


def by_key(df, *columns):
    return {r[0]: tuple(r[1:]) if len(columns) > 2 else r[1] for r in df.select(*columns).collect()}
