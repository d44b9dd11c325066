"""Small documents tables for the operators' tests."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


def docs(spark, rows, extra=()):
    """rows: (doc_id, text) or (doc_id, text, lang, source); ``extra`` adds
    columns whose names clash with those the operators use."""
    full = []
    for r in rows:
        r = tuple(r) + ("en", "src0")[len(r) - 2:] if len(r) < 4 else tuple(r)
        full.append((*r, None if r[1] is None else len(r[1])))
    df = spark.createDataFrame(full, SCHEMA)
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(7).cast("long") for c in extra})


def plain(rows):
    return [tuple(r) for r in rows]
