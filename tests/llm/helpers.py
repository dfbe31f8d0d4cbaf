from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: columns whose names the operators use themselves
CLASHES = ("id", "fp", "row", "doc", "all", "gone", "key", "label", "score", "item", "gram", "kept", "n_lines", "component", "payload", "first", "rank", "v")


def documents(spark, *rows):
    """(doc_id, text) or (doc_id, text, lang) rows as documents."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in CLASHES if c not in df.columns})
