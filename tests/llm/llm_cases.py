"""Small inputs shared by the operator tests."""

import random

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

#: The columns of documents and some that clash with names used inside.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.LongType()) for c in ("key", "part", "bucket", "score", "_id", "_t", "size", "h", "a", "n", "rep")],
    ]
)


def docs(spark, rows):
    """rows: (doc_id, text[, source])."""
    full = []
    for r in rows:
        doc_id, text, source = (*r, "s")[:3]
        full.append((doc_id, text, None if source is None else "en", source, None if text is None else len(text), *[7] * 11))
    return spark.createDataFrame(full, SCHEMA)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_rows():
    """Nulls, empty and blank texts, a very long text, ties and repeated rows."""
    rng = random.Random(5)
    base = words(rng, 60)
    long = words(rng, 40_000)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, base),
        (5, base),
        (6, base + " tail"),
        (6, base + " tail"),
        (None, base),
        (None, None),
        (7, long),
        (8, "one"),
        (9, "one"),
        (10, "Ünï cödé 　 'tis <|endoftext|> \U0001f600 don't", None),
        (11, words(rng, 300)),
    ]


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
