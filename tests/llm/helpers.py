"""Small tables with the awkward cases, and brute-force versions in plain Python."""

import re

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977} v{i % 89}" for i in range(12_000))


def docs(spark, texts, ids=None):
    """A documents table of several partitions; None stays null."""
    rows = [(i if ids is None else ids[i], t, "en", "src0", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC).repartition(3)


def clashing(df):
    """The same rows with extra columns whose names operators use inside."""
    from pyspark.sql import functions as F
    for c in ("id", "h", "key", "same", "n", "row", "spans", "features", "score", "component_id", "removed"):
        df = df.withColumn(c, F.lit("x"))
    return df


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
