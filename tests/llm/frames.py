"""Small frames with the awkward rows that every operator must take."""

from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LONG = "alpha beta gamma delta " * 6000

AWKWARD = [
    (1, "The first text of all, with a few words.\nAnd a second line.", "en", "a", 10),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \t\n\x0b\x0c\r ", "en", "b", 7),
    (5, LONG, "en", "a", len(LONG)),
    (6, "The first text of all, with a few words.\nAnd a second line.", "en", "b", 10),
    (6, "The first text of all, with a few words.\nAnd a second line.", "en", "b", 10),
    (None, "No id here, but words: é漢😀 ▁ \x00 <0x0A> end", "fr", None, 3),
    (None, "No id here, but words: é漢😀 ▁ \x00 <0x0A> end", "fr", None, 3),
    (7, "x", None, "a", 1),
    (-8, "The first  text of all, with a few words.\n\nAnd a second line.", "en", "c", 10),
    (9, "a" * 50_000, "en", "c", 50_000),
]


def documents(spark, rows=AWKWARD):
    return spark.createDataFrame([tuple(r) for r in rows], DOCUMENT)


def with_clashes(df, *names):
    """The frame with extra columns of names that operators use inside."""
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit("own"))
    return df


CLASHES = ["digest", "rank", "size", "fp", "mark", "bucket", "copies", "taken", "src", "chunk", "quality_score", "keep_id",
           "component_id", "stay_id", "copy", "epoch", "target", "n_words"]
