"""Rows that every operator has to bear: nulls, empty and long texts, repeats, clashing names."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "x", "en", "b", 1), (5, "word " * 20_000, "de", None, 100_000),
    (6, "the same text twice over and over again", "en", "a", 1), (7, "the same text twice over and over again", "fr", "b", 1), (7, "the same text twice over and over again", "fr", "b", 1),
    (8, "ünïcödé 漢字 😀 text", "de", "c", 1), (None, "no id here", "en", "a", 1),
]


def odd(spark, clash=()):
    """The odd rows, with further columns named like an operator's own."""
    df = spark.createDataFrame(ODD, DOCS)
    return df.withColumns({c: F.lit("clash") for c in clash})


def empty(spark):
    return spark.createDataFrame([], DOCS)
