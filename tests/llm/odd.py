"""Documents with nulls, empty and long texts, ties, repeated rows and columns that clash with results."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()), T.StructField("row", T.StringType()), T.StructField("res", T.StringType()), T.StructField("node", T.StringType()),
])
_EXTRA = ("s", "x", "y", "z")
_WORDS = "the cat sat on a mat and saw ten big dogs run by in the sun while it rained"
ROWS = [
    (1, _WORDS, "en", "a", 60, *_EXTRA), (1, _WORDS, "en", "a", 60, *_EXTRA), (2, None, None, None, None, *_EXTRA), (3, "", "en", "a", 0, *_EXTRA), (4, " \n\t ", "fr", "b", 4, *_EXTRA),
    (5, "le chat et la souris sont dans la maison de l'été", "fr", "b", 40, *_EXTRA), (6, "word " * 60_000, "en", None, 300_000, *_EXTRA), (7, "x", "fr", "b", 1, *_EXTRA),
    (8, "12 34 !!", "en", "a", 8, *_EXTRA), (None, _WORDS, "en", "a", 60, *_EXTRA), (9, "ÀÉ Ünïcode 中文 \U0001f600 \x00 \x85 end", "fr", "a", 20, *_EXTRA), (10, _WORDS + " again", "en", "a", 66, *_EXTRA),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)
