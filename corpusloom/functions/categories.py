"""Automatic categories: a naive Bayes classifier of hashed words, trained by sums over partitions and applied without a shuffle.

Words fall into `BUCKETS` buckets by the first digits of their MD5. Training counts words by label and bucket, at most labels x buckets
rows whatever the corpus, combined within tasks first; the model is one row of arrays, so it can be broadcast: `LABELS` labels of
`BUCKETS` numbers are 32 MB at most. A text's score for a label is the log prior and the log shares of its words, add-one smoothed.

Defined cases: rows without a label do not train; empty and null texts get the commonest label (of equals the first by name); without any
labelled row every category is null; labels beyond `LABELS` are an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, LABELS = 1 << 16, 64
WORD = r"[\p{L}\p{N}]+"


def buckets_of(c: Column) -> Column:
    """The bucket of each word of a text, from 1."""
    words = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(WORD), F.lit(0))
    return F.transform(words, lambda w: F.conv(F.left(F.md5(w.cast("binary")), F.lit(4)), 16, 10).cast("int") + 1)


def trained(rows: DataFrame, label: str, text: str = "text") -> DataFrame:
    """One row: labels (by name), priors and weights, arrays by label; weights are log shares by bucket."""
    known = rows.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), F.col(text).alias("text"))
    named = known.groupBy("label").agg(F.count("*").alias("n"))
    many = named.count()
    if many > LABELS:
        raise ValueError(f"{many} labels; at most {LABELS}")
    counts = known.select("label", F.explode(buckets_of(F.col("text"))).alias("bucket")).groupBy("label", "bucket").agg(F.count("*").alias("n"))
    each = counts.groupBy("label").agg(F.sum("n").alias("words"), F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("by"))
    # the map becomes an array by bucket, so that a word's weight is found by its number
    filled = named.withColumnRenamed("n", "docs").join(each, "label", "left").select(
        "label", "docs", F.coalesce("words", F.lit(0)).alias("words"), F.array_sort(F.map_entries(F.coalesce("by", F.create_map().cast("map<int,bigint>")))).alias("by"),
    )
    spread = F.flatten(F.transform(F.arrays_zip(F.concat(F.array(F.struct(F.lit(0).alias("key"), F.lit(0).cast("long").alias("value"))), "by").alias("before"), F.concat("by", F.array(F.struct(F.lit(BUCKETS + 1).alias("key"), F.lit(0).cast("long").alias("value")))).alias("now")), lambda z: F.concat(
        F.array_repeat(F.lit(0).cast("long"), z["now"]["key"] - z["before"]["key"] - 1), F.array(z["now"]["value"]),
    )))
    logs = F.transform(F.slice(spread, 1, BUCKETS), lambda n: F.log((n + 1.0) / (F.col("words") + float(BUCKETS))))
    one = filled.select("label", "docs", logs.alias("weights")).agg(F.array_sort(F.collect_list(F.struct("label", "docs", "weights"))).alias("all"))
    total = F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + x["docs"])
    return one.select(F.col("all.label").alias("labels"), F.transform("all", lambda x: F.log(x["docs"] / total)).alias("priors"), F.col("all.weights").alias("weights"))


def categorised(rows: DataFrame, model: DataFrame, text: str = "text", name: str = "category") -> DataFrame:
    """`rows` with the likeliest label of each text as column `name`."""
    bounded = model.select(F.struct("labels", "priors", "weights").alias("_model")).limit(1)
    met = rows.withColumn("_buckets", buckets_of(F.col(text))).join(F.broadcast(bounded), F.lit(True), "left")  # one row of bounded arrays
    scores = F.transform("_model.labels", lambda _, i: F.aggregate("_buckets", F.get("_model.priors", i), lambda a, b: a + F.get(F.get("_model.weights", i), b - 1)))
    best = F.array_position(scores, F.array_max(scores)).cast("int")
    return met.withColumn(name, F.when(F.size(F.col("_model.labels")) > 0, F.get(F.col("_model.labels"), best - 1))).drop("_buckets", "_model")
