"""The document library: schema, validation, storage layout, reading and writing.

A document has an id, a source (type, url, path), text with free-form string metadata and a vector, and two timestamps.
Keys that queries often filter on are columns of their own beside the metadata map, so that filters reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("source", T.StructType([T.StructField("type", T.StringType()), T.StructField("url", T.StringType()), T.StructField("path", T.StringType())])),
    T.StructField("content", T.StructType([
        T.StructField("raw", T.BinaryType()), T.StructField("text", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())), T.StructField("embeddings", T.ArrayType(T.FloatType())),
    ])),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def problem(ident: Column, kind: Column, url: Column, path: Column) -> Column:
    """Why a document is not valid; null where it is."""
    return F.when(blank(ident), "document ID is required").when(blank(kind), "source type is required").when(blank(url) & blank(path), "either source URL or path is required")


def dated_path(kind: Column, created: Column, ident: Column) -> Column:
    return F.concat_ws("/", F.lit("documents"), kind, F.date_format(created, "yyyy/MM"), ident)


def hashed_path(ident: Column) -> Column:
    """documents/ab/cd/abcd...; ids of under two or four bytes have fewer levels."""
    n = F.octet_length(ident)
    return (
        F.when(n < 2, F.concat_ws("/", F.lit("documents"), ident))
        .when(n < 4, F.concat_ws("/", F.lit("documents"), F.substring(ident, 1, 2), ident))
        .otherwise(F.concat_ws("/", F.lit("documents"), F.substring(ident, 1, 2), F.substring(ident, 3, 2), ident))
    )


def store(docs: DataFrame, path: str) -> None:
    """Appends valid documents, laid out by source type, year and month; invalid ones are left out (see `rejected`)."""
    valid = docs.where(problem(F.col("id"), F.col("source.type"), F.col("source.url"), F.col("source.path")).isNull())
    laid = valid.withColumns({"source_type": F.col("source.type"), "year": F.year("created_at"), "month": F.month("created_at")})
    laid.write.mode("append").partitionBy("source_type", "year", "month").parquet(path)


def rejected(docs: DataFrame) -> DataFrame:
    why = problem(F.col("id"), F.col("source.type"), F.col("source.url"), F.col("source.path"))
    return docs.select("id", why.alias("error")).where("error is not null")


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def get(docs: DataFrame, ident: str) -> DataFrame:
    return docs.where(F.col("id") == ident)


def listed(docs: DataFrame, filters: dict[str, str]) -> DataFrame:
    """Filters `type` (source type) and `source` (source url); other keys are ignored."""
    for key, column in (("type", "source.type"), ("source", "source.url")):
        if key in filters:
            docs = docs.where(F.col(column) == filters[key])
    return docs


def hybrid(primary: DataFrame, secondary: DataFrame, key: str = "id") -> DataFrame:
    """The primary's rows, and the secondary's where the primary has none."""
    return primary.unionByName(secondary.join(primary.select(key), key, "left_anti"), allowMissingColumns=True)


def merged_index(paths: DataFrame, metadata: DataFrame, key: str = "id") -> DataFrame:
    """Every id of either side; ids without metadata keep a row."""
    return paths.join(metadata, key, "full_outer")
