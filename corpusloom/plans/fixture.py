"""The fixture tables seen as a document library, for Spark and for the SQL of the checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.sources.spread import spread

#: What marks a document as attributed.
MARKER = "collected by the library"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, dealt over all cores: for queries whose time goes into each text."""
    return spread(read(spark, sf_dir, "documents"))


def title(text: Column) -> Column:
    return F.left(t.first_nonblank_line(text, t.ASCII_SPACES), F.lit(100))


def labelled(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """`docs` with the quality of each of their labels, or none."""
    return docs.join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")


def library(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    attribution = F.when(n % 4 < 2, F.concat(F.lit("Collected by the Library, item "), n.cast("string"))).when(n % 4 == 2, F.lit("none given"))
    tier = F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    cols = {
        "id": n.cast("string"), "source": F.col("source"), "url": F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/"), n.cast("string")),
        "title": title(F.col("text")), "language": F.col("lang"), "quality_tier": tier,
        "author": F.when(n % 3 == 0, F.concat(F.lit("Author "), (n % 7).cast("string"))),
        "authors": F.concat(F.lit("Author "), (n % 7).cast("string"), F.lit(", Author "), (n % 11).cast("string")),
        "created_at": F.timestamp_add("MINUTE", n.cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")),
    }
    named = [F.when(c.isNotNull(), F.struct(F.lit(k).alias("key"), c.alias("value"))) for k, c in (("attribution", attribution), ("words", t.word_count(F.col("text")).cast("string")))]
    cols["metadata"] = F.map_from_entries(F.array_compact(F.array(*named)))
    return labelled(spark, sf_dir, texts(spark, sf_dir)).select(*[c.alias(k) for k, c in cols.items()], "text", "doc_id")


#: The same view in SQL.
LIBRARY = r"""library AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, source, 'https://' || source || '.example.org/' || d.doc_id AS url,
    left(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^[\s]+|[\s]+$', '', 'g')), lambda x: x <> '')[1], 100) AS title,
    lang AS language, CASE quality WHEN 1 THEN 'high' WHEN 0 THEN 'low' END AS quality_tier,
    CASE WHEN d.doc_id % 3 = 0 THEN 'Author ' || (d.doc_id % 7) END AS author, 'Author ' || (d.doc_id % 7) || ', Author ' || (d.doc_id % 11) AS authors,
    CASE WHEN d.doc_id % 4 < 2 THEN 'Collected by the Library, item ' || d.doc_id WHEN d.doc_id % 4 = 2 THEN 'none given' END AS attribution,
    TIMESTAMP '2024-01-01' + to_minutes(d.doc_id) AS created_at, text, d.doc_id
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""
