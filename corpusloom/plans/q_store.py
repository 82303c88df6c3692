"""Queries over the versioned library, with the SQL that checks them: four commits made from the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.plans.fixture import MARKER, read
from corpusloom.sources import versioned as vs
from corpusloom.sources.scratch import new_path

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__], ORACLES[fn.__name__] = fn, sql
        return fn

    return register


def made(spark, sf_dir) -> str:
    """Two thirds of the documents; a fifth of all changed; a seventh of all removed; the last third."""
    path, n = new_path(spark, "library"), F.col("doc_id")
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", n.cast("string").alias("id"), F.col("source").alias("source_type"), F.concat(F.lit("https://x.example.org/"), n.cast("string")).alias("url"), "text",
        F.create_map(F.lit("lang"), "lang").alias("metadata"), F.timestamp_add("MINUTE", n.cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("created_at"),
    )
    vs.commit(docs.where("doc_id % 3 <> 2"), path, "first load, Collected by the Library", "loader")
    vs.commit(docs.where("doc_id % 5 = 0").withColumn("text", F.concat("text", F.lit("!"))), path, "corrections", "editor")
    vs.remove(docs.where("doc_id % 7 = 0"), path, "removals", "editor")
    vs.commit(docs.where("doc_id % 3 = 2"), path, "the rest; collected by the library", "loader")
    return path


_STATE = "SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 5 = 0 THEN text || '!' ELSE text END AS text, CAST(CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version FROM documents WHERE (doc_id % 3 <> 2 OR doc_id % 5 = 0) AND doc_id % 7 <> 0"


@query(_STATE)
def store_as_of(spark, sf_dir):
    """All documents as of the third commit."""
    return vs.state(spark, made(spark, sf_dir), 3).select("id", "text", "version")


@query(f"SELECT id, text, version FROM ({_STATE}) WHERE CAST(id AS BIGINT) % 3 <> 2 UNION ALL SELECT CAST(doc_id AS VARCHAR), text, 4 FROM documents WHERE doc_id % 3 = 2")
def store_latest(spark, sf_dir):
    """The latest documents, read from a mirror that has replayed all commits."""
    path, copy = made(spark, sf_dir), new_path(spark, "mirror")
    vs.mirror(spark, path, copy)
    return vs.state(spark, copy).select("id", "text", "version")


@query("""SELECT CAST(v AS BIGINT) AS version, CAST(v - 1 AS BIGINT) AS parent, author, message, (SELECT count(*) FROM documents WHERE CASE v WHEN 1 THEN doc_id % 3 <> 2 WHEN 2 THEN doc_id % 5 = 0 WHEN 3 THEN doc_id % 7 = 0 ELSE doc_id % 3 = 2 END) AS rows,
    v IN (1, 4) AS attributed
  FROM (VALUES (1, 'loader', 'first load, Collected by the Library'), (2, 'editor', 'corrections'), (3, 'editor', 'removals'), (4, 'loader', 'the rest; collected by the library')) AS t(v, author, message)""")
def store_log(spark, sf_dir):
    """The commits, and which of them name the library as their source."""
    path = made(spark, sf_dir)
    entries = vs.log(spark, path)
    named = vs.attribution(entries, MARKER).select("version", F.lit(True).alias("attributed"))
    return entries.join(named, "version", "left").select("version", "parent", "author", "message", "rows", F.coalesce("attributed", F.lit(False)).alias("attributed"))


@query("""SELECT id, 'documents/' || source || strftime(moment, '/%Y/%m/') || id AS file_path, source AS type, CAST(year(moment) AS INTEGER) AS year, CAST(month(moment) AS INTEGER) AS month
  FROM (SELECT CAST(doc_id AS VARCHAR) AS id, source, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS moment FROM documents WHERE doc_id % 7 <> 0 OR doc_id % 3 = 2)""")
def store_index(spark, sf_dir):
    """The index of the latest documents, built from the paths of their files and, for the dates, the rows."""
    index = vs.index(spark, made(spark, sf_dir))
    rebuilt = vs.index_of_paths(index.select(F.concat("file_path", F.lit("/text.txt")).alias("path")))
    return index.select("id", "year", "month").join(rebuilt.drop("year", "month"), "id").select("id", "file_path", "type", "year", "month")
