"""Collected items: RSS, Atom, JSON records and data sets, all to rows of id, url, type and metadata.

Readers take text files already in storage, so collecting scales with files; fetching is a caller's matter. Attribution
text and other constants are parameters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as t
from corpusloom.functions.web import stable_id

RSS_ITEM = "title string, link string, description string, pubDate string"
ATOM_ENTRY = "id string, title string, summary string, published string, updated string, author array<struct<name:string>>, link array<struct<_href:string,_type:string,_rel:string>>"


def passes(c: Column, filters: list[str]) -> Column:
    """Whether any filter occurs (any case); all pass without filters."""
    return reduce(lambda a, b: a | b, [F.contains(F.lower(c), F.lit(f.lower())) for f in filters]) if filters else F.lit(True)


def with_extra(meta: Column, extra: dict[str, str] | None) -> Column:
    """A metadata map with constants added; a constant beats what was there."""
    if not extra:
        return meta
    kept = F.map_filter(meta, lambda k, v: ~k.isin(*extra))
    return F.map_concat(kept, F.create_map(*[F.lit(x) for kv in extra.items() for x in kv]))


def _meta(**columns: Column) -> Column:
    return F.map_filter(F.create_map(*[x for k, c in columns.items() for x in (F.lit(k), c)]), lambda k, v: v.isNotNull())


def rss(spark: SparkSession, path: str, name: str, url: str, filters: list[str] = (), extra: dict[str, str] | None = None) -> DataFrame:
    items = spark.read.schema(RSS_ITEM).option("rowTag", "item").format("xml").load(path)
    kept = items.where(passes(F.concat_ws(" ", "title", "description"), list(filters)))
    meta = _meta(title=F.col("title"), description=F.col("description"), pubDate=F.col("pubDate"), source=F.lit(name), feedURL=F.lit(url))
    return kept.select(stable_id(F.col("link")).alias("id"), F.col("link").alias("url"), F.lit("web").alias("type"), with_extra(meta, extra).alias("metadata"))


def atom(spark: SparkSession, path: str, source: str, extra: dict[str, str] | None = None) -> DataFrame:
    """Entries with a PDF link; authors joined by a comma."""
    entries = spark.read.schema(ATOM_ENTRY).option("rowTag", "entry").format("xml").load(path)
    pdf = F.get(F.filter("link", lambda x: x["_type"] == "application/pdf"), F.lit(0))["_href"]
    meta = _meta(title=F.col("title"), authors=F.array_join(F.transform("author", lambda a: a["name"]), ", "), abstract=F.col("summary"), published=F.col("published"), updated=F.col("updated"), source=F.lit(source))
    return entries.where(pdf.isNotNull()).select("id", pdf.alias("url"), F.lit("pdf").alias("type"), with_extra(meta, extra).alias("metadata"))


def json_records(spark: SparkSession, path: str, name: str, extra: dict[str, str] | None = None) -> DataFrame:
    """One JSON object a line: the address is url, link or href; records without one are skipped."""
    rows = spark.read.text(path).select(F.from_json("value", T.MapType(T.StringType(), T.StringType())).alias("m")).where("m is not null")
    url = F.coalesce(*[F.nullif(F.try_element_at("m", F.lit(k)), F.lit("")) for k in ("url", "link", "href")])
    meta = with_extra(with_extra(F.col("m"), {"source": name}), extra)
    return rows.where(url.isNotNull()).select(stable_id(url).alias("id"), url.alias("url"), F.lit("web").alias("type"), meta.alias("metadata"))


def unseen(items: DataFrame, seen: DataFrame, key: str = "id") -> DataFrame:
    """The first of each id among the items, without ids seen before."""
    first = items.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("url"))).where("_n = 1").drop("_n")
    return first.join(seen.select(key), key, "left_anti")


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a data-set file: an object with a list `dataset`, which may be null."""
    turn = "struct<role:string,content:string>"
    schema = f"dataset array<struct<id:string,conversation:array<{turn}>,metadata:map<string,string>,source:struct<url:string,title:string,category:string,description:string,word_count:long,quality_tier:string>,created_at:string>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.inline("dataset"))


def write_dataset(rows: DataFrame, path: str) -> None:
    """One JSON object a line; the envelope of counts goes to its own folder as one row."""
    rows.write.mode("overwrite").json(f"{path}/dataset")
    rows.agg(F.count("*").alias("total")).write.mode("overwrite").json(f"{path}/metadata")


def training_text(title: Column, source: Column, words: Column, c: Column) -> Column:
    """A text with its header block."""
    return F.concat(F.lit("Title: "), title, F.lit("\nSource: "), source, F.lit("\nWords: "), words.cast("string"), F.lit("\n\n"), c)


def write_training_texts(docs: DataFrame, path: str, category: str, title: str = "title", source: str = "source", text: str = "text") -> None:
    body = training_text(F.col(title), F.col(source), t.word_count(F.col(text)), F.col(text))
    docs.select(F.col(category), body.alias("value")).write.mode("overwrite").partitionBy(category).text(path)
