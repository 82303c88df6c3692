"""Search, snippets, highlights, facets, statistics, rendering and export of a document collection."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as t


def search(docs: DataFrame, query: str, text: str = "text", key: str = "id") -> DataFrame:
    """Documents that contain the query (any case) with score hits / words, best first."""
    low = F.lower(F.col(text))
    hits = docs.where(F.contains(low, F.lit(query.lower())))
    score = F.try_divide(t.occurrences(low, F.lit(query.lower())).cast("double"), t.word_count(F.col(text)).cast("double"))
    return hits.withColumn("score", F.coalesce(score, F.lit(0.0))).orderBy(F.desc("score"), key)


def snippet(c: Column, query: str, length: int = 150) -> Column:
    """The text around the first hit, or its beginning."""
    at, n, half = F.locate(query.lower(), F.lower(c)), F.length(c), length // 2
    start = F.greatest(at - half, F.lit(1))
    end = F.least(at + len(query) + half, n + 1)
    around = F.concat(F.when(start > 1, "...").otherwise(""), c.substr(start, end - start), F.when(end <= n, "...").otherwise(""))
    return F.when(at > 0, around).when(n > length, F.concat(F.left(c, F.lit(length)), F.lit("..."))).otherwise(c)


def highlights(c: Column, query: str, most: int = 3) -> Column:
    """The first sentences that contain any word of the query."""
    terms = query.lower().split()
    return F.slice(F.transform(F.filter(F.split(c, r"\."), lambda s: t.has_any(F.lower(s), terms)), t.trim), 1, most)


def bold(c: Column, terms: list[str]) -> Column:
    for term in terms:
        c = F.regexp_replace(c, f"(?iu)({re.escape(term)})", r"**$1**")
    return c


def title(metadata_title: Column, name: Column, c: Column, ident: Column) -> Column:
    line = t.trim(F.regexp_replace(t.first_nonblank_line(c), "^#", ""))
    short = F.when(F.length(line) > 100, F.concat(F.left(line, F.lit(100)), F.lit("..."))).otherwise(line)
    return F.coalesce(F.nullif(metadata_title, F.lit("")), F.nullif(name, F.lit("")), F.nullif(short, F.lit("")), F.concat(F.lit("Document "), ident))


def facets(docs: DataFrame, fields: list[str]) -> DataFrame:
    """field, value, count of all non-empty values, in one pass."""
    rows = docs.select(F.explode_outer(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("f"))
    return rows.select("f.*").where("value is not null and value <> ''").groupBy("field", "value").agg(F.count("*").alias("count"))


def statistics(docs: DataFrame, score: Column, created: str) -> DataFrame:
    """One row: documents, average score over all documents, first and last date."""
    return docs.agg(F.count("*").alias("documents"), (F.coalesce(F.sum(score), F.lit(0.0)) / F.count("*")).alias("avg_quality"), F.min(created).alias("first_date"), F.max(created).alias("last_date"))


def distributions(docs: DataFrame, fields: list[str]) -> DataFrame:
    """Counts by each field and in all, by grouping sets."""
    return docs.groupingSets([[F.col(f)] for f in fields] + [[]], *fields).agg(F.count("*").alias("documents"), *[F.grouping(f).cast("int").alias(f"all_{f}") for f in fields])


def page(docs: DataFrame, order: list, number: int, size: int) -> DataFrame:
    return docs.orderBy(*order).offset((number - 1) * size).limit(size)


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def render(c: Column, form: str) -> Column:
    """html, markdown, plain or json of a text; anything else passes."""
    if form == "html":
        paras = F.filter(t.paragraphs(escape_html(c)), lambda p: t.trim(p) != "")
        return F.array_join(F.transform(paras, lambda p: F.concat(F.lit("<p>"), F.replace(p, F.lit("\n"), F.lit("<br>")), F.lit("</p>"))), "")
    if form == "markdown":
        return F.array_join(F.transform(t.lines(c), t.trim), "\n")
    if form == "plain":
        return F.array_join(F.filter(F.transform(t.lines(c), t.trim), lambda x: x != ""), "\n")
    return F.to_json(F.struct(c.alias("content"))) if form == "json" else c


def export(ident: Column, heading: Column, c: Column, form: str) -> Column:
    if form == "markdown":
        return F.concat(F.lit("# "), heading, F.lit("\n\n"), c)
    if form == "xml":
        return F.concat(F.lit("<document><id>"), escape_html(ident), F.lit("</id><title>"), escape_html(heading), F.lit("</title><content>"), escape_html(c), F.lit("</content></document>"))
    if form == "json":
        return F.to_json(F.struct(ident.alias("id"), heading.alias("title"), c.alias("content")))
    raise ValueError(f"unsupported export format: {form}")


#: A stored judgement as it stands in metadata.
QUALITY = "overall_score double, quality_tier string, confidence_level double"
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def shown_metadata(m: Column) -> Column:
    """Metadata without keys that begin with `_`; moments under keys with `time` or `date` in plain form, in their own offset."""

    def shown(key: Column, value: Column) -> Column:
        dated = F.contains(key, F.lit("time")) | F.contains(key, F.lit("date"))
        plain = F.replace(F.left(value, F.lit(19)), F.lit("T"), F.lit(" "))
        valid = F.regexp_like(value, F.lit(RFC3339)) & F.try_to_timestamp(plain, F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
        return F.when(dated & valid, plain).otherwise(value)

    return F.transform_values(F.map_filter(m, lambda k, _: ~F.startswith(k, F.lit("_"))), shown)


def stored_quality(m: Column) -> Column:
    """The judgement stored as JSON under `quality`; null where there is none or it cannot be read."""
    return F.from_json(F.try_element_at(m, F.lit("quality")), QUALITY)
