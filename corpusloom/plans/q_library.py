"""Queries of the query language and of the document store."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.plans import gql
from corpusloom.plans.fixture import LIBRARY, MARKER, library, read
from corpusloom.sources import library as store

DOC = ["id", "source", "title", "author", "language", "created_at"]


def _gql(text: str, *columns: str):
    def run(spark, sf_dir):
        out = gql.plan(text, gql.Views(library(spark, sf_dir), MARKER))
        return out.select(*columns) if columns else out

    return run


def _docs(where: str, order: str = "id", limit: int | None = None) -> str:
    return f"WITH {LIBRARY} SELECT {', '.join(DOC)} FROM library WHERE {where} ORDER BY {order}" + ("" if limit is None else f" LIMIT {limit}")


_WORDS = r"len(list_filter(regexp_split_to_array(text, '[\t\n\f\r ]+'), lambda x: x <> ''))"


_CASES = {
    "gql_documents_topk": ('SELECT FROM documents WHERE title ~ "the" AND language = "en" ORDER BY created_at DESC LIMIT 20', _docs("lower(title) LIKE '%the%' AND language = 'en'", "created_at DESC, id", 20)),
    "gql_contains": ('SELECT FROM documents WHERE title ~ "ER" LIMIT ALL', _docs("lower(title) LIKE '%er%'")),
    "gql_and_filters": ('SELECT FROM documents WHERE source = "src1" AND author = "Author 1" LIMIT ALL', _docs("source = 'src1' AND coalesce(author, authors) = 'Author 1'")),
    "gql_not_equals": ('SELECT FROM documents WHERE quality_tier != "high" LIMIT ALL', _docs("quality_tier IS NULL OR quality_tier <> 'high'")),
    "gql_exists": ("SELECT FROM documents WHERE attribution exists AND quality_tier exists LIMIT ALL", _docs("attribution IS NOT NULL AND quality_tier IS NOT NULL")),
    "gql_not_exists": ("SELECT FROM documents WHERE attribution not exists LIMIT ALL", _docs("attribution IS NULL")),
    "gql_created_range": ('SELECT FROM documents WHERE created_at > "2024-01-01T02:00:00" AND created_at <= "2024-01-01T05:30:00" ORDER BY created_at LIMIT ALL', _docs("created_at > TIMESTAMP '2024-01-01 02:00:00' AND created_at <= TIMESTAMP '2024-01-01 05:30:00'", "created_at, id")),
    "gql_or": ('SELECT FROM documents WHERE (language = "fr" OR language = "de") AND source in ("src1", "src2", "src3") ORDER BY title DESC LIMIT 50', _docs("language IN ('fr', 'de') AND source IN ('src1', 'src2', 'src3')", "coalesce(title, '') DESC, id", 50)),
    "gql_between": ("SELECT FROM documents WHERE created_at between '2024-01-01T01:00:00' and '2030-01-01T00:00:00' AND not (language = 'en') LIMIT ALL", _docs("created_at BETWEEN TIMESTAMP '2024-01-01 01:00:00' AND TIMESTAMP '2030-01-01' AND coalesce(language <> 'en', true)")),
    "gql_metadata_number": ("SELECT FROM documents WHERE words > 900 ORDER BY id LIMIT ALL", _docs(f"{_WORDS} > 900")),
    "gql_number_between": ("SELECT FROM documents WHERE words between 100 and 999.5 LIMIT ALL", _docs(f"{_WORDS} BETWEEN 100 AND 999")),
    "gql_number_in": ("SELECT FROM documents WHERE words in (1, 50, 120, 1000, 1234567) OR words = 77 LIMIT ALL", _docs(f"{_WORDS} IN (1, 50, 77, 120, 1000)")),
    "gql_number_differs": ("SELECT FROM documents WHERE words != 100 AND words not in (50.0, 1234567) LIMIT ALL", _docs(f"coalesce({_WORDS} NOT IN (50, 100), true)")),
    "gql_order_metadata": ("SELECT FROM documents WHERE quality_tier exists ORDER BY attribution DESC LIMIT 30", _docs("quality_tier IS NOT NULL", "coalesce(attribution, '') DESC, id", 30)),
    "gql_limit_zero": ("SELECT FROM documents LIMIT 0", _docs("true", limit=0)),
}

QUERIES = {k: _gql(text, *DOC) for k, (text, _) in _CASES.items()}
ORACLES = {k: sql for k, (_, sql) in _CASES.items()}

QUERIES |= {
    "gql_group_by": _gql('SELECT source, language, COUNT(*) AS n, COUNT(quality_tier) AS judged, AVG(words) AS mean, MAX(created_at) AS newest FROM documents WHERE title exists GROUP BY source, language HAVING n > 1 ORDER BY n DESC LIMIT ALL'),
    "gql_totals": _gql("SELECT COUNT(*) AS n, COUNT(DISTINCT source) AS sources, SUM(words) AS words, MIN(words) AS least FROM documents WHERE language != 'en'"),
    "gql_join": _gql("SELECT d.id AS id, d.title AS title, s.count AS in_source FROM documents d JOIN sources AS s ON d.source = s.source WHERE d.language = 'fr' AND s.count > 10 ORDER BY in_source DESC LIMIT ALL"),
    "gql_join_grouped": _gql("SELECT a.author AS author, COUNT(*) AS n, AVG(document_count) AS listed FROM documents d LEFT JOIN authors a ON d.author = a.author WHERE d.words > 20 GROUP BY a.author ORDER BY n DESC LIMIT ALL"),
    "gql_sources": _gql("SELECT FROM sources", "source", "count"),
    "gql_sources_filtered": _gql("SELECT FROM sources WHERE count > 40 AND source ~ 'src1' ORDER BY source", "source", "count"),
    "gql_authors": _gql("SELECT FROM authors", "author", "document_count"),
    "gql_attribution": _gql("SELECT FROM attribution WHERE document_count > 10"),
}
_COUNTS = f"WITH {LIBRARY}, s AS (SELECT source, count(*) AS count FROM library GROUP BY source) "
_AUTHORS = """a AS (
  SELECT author, count(*) AS document_count FROM (
    SELECT unnest(CASE WHEN coalesce(author, '') = '' THEN names ELSE list_prepend(author, list_filter(names, lambda x: x <> author)) END) AS author
    FROM (SELECT author, list_filter(list_transform(string_split(authors, ','), lambda x: trim(x)), lambda x: x <> '') AS names FROM library)) GROUP BY author)"""
ORACLES |= {
    "gql_group_by": f"""WITH {LIBRARY} SELECT source, language, count(*) AS n, count(quality_tier) AS judged, avg({_WORDS}) AS mean, max(created_at) AS newest
      FROM library WHERE coalesce(title, '') <> '' GROUP BY source, language HAVING count(*) > 1""",
    "gql_totals": f"WITH {LIBRARY} SELECT count(*) AS n, count(DISTINCT source) AS sources, CAST(sum({_WORDS}) AS DOUBLE) AS words, CAST(min(CAST({_WORDS} AS VARCHAR)) AS VARCHAR) AS least FROM library WHERE coalesce(language <> 'en', true)",
    "gql_join": _COUNTS + "SELECT id, title, count AS in_source FROM library JOIN s USING (source) WHERE language = 'fr' AND count > 10",
    "gql_join_grouped": f"""WITH {LIBRARY}, {_AUTHORS}
      SELECT a.author AS author, count(*) AS n, avg(document_count) AS listed FROM library d LEFT JOIN a ON coalesce(nullif(d.author, ''), d.authors) = a.author WHERE {_WORDS} > 20 GROUP BY a.author""",
    "gql_sources": _COUNTS + "SELECT source, count FROM s ORDER BY count DESC, source LIMIT 100",
    "gql_sources_filtered": _COUNTS + "SELECT source, count FROM s WHERE count > 40 AND source LIKE '%src1%'",
    "gql_authors": f"""WITH {LIBRARY}, a AS (
      SELECT author FROM library WHERE author IS NOT NULL
      UNION ALL SELECT n FROM (SELECT author AS first, unnest(list_transform(string_split(authors, ','), lambda x: trim(x))) AS n FROM library) WHERE first IS NULL OR n <> first
    ) SELECT author, count(*) AS document_count FROM a GROUP BY author ORDER BY 2 DESC, 1 LIMIT 100""",
    "gql_attribution": f"""WITH {LIBRARY} SELECT source, count(*) AS document_count, min(created_at) AS first_seen, max(created_at) AS last_seen,
      arg_min(coalesce(lower(attribution) LIKE '%{MARKER}%', false), created_at) AS attributed, last(attribution ORDER BY created_at) AS attribution
      FROM library GROUP BY source HAVING count(*) > 10 ORDER BY 2 DESC, 1 LIMIT 100""",
}


def attribution_rate(spark, sf_dir):
    """Share of all documents that are attributed, in per cent."""
    views = gql.Views(library(spark, sf_dir), MARKER)
    flag = views.attributed()
    return views.library.agg(F.count("*").alias("documents"), F.count_if(flag).alias("attributed"), F.round(F.avg(flag.cast("double")) * 100, 6).alias("rate"))


def list_documents(spark, sf_dir):
    docs = library(spark, sf_dir).select("id", F.struct(F.col("source").alias("type"), "url").alias("source"))
    return store.listed(docs, {"type": "src3", "other": "x"}).select("id", F.col("source.type").alias("source_type"), F.col("source.url").alias("url"))


def doc_paths(spark, sf_dir):
    lib = library(spark, sf_dir)
    return lib.select("id", store.dated_path(F.col("source"), F.col("created_at"), F.col("id")).alias("dated"), store.hashed_path(F.col("id")).alias("hashed"))


def doc_validation(spark, sf_dir):
    lib, n = library(spark, sf_dir), F.col("doc_id")
    broken = lib.select(F.when(n % 5 == 0, "").otherwise(F.col("id")).alias("id"), F.when(n % 7 != 0, F.col("source")).alias("type"), F.when(n % 3 == 0, F.col("url")).alias("url"), F.when(n % 2 == 0, F.concat(F.lit("/data/"), F.col("id"))).alias("path"))
    return broken.groupBy(F.coalesce(store.problem(*map(F.col, ("id", "type", "url", "path"))), F.lit("valid")).alias("outcome")).agg(F.count("*").alias("n"))


def hybrid_read(spark, sf_dir):
    lib = library(spark, sf_dir).select("id", "source")
    first = lib.where(F.col("id").cast("long") % 3 == 0).withColumn("backend", F.lit("primary"))
    return store.hybrid(first, lib.withColumn("backend", F.lit("secondary"))).groupBy("backend").agg(F.count("*").alias("n"))


def documents_index(spark, sf_dir):
    lib = library(spark, sf_dir)
    paths = lib.where("doc_id % 2 = 0").select("id", store.hashed_path(F.col("id")).alias("path"))
    return store.merged_index(paths, lib.where("doc_id % 3 = 0").select("id", "title"))


def point_lookup(spark, sf_dir):
    return store.get(library(spark, sf_dir), "77").select("id", "source", "title")


QUERIES |= {f.__name__: f for f in (attribution_rate, list_documents, doc_paths, doc_validation, hybrid_read, documents_index, point_lookup)}
_HASHED = "CASE WHEN strlen(id) < 2 THEN 'documents/' || id WHEN strlen(id) < 4 THEN 'documents/' || substr(id, 1, 2) || '/' || id ELSE 'documents/' || substr(id, 1, 2) || '/' || substr(id, 3, 2) || '/' || id END"
ORACLES |= {
    "attribution_rate": f"WITH {LIBRARY}, f AS (SELECT coalesce(lower(attribution) LIKE '%{MARKER}%', false) AS x FROM library) SELECT count(*) AS documents, count(*) FILTER (x) AS attributed, round(avg(CAST(x AS DOUBLE)) * 100, 6) AS rate FROM f",
    "list_documents": f"WITH {LIBRARY} SELECT id, source AS source_type, url FROM library WHERE source = 'src3'",
    "doc_paths": f"WITH {LIBRARY} SELECT id, 'documents/' || source || '/' || strftime(created_at, '%Y/%m') || '/' || id AS dated, {_HASHED} AS hashed FROM library",
    "doc_validation": f"""WITH {LIBRARY} SELECT CASE WHEN doc_id % 5 = 0 THEN 'document ID is required' WHEN doc_id % 7 = 0 THEN 'source type is required'
      WHEN doc_id % 3 <> 0 AND doc_id % 2 <> 0 THEN 'either source URL or path is required' ELSE 'valid' END AS outcome, count(*) AS n FROM library GROUP BY 1""",
    "hybrid_read": "SELECT CASE WHEN doc_id % 3 = 0 THEN 'primary' ELSE 'secondary' END AS backend, count(*) AS n FROM documents GROUP BY 1",
    "documents_index": f"WITH {LIBRARY} SELECT id, CASE WHEN doc_id % 2 = 0 THEN {_HASHED} END AS path, CASE WHEN doc_id % 3 = 0 THEN title END AS title FROM library WHERE doc_id % 2 = 0 OR doc_id % 3 = 0",
    "point_lookup": f"WITH {LIBRARY} SELECT id, source, title FROM library WHERE id = '77'",
}


def operation_metrics(spark, sf_dir):
    """Counts, outcomes and durations by backend and operation, with subtotals."""
    ev = read(spark, sf_dir, "events").select(F.concat(F.lit("b"), F.col("user_id") % 3).alias("backend"), F.col("event_type").alias("operation"), (F.col("value") * 1000).cast("long").alias("ns"), (F.col("event_type") != "error").alias("ok"))
    total = F.sum("ns")
    out = ev.rollup("backend", "operation").agg(
        F.count("*").alias("n"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"), F.min("ns").alias("least"), F.max("ns").alias("most"),
        total.alias("total"), F.expr("sum(ns) div count(*)").alias("average"), F.round(F.count_if("ok") * 100.0 / F.count("*"), 6).cast("double").alias("success_rate"),
    )
    return out


QUERIES["op_metrics_rollup"] = operation_metrics
ORACLES["op_metrics_rollup"] = """WITH e AS (SELECT 'b' || (user_id % 3) AS backend, event_type AS operation, CAST(trunc(value * 1000) AS BIGINT) AS ns, event_type <> 'error' AS ok FROM events)
  SELECT backend, operation, count(*) AS n, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed, min(ns) AS least, max(ns) AS most,
    CAST(sum(ns) AS BIGINT) AS total, CAST(sum(ns) // count(*) AS BIGINT) AS average, round(CAST(count(*) FILTER (ok) AS DOUBLE) * 100 / count(*), 6) AS success_rate
  FROM e GROUP BY ROLLUP (backend, operation)"""
