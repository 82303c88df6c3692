"""Queries of pages, vectors, search, corpus reports, compliance, training records and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.functions import vectors as v
from corpusloom.functions import web
from corpusloom.operators import compliance as co
from corpusloom.operators import conversations as cv
from corpusloom.operators import corpus as cp
from corpusloom.operators import search as se
from corpusloom.plans.fixture import LIBRARY, labelled, library, read, texts, title
from corpusloom.plans.q_quality import quoted, sql_any, sql_fields, sql_many, sql_trim
from corpusloom.streaming import events as ev

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


# -- pages -------------------------------------------------------------------------------------------------------------


def nested(c: str, pairs) -> str:
    return reduce(lambda s, p: f"replace({s}, {quoted(p[0])}, {quoted(p[1])})", pairs, c)


@query("SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, nullif(regexp_extract(html, '(?i)<meta[^>]*(?:name|property)=[\"'']viewport[\"''][^>]*content=[\"'']([^\"'']+)[\"'']', 1), '') AS viewport, len(regexp_extract_all(html, '(?i)<a[^>]+href=[\"'']([^\"'']+)[\"'']', 1)) AS links FROM pages")
def page_metadata(spark, sf_dir):
    h = F.col("html")
    return read(spark, sf_dir, "pages").select("page_id", web.title(h).alias("title"), web.meta(h, "viewport").alias("viewport"), F.size(web.links(h)).cast("long").alias("links"))


_MAIN = "coalesce(" + ", ".join(f"nullif(regexp_extract(c1, {quoted(p)}, 1), '')" for p in web.MAIN) + ", c1)"


@query(rf"""WITH a AS (SELECT page_id, regexp_replace(html, '(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', '', 'g') AS c1 FROM pages),
  b AS (SELECT page_id, regexp_replace({_MAIN}, '</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table)[^>]*>', chr(10), 'g') AS c2 FROM a),
  c AS (SELECT page_id, regexp_replace({nested("regexp_replace(c2, '<[^>]*>', '', 'g')", web.REFERENCES.items())}, '&#[0-9]+;', ' ', 'g') AS c3 FROM b)
  SELECT page_id, array_to_string(list_filter(list_transform(string_split(c3, chr(10)), lambda x: {sql_trim("regexp_replace(x, '[ \\t]+', ' ', 'g')")}), lambda x: x <> ''), chr(10)) AS text FROM c""")
def page_text_regex(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", web.pattern_text(F.col("html")).alias("text"))


@query()
def page_text_dom(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", web.dom_text("html").alias("text"))


_TYPES = ["text/html; charset=utf-8", "TEXT/PLAIN", "application/pdf", "application/json ;x"]


@query(f"SELECT media, media IN ({', '.join(map(quoted, web.MEDIA))}) AS supported, count(*) AS pages FROM (SELECT lower(trim(string_split([{', '.join(map(quoted, _TYPES))}][page_id % 4 + 1], ';')[1])) AS media FROM pages) GROUP BY 1, 2")
def page_media_type(spark, sf_dir):
    c = F.element_at(F.array(*map(F.lit, _TYPES)), (F.col("page_id") % 4 + 1).cast("int"))
    return read(spark, sf_dir, "pages").groupBy(web.media_type(c).alias("media"), web.supported(c).alias("supported")).agg(F.count("*").alias("pages"))


_HOST = "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)"


@query(f"SELECT {_HOST} AS host, count(*) AS pages FROM pages GROUP BY 1")
def page_hosts(spark, sf_dir):
    return read(spark, sf_dir, "pages").groupBy(F.try_parse_url("url", F.lit("HOST")).alias("host")).agg(F.count("*").alias("pages"))


@query("SELECT page_id, md5(regexp_replace(url, '#.*$', '')) AS id FROM pages")
def dedupe_url_id(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", web.stable_id(F.col("url")).alias("id"))


@query("""SELECT CASE page_id % 4 WHEN 0 THEN 'only HTTP and HTTPS URLs are allowed' WHEN 1 THEN 'private hosts are not allowed' WHEN 2 THEN 'invalid metadata key' ELSE 'valid' END AS outcome, count(*) AS n FROM pages GROUP BY 1""")
def validate_requests(spark, sf_dir):
    n = F.col("page_id") % 4
    url = F.when(n == 0, "ftp://x.example/a").when(n == 1, "http://10.1.2.3/x").otherwise(F.col("url"))
    meta = F.create_map(F.when(n == 2, "bad key!").otherwise("good_key"), F.lit("v"))
    return read(spark, sf_dir, "pages").groupBy(F.coalesce(web.url_problem(url), web.metadata_problem(meta), F.lit("valid")).alias("outcome")).agg(F.count("*").alias("n"))


@query("SELECT page_id, 'https://example.org/p' || page_id AS url, '2024' AS captured, CASE WHEN page_id % 2 = 0 THEN 'text/html' ELSE 'image/png' END AS mime, '200' AS status FROM pages WHERE page_id % 2 = 0")
def crawl_index(spark, sf_dir):
    n = F.col("page_id").cast("string")
    line = F.concat(F.lit("org,example)/p"), n, F.lit(' 2024 {"mime": "'), F.when(F.col("page_id") % 2 == 0, "text/html").otherwise("image/png"), F.lit('", "status": "200"}'))
    rows = read(spark, sf_dir, "pages").select("page_id", *[c.alias(k) for k, c in web.cdx(line).items()])
    return rows.where(F.startswith("mime", F.lit("text/")) & (F.col("status") == "200"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'warc' WHEN page_id % 3 = 1 THEN 'html' ELSE 'empty' END AS kind, CASE WHEN page_id % 3 = 0 THEN strlen(html) END AS body_bytes FROM pages")
def archive_records(spark, sf_dir):
    n, h = F.col("page_id") % 3, F.col("html")
    record = F.when(n == 0, F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\n\r\n"), h)).when(n == 1, h).otherwise("  ")
    return read(spark, sf_dir, "pages").select("page_id", web.sniff(record).alias("kind"), F.octet_length(web.warc_body(record)).cast("long").alias("body_bytes"))


@query("SELECT doc_id, x AS text, CAST(strlen(x) AS BIGINT) AS characters FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN trim(text) ELSE '<b>' || text || '</b>' END AS x FROM documents)")
def extract_formats(spark, sf_dir):
    n = F.col("doc_id") % 2
    docs = texts(spark, sf_dir).select("doc_id", F.concat(F.lit("<b>"), "text", F.lit("</b>")).alias("raw"), F.when(n == 0, "HTML").otherwise("weird").alias("kind"))
    out = docs.withColumn("text", web.extracted(F.col("raw"), F.col("kind")))
    return out.select("doc_id", "text", t.size_of(F.col("text")).alias("characters"))


# -- vectors -----------------------------------------------------------------------------------------------------------

_DOT = "list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


@query(f"SELECT b.vec_id, round({_DOT}, 6) AS similarity FROM (SELECT embedding FROM embeddings WHERE vec_id = 7) a, embeddings b ORDER BY {_DOT} DESC, b.vec_id LIMIT 20")
def similar_topk(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    found = v.nearest(vectors, vectors.where("vec_id = 7").first()["embedding"], 20)
    return found.select("vec_id", F.round("similarity", 6).alias("similarity"))


@query(f"SELECT a.vec_id AS query_id, b.vec_id, round({_DOT}, 6) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY round({_DOT}, 9) DESC, b.vec_id) <= 5")
def similar_search(spark, sf_dir):
    """Five nearest of each stated query vector, against all vectors."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    queries = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    return v.nearest_of(queries, vectors, 5).withColumn("similarity", F.round("similarity", 6))


@query("SELECT label, count(*) AS vectors, round(avg(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))), 6) AS mean_norm FROM embeddings GROUP BY label")
def vector_norms(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").groupBy("label").agg(F.count("*").alias("vectors"), F.round(F.avg(v.norm(F.col("embedding"))), 6).alias("mean_norm"))


@query("SELECT label, i - 1 AS dim, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS mean FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2")
def label_centroids(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("dim", "x"))
    return rows.groupBy("label", F.col("dim").cast("long").alias("dim")).agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"))


@query()
def embed_documents(spark, sf_dir):
    docs = texts(spark, sf_dir).select("doc_id", v.embed("text").alias("e"))
    return docs.select("doc_id", F.size("e").alias("dim"), F.round(v.norm(F.col("e")), 3).alias("norm"))


# -- search and presentation ---------------------------------------------------------------------------------------------


@query(f"SELECT id, round((length(low) - length(replace(low, 'tion', ''))) // 4 / CAST(w AS DOUBLE), 9) AS score FROM (SELECT CAST(doc_id AS VARCHAR) AS id, lower(text) AS low, len({sql_fields('text')}) AS w FROM documents) WHERE contains(low, 'tion')")
def search_hits(spark, sf_dir):
    docs = texts(spark, sf_dir).select(F.col("doc_id").cast("string").alias("id"), "text")
    return se.search(docs, "TION").select("id", F.round("score", 9).alias("score"))


@query("""WITH a AS (SELECT doc_id, text, strpos(lower(text), 'ing the') AS p, length(text) AS n FROM documents), b AS (SELECT *, greatest(p - 75, 1) AS s, least(p + 7 + 75, n + 1) AS e FROM a)
  SELECT doc_id, CASE WHEN p > 0 THEN CASE WHEN s > 1 THEN '...' ELSE '' END || substr(text, s, e - s) || CASE WHEN e <= n THEN '...' ELSE '' END WHEN n > 150 THEN left(text, 150) || '...' ELSE text END AS snippet FROM b""")
def search_snippets(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", se.snippet(F.col("text"), "ing the").alias("snippet"))


@query(f"SELECT doc_id, array_to_string(list_transform(list_filter(string_split(text, '.'), lambda s: contains(lower(s), 'the') OR contains(lower(s), 'der'))[1:3], lambda s: {sql_trim('s')}), ' | ') AS highlights, regexp_replace(regexp_replace(text, '(?i)(the)', '**\\1**', 'g'), '(?i)(der)', '**\\1**', 'g') AS bold FROM documents")
def search_highlights(spark, sf_dir):
    c = F.col("text")
    return texts(spark, sf_dir).select("doc_id", F.array_join(se.highlights(c, "The der"), " | ").alias("highlights"), se.bold(c, ["the", "der"]).alias("bold"))


@query("SELECT doc_id, regexp_replace(regexp_replace(text, '(?i)(the)', '**\\1**', 'g'), '(?i)(der)', '**\\1**', 'g') AS bold FROM documents")
def search_bold(spark, sf_dir):
    """Every occurrence in the whole text."""
    return texts(spark, sf_dir).select("doc_id", se.bold(F.col("text"), ["the", "der"]).alias("bold"))


@query(f"WITH {LIBRARY} SELECT field, value, count(*) AS count FROM (SELECT unnest([{{'field': 'source', 'value': source}}, {{'field': 'language', 'value': language}}, {{'field': 'quality_tier', 'value': quality_tier}}], recursive := true) FROM library) WHERE value <> '' GROUP BY 1, 2")
def facets(spark, sf_dir):
    return se.facets(library(spark, sf_dir), ["source", "language", "quality_tier"])


_SCORE = "CASE quality_tier WHEN 'high' THEN 0.8 WHEN 'low' THEN 0.4 END"


@query(f"WITH {LIBRARY} SELECT count(*) AS documents, round(CAST(coalesce(sum({_SCORE}), 0) AS DOUBLE) / count(*), 6) AS avg_quality, min(created_at) AS first_date, max(created_at) AS last_date FROM library")
def collection_stats(spark, sf_dir):
    out = se.statistics(library(spark, sf_dir), F.when(F.col("quality_tier") == "high", 0.8).when(F.col("quality_tier") == "low", 0.4), "created_at")
    return out.withColumn("avg_quality", F.round("avg_quality", 6))


@query(f"WITH {LIBRARY} SELECT source, language, quality_tier, count(*) AS documents, CAST(grouping(source) AS INTEGER) AS all_source, CAST(grouping(language) AS INTEGER) AS all_language, CAST(grouping(quality_tier) AS INTEGER) AS all_quality_tier FROM library GROUP BY GROUPING SETS ((source), (language), (quality_tier), ())")
def collection_distributions(spark, sf_dir):
    return se.distributions(library(spark, sf_dir), ["source", "language", "quality_tier"])


@query(f"WITH {LIBRARY} SELECT coalesce(quality_tier, 'Other') AS grp, count(*) AS documents, min(id) AS first_id FROM library GROUP BY 1")
def group_by_key(spark, sf_dir):
    return library(spark, sf_dir).groupBy(F.coalesce("quality_tier", F.lit("Other")).alias("grp")).agg(F.count("*").alias("documents"), F.min("id").alias("first_id"))


@query(f"WITH {LIBRARY} SELECT id, title FROM library ORDER BY created_at DESC, id LIMIT 25 OFFSET 50")
def paging(spark, sf_dir):
    return se.page(library(spark, sf_dir).select("id", "title", "created_at"), [F.desc("created_at"), "id"], 3, 25).select("id", "title")


_LINE = f"{sql_trim(rf'''regexp_replace(list_filter(list_transform(string_split(text, chr(10)), lambda x: {sql_trim('x')}), lambda x: x <> '')[1], '^#', '')''')}"


@query(f"WITH a AS (SELECT doc_id, {_LINE} AS l FROM documents) SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'Named ' || doc_id ELSE coalesce(nullif(CASE WHEN length(l) > 100 THEN left(l, 100) || '...' ELSE l END, ''), 'Document ' || doc_id) END AS title FROM a")
def titles(spark, sf_dir):
    n = F.col("doc_id")
    named = F.when(n % 10 == 0, F.concat(F.lit("Named "), n.cast("string")))
    return texts(spark, sf_dir).select("doc_id", se.title(F.lit(None).cast("string"), named, F.col("text"), n.cast("string")).alias("title"))


def _esc(c: str) -> str:
    return nested(c, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("'", "&#39;")])


_ODD = "text || ' <a & \"b\"> ''c''' || chr(10) || chr(10) || '  next line ' || chr(10) || 'x'"


@query(f"""WITH d AS (SELECT doc_id, {_ODD} AS x FROM documents)
  SELECT doc_id, array_to_string(list_transform(list_filter(string_split({_esc('x')}, chr(10) || chr(10)), lambda p: {sql_trim('p')} <> ''), lambda p: '<p>' || replace(p, chr(10), '<br>') || '</p>'), '') AS html,
    array_to_string(list_transform(string_split(x, chr(10)), lambda l: {sql_trim('l')}), chr(10)) AS markdown, array_to_string(list_filter(list_transform(string_split(x, chr(10)), lambda l: {sql_trim('l')}), lambda l: l <> ''), chr(10)) AS plain,
    '# T' || doc_id || chr(10) || chr(10) || x AS exported, '<document><id>' || doc_id || '</id><title>' || 'T' || doc_id || '</title><content>' || {_esc('x')} || '</content></document>' AS xml FROM d""")
def rendering(spark, sf_dir):
    n = F.col("doc_id").cast("string")
    docs = texts(spark, sf_dir).select("doc_id", F.concat("text", F.lit(" <a & \"b\"> 'c'\n\n  next line \nx")).alias("x"))
    head = F.concat(F.lit("T"), n)
    return docs.select("doc_id", *[se.render(F.col("x"), f).alias(f) for f in ("html", "markdown", "plain")], se.export(n, head, F.col("x"), "markdown").alias("exported"), se.export(n, head, F.col("x"), "xml").alias("xml"))


# -- corpus ------------------------------------------------------------------------------------------------------------


@query("SELECT source, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(sum(n_chars) // count(*) AS BIGINT) AS average, round(sum(n_chars) * 100.0 / sum(sum(n_chars)) OVER (), 6) AS share FROM documents GROUP BY source")
def corpus_by_category(spark, sf_dir):
    return cp.by_category(read(spark, sf_dir, "documents"), "source", "n_chars")


@query("SELECT source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) = 1")
def keep_longest_per_source(spark, sf_dir):
    return cp.longest_per_key(read(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), "source", "n_chars", "doc_id")


@query(f"SELECT CASE WHEN n_chars > 50000 THEN 'large' WHEN n_chars > 20000 THEN 'medium' ELSE 'small' END AS bucket, CASE WHEN w > 2000 THEN 'high' WHEN w > 500 THEN 'medium' ELSE 'low' END AS grade, count(*) AS documents, round(avg(CAST(contains(lower(text), 'tion') AS INTEGER)) * 100, 6) AS marked FROM (SELECT *, len({sql_fields('text')}) AS w FROM documents) GROUP BY 1, 2")
def size_buckets(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    marked = F.round(F.avg(t.has(F.lower("text"), "tion").cast("double")) * 100, 6)
    return docs.groupBy(cp.size_bucket(F.col("n_chars")).alias("bucket"), cp.length_grade(t.word_count(F.col("text"))).alias("grade")).agg(F.count("*").alias("documents"), marked.alias("marked"))


@query(f"SELECT doc_id, round(CAST(least(1, CASE WHEN w > 10000 THEN 0.3 WHEN w > 5000 THEN 0.2 WHEN w > 1000 THEN 0.1 ELSE 0 END + 0.02 * {sql_many('low', cp.EDUCATIONAL)} + CASE WHEN doc_id % 2 = 0 THEN 0.3 ELSE 0 END + 0.03 * {sql_many('low', cp.TECHNICAL)}) AS DOUBLE), 6) AS score FROM (SELECT doc_id, lower(text) AS low, len({sql_fields('text')}) AS w FROM documents)")
def additive_quality(spark, sf_dir):
    url = F.when(F.col("doc_id") % 2 == 0, "https://x.edu/a").otherwise("https://x.example/a")
    return read(spark, sf_dir, "documents").select("doc_id", F.round(cp.additive_score(F.col("text"), cp.host_bonus(url)), 6).alias("score"))


@query("SELECT doc_id FROM (SELECT doc_id, coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents) WHERE before < 100000")
def budget_prefix(spark, sf_dir):
    return co.within_budget(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), F.col("n_chars"), ["doc_id"], 100_000).select("doc_id")


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS first_id FROM documents")
def exact_dups(spark, sf_dir):
    return cp.exact_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id", "first_id")


@query("SELECT role, count(*) AS turns FROM (SELECT role FROM conversations UNION ALL SELECT role FROM conversations WHERE turn = 0) GROUP BY role")
def merge_union(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return cp.merged(c, c.where("turn = 0").drop("turn")).groupBy("role").agg(F.count("*").alias("turns"))


@query("SELECT coalesce(a.source, e.source) AS source, coalesce(n, 0) AS actual, coalesce(x, 0) AS expected, round(coalesce(n, 0) * 100.0 / x, 6) AS rate FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1) a FULL JOIN (VALUES ('src1', 40), ('src2', 50), ('none', 5)) e(source, x) ON a.source = e.source")
def store_verification(spark, sf_dir):
    actual = read(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("actual"))
    return cp.expected_and_actual(actual, spark.createDataFrame([("src1", 40), ("src2", 50), ("none", 5)], "source string, expected int"), "source").withColumn("expected", F.col("expected").cast("int"))


# -- compliance and rates ------------------------------------------------------------------------------------------------

_ROBOTS = "User-agent: *\nDisallow: /private/\nAllow: /private/open\nCrawl-delay: 2\n\nUser-agent: loom\nDisallow: /en/2*\nDisallow: /fr/\nAllow: /fr/8"


@query(f"""WITH p AS (SELECT page_id, url, {_HOST} AS host, coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1), ''), '') AS path FROM pages),
  r AS (SELECT *, contains(host, 'example.org') AS ruled, starts_with(path, '/fr/8') OR NOT (starts_with(path, '/en/2') OR starts_with(path, '/fr/')) AS fine, regexp_matches(host, 'example\\.(org|com)$') AS tos FROM p)
  SELECT page_id, (NOT ruled OR fine) AND tos AS allowed, concat_ws('; ', CASE WHEN ruled AND NOT fine THEN 'Blocked by robots.txt' END, CASE WHEN NOT tos THEN 'Terms of Service prohibit automation' END) AS restrictions,
    concat_ws('; ', CASE WHEN regexp_matches(host, 'example\\.com$') THEN 'Attribution required' END, 'Respect crawl delay of 1.0s', 'Use respectful crawling practices', 'Monitor for rate limiting') AS recommendations, 1.0::DOUBLE AS delay FROM r""")
def robots_verdict(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url", F.try_parse_url("url", F.lit("HOST")).alias("host"), F.coalesce(F.try_parse_url("url", F.lit("PATH")), F.lit("")).alias("path"))
    files = pages.where(F.contains("host", F.lit("example.org"))).select("host").distinct().withColumn("body", F.lit(_ROBOTS))
    policies = spark.createDataFrame([("example.org", True, False), ("example.com", True, True), ("example.net", False, False)], "domain string, allows_automation boolean, requires_attribution boolean")
    out = co.verdicts(pages, co.robots_rules(files), policies, "loom")
    return out.select("page_id", "allowed", F.array_join("restrictions", "; ").alias("restrictions"), F.array_join("recommendations", "; ").alias("recommendations"), "delay")


@query("SELECT 'h' AS host, '*' AS agent, '/private/open' AS allow, '/private/' AS disallow, 2.0::DOUBLE AS delay UNION ALL SELECT 'h', 'loom', '/fr/8', '/en/2*,/fr/', NULL")
def robots_parse(spark, sf_dir):
    out = co.robots_rules(spark.createDataFrame([("h", _ROBOTS)], "host string, body string"))
    return out.select("host", "agent", F.array_join("allow", ",").alias("allow"), F.array_join("disallow", ",").alias("disallow"), "delay")


@query("SELECT event_type, count(*) AS processed, count(*) FILTER (value > 20) AS successful, round(avg(value) FILTER (value > 20), 6) AS avg_quality, max(ts) AS last_seen FROM events GROUP BY 1")
def domain_stats(spark, sf_dir):
    return co.domain_stats(read(spark, sf_dir, "events"), "event_type", F.col("value") > 20, F.col("value"), "ts").withColumn("avg_quality", F.round("avg_quality", 6))


@query("SELECT event_id, round(coalesce(greatest(0, 3600 - (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6), 0), 6) AS wait, round(avg(CAST(event_type <> 'error' AS INTEGER)) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS success_rate FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def wait_times(spark, sf_dir):
    out = co.waits(read(spark, sf_dir, "events"), "user_id", "ts", "event_id", F.lit(3600.0))
    return co.recent_rates(out, "user_id", "ts", "event_id", F.col("event_type") != "error").select("event_id", F.round("wait", 6).alias("wait"), F.round("success_rate", 6).alias("success_rate"))


@query("""WITH g AS (SELECT *, sum(CAST(value <= 60 AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS good FROM events), r AS (SELECT event_id, sum(CAST(value > 60 AS INTEGER)) OVER (PARTITION BY user_id, good ORDER BY ts, event_id) AS n FROM g)
  SELECT event_id, CAST(n AS BIGINT) AS errors, CAST(CASE WHEN n > 3 THEN least(n * 30, 300) ELSE 0 END AS BIGINT) AS backoff FROM r""")
def error_backoff(spark, sf_dir):
    return co.error_backoff(read(spark, sf_dir, "events"), "user_id", "ts", "event_id", F.col("value") > 60).select("event_id", "errors", "backoff")


# -- training records ----------------------------------------------------------------------------------------------------

_OVERVIEW = f"coalesce(list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda p: {sql_trim('p')}), lambda p: strlen(p) > 50 AND strlen(p) < 300)[1], CASE WHEN strlen(text) > 200 THEN left(text, 200) || '...' ELSE text END)"
_POINTS = f"array_to_string(list_transform(list_filter(list_transform(string_split(text, chr(10)), lambda x: {sql_trim('x')}), lambda x: strlen(x) > 20 AND strlen(x) < 150 AND (contains(x, ':') OR starts_with(x, '- ') OR starts_with(x, '* ')))[1:7], lambda x: '• ' || x), chr(10))"
_ID = "lower(regexp_replace(title, '[^a-zA-Z0-9_-]', '_', 'g'))"


@query(f"""WITH {LIBRARY}, b AS (SELECT *, {_OVERVIEW} AS o, {_POINTS} AS k, len({sql_fields('text')}) AS w FROM library), r AS (
  SELECT id, {_ID} || '_overview_' || id AS conversation_id, 'overview' AS kind, 'What does ' || title || ' cover?' AS question, 'Here''s what it covers:' || chr(10) || chr(10) || o AS answer FROM b
  UNION ALL SELECT id, {_ID} || '_detailed_explanation_' || id, 'detailed_explanation', 'I need detailed information about ' || lower(title) || '. What are the key concepts?', o || chr(10) || chr(10) || 'In all there are ' || w || ' words.' FROM b
  UNION ALL SELECT id, {_ID} || '_quick_reference_' || id, 'quick_reference', 'Give me a quick reference for ' || title || '.', 'Here''s a quick reference for ' || title || ':' || chr(10) || chr(10) || k FROM b) SELECT * FROM r""")
def conv_fanout(spark, sf_dir):
    out = cv.conversations_of(library(spark, sf_dir))
    return out.select("id", "conversation_id", "kind", F.col("conversation")[0]["content"].alias("question"), F.col("conversation")[1]["content"].alias("answer"))


@query(f"WITH {LIBRARY}, b AS (SELECT *, {_OVERVIEW} AS o, {_POINTS} AS k, len({sql_fields('text')}) AS w FROM library), r AS (SELECT 'overview' AS kind, length('What does  cover?') + length(title) + length('Here''s what it covers:') + 2 + length(o) AS n FROM b UNION ALL SELECT 'detailed_explanation', length('I need detailed information about . What are the key concepts?') + length(lower(title)) + length(o) + 2 + length('In all there are  words.') + length(CAST(w AS VARCHAR)) FROM b UNION ALL SELECT 'quick_reference', length('Give me a quick reference for .') + 2 * length(title) + length('Here''s a quick reference for :') + 2 + length(k) FROM b) SELECT kind, count(*) AS conversations, count(*) * 2 AS turns, CAST(sum(n) AS BIGINT) AS chars FROM r GROUP BY 1")
def conv_summary(spark, sf_dir):
    return cv.summary(cv.conversations_of(library(spark, sf_dir)))


_TERM_LIST = "list_filter([" + ", ".join(f"CASE WHEN contains(lower(text), {quoted(x)}) THEN {quoted(x)} END" for x in cv.TERMS) + "], lambda x: x IS NOT NULL)"


@query(f"WITH {LIBRARY} SELECT id, array_to_string(list_concat(list_filter(list_transform({sql_fields('lower(title)')}, lambda w: trim(w, '.,!?()[]{{}}:;\"''')), lambda w: strlen(w) > 2 AND w NOT IN ('the', 'and', 'for')), {_TERM_LIST}), ',') AS keywords FROM library")
def conv_keywords(spark, sf_dir):
    docs = texts(spark, sf_dir).select("doc_id", F.array_join(cv.keywords(title(F.col("text")), F.col("text")), ",").alias("keywords"))
    return labelled(spark, sf_dir, docs).select(F.col("doc_id").cast("string").alias("id"), "keywords")


_DOMAINS, _KINDS = ["Programming", "Web", "AI", "History"], ["Theory", "Architecture", "General"]
_F = lambda cond, *names: ", ".join(f"CASE WHEN {cond} THEN '{n}' END" for n in names)


@query(f"""WITH d AS (SELECT doc_id, text, [{', '.join(map(quoted, _DOMAINS))}][doc_id % 4 + 1] AS domain, [{', '.join(map(quoted, _KINDS))}][doc_id % 3 + 1] AS category FROM documents)
  SELECT doc_id, concat_ws(',', 'explanation', 'qa', {_F("domain IN ('Programming', 'CS') OR " + sql_any('text', ['function', 'algorithm']), 'code_example', 'tutorial', 'best_practices')}, {_F(sql_any('text', ['theorem', 'principle']) + " OR category = 'Theory'", 'deep_dive')},
    {_F("domain IN ('DevOps', 'Web', 'Cloud')", 'step_by_step', 'troubleshooting')}, {_F(sql_any('text', ['advantage', 'disadvantage', 'versus', 'compared']), 'comparison')}, {_F('doc_id % 5 > 3', 'interview', 'case_study')}, {_F("domain = 'AI' OR category = 'Architecture'", 'debate')}) AS formats FROM d""")
def conv_formats(spark, sf_dir):
    n = F.col("doc_id")
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (n % len(xs) + 1).cast("int"))
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(cv.formats(pick(_DOMAINS), pick(_KINDS), F.col("text"), F.when(n % 5 > 3, 6).otherwise(2)), ",").alias("formats"))


@query()
def conv_sections(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.posexplode(cv.sections(F.col("text"))).alias("nth", "section"))


@query("SELECT role, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars, count(DISTINCT conv_id) AS conversations FROM conversations GROUP BY 1")
def turns_per_role(spark, sf_dir):
    return read(spark, sf_dir, "conversations").groupBy("role").agg(F.count("*").alias("turns"), F.sum(F.length("text")).alias("chars"), F.countDistinct("conv_id").alias("conversations"))


_MODELS = [("a", ["code", "math"], 0.9, 0.8, 0.01, 1.0, True), ("b", ["prose"], 0.95, 0.7, 0.0, 1.1, True), ("c", ["code", "prose", "math"], 0.99, 0.9, 0.2, 1.0, False), ("d", ["math"], 0.8, 0.9, 0.002, 1.0, True)]


@query("""WITH m(name, caps, s, q, c, w) AS (VALUES ('a', ['code', 'math'], 0.9, 0.8, 0.01, 1.0), ('b', ['prose'], 0.95, 0.7, 0.0, 1.1), ('d', ['math'], 0.8, 0.9, 0.002, 1.0)),
  r AS (SELECT event_id, [['code'], ['prose', 'math'], ['math'], CAST([] AS VARCHAR[])][event_id % 4 + 1] AS needs FROM events),
  x AS (SELECT event_id, name, round(CAST((len(list_intersect(caps, needs)) * 0.3 + s * 0.25 + q * 0.25 + CASE WHEN c > 0 THEN 0.2 / (1 + c * 100) ELSE 0 END) * w AS DOUBLE), 9) AS score FROM r, m)
  SELECT event_id, name AS model, round(score, 6) AS score FROM x QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY score DESC, name) = 1""")
def model_choice(spark, sf_dir):
    models = spark.createDataFrame(_MODELS, "name string, capabilities array<string>, success_rate double, quality double, cost double, weight double, usable boolean")
    needs = F.element_at(F.array(F.array(F.lit("code")), F.array(F.lit("prose"), F.lit("math")), F.array(F.lit("math")), F.array().cast("array<string>")), (F.col("event_id") % 4 + 1).cast("int"))
    return cv.best_model(read(spark, sf_dir, "events").select("event_id", needs.alias("needs")), models, "event_id").withColumn("score", F.round("score", 6))


# -- streams -------------------------------------------------------------------------------------------------------------


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY 1")
def stream_event_counts(spark, sf_dir):
    stream = ev.subscribe(ev.source(spark, f"{sf_dir}/events.parquet"), "click", "view").groupBy("event_type").agg(F.count("*").alias("n"))
    return ev.to_table(stream, "stream_event_counts", "complete")


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_windows(spark, sf_dir):
    out = ev.to_table(ev.windowed_counts(ev.source(spark, f"{sf_dir}/events.parquet"), late="60 days"), "stream_windows", "complete")
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


@query("SELECT count(*) AS users FROM (SELECT DISTINCT user_id FROM events)")
def stream_dedup(spark, sf_dir):
    out = ev.to_table(ev.deduplicated(ev.source(spark, f"{sf_dir}/events.parquet"), ["user_id"], "60 days").select("user_id"), "stream_dedup")
    return out.agg(F.count("*").alias("users"))


@query()
def adaptive_delay(spark, sf_dir):
    stream = ev.timed(ev.source(spark, f"{sf_dir}/events.parquet"))
    rows = stream.select(F.concat(F.lit("d"), F.col("user_id") % 5).alias("key"), "ts", F.col("event_id").alias("order"), (F.col("event_type") != "error").alias("ok"), (F.col("value") > 95).alias("limited"))
    return ev.to_table(ev.adaptive_delays(rows), "adaptive_delay", "update")
