"""Pages to documents and robots files by time, with the SQL that checks them. Times, status and media types follow from the page's number."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.operators import compliance, crawl
from corpusloom.plans import q_operators
from corpusloom.plans.fixture import read

QUERIES, ORACLES = {}, {}
HOURS = 12.0


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__], ORACLES[fn.__name__] = fn, sql
        return fn

    return register


def fetched(spark, sf_dir):
    n = F.col("page_id")
    host = F.try_parse_url("url", F.lit("HOST"))
    return read(spark, sf_dir, "pages").select(
        "page_id", "url", host.alias("host"), F.coalesce(F.try_parse_url("url", F.lit("PATH")), F.lit("")).alias("path"),
        F.timestamp_add("MINUTE", (n * 7).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("at"),
        F.when(n % 11 == 3, 404).when(n % 11 == 7, F.lit(None)).otherwise(200).alias("status"), F.when(n % 13 == 5, "application/pdf").otherwise("text/html; charset=utf-8").alias("content_type"), "html",
    )


def robots(spark, sf_dir):
    """A robots file of every third page's host, fetched an hour before the page; it shuts the page's first folder."""
    pages = fetched(spark, sf_dir).where("page_id % 3 = 0")
    folder = F.regexp_extract("path", "^/[^/]*/", 0)
    body = F.concat(F.lit("Sitemap: https://"), "host", F.lit("/map.xml\nUser-agent: other\nDisallow: /\nUser-agent: *\nDisallow: "), folder, F.lit("\nRequest-rate: 1/5 # slow\nCrawl-delay: 2"))
    return pages.select("host", (F.col("at") - F.expr("INTERVAL 1 HOUR")).alias("fetched_at"), body.alias("body"))


def policies(spark):
    return spark.createDataFrame([("example.org", True, False), ("example.com", True, True), ("example.net", False, False)], "domain string, allows_automation boolean, requires_attribution boolean")


_HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"
_P = rf"""p AS (SELECT page_id, url, {_HOST} AS host, coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1), ''), '') AS path, TIMESTAMP '2024-01-01' + to_minutes(page_id * 7) AS moment,
    CASE WHEN page_id % 11 = 3 THEN 404 WHEN page_id % 11 <> 7 THEN 200 END AS status, CASE WHEN page_id % 13 = 5 THEN 'application/pdf' ELSE 'text/html' END AS media FROM pages),
f AS (SELECT host, moment - INTERVAL 1 HOUR AS since, regexp_extract(path, '^/[^/]*/') AS folder FROM p WHERE page_id % 3 = 0),
r AS (SELECT p.*, since IS NOT NULL AND moment < since + INTERVAL 12 HOURS AS ruled, since, folder FROM p ASOF LEFT JOIN f ON p.host = f.host AND p.moment >= f.since)"""


@query(f"WITH {_P} SELECT page_id, CASE WHEN ruled THEN epoch_us(since) END AS since_us, CASE WHEN ruled THEN '1/5' END AS request_rate, CASE WHEN ruled AND folder <> '' THEN starts_with(path, folder) ELSE false END AS shut FROM r")
def robots_at_time(spark, sf_dir):
    """The robots file that was valid when a page was fetched, and whether it shuts the page."""
    pages, files = fetched(spark, sf_dir), robots(spark, sf_dir)
    known = crawl.rules_at(pages, files.withColumn("body", F.concat("body", F.lit("\nAllow: at-"), F.unix_micros("fetched_at").cast("string"))), "loom", HOURS)
    since = F.get(F.col("rule.allow"), F.lit(0))
    shut = F.col("rule").isNotNull() & ~compliance.path_allowed(F.col("rule.allow"), F.col("rule.disallow"), F.col("path"))
    return known.select("page_id", F.substring(since, 4, 30).cast("long").alias("since_us"), "rule.request_rate", shut.alias("shut"))


@query(f"WITH {_P} SELECT host, epoch_us(since) AS since_us, CAST(0 AS INTEGER) AS nth, 'https://' || host || '/map.xml' AS url FROM f")
def robots_sitemaps(spark, sf_dir):
    return compliance.sitemaps(robots(spark, sf_dir), ["host", "fetched_at"]).select("host", F.unix_micros("fetched_at").alias("since_us"), "nth", "url")


_TEXT = q_operators.ORACLES["page_text_regex"]


@query(rf"""WITH {_P}, x AS ({_TEXT}),
j AS (SELECT r.*, text, least(1, strlen(text) / 1000.0) AS q, CASE
    WHEN (ruled AND folder <> '' AND starts_with(path, folder)) OR NOT regexp_matches(host, 'example\.(org|com)$') THEN 'URL not allowed: ' || concat_ws(', ', CASE WHEN ruled AND folder <> '' AND starts_with(path, folder) THEN 'Blocked by robots.txt' END, CASE WHEN NOT regexp_matches(host, 'example\.(org|com)$') THEN 'Terms of Service prohibit automation' END)
    WHEN status IS DISTINCT FROM 200 THEN 'status ' || coalesce(CAST(status AS VARCHAR), 'unknown') WHEN media <> 'text/html' THEN 'Unsupported content type: ' || media END AS early
  FROM r JOIN x USING (page_id))
SELECT page_id, early IS NULL AND q >= 0.6 AS accepted, coalesce(early, CASE WHEN q < 0.6 THEN 'too little text' END) AS reason, CASE WHEN early IS NULL THEN text END AS text FROM j""")
def page_routing(spark, sf_dir):
    """Every page as an accepted document or a refusal with its reason; the validator here goes by length."""

    def by_length(docs):
        return docs.withColumn("overall", F.least(F.lit(1.0), t.size_of(F.col("text")) / 1000.0))

    out = crawl.routed(fetched(spark, sf_dir), robots(spark, sf_dir), policies(spark), "loom", by_length, hours=HOURS)
    reason = F.when(F.startswith("reason", F.lit("Quality score")), "too little text").otherwise(F.col("reason"))
    return out.select("page_id", "accepted", reason.alias("reason"), "text")
