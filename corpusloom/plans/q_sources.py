"""Queries of the table of crawl sources and of the token bucket."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import sources_plan as sp
from corpusloom.plans.fixture import read
from corpusloom.streaming import events as ev

QUERIES, ORACLES = {}, {}
NOW = "2024-01-10 00:00:00"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def sources(spark, sf_dir):
    """A source per nation: some without a name or start URLs, some paused."""
    n = F.col("n_nationkey")
    urls = F.when(n % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("https://"), F.lower("n_name"), F.lit(".example/a")), F.concat(F.lit("https://"), F.lower("n_name"), F.lit(".example/b.pdf"))))
    return read(spark, sf_dir, "nation").select(
        n.cast("string").alias("id"), F.when(n % 7 == 0, "").otherwise(F.col("n_name")).alias("name"), F.lit("https://x.example").alias("base_url"), urls.alias("start_urls"), (n % 3).alias("priority"),
        F.create_map(F.lit("region"), F.col("n_regionkey").cast("string")).alias("metadata"), F.when(n % 4 == 0, "paused").otherwise("active").alias("status"),
        F.timestamp_add("DAY", n, F.lit("2024-01-01").cast("timestamp_ntz")).alias("next_crawl"), F.lit(86400).alias("interval_s"),
    )


@query("SELECT CASE WHEN n_nationkey % 7 = 0 THEN 'source name is required' WHEN n_nationkey % 5 = 0 THEN 'at least one start URL is required' ELSE 'valid' END AS outcome, count(*) AS n FROM nation GROUP BY 1")
def source_validation(spark, sf_dir):
    return sources(spark, sf_dir).groupBy(F.coalesce(sp.problem(*map(F.col, ("id", "name", "base_url", "start_urls"))), F.lit("valid")).alias("outcome")).agg(F.count("*").alias("n"))


@query("SELECT n_nationkey || '-0' AS job_id, 'https://' || lower(n_name) || '.example/a' AS url, n_nationkey % 3 AS priority, CASE WHEN n_nationkey % 7 = 0 THEN '' ELSE n_name END || '/' || n_regionkey AS tags FROM nation WHERE n_nationkey % 5 <> 0")
def crawl_jobs(spark, sf_dir):
    made = sp.jobs(sources(spark, sf_dir)).where(sp.passes_rules(sp.DEFAULT_RULES))
    return made.select("job_id", "url", "priority", F.concat_ws("/", F.col("metadata")["source_name"], F.col("metadata")["region"]).alias("tags"))


@query(f"""WITH s AS (SELECT n_nationkey AS n, CASE WHEN n_nationkey % 4 = 0 THEN 'paused' ELSE 'active' END AS status, TIMESTAMP '2024-01-01' + to_days(n_nationkey) AS nx FROM nation)
  SELECT CAST(n AS VARCHAR) AS id, CASE WHEN n % 2 = 0 THEN 'active' ELSE 'error' END AS status, TIMESTAMP '{NOW}' + to_days(CASE WHEN n % 2 = 0 THEN 1 ELSE 2 END) AS next_crawl FROM s WHERE status = 'active' AND nx < TIMESTAMP '{NOW}'""")
def due_sources(spark, sf_dir):
    now = F.lit(NOW).cast("timestamp_ntz")
    found = sp.due(sources(spark, sf_dir), now)
    outcomes = found.select("id", (F.col("id").cast("int") % 2 == 0).alias("ok"))
    return sp.after_crawl(found, outcomes, now).select("id", "status", "next_crawl")


@query("SELECT count(*) AS sources, count(*) FILTER (n_nationkey % 4 <> 0) AS active, CAST(0 AS BIGINT) AS errors, true AS healthy FROM nation")
def service_health(spark, sf_dir):
    return sp.health(sources(spark, sf_dir), 12)


@query()
def token_bucket(spark, sf_dir):
    rows = ev.timed(ev.source(spark, f"{sf_dir}/events.parquet")).select(F.col("event_type").alias("key"), "ts", F.col("event_id").alias("order"))
    return ev.to_table(ev.token_bucket(rows, 5, 1800.0), "token_bucket").groupBy("key", "granted").agg(F.count("*").alias("n"))
