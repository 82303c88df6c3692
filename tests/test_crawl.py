"""From pages to documents: robots rules by time, refusals and their order, whitelists, ingestion that survives restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import compliance, crawl

T0 = dt.datetime(2024, 1, 1)
PAGE = "url string, host string, path string, at timestamp, status int, content_type string, html string"
GOOD = "<html><head><title> A title </title><meta name='author' content='Ann'></head><body><main>" + "word " * 50 + "</main></body></html>"


def hours(n):
    return T0 + dt.timedelta(hours=n)


def page(url="https://a.org/x/1", at=5, status=200, kind="text/html", html=GOOD):
    host = url.split("/")[2] if "//" in url else None
    return (url, host, "/" + url.split("/", 3)[3] if url.count("/") > 2 else "", hours(at), status, kind, html)


@pytest.fixture(scope="module")
def robots(spark):
    rows = [("a.org", hours(0), "User-agent: *\nDisallow: /x/"), ("a.org", hours(10), "User-agent: loom\nDisallow: /y/\nUser-agent: *\nDisallow: /"), ("b.org", hours(1), "# nothing")]
    return spark.createDataFrame(rows, "host string, fetched_at timestamp, body string")


@pytest.fixture(scope="module")
def policies(spark):
    return spark.createDataFrame([("a.org", True, False), ("b.org", True, True), ("c.org", False, False)], "domain string, allows_automation boolean, requires_attribution boolean")


def test_rules_are_those_of_the_time(spark, robots):
    pages = spark.createDataFrame([page(at=a) for a in (-1, 0, 5, 9.99, 10, 21.9, 22, 99)] + [page("https://b.org/", at=2)], PAGE).repartition(3)
    got = {(r.host, r.at): r.rule and r.rule.disallow for r in crawl.rules_at(pages, robots, "loom", hours=12).collect()}
    assert got == {
        ("a.org", hours(-1)): None, ("a.org", hours(0)): ["/x/"], ("a.org", hours(5)): ["/x/"], ("a.org", hours(9.99)): ["/x/"], ("a.org", hours(10)): ["/y/"],
        ("a.org", hours(21.9)): ["/y/"], ("a.org", hours(22)): None, ("a.org", hours(99)): None, ("b.org", hours(2)): None,
    }


def test_rates_and_sitemaps(spark):
    body = "Sitemap: https://a.org/1.xml\nUser-agent: *\nRequest-rate: 1/5\nCrawl-delay: 3\nsitemap:https://a.org/2.xml # two\nUser-agent: loom\n request-RATE : 2/9\nDisallow: /q"
    files = spark.createDataFrame([("a.org", body), ("b.org", None), ("c.org", "")], "host string, body string")
    assert {(r.agent, r.request_rate, r.delay) for r in compliance.robots_rules(files).collect()} == {("*", "1/5", 3.0), ("loom", "2/9", None)}
    assert [tuple(r) for r in compliance.sitemaps(files, ["host"]).orderBy("nth").collect()] == [("a.org", 0, "https://a.org/1.xml"), ("a.org", 1, "https://a.org/2.xml")]


def test_refusals_in_order(spark, robots, policies):
    cases = {
        page("ftp://a.org/1"): "only HTTP and HTTPS URLs are allowed", page("https://a.org/x/2", at=1, status=404): "URL not allowed: Blocked by robots.txt", page("https://c.org/3", kind=None): "URL not allowed: Terms of Service prohibit automation",
        page("https://a.org/4", status=404, kind="image/png"): "status 404", page("https://a.org/5", status=None): "status unknown", page("https://a.org/6", kind="image/png"): "Unsupported content type: image/png",
        page("https://a.org/7", html="x" * 2000): "Content exceeds maximum size limit", page("https://a.org/8", html=None): "Quality score 0.00 below threshold 0.60", page("https://sub.a.org/9"): None,
    }
    score = lambda d: d.withColumn("overall", F.when(F.col("text") == "", 0.0).otherwise(0.9))
    pages = spark.createDataFrame(list(cases), PAGE).withColumn("row", F.lit(1))
    got = crawl.routed(pages, robots, policies, "loom", score, hours=12, most_bytes=1500).collect()
    assert {r.url: r.reason for r in got} == {p[0]: why for p, why in cases.items()}
    ok = next(r for r in got if r.accepted)
    assert (ok.title, ok.metadata["author"], ok.quality, ok.row) == ("A title", "Ann", 0.9, 1) and ok.text.startswith("word word")
    assert sum(r.accepted for r in got) == 1 and all(r.text is None for r in got if r.reason and not r.reason.startswith("Quality"))


def test_validators(spark, robots, policies):
    pages = spark.createDataFrame([page("https://a.org/4")], PAGE)
    assert crawl.routed(pages, robots, policies, "loom", None).first().quality == crawl.UNJUDGED
    failing = crawl.routed(pages, robots, policies, "loom", lambda d: d.withColumn("overall", F.lit(None).cast("double"))).first()
    assert (failing.quality, failing.accepted) == (crawl.FAILED, False)
    assert crawl.routed(pages, robots, policies, "loom").first().quality == crawl.FAILED  # fifty words are too few to assess


def test_whitelist(spark, robots, policies):
    white = spark.createDataFrame([("a.org",)], "domain string")
    pages = spark.createDataFrame([page("https://deep.a.org/1"), page("https://b.org/1"), page("https://xa.org/1")], PAGE)
    got = {r.host: r.reason for r in crawl.routed(pages, robots, policies, "loom", None, whitelist=white, blacklist=["b.org"]).collect()}
    assert got == {"deep.a.org": None, "b.org": "URL not allowed: Domain not in whitelist", "xa.org": "URL not allowed: Domain not in whitelist"}


def test_ingestion_takes_each_document_once_through_a_crash(spark, robots, policies, tmp_path):
    src, out, progress = (str(tmp_path / n) for n in ("src", "out", "progress"))
    route = lambda df: crawl.routed(df, robots, policies, "loom", None)

    def arrive(*urls):
        spark.createDataFrame([page(u, at=7 + i) for i, u in enumerate(urls)], PAGE).coalesce(1).write.mode("append").parquet(src)

    def run(step=route):
        crawl.ingest(spark.readStream.schema(PAGE).parquet(src), step, out, progress)
        return sorted(r.url for r in spark.read.parquet(out).where("accepted").collect())

    arrive("https://a.org/1", "https://a.org/2", "https://a.org/1#again")
    assert run() == ["https://a.org/1", "https://a.org/2"]
    arrive("https://a.org/2#other", "https://a.org/3", "https://c.org/no")

    def crash(df):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(crash)
    assert run() == ["https://a.org/1", "https://a.org/2", "https://a.org/3"]
    # the end of the last batch was lost after its rows were written: it runs again and replaces them
    import os

    last = max(int(n) for n in os.listdir(f"{progress}/commits") if n.isdigit())
    os.remove(f"{progress}/commits/{last}")
    os.remove(f"{progress}/commits/.{last}.crc")
    assert run() == ["https://a.org/1", "https://a.org/2", "https://a.org/3"]
    assert spark.read.parquet(out).where("not accepted").count() == 1


def test_empty(spark, robots, policies):
    none = spark.createDataFrame([], PAGE)
    assert crawl.routed(none, robots, policies, "loom", None).count() == 0
    assert crawl.routed(spark.createDataFrame([page()], PAGE), robots.limit(0), policies.limit(0), "loom", None).first().reason.startswith("URL not allowed")
