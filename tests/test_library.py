"""The query language, the store, cleaning, quality, search and the rest on small fixtures."""

import datetime as dt
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import assessment, cleaning, readability, vectors, web
from corpusloom.operators import compliance, conversations, corpus, search
from corpusloom.plans import gql
from corpusloom.sources import library as store


@pytest.fixture(scope="module")
def views(spark):
    at = dt.datetime(2024, 5, 1)
    rows = [
        ("t1", "arXiv", "u1", "Neural Networks in Machine Learning", "John Smith", None, {"attribution": "collected by the library"}, at),
        ("t2", "PubMed", "u2", "Medical Research", None, "Jane Doe, Bob Wilson", {"x": "no mark"}, at + dt.timedelta(hours=12)),
        ("t3", "arXiv", "u3", "Transformer Architecture Analysis", "Alice Johnson", "Alice Johnson, Jane Doe", {"attribution": "none"}, at + dt.timedelta(hours=18)),
        ("t4", "", "u4", None, "", None, {}, at + dt.timedelta(hours=20)),
    ]
    lib = spark.createDataFrame(rows, "id string, source string, url string, title string, author string, authors string, metadata map<string,string>, created_at timestamp")
    return gql.Views(lib, "Collected by")


def ids(df):
    return [r.id for r in df.collect()]


@pytest.mark.parametrize(
    "text,want",
    [
        ("SELECT FROM documents", ["t1", "t2", "t3", "t4"]),
        ('SELECT FROM documents WHERE source = "arXiv"', ["t1", "t3"]),
        ('select from documents where title ~ "NEURAL"', ["t1"]),
        ('SELECT FROM documents WHERE author = "Jane Doe, Bob Wilson"', ["t2"]),
        ('SELECT FROM documents WHERE source = "arXiv" AND author = "John Smith"', ["t1"]),
        ("SELECT FROM documents ORDER BY created_at DESC LIMIT 2", ["t4", "t3"]),
        ('SELECT FROM documents WHERE title != "x"', ["t1", "t2", "t3", "t4"]),
        ("SELECT FROM documents WHERE title not exists", ["t4"]),
        ("SELECT FROM documents WHERE attribution exists AND NOT (source = 'PubMed')", ["t1", "t3"]),
        ('SELECT FROM documents WHERE created_at > "2024-05-01T13:00:00"', ["t3", "t4"]),
        ('SELECT FROM documents WHERE created_at > "not a date"', []),
        ("SELECT FROM documents WHERE source in ('PubMed', \"x\") OR id = t4", ["t2", "t4"]),
        ("SELECT FROM documents WHERE authors ~ 'jane' ORDER BY title", ["t2", "t3"]),
        ("SELECT FROM documents LIMIT 0", []),
    ],
)
def test_documents(views, text, want):
    assert ids(gql.plan(text, views)) == want


@pytest.mark.parametrize("text", ["", "SELECT", "SELECT FROM nothing", "SELECT FROM documents WHERE", "SELECT FROM documents WHERE a", "SELECT FROM documents LIMIT x", "SELECT FROM documents @", 'SELECT FROM documents WHERE a = "x" junk', "SELECT FROM documents WHERE a in (1", 'SELECT FROM documents WHERE a = "open'])
def test_errors(text):
    with pytest.raises(gql.QueryError):
        gql.parse(text)


def test_groups(views):
    assert [tuple(r) for r in gql.plan("SELECT FROM sources", views).collect()] == [("arXiv", 2), ("PubMed", 1), ("unknown", 1)]
    assert [tuple(r) for r in gql.plan("SELECT FROM sources WHERE count > 1", views).collect()] == [("arXiv", 2)]
    assert {tuple(r) for r in gql.plan("SELECT FROM authors", views).collect()} == {("Alice Johnson", 1), ("Jane Doe", 2), ("John Smith", 1), ("Bob Wilson", 1)}
    rows = {r.source: r for r in gql.plan("SELECT FROM attribution", views).collect()}
    assert rows["arXiv"].attributed and not rows["PubMed"].attributed and rows["arXiv"].attribution == "none"


def test_builder():
    b = gql.Builder("documents").where("source", "=", "arXiv").where("n", ">", 3).order_by("title", True).limit(5)
    assert b.text() == 'SELECT FROM documents WHERE source = "arXiv" AND n > 3 ORDER BY title DESC LIMIT 5'
    assert gql.parse(b.text()).order_by == b.query().order_by and all(gql.parse(q) for q in gql.EXAMPLES.values())


def test_builder_text_reads_back():
    values = ['a "b" c', "it's", "back\\slash \\", "", "x\ny", True, False, 0, -7, 1234567, 12345678901234567, 0.1, -2.5, 1e20, 1e-7, 1234567.0]
    for v in values:
        b = gql.Builder("documents").where("n", "!=", v).any_of(("a.b", "in", v, "z"), ("c", "exists")).none_of(("d", "between", v, v)).where("e", "not exists").limit(None)
        assert gql.parse(b.text()) == b.query(), b.text()
    with pytest.raises(gql.QueryError):
        gql.Builder().where("n", "=", float("nan")).text()


@pytest.mark.parametrize("text, want", [
    ("n = 1234567", ["a"]), ("n != 1234567", ["b", "c", "d", "e"]), ("n in (1234567, 9.0)", ["a", "b"]), ("n between 5 and 200", ["b", "c"]), ("n not in (9)", ["a", "c", "d", "e"]), ("n > 1234566", ["a"]),
    ("n < -1", []), ('n = "1234567"', ["a"]), ("m = 100", ["b"]), ("m between 99.5 and 100.5", ["b"]), ("m != 100", ["a", "c", "d", "e"]), ('n between "1" and "2"', ["a", "c"]), ("big = 9007199254740993", ["a"]),
])
def test_numbers_compare_alike(spark, text, want):
    rows = [("a", "1234567", 1, 9007199254740993), ("b", "9", 100, 9007199254740992), ("c", "100", 7, 1), ("d", "word", None, 2), ("e", None, None, None)]
    lib = spark.createDataFrame(rows, "id string, n string, m long, big long").select("id", "m", "big", F.create_map(F.lit("n"), F.col("n")).alias("metadata"))
    assert ids(gql.plan(f"SELECT FROM documents WHERE {text}", gql.Views(lib, "x"))) == want


def test_top_k_and_pushdown(spark, tmp_path, views):
    path = str(tmp_path / "lib")
    views.library.write.parquet(path)
    df = gql.plan('SELECT FROM documents WHERE source = "arXiv" ORDER BY title LIMIT 1', gql.Views(spark.read.parquet(path), "x")).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "EqualTo(source,arXiv)" in plan


def test_store(spark, tmp_path):
    at = dt.datetime(2024, 3, 4)
    docs = spark.createDataFrame([("abcdef", ("web", "u", None), (None, "hi", {"a": "b"}, [1.0]), at, at), ("b", ("web", None, None), (None, "", {}, None), at, at)], store.SCHEMA)
    store.store(docs, str(tmp_path / "lib"))
    back = store.load(spark, str(tmp_path / "lib"))
    assert ids(back) == ["abcdef"] and back.first().month == 3 and ids(store.get(back, "abcdef")) == ["abcdef"]
    assert [tuple(r) for r in store.rejected(docs).collect()] == [("b", "either source URL or path is required")]
    paths = spark.createDataFrame([("a",), ("abc",), ("abcd",)], "id string").select(store.hashed_path(F.col("id"))).collect()
    assert [r[0] for r in paths] == ["documents/a", "documents/ab/abc", "documents/ab/cd/abcd"]


@pytest.mark.parametrize(
    "rule,text,want",
    [
        ("whitespace_normalization", "  a   b\n\n c\t", "a b c"),
        ("html_tag_removal", "<p>Hello <b>world</b> &amp; all</p>", "Hello world & all"),
        ("url_cleaning", "see https://x.org/a and www.y.com ok", "see [URL] and [URL] ok"),
        ("email_obfuscation", "to me@x.org!", "to [EMAIL]!"),
        ("number_normalization", "Pi is 3.14159265359 approximately", "Pi is 3.14 approximately"),
        ("punctuation_cleaning", "Really???????", "Really???"),
        ("encoding_normalization", "itâ€™s​ a b\u0007", "it's a b"),
        ("duplicate_line_removal", "a\na \nb\n\n\na", "a\nb\n\n\na"),
    ],
)
def test_rules(spark, rule, text, want):
    apply = next(r.apply for r in cleaning.CHAIN if r.name == rule)
    assert spark.createDataFrame([(text,)], "t string").select(apply(F.col("t"))).first()[0] == want


def test_cleaner_options(spark):
    df = spark.createDataFrame([("<b>x</b>  1.23456",), (None,), ("",)], "text string")
    rows = cleaning.Cleaner().apply(df).collect()
    assert rows[0].cleaned == "x 1.23" and rows[0].rules_applied == ["whitespace_normalization", "html_tag_removal", "number_normalization"] and rows[1].cleaned == ""
    assert cleaning.Cleaner().apply(df, kind="markdown").first().cleaned == "<b>x</b> 1.23456"
    only = cleaning.Cleaner().restricted(allow=["email_obfuscation"], deny=["email_obfuscation"])
    assert only.names() == ["email_obfuscation"] and "url_cleaning" not in cleaning.Cleaner().restricted(deny=["url_cleaning"]).names()
    assert cleaning.Cleaner().add(cleaning.Rule("up", F.upper)).apply(df).first().cleaned == "X 1.23"


def test_full_references(spark):
    df = spark.createDataFrame([("&eacute;&hellip;&#x41;",)], "t string")
    assert df.select(cleaning.decode_all("t")).first()[0] == "é…A"


def test_assessment_bands(spark):
    good = "The study of algorithms shows steady progress. " * 3 + "According to the survey of 2020, results improved by 20 percent. " * 12
    df = spark.createDataFrame([(good, {"title": "T", "topic": "algorithms", "content_type": "article", "domain": "technology"}), ("Hi", {}), ("", {})], "text string, metadata map<string,string>")
    rows = assessment.assess(df).collect()
    assert 0.3 < rows[0].overall <= 1 and rows[0].error is None and rows[0].tier in ("high", "medium", "low", "premium")
    assert rows[1].overall is None and rows[1].error.startswith("content too short") and rows[2].error


def test_repeated_words(spark):
    words = ["alpha"] * 3 + ["beta"] * 2 + [f"word{i}" for i in range(35)]  # 40 words: more than 2 is too often
    assert spark.range(1).select(assessment.repeated_words(F.array(*map(F.lit, words)))).first()[0] == 1


def test_syllables(spark):
    df = spark.createDataFrame([("table", 2), ("make", 1), ("readability", 5), ("the", 1), ("rhythm", 1)], "w string, n int")
    assert df.where(readability.syllables(F.col("w")) != F.col("n")).count() == 0


def test_search_and_rendering(spark):
    df = spark.createDataFrame([("1", "An artificial mind. A Machine, artificial."), ("2", "nothing here")], "id string, text string")
    assert ids(search.search(df, "ARTIFICIAL")) == ["1"]
    c = F.col("text")
    row = df.select(search.snippet(c, "machine", 10).alias("s"), search.highlights(c, "machine").alias("h"), search.bold(c, ["artificial"]).alias("b"), search.export(F.col("id"), F.lit("A<"), c, "xml").alias("x"), search.render(c, "html").alias("r")).first()
    assert row.s == "...d. A Machine, art..." and row.h == ["A Machine, artificial"] and row.b.count("**artificial**") == 2 and "<id>1</id><title>A&lt;" in row.x and row.r.startswith("<p>An")
    with pytest.raises(ValueError):
        search.export(F.col("id"), F.lit(""), c, "pdf")


def test_robots(spark):
    rules = compliance.robots_rules(spark.createDataFrame([("h", "User-agent: *\nDisallow: /p/ # x\nAllow: /p/a\nCrawl-delay: 2\nDisallow:")], "host string, body string"))
    urls = spark.createDataFrame([("h", "/p/b"), ("h", "/p/abc"), ("h", "/q"), ("sub.k.org", "/"), ("none", "/")], "host string, path string")
    policies = spark.createDataFrame([("h", True, False), ("k.org", True, True)], "domain string, allows_automation boolean, requires_attribution boolean")
    got = {(r.host, r.path): (r.allowed, r.delay) for r in compliance.verdicts(urls, rules, policies, "me").collect()}
    assert got == {("h", "/p/b"): (False, 2.0), ("h", "/p/abc"): (True, 2.0), ("h", "/q"): (True, 2.0), ("sub.k.org", "/"): (True, 1.0), ("none", "/"): (False, 1.0)}


def test_budget_over_many_shards(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("n"))
    total, want = 0, []
    for i in range(1000):
        if total < 500:
            want.append(i)
        total += i % 7
    assert sorted(ids(compliance.within_budget(df, F.col("n"), ["id"], 500))) == want


def test_budget_with_carried_columns(spark):
    """300,000 rows over several partitions; the exact prefix, whatever is carried and whatever the columns are called."""
    rows = spark.range(0, 300_000, numPartitions=7).select(
        F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("key"), "id", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(60)).alias("size"), F.col("id").cast("string").alias("row"), F.lit("x").alias("so_far")
    )
    listed = rows.select("key", "id", "size").toPandas().sort_values(["key", "id"], kind="stable")
    before = listed["size"].cumsum() - listed["size"]
    for budget in (0, 1, 4_000_000, 10**9):
        got = compliance.within_budget(rows, F.col("size"), ["key", "id"], budget, few=5000)
        assert got.columns == rows.columns and sorted(r.id for r in got.select("id").collect()) == sorted(listed["id"][before < budget])
    real = compliance.within_budget(rows, F.col("size") / 2, ["key", "id"], 1_000_000.25, splits=4, few=1000)
    assert real.count() == int((before / 2 < 1_000_000.25).sum())
    assert compliance.within_budget(rows.limit(0), F.col("size"), ["key"], 5).count() == 0


def test_budget_with_nulls_and_equal_keys(spark):
    rows = spark.createDataFrame([(None, None, 4), ("a", 1, None), ("a", 1, 2), ("a", 1, 2), ("b", None, 5), ("c", 0, 9)] * 40, "k string, n int, size int")
    got = compliance.within_budget(rows, F.col("size"), ["k", "n"], 170, splits=2, few=3)
    assert got.groupBy("k").count().where("k is null").first()["count"] == 40 and got.agg(F.sum("size")).first()[0] in (170, 172) and got.where("k > 'a'").count() == 0
    assert compliance.within_budget(rows, F.col("size"), ["k", "n"], 10**6).count() == 240


def test_vectors(spark):
    a, b = vectors.embedding("Some text, some more."), vectors.embedding("Some text, some more.")
    assert len(a) == 384 and abs(float((a * a).sum()) - 1) < 1e-3 and (a == b).all() and vectors.embedding("") is None
    row = spark.range(1).select(vectors.dot(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(4.0))), vectors.dot(F.array(F.lit(1.0)), F.array(F.lit(3.0), F.lit(4.0)))).first()
    assert tuple(row) == (11.0, 0.0)


def test_pages(spark):
    html = "<html><head><title>T</title><script>x</script></head><body><nav>Menu</nav><p>One &amp; <b>two</b></p><div>Three</div></body></html>"
    df = spark.createDataFrame([(html,), (None,)], "h string")
    text, none = [r[0] for r in df.select(web.dom_text("h")).collect()]
    assert none is None and "Menu" not in text and "x" not in text and text.index("One &") < text.index("two") < text.index("Three")
    problems = spark.createDataFrame([("https://x.org/a", None), ("ftp://x.org", "only HTTP and HTTPS URLs are allowed"), ("http://127.0.0.1/", "private hosts are not allowed")], "u string, p string")
    assert problems.where(~web.url_problem(F.col("u")).eqNullSafe(F.col("p"))).count() == 0



def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    "text,want",
    [
        ("SELECT source, COUNT(*) FROM documents GROUP BY source", [("", 1), ("PubMed", 1), ("arXiv", 2)]),
        ("SELECT COUNT(author) AS named, COUNT(DISTINCT source) AS sources, MIN(id) FROM documents", [(4 - 1, 2, "t1")]),
        ("SELECT title AS t, id FROM documents WHERE source = 'arXiv' ORDER BY t DESC", [("Transformer Architecture Analysis", "t3"), ("Neural Networks in Machine Learning", "t1")]),
        ("SELECT source AS s, COUNT(*) AS n FROM documents GROUP BY source HAVING n > 1 ORDER BY n DESC", [("arXiv", 2)]),
        ("SELECT d.id AS id, s.count AS n FROM documents d JOIN sources s ON d.source = s.source WHERE s.count > 1", [("t1", 2), ("t3", 2)]),
        ("SELECT d.id AS id, s.count AS n FROM documents AS d LEFT JOIN sources s ON d.source = s.source AND d.title = s.source LIMIT ALL", [("t1", None), ("t2", None), ("t3", None), ("t4", None)]),
        ("SELECT attribution, COUNT(*) AS n FROM documents GROUP BY attribution ORDER BY n DESC LIMIT 1", [(None, 2)]),
        ("SELECT a.author AS name, COUNT(*) AS n, AVG(document_count) AS listed FROM documents d JOIN authors a ON d.author = a.author GROUP BY a.author", [("Alice Johnson", 1, 1.0), ("John Smith", 1, 1.0)]),
    ],
)
def test_groups_and_joins(views, text, want):
    assert rows_of(gql.plan(text, views)) == want


def test_columns_of_a_join_without_items(views):
    df = gql.plan("SELECT FROM documents d JOIN sources s ON d.source = s.source", views)
    assert df.columns[:2] == ["d_id", "d_source"] and df.columns[-2:] == ["s_source", "s_count"] and df.count() == 3


@pytest.mark.parametrize(
    "text,why",
    [
        ("SELECT id, COUNT(*) FROM documents", "neither grouped nor counted"), ("SELECT FROM documents GROUP BY source", "needs items"), ("SELECT id FROM documents HAVING id = 1", "needs groups"),
        ("SELECT source, COUNT(*) FROM documents GROUP BY source HAVING title = 'x'", "neither grouped"), ("SELECT id, id FROM documents", "one name"), ("SELECT FROM documents d JOIN sources d ON source = source", "two views"),
        ("SELECT FROM documents d JOIN sources s ON source = s.source", "which view"), ("SELECT FROM documents d JOIN documents e ON d.id = e.id WHERE nowhere = 1", "which view"), ("SELECT FROM documents LEFT sources", "expected JOIN"),
        ("SELECT COUNT( FROM documents", r"expected \)"), ("SELECT COUNT() FROM documents", "expected a field"), ("SELECT COUNT(* FROM documents", "expected"), ("SELECT id FROM nowhere", "unknown view"),
    ],
)
def test_errors_of_groups_and_joins(views, text, why):
    with pytest.raises(gql.QueryError, match=why):
        gql.plan(text, views)


def test_filters_reach_below_the_join(spark, tmp_path):
    lib = spark.createDataFrame([("t1", "a", "x", dt.datetime(2024, 1, 1))], "id string, source string, title string, created_at timestamp")
    lib.write.parquet(str(tmp_path / "lib"))
    views = gql.Views(spark.read.parquet(str(tmp_path / "lib")), "m")
    plan = gql.plan("SELECT d.id AS id, e.title AS t FROM documents d JOIN documents e ON d.source = e.source WHERE d.title = 'x' AND e.id > 't0'", views)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(title,x)" in plan and "GreaterThan(id,t0)" in plan


def test_sections_and_as_of(spark):
    df = spark.createDataFrame([("\n".join(["line of text number %d with more words" % i for i in range(40)]),)], "t string")
    parts = df.select(conversations.sections(F.col("t"))).first()[0]
    assert len(parts) > 2 and all(len(p) > 50 for p in parts)
    left = spark.createDataFrame([("k", 5), ("k", 1), ("z", 5)], "k string, t int")
    right = spark.createDataFrame([("k", 2, "a"), ("k", 5, "b"), ("k", 9, "c")], "k string, s int, v string")
    assert {tuple(r) for r in corpus.as_of(left, right, "k", "t", "s", "v").select("k", "t", "v").collect()} == {("k", 5, "b"), ("k", 1, None), ("z", 5, None)}


def test_sections_against_brute_force_in_linear_time(spark):
    rng = random.Random(3)

    def brute(text, size=400, least=50):
        cur, done = "", []
        for line in text.split("\n"):
            cur += line + "\n"
            if len(cur.encode()) > size and (line == "" or len(done) < 10) and len(cur.strip().encode()) > least:
                done.append(cur.strip())
                cur = ""
        return done + ([cur.strip()] if len(cur.strip().encode()) > least else [])

    texts = ["\n".join(rng.choice(["", "  ", "\u00a0é word" * rng.randint(1, 30), " x " * rng.randint(1, 90)]) for _ in range(rng.randint(0, 150))) for _ in range(60)]
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select("t", conversations.sections(F.col("t")).alias("s")).collect()
    assert all(r.s == brute(r.t) for r in rows)
    begun = time.time()
    assert spark.createDataFrame([("some words here\n" * 60_000,)], "t string").select(F.size(conversations.sections(F.col("t")))).first()[0] == 11
    assert time.time() - begun < 20


def test_email_mask_keeps_its_matches_in_linear_time(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab.@_-%c ", [5, 5, 4, 4, 1, 1, 1, 5, 1], k=rng.randint(0, 60))) for _ in range(2000)] + ["a@b.co_x@e.fr", "a@b.co@c.de"]
    for r in spark.createDataFrame([(x,) for x in texts], "t string").select("t", cleaning.mask_emails(F.col("t")).alias("m")).collect():
        assert r.m == re.sub(cleaning.EMAIL, "[EMAIL]", r.t)
    begun = time.time()
    spark.createDataFrame([("a@" + "b" * 400_000 + "@" + "c." * 100_000,)], "t string").select(cleaning.mask_emails(F.col("t"))).collect()
    assert time.time() - begun < 10


def test_as_of_takes_the_greatest_of_a_tie(spark):
    left = spark.createDataFrame([("k", 5)], "k string, t int")
    right = spark.createDataFrame([("k", 2, "b", 1), ("k", 2, "a", 9), ("k", 2, None, 10)], "k string, s int, v string, nth int").repartition(3)
    assert corpus.as_of(left, right, "k", "t", "s", "v").first()["v"] == "b"
    assert corpus.as_of(left, right, "k", "t", "s", "v", tie="nth").first()["v"] == "a"


@pytest.mark.parametrize("block", [2, 100])
def test_nearest_of_many(spark, block):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(60, 5))
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)] + [(70, None), (71, [1.0])], "vec_id long, embedding array<double>").repartition(4)
    queries = rows.where("vec_id < 5").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    got = {}
    for r in vectors.nearest_of(queries, rows, 3, block=block).orderBy("query_id", F.desc("similarity")).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    s = m @ m.T
    np.fill_diagonal(s, -np.inf)
    assert got == {i: np.argsort(-s[i])[:3].tolist() for i in range(5)}
    assert vectors.nearest_of(queries.limit(0), rows, 3).count() == 0 == vectors.nearest_of(queries, rows.limit(0), 3).count()


def test_bold_reaches_past_the_first_characters(spark, tmp_path):
    import __spark_entry__

    texts = ["x " * 150 + "The end, oTHEr, wunDER", "", None, "the"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = dict(__spark_entry__.queries()["search_bold"](spark, str(tmp_path)).collect())
    assert got == {0: "x " * 150 + "**The** end, o**THE**r, wun**DER**", 1: "", 2: None, 3: "**the**"}


def test_short_values_and_views(spark):
    rows = spark.createDataFrame([(0,), (1023,), (1024,), (1280,), (1536,), (1 << 20,), (5 << 40,), (None,)], "n long")
    assert [r[0] for r in rows.select(corpus.short_bytes(F.col("n"))).collect()] == ["0 B", "1023 B", "1.0 KB", "1.2 KB", "1.5 KB", "1.0 MB", "5.0 TB", None]
    meta = {"_x": "1", "time": "2024-02-30T00:00:00Z", "date": "2024-02-29T01:02:03-05:00", "other": "2024-02-29T01:02:03Z", "no_time": None}
    one = spark.createDataFrame([(meta,), ({"quality": "{"},), (None,)], "m map<string,string>")
    shown = [r[0] for r in one.select(search.shown_metadata(F.col("m"))).collect()]
    assert shown[0] == {"time": "2024-02-30T00:00:00Z", "date": "2024-02-29 01:02:03", "other": "2024-02-29T01:02:03Z", "no_time": None}
    assert shown[1:] == [{"quality": "{"}, None]
    assert [r[0] and r[0]["overall_score"] for r in one.select(search.stored_quality(F.col("m"))).collect()] == [None] * 3


def test_page_heads(spark):
    pages = ["<meta name='a' content='1'><META property=\"a\" content='2'><meta name=b>", "", None, "<meta name='k' property='p' content='&lt;x'>"]
    out = [r[0] for r in spark.createDataFrame([(p,) for p in pages], "h string").select(web.head_entries(F.col("h"))).collect()]
    assert out == [{"a": "2"}, {}, None, {"k": "<x", "p": "<x"}]


def test_retries_and_metrics(spark):
    n = spark.createDataFrame([(0,), (1,), (3,), (9,)], "n int")
    assert [r[0] for r in n.select(conversations.retry_schedule(F.col("n"), 1.0, 2.0, 3)).collect()] == [[], [1.0], [1.0, 2.0, 4.0], [1.0, 2.0, 4.0]]
    rows = spark.createDataFrame([("m", True, 0.9, 10, "premium"), ("m", False, 0.1, 99, "reject"), ("x", False, None, None, None)], "model string, ok boolean, score double, ms int, tier string")
    got = {r["model"]: r for r in conversations.model_metrics(rows, "model", F.col("ok"), F.col("score"), F.col("ms"), F.col("tier")).collect()}
    assert (got["m"]["requests"], got["m"]["success_rate"], got["m"]["quality"], got["m"]["premium"], got["m"]["reject"]) == (2, 0.5, 0.9, 1, 0)
    assert (got["x"]["success_rate"], got["x"]["quality"]) == (0.0, None)
