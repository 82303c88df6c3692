"""Queries of page heads, metadata views, progress and curation reports, generation metrics and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import assessment
from corpusloom.functions import text as t
from corpusloom.functions import web
from corpusloom.operators import conversations as cv
from corpusloom.operators import corpus as cp
from corpusloom.operators import search as se
from corpusloom.operators import sources_plan as sp
from corpusloom.plans.fixture import read, texts
from corpusloom.plans.q_operators import nested
from corpusloom.plans.q_quality import quoted, sql_any, sql_collapse, sql_fields, sql_many

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return keep


_HEAD = ['<meta name="author" content="A  &amp; ', '"><META property=\'og:title\' content=\'T ', '\'><meta name="author" content="Last"><script type="application/ld+json">{"n": ', "}</script>"]
_CONTENT = sql_collapse(nested(f"regexp_extract(x, {quoted(web.META_CONTENT)}, 1)", web.REFERENCES.items()))
_ENTRY = lambda p: f"{{'key': regexp_extract(x, {quoted(p)}, 1), 'value': {_CONTENT}}}"


@query(f"""WITH h AS (SELECT page_id, {quoted(_HEAD[0])} || page_id || {quoted(_HEAD[1])} || page_id || {quoted(_HEAD[2])} || page_id || {quoted(_HEAD[3])} || html AS h FROM pages),
  tag AS (SELECT page_id, unnest(regexp_extract_all(h, {quoted(web.META_TAG)}, 1)) AS x, generate_subscripts(regexp_extract_all(h, {quoted(web.META_TAG)}, 1), 1) AS nth FROM h),
  e AS (SELECT page_id, nth, unnest([{_ENTRY(web.META_NAME)}, {_ENTRY(web.META_PROPERTY)}]) AS e FROM tag),
  k AS (SELECT page_id, e.key AS key, max_by(e.value, nth) AS value FROM e WHERE e.key <> '' AND e.value <> '' GROUP BY 1, 2)
  SELECT page_id, string_agg(key || '=' || value, '; ' ORDER BY key) AS entries, max(value) FILTER (key = 'author') AS author, max(value) FILTER (key = 'og:title') AS og_title, '{{"n": ' || page_id || '}}' AS json_ld FROM k GROUP BY page_id""")
def page_head(spark, sf_dir):
    n = F.col("page_id").cast("string")
    html = F.concat(F.lit(_HEAD[0]), n, F.lit(_HEAD[1]), n, F.lit(_HEAD[2]), n, F.lit(_HEAD[3]), F.col("html"))
    rows = read(spark, sf_dir, "pages").select("page_id", web.head_entries(html).alias("m"), web.json_ld(html).alias("json_ld"))
    entries = F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")
    return rows.select("page_id", entries.alias("entries"), F.try_element_at("m", F.lit("author")).alias("author"), F.try_element_at("m", F.lit("og:title")).alias("og_title"), "json_ld")


_AT = "TIMESTAMP '2024-01-01' + to_minutes(doc_id)"


@query(f"""SELECT doc_id, 'date=' || CASE WHEN doc_id % 3 = 0 THEN 'May 2024' ELSE strftime({_AT}, '%Y-%m-%d %H:%M:%S') END || '; source=' || source || '; update_time=' || strftime({_AT}, '%Y-%m-%d %H:%M:%S') AS shown,
  CASE WHEN doc_id % 2 = 0 THEN round(n_chars / 1000, 6) END AS overall_score, CASE WHEN doc_id % 2 = 0 THEN source END AS quality_tier FROM documents""")
def metadata_view(spark, sf_dir):
    n = F.col("doc_id")
    at = F.date_format(F.timestamp_add("MINUTE", n.cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss")
    judged = F.to_json(F.struct((F.col("n_chars") / 1000).alias("overall_score"), F.col("source").alias("quality_tier")))
    m = F.create_map(
        F.lit("_hidden"), F.lit("x"), F.lit("update_time"), F.concat(at, F.lit("+02:00")), F.lit("date"), F.when(n % 3 == 0, "May 2024").otherwise(F.concat(at, F.lit(".25Z"))),
        F.lit("source"), F.col("source"), F.lit("quality"), F.when(n % 2 == 0, judged).otherwise("not JSON"),
    )
    rows = read(spark, sf_dir, "documents").select("doc_id", F.map_filter(se.shown_metadata(m), lambda k, _: k != "quality").alias("m"), se.stored_quality(m).alias("q"))
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")
    return rows.select("doc_id", shown.alias("shown"), F.round("q.overall_score", 6).alias("overall_score"), F.col("q.quality_tier").alias("quality_tier"))


_UNITS = ", ".join(f"('{u}B', {1024**i}::DOUBLE)" for i, u in enumerate("KMGTPE", 1))


@query(f"""WITH u(unit, size) AS (VALUES {_UNITS}), n AS (SELECT doc_id, n_chars * n_chars * n_chars AS n, 'https://' || source || '/' || repeat('x', CAST(doc_id % 80 AS INTEGER)) AS url FROM documents),
  b AS (SELECT doc_id, max_by(printf('%.1f %s', n / size, unit), size) AS s FROM n JOIN u ON n >= size GROUP BY 1)
  SELECT n.doc_id, coalesce(s, n || ' B') AS size, CASE WHEN length(url) > 60 THEN left(url, 57) || '...' ELSE url END AS url FROM n LEFT JOIN b USING (doc_id)""")
def short_values(spark, sf_dir):
    n = F.col("n_chars") * F.col("n_chars") * F.col("n_chars")
    url = F.concat(F.lit("https://"), "source", F.lit("/"), F.repeat(F.lit("x"), (F.col("doc_id") % 80).cast("int")))
    return read(spark, sf_dir, "documents").select("doc_id", cp.short_bytes(n).alias("size"), cp.short_url(url).alias("url"))


_STATUS = "CASE WHEN doc_id % 10 = 0 THEN 'blocked' WHEN n_chars < 500 THEN 'filtered' ELSE 'kept' END"
_SHARE = lambda x: f"round(avg(CAST(s = '{x}' AS INTEGER)) * 100, 6) AS {x}"


@query(f"""WITH d AS (SELECT *, {_STATUS} AS s, len({sql_fields('text')}) AS w FROM documents) SELECT source, count(*) AS processed, count(*) FILTER (s = 'kept') AS documents, CAST(sum(w) FILTER (s = 'kept') AS BIGINT) AS words,
  CAST(sum(n_chars) FILTER (s = 'kept') AS BIGINT) AS chars, round(avg(n_chars / 1000) FILTER (s = 'kept'), 6) AS quality, {_SHARE('kept')}, {_SHARE('blocked')}, {_SHARE('filtered')} FROM d GROUP BY source""")
def progress_summary(spark, sf_dir):
    status = F.when(F.col("doc_id") % 10 == 0, "blocked").when(F.col("n_chars") < 500, "filtered").otherwise("kept")
    docs = texts(spark, sf_dir).select("source", "n_chars", status.alias("status"), t.word_count(F.col("text")).alias("words"))
    return cp.progress(docs, "source", F.col("status"), F.col("words"), F.col("n_chars"), F.col("n_chars") / 1000)


@query(f"SELECT lang, count(*) AS documents, CAST(sum(len({sql_fields('text')})) AS BIGINT) AS words, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(grouping(lang) AS INTEGER) AS all_of_them FROM documents WHERE source = 'src1' GROUP BY ROLLUP (lang)")
def curation_report(spark, sf_dir):
    docs = texts(spark, sf_dir).where("source = 'src1'")
    return cp.curation(docs, "lang", t.word_count(F.col("text")), F.length("text").cast("long"))


_TIER = "CASE WHEN value >= 90 THEN 'premium' WHEN value >= 80 THEN 'high' WHEN value >= 65 THEN 'medium' WHEN value >= 50 THEN 'low' ELSE 'reject' END"


@query(f"""SELECT event_type, count(*) AS requests, count(*) FILTER (event_id % 7 <> 0) AS successful, round(avg(CAST(event_id % 7 <> 0 AS INTEGER)), 6) AS success_rate, round(avg(value / 100) FILTER (event_id % 7 <> 0), 6) AS quality,
  round(avg(event_id % 1000) FILTER (event_id % 7 <> 0), 6) AS millis, {', '.join(f"count(*) FILTER (event_id % 7 <> 0 AND {_TIER} = '{x}') AS {x}" for x in ('premium', 'high', 'medium', 'low', 'reject'))} FROM events GROUP BY 1""")
def generation_metrics(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_type", (F.col("event_id") % 7 != 0).alias("ok"), (F.col("value") / 100).alias("score"), (F.col("event_id") % 1000).alias("millis"), F.expr(_TIER).alias("tier"))
    return cv.model_metrics(rows, "event_type", F.col("ok"), F.col("score"), F.col("millis"), F.col("tier"))


@query("SELECT event_id, [2.0 * power(1.5, i) FOR i IN range(least(event_id % 7, 5))]::VARCHAR AS waits FROM events")
def retry_waits(spark, sf_dir):
    waits = cv.retry_schedule(F.col("event_id") % 7, 2.0, 1.5, 5)
    return read(spark, sf_dir, "events").select("event_id", F.concat(F.lit("["), F.array_join(waits.cast("array<string>"), ", "), F.lit("]")).alias("waits"))


_TOPICS = ["Science", "Cooking", "Economics", "History"]


@query(f"SELECT doc_id, {sql_any('lower(text)', cv.CODE_MARKS)} AS code, {sql_any('lower(text)', cv.GO_MARKS)} AS go, [{', '.join(map(quoted, _TOPICS))}][doc_id % 4 + 1] IN ({', '.join(map(quoted, cv.COMPLEX_DOMAINS))}) OR {sql_any('lower(text)', cv.COMPLEX_WORDS)} AS complex FROM documents")
def topic_predicates(spark, sf_dir):
    c, domain = F.col("text"), F.element_at(F.array(*map(F.lit, _TOPICS)), (F.col("doc_id") % 4 + 1).cast("int"))
    return texts(spark, sf_dir).select("doc_id", cv.has_code(c).alias("code"), cv.on_go(c).alias("go"), cv.is_complex(domain, c).alias("complex"))


_URLS = ["https://en.wikipedia.org/x", "https://cs.x.edu/golang.org", "https://x.gov/a", "https://go.dev/x", "https://x.example/a"]


def _banded(name: str, variant: dict) -> str:
    cases = lambda pairs, test: "CASE " + " ".join(f"WHEN {test(k)} THEN {x}" for k, x in pairs) + " ELSE 0 END"
    rank = cases(variant["priorities"].items(), lambda k: f"priority = {k}") if variant["priorities"] else "0"
    parts = [
        cases(variant["bands"], lambda n: f"w > {n}"), f"least({cp.EDUCATIONAL_MOST}, {cp.EDUCATIONAL_WEIGHT} * {sql_many('low', variant['educational'])})",
        cases(variant["hosts"], lambda names: sql_any("url", names)), f"least({cp.TECHNICAL_MOST}, {cp.TECHNICAL_WEIGHT} * {sql_many('low', variant['technical'])})", rank,
    ]
    return f"round(CAST(least(1, {' + '.join(parts)}) AS DOUBLE), 6) AS {name}"


@query(f"""WITH d AS (SELECT doc_id, text, lower(text) AS low, len({sql_fields('text')}) AS w, [{', '.join(map(quoted, _URLS))}][doc_id % 5 + 1] AS url, doc_id % 3 AS priority FROM documents)
  SELECT doc_id, {_banded('broad', cp.BROAD)}, {_banded('focused', cp.FOCUSED)}, CASE WHEN s >= 8 THEN 'high' WHEN s >= 5 THEN 'medium' ELSE 'low' END AS simple
  FROM (SELECT *, CASE WHEN w > 1000 THEN 4 WHEN w > 500 THEN 2 ELSE 0 END + 2 * (CAST({sql_any('text', ['function', 'class'])} AS INTEGER) + CAST(len(string_split(text, chr(10) || chr(10))) > 5 AS INTEGER) + CAST({sql_any('text', ['example', 'tutorial'])} AS INTEGER)) AS s FROM d)""")
def score_variants(spark, sf_dir):
    """The additive scores beside `additive_quality`: two by bands with limits, one as a grade."""
    n = F.col("doc_id")
    url = F.element_at(F.array(*map(F.lit, _URLS)), (n % 5 + 1).cast("int"))
    rows = texts(spark, sf_dir).select("doc_id", "text", url.alias("url"), (n % 3).alias("priority"))
    score = lambda v: F.round(cp.banded_score(F.col("text"), F.col("url"), F.col("priority"), v), 6)
    return rows.select("doc_id", score(cp.BROAD).alias("broad"), score(cp.FOCUSED).alias("focused"), cp.simple_grade(F.col("text")).alias("simple"))


@query("""WITH c AS (SELECT conv_id, conv_id % 3 AS domain, CASE WHEN conv_id % 4 > 0 THEN 'level ' || (conv_id % 4) END AS difficulty, count(*) AS n, sum(length(coalesce(text, ''))) AS chars FROM conversations GROUP BY conv_id),
  e AS (SELECT 'all' AS field, '' AS value, n, chars FROM c UNION ALL SELECT 'domain', CAST(domain AS VARCHAR), n, chars FROM c UNION ALL SELECT 'difficulty', coalesce(difficulty, 'unknown'), n, chars FROM c)
  SELECT field, value, count(*) AS conversations, CAST(sum(n) AS BIGINT) AS turns, CAST(sum(chars) AS BIGINT) AS chars, round(avg(n), 6) AS mean_turns FROM e GROUP BY ALL""")
def conv_summaries(spark, sf_dir):
    """Conversations by domain, by difficulty and in all."""
    n = F.col("conv_id")
    turns = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("content")))).alias("conversation"))
    rows = turns.select("conversation", (n % 3).alias("domain"), F.when(n % 4 > 0, F.concat(F.lit("level "), (n % 4).cast("string"))).alias("difficulty"))
    return cv.summaries(rows, ["domain", "difficulty"])


_RULES = [{"kind": "include", "field": "url", "pattern": "/(en|fr)/"}, {"kind": "exclude", "field": "url", "pattern": "/2[0-9]*$"}, {"kind": "transform", "field": "url", "pattern": "[?#].*$"}, {"kind": "transform", "field": "url", "pattern": "^https?:", "value": "web:"}]


@query(f"SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?:', 'web:') AS url FROM pages WHERE regexp_matches(url, {quoted(_RULES[0]['pattern'])}) AND NOT regexp_matches(url, {quoted(_RULES[1]['pattern'])})")
def url_rules(spark, sf_dir):
    """Include, exclude and transform rules over the pages' addresses."""
    return sp.by_rules(read(spark, sf_dir, "pages").select("page_id", "url"), _RULES)


@query("""WITH k AS (SELECT user_id % 50 AS key, round(value, 3) AS conf, ts FROM events WHERE event_type IN ('view', 'click')), l AS (SELECT key, max({'ts': ts, 'conf': conf}) AS m FROM k GROUP BY key)
  SELECT CAST(key AS VARCHAR) AS key, m.conf AS known_confidence, m.ts AS checked_at FROM l WHERE m.ts > (SELECT max(ts) FROM events) - INTERVAL 6 HOURS""")
def knowledge_import(spark, sf_dir):
    """Knowledge of two sources merged by key, without what is older than six hours."""
    ev = read(spark, sf_dir, "events")
    rows = lambda kind: ev.where(F.col("event_type") == kind).select((F.col("user_id") % 50).cast("string").alias("key"), F.round("value", 3).alias("known_confidence"), F.col("ts").alias("checked_at"))
    now = F.lit(ev.agg(F.max("ts")).first()[0])
    return assessment.fresh_knowledge(assessment.imported_knowledge(rows("view"), rows("click")), now, 6)
