"""Queries of cleaning, readability and quality assessment."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import assessment as a
from corpusloom.functions import cleaning as cl
from corpusloom.functions import readability as r
from corpusloom.functions import text as t
from corpusloom.plans.fixture import texts

QUERIES, ORACLES = {}, {}

# -- SQL shorthands ---------------------------------------------------------------------------------------------------

WS = r"[\t\n\f\r ]"


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_any(c: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, {quoted(x)})" for x in terms) + ")"


def sql_many(c: str, terms: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({c}, {quoted(x)}) AS DOUBLE)" for x in terms) + ")"


def sql_trim(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\x{{85}}\x{{A0}}]+|[\s\x{{85}}\x{{A0}}]+$', '', 'g')"


def sql_collapse(c: str) -> str:
    return sql_trim(f"regexp_replace({c}, '{WS}+', ' ', 'g')")


def sql_fields(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{WS}+'), lambda w: w <> '')"


def sql_sentences(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '[.!?]+{WS}+'), lambda s: strlen({sql_trim('s')}) > 10)"


# -- cleaning: fixture texts have little to clean, so both sides add the same dirt --------------------------------------

_DIRT = [
    " See <p class='x'>the <b>tags</b></p> &amp; &lt;tag&gt; &quot;q&quot; ", " at http://x.example/", "?a=1 or www.site.example/p or ftp://files.example/f ", " mail jane.", "+x@mail.example.org now!!!!!! Really???? ",
    " Pi is 3.14159265359 or 2.5 or 10.00001 ", " “curly” ‘quotes’ – dash — and Itâ€™s Â here nbsp​ zero﻿ bom\u0007bell \nsame line\n same line \n\n\nother",
]


def dirty(spark, sf_dir):
    n = F.col("doc_id").cast("string")
    return texts(spark, sf_dir).select("doc_id", F.concat("text", F.lit(_DIRT[0] + _DIRT[1]), n, F.lit(_DIRT[2] + _DIRT[3]), n, F.lit(_DIRT[4] + _DIRT[5] + _DIRT[6])).alias("text"))


_D = "d AS (SELECT doc_id, text || " + " || ".join([quoted(_DIRT[0] + _DIRT[1]), "doc_id", quoted(_DIRT[2] + _DIRT[3]), "doc_id", quoted(_DIRT[4] + _DIRT[5] + _DIRT[6])]) + " AS text FROM documents)"


def _nested(c: str, pairs) -> str:
    for x, y in pairs:
        c = f"replace({c}, {quoted(x)}, {quoted(y)})"
    return c


def sql_tags(c: str) -> str:
    return sql_collapse(_nested(f"regexp_replace({c}, '<[^>]*>', ' ', 'g')", cl.ENTITIES.items()))


def sql_urls(c: str) -> str:
    for p in cl.URLS:
        c = f"regexp_replace({c}, {quoted(p)}, '[URL]', 'g')"
    return c


def sql_encoding(c: str) -> str:
    c = _nested(c, [*cl.MOJIBAKE, ("﻿", ""), (" ", " "), ("​", ""), ("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"'), ("–", "-"), ("—", "-")])
    return rf"regexp_replace({c}, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{{80}}-\x{{9F}}]', '', 'g')"


def sql_repeats(c: str) -> str:
    ls = f"string_split({c}, chr(10))"
    return f"array_to_string(list_filter({ls}, lambda x, i: i = 1 OR {sql_trim('x')} = '' OR {sql_trim('x')} <> {sql_trim(f'{ls}[i - 1]')}), chr(10))"


_SQL_RULES = {
    "whitespace_normalization": sql_collapse, "html_tag_removal": sql_tags, "url_cleaning": sql_urls,
    "email_obfuscation": lambda c: f"regexp_replace({c}, {quoted(cl.EMAIL)}, '[EMAIL]', 'g')",
    "number_normalization": lambda c: rf"regexp_replace({c}, '\b(\d+\.\d{{2}})\d{{2,}}\b', '\1', 'g')",
    "punctuation_cleaning": lambda c: _nested(rf"regexp_replace({c}, '([!?.,:;]{{3}})[!?.,:;]+', '\1', 'g')", [("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'")]),
    "encoding_normalization": sql_encoding, "duplicate_line_removal": sql_repeats,
}

for _rule in cl.CHAIN:
    _key = "clean_" + _rule.name
    QUERIES[_key] = lambda spark, sf_dir, rule=_rule: dirty(spark, sf_dir).select("doc_id", rule.apply(F.col("text")).alias("cleaned"))
    ORACLES[_key] = f"WITH {_D} SELECT doc_id, {_SQL_RULES[_rule.name]('text')} AS cleaned FROM d"


def clean_chain(spark, sf_dir):
    out = cl.Cleaner().apply(dirty(spark, sf_dir))
    return out.select("doc_id", "cleaned", F.array_join("rules_applied", ",").alias("rules"), "original_length", "cleaned_length", "bytes_removed", F.round("compression_ratio", 6).alias("ratio"))


def _chain(names: list[str]) -> str:
    parts = [f"{_D}, s0 AS (SELECT doc_id, text AS c0 FROM d)"]
    for i, n in enumerate(names):
        parts.append(f"s{i + 1} AS (SELECT *, {_SQL_RULES[n](f'c{i}')} AS c{i + 1} FROM s{i})")
    return "WITH " + ", ".join(parts)


def _applied(names: list[str]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN c{i} <> c{i + 1} THEN '{n}' END" for i, n in enumerate(names)) + ")"


_ALL = [x.name for x in cl.CHAIN]
_LINES = ["duplicate_line_removal", *_ALL[:-1]]
QUERIES["clean_chain"] = clean_chain
ORACLES["clean_chain"] = f"""{_chain(_ALL)} SELECT doc_id, c8 AS cleaned, {_applied(_ALL)} AS rules, CAST(strlen(c0) AS BIGINT) AS original_length, CAST(strlen(c8) AS BIGINT) AS cleaned_length,
  CAST(strlen(c0) - strlen(c8) AS BIGINT) AS bytes_removed, round(CAST(strlen(c0) - strlen(c8) AS DOUBLE) / strlen(c0), 6) AS ratio FROM s8"""
QUERIES["clean_line_aware"] = lambda spark, sf_dir: cl.Cleaner(line_aware=True).apply(dirty(spark, sf_dir)).select("doc_id", "cleaned", F.array_join("rules_applied", ",").alias("rules"))
ORACLES["clean_line_aware"] = f"{_chain(_LINES)} SELECT doc_id, c8 AS cleaned, {_applied(_LINES)} AS rules FROM s8"


def clean_report(spark, sf_dir):
    out = cl.Cleaner().apply(dirty(spark, sf_dir))
    return out.select(F.explode_outer("rules_applied").alias("rule"), "bytes_removed").where("rule is not null").groupBy("rule").agg(F.count("*").alias("documents"), F.sum("bytes_removed").alias("bytes_removed"))


QUERIES["clean_report"] = clean_report
ORACLES["clean_report"] = f"""{_chain(_ALL)} SELECT rule, count(*) AS documents, CAST(sum(b) AS BIGINT) AS bytes_removed
  FROM (SELECT unnest(string_split({_applied(_ALL)}, ',')) AS rule, strlen(c0) - strlen(c8) AS b FROM s8) WHERE rule <> '' GROUP BY rule"""
QUERIES["clean_lines"] = lambda spark, sf_dir: dirty(spark, sf_dir).select("doc_id", cl.clean_lines(F.col("text"), ["tags"], ["The"], 20).alias("cleaned"))
ORACLES["clean_lines"] = f"WITH {_D} SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: {sql_trim('x')}), lambda x: strlen(x) >= 20 AND NOT starts_with(x, 'The') AND NOT contains(lower(x), 'tags')), chr(10)) AS cleaned FROM d"

# -- readability -------------------------------------------------------------------------------------------------------

_COUNTS = rf"""w AS (
  SELECT doc_id, text, list_filter(list_transform({sql_fields('text')}, lambda x: regexp_replace(lower(x), '[.,;:!?''"()\[\]{{}}—–-]', '', 'g')), lambda x: x <> '') AS w FROM documents
), y AS (
  SELECT *, list_transform(w, lambda x: greatest(1, len(regexp_extract_all(x, '[aeiouy]+')) - CASE WHEN ends_with(x, 'e') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(x, '[^aeiouy]le$') THEN 1 ELSE 0 END)) AS s FROM w
), c AS (
  SELECT doc_id, len(w) AS n_words, greatest(1, len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda x: {sql_trim('x')} <> ''))) AS n_sentences, CAST(coalesce(list_sum(s), 0) AS BIGINT) AS n_syllables,
    len(list_filter(list_zip(w, s), lambda p: p[2] >= 3 AND p[1] NOT IN ({', '.join(map(quoted, r.EASY))}))) AS n_complex, length(regexp_replace(text, '[^\p{{L}}\p{{Nd}}]', '', 'g')) AS n_characters FROM y
), f AS (
  SELECT *, CAST(n_words AS DOUBLE) / n_sentences AS ws, CAST(n_syllables AS DOUBLE) / n_words AS sw, 100.0 * n_complex / n_words AS pc FROM c
), g AS (
  SELECT *, CASE WHEN n_words > 0 THEN 0.39 * ws + 11.8 * sw - 15.59 ELSE 0 END AS flesch_kincaid, CASE WHEN n_words > 0 THEN 206.835 - 1.015 * ws - 84.6 * sw ELSE 0 END AS flesch_ease,
    CASE WHEN n_words > 0 THEN 0.4 * (ws + pc) ELSE 0 END AS gunning_fog, CASE WHEN n_words > 0 THEN 1.043 * sqrt(n_complex * (30.0 / n_sentences)) + 3.1291 ELSE 0 END AS smog,
    CASE WHEN n_words > 0 THEN 4.71 * n_characters / n_words + 0.5 * ws - 21.43 ELSE 0 END AS ari FROM f
), o AS (
  SELECT *, greatest(0, 100 - 5 * flesch_kincaid) + greatest(0, 100 - 5 * gunning_fog) + greatest(0, 100 - 5 * smog) + greatest(0, 100 - 5 * ari) AS gs FROM g
), read AS (
  SELECT *, CASE WHEN n_words = 0 THEN 0 WHEN flesch_ease > 0 THEN (flesch_ease + gs) / 5 ELSE gs / 4 END AS overall FROM o
)"""
_COUNTED = ["n_words", "n_sentences", "n_syllables", "n_complex", "n_characters"]
_SCORED = ["flesch_kincaid", "flesch_ease", "gunning_fog", "smog", "ari", "overall"]
QUERIES["readability_counts"] = lambda spark, sf_dir: r.counts(texts(spark, sf_dir)).select("doc_id", *_COUNTED)
ORACLES["readability_counts"] = f"WITH {_COUNTS} SELECT doc_id, {', '.join(f'CAST({x} AS BIGINT) AS {x}' for x in _COUNTED)} FROM read"
QUERIES["readability_scores"] = lambda spark, sf_dir: r.scores(r.counts(texts(spark, sf_dir))).select("doc_id", *[F.round(x, 6).alias(x) for x in _SCORED], "in_target_band")
ORACLES["readability_scores"] = f"WITH {_COUNTS} SELECT doc_id, {', '.join(f'round({x}, 6) AS {x}' for x in _SCORED)}, flesch_kincaid BETWEEN 8 AND 12 AS in_target_band FROM read"
_LEVEL = "CASE WHEN n_words = 0 THEN 'unreadable' " + " ".join(f"WHEN flesch_ease >= {k} THEN '{v}'" for k, v in ((90, "very easy"), (80, "easy"), (70, "fairly easy"), (60, "standard"), (50, "fairly difficult"), (30, "difficult"))) + " ELSE 'very difficult' END"
QUERIES["readability_levels"] = lambda spark, sf_dir: r.scores(r.counts(texts(spark, sf_dir))).groupBy("level").agg(F.count("*").alias("documents"))
ORACLES["readability_levels"] = f"WITH {_COUNTS} SELECT {_LEVEL} AS level, count(*) AS documents FROM read GROUP BY 1"
QUERIES["readability_advice"] = lambda spark, sf_dir: r.scores(r.counts(texts(spark, sf_dir))).select("doc_id", F.array_join(r.advice(), "; ").alias("advice"))
_ADVICE = [("ws > 20", r.LONG_SENTENCES), ("pc > 15", r.COMPLEX_WORDS), ("sw > 1.7", r.LONG_WORDS), ("flesch_kincaid > 12", r.TOO_HARD), ("flesch_kincaid < 8", r.TOO_SIMPLE), ("n_words < 100", r.TOO_SHORT), ("n_sentences < 3", r.FEW_SENTENCES)]
ORACLES["readability_advice"] = f"WITH {_COUNTS}, s AS (SELECT doc_id, concat_ws('; ', {', '.join(f'CASE WHEN {c} THEN {quoted(m)} END' for c, m in _ADVICE)}) AS x FROM read) SELECT doc_id, CASE WHEN x = '' THEN {quoted(r.BALANCED)} ELSE x END AS advice FROM s"

# -- assessment --------------------------------------------------------------------------------------------------------

#: Sentences that give fixture texts something to find; metadata by id.
_SAID = [" According to the 2020 survey, growth was 12 percent. ", " Today the debate is # Overview of a step 1 example template. ", " Research findings of this century show your welcome `code`. Summary follows.\n\n", "x\n\ny"]


def enriched(spark, sf_dir):
    n = F.col("doc_id")
    text = F.concat(F.col("text"), F.when(n % 2 == 0, _SAID[0]).otherwise(""), F.when(n % 3 == 0, _SAID[1]).otherwise(""), F.when(n % 5 == 0, _SAID[2] + _SAID[3]).otherwise(""))
    meta = F.create_map(
        F.lit("title"), F.when(n % 4 == 0, "").otherwise("A title"), F.lit("content_type"), F.element_at(F.array(*map(F.lit, ("research_abstract", "tutorial", "documentation", "article"))), (n % 4 + 1).cast("int")),
        F.lit("topic"), F.when(n % 3 == 0, "the").when(n % 3 == 1, "debate").otherwise(""), F.lit("keywords"), F.when(n % 5 == 0, "growth, step ,zzz").otherwise(""), F.lit("domain"), F.lit("technology"),
    )
    return texts(spark, sf_dir).select("doc_id", text.alias("text"), meta.alias("metadata"))


_E = f"""d AS (SELECT doc_id, text || CASE WHEN doc_id % 2 = 0 THEN {quoted(_SAID[0])} ELSE '' END || CASE WHEN doc_id % 3 = 0 THEN {quoted(_SAID[1])} ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN {quoted(_SAID[2] + _SAID[3])} ELSE '' END AS text,
  CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'A title' END AS title, ['research_abstract', 'tutorial', 'documentation', 'article'][doc_id % 4 + 1] AS kind,
  CASE doc_id % 3 WHEN 0 THEN 'the' WHEN 1 THEN 'debate' ELSE '' END AS topic, CASE WHEN doc_id % 5 = 0 THEN 'growth, step ,zzz' ELSE '' END AS keywords FROM documents)"""
_CASCADE = "CASE " + " ".join(f"WHEN {sql_any('x', terms + (a.DOMAIN_TERMS['technology'] if terms is a.SCIENTIFIC else []))} THEN {conf}" for terms, conf, *_ in reversed(a.CHECKS)) + " ELSE 0.7 END"
_CLAIMS = f"list_filter(list_transform({sql_sentences('text')}, lambda s: {sql_trim('s')}), lambda s: regexp_matches(s, '[0-9]') OR {sql_any('lower(s)', a.CLAIM_PHRASES)})"
_ASSESS = rf"""{_E}, m AS (
  SELECT *, lower(text) AS low, {sql_fields('text')} AS w, len({sql_sentences('text')}) AS sentence_count, len(string_split(text, chr(10) || chr(10))) AS paragraph_count,
    list_transform({_CLAIMS}, lambda s: lower(s)) AS cs FROM d
), p AS (
  SELECT *, len(w) AS word_count, list_transform(cs, lambda x: CAST({_CASCADE} AS DOUBLE)) AS conf,
    list_transform(list_filter(w, lambda x: strlen(x) > 3), lambda x: lower(x)) AS lw,
    list_filter(list_transform(string_split(keywords, ','), lambda x: trim(x)), lambda x: x <> '') AS ks FROM m
), q AS (
  SELECT *, CASE WHEN len(conf) > 0 THEN list_sum(conf) / len(conf) END AS facts,
    len(list_filter(map_values(list_histogram(lw)), lambda x: x > word_count // 20)) AS repeats FROM p
), v AS (
  SELECT doc_id, text, word_count, sentence_count, paragraph_count,
    CASE WHEN word_count < 100 THEN 'content too short: ' || word_count || ' words (minimum: 100)' WHEN word_count > 50000 THEN 'content too long: ' || word_count || ' words (maximum: 50000)'
      WHEN sentence_count < 5 THEN 'too few sentences: ' || sentence_count || ' (minimum: 5)' END AS error,
    facts, coalesce(facts, 0.8) AS accuracy,
    0.8 * CASE kind WHEN 'research_abstract' THEN {sql_many('low', a.RESEARCH_PARTS)} / 7 WHEN 'tutorial' THEN least(1, ({sql_many('low', a.TUTORIAL_PARTS)} + CASE WHEN regexp_matches(text, '(?i)(step{WS}+[0-9]+|^[0-9]+\.)') THEN 0.5 ELSE 0 END) / 5)
      WHEN 'documentation' THEN {sql_many('low', a.DOCUMENTATION_PARTS)} / 4
      ELSE least(1, CASE WHEN contains(text, '#') THEN 0.3 ELSE 0 END + CASE WHEN {sql_any('low', ['conclusion', 'summary'])} THEN 0.3 ELSE 0 END + CASE WHEN {sql_any('low', ['introduction', 'overview'])} THEN 0.2 ELSE 0 END + CASE WHEN paragraph_count >= 3 THEN 0.2 ELSE 0 END) END
    + 0.2 * (0.8 * (CASE WHEN title <> '' THEN 1 ELSE 0 END + CASE WHEN topic <> '' THEN 1 ELSE 0 END + 1) / 3 + 0.2 * (CASE WHEN keywords <> '' THEN 1 ELSE 0 END + 1) / 3) AS completeness,
    CASE WHEN topic = '' THEN 0.7 ELSE least(1, CASE WHEN contains(low, topic) THEN 0.4 ELSE 0 END + CASE WHEN len(ks) > 0 THEN 0.4 * len(list_filter(ks, lambda k: contains(low, k))) / len(ks) ELSE 0.4 END
      + CASE WHEN word_count > 0 THEN 0.2 * least(1, 100.0 * ((length(low) - length(replace(low, topic, ''))) // length(topic)) / word_count) ELSE 0 END) END AS relevance,
    greatest(0, 1 - 0.1 * {sql_many('low', a.LANGUAGE_ERRORS)}) AS language_quality,
    least(1, CASE WHEN regexp_matches(text, '#{{1,6}}{WS}+') THEN 0.4 ELSE 0 END + CASE WHEN regexp_matches(text, '^{WS}*(?:[-*+]|[0-9]+\.){WS}+') THEN 0.3 ELSE 0 END + CASE WHEN contains(text, '`') THEN 0.2 ELSE 0 END + CASE WHEN paragraph_count >= 3 THEN 0.1 ELSE 0 END) AS structure_quality,
    CASE WHEN word_count < 500 THEN word_count / 500.0 WHEN word_count > 2000 THEN greatest(1 - (word_count - 2000) / 2000.0, 0.5) ELSE 1 END AS length_score,
    greatest(0, 1 - 0.3 * {sql_many('low', a.TEMPLATE_PHRASES)} - 0.1 * repeats) AS uniqueness FROM q
)"""
_META = lambda k: F.try_element_at(F.col("metadata"), F.lit(k))


def basic_metrics(spark, sf_dir):
    out = enriched(spark, sf_dir).withColumns(a.basic_metrics(F.col("text")))
    return out.select("doc_id", "word_count", "sentence_count", "paragraph_count", "character_count", a.gate(F.col("word_count"), F.col("sentence_count")).alias("error"))


def claim_checks(spark, sf_dir):
    out = enriched(spark, sf_dir).select("doc_id", F.posexplode(a.claims(F.col("text"))).alias("nth", "claim"))
    checked = out.withColumns(a.fact_check(F.col("claim"), "technology"))
    return checked.select("doc_id", F.col("nth").cast("long").alias("nth"), "claim", "confidence", "verified", "explanation", F.array_join("sources", ",").alias("sources"))


def dimensions(spark, sf_dir):
    c = F.col("text")
    words = t.word_count(c)
    out = enriched(spark, sf_dir)
    cols = {
        "completeness": a.completeness(c, _META("content_type")) * 0.8 + a.metadata_completeness(F.col("metadata")) * 0.2, "relevance": a.relevance(c, _META("topic"), _META("keywords")),
        "language_quality": a.language_quality(c), "structure_quality": a.structure_quality(c), "length_score": a.length_score(words), "uniqueness": a.uniqueness(c),
    }
    return out.select("doc_id", *[F.round(x, 6).alias(k) for k, x in cols.items()])


_FINAL = ["accuracy", "completeness", "relevance", "quality", "uniqueness", "overall", "confidence"]


def assessed(spark, sf_dir):
    return a.assess(enriched(spark, sf_dir), domain="technology")


def quality_scores(spark, sf_dir):
    return assessed(spark, sf_dir).select("doc_id", *[F.round(x, 6).alias(x) for x in _FINAL], "tier", F.array_join("suggestions", "; ").alias("suggestions"), "error")


def quality_tiers(spark, sf_dir):
    return assessed(spark, sf_dir).groupBy(F.coalesce("tier", F.lit("not assessed")).alias("tier")).agg(F.count("*").alias("documents"), F.round(F.avg("overall"), 6).alias("mean"))


def knowledge_join(spark, sf_dir):
    rows = enriched(spark, sf_dir).select("doc_id", F.explode(a.claims(F.col("text"))).alias("claim"))
    now = F.lit("2024-06-02 00:00:00").cast("timestamp_ntz")
    known = rows.select(a.claim_key(F.col("claim")).alias("key")).distinct().select("key", F.lit(0.9).alias("known_confidence"), F.when(F.length("key") % 2 == 0, F.lit("2024-06-01 12:00:00")).otherwise(F.lit("2024-05-01 12:00:00")).cast("timestamp_ntz").alias("checked_at"))
    return a.with_knowledge(rows, known, now).groupBy((F.col("known_confidence").isNotNull()).alias("fresh")).agg(F.count("*").alias("claims"))


def quality_gate(spark, sf_dir):
    """Kept at 0.3 or more; what cannot be assessed counts one half."""
    return assessed(spark, sf_dir).groupBy((F.coalesce("overall", F.lit(0.5)) >= 0.3).alias("kept")).agg(F.count("*").alias("documents"))


QUERIES |= {f.__name__: f for f in (basic_metrics, claim_checks, dimensions, quality_scores, quality_tiers, knowledge_join, quality_gate)}
_READ = _COUNTS.replace("FROM documents\n", "FROM v\n")
_TOTAL = rf"""{_ASSESS}, {_READ}, z AS (
  SELECT v.*, 0.3 * greatest(0, least(1, (read.overall - 40) / 50 + 0.5)) + 0.3 * language_quality + 0.2 * structure_quality + 0.2 * length_score AS quality FROM v JOIN read USING (doc_id)
), t AS (
  SELECT *, least(1, accuracy * 0.3 + completeness * 0.2 + relevance * 0.2 + quality * 0.15 + uniqueness * 0.15) AS overall,
    0.6 * (1 - least(1, list_stddev_pop([accuracy, completeness, relevance, quality, uniqueness]))) + 0.4 * coalesce(facts, 1) AS confidence FROM z
), u AS (
  SELECT *, CASE WHEN error IS NULL THEN CASE WHEN overall >= 0.9 THEN 'premium' WHEN overall >= 0.8 THEN 'high' WHEN overall >= 0.65 THEN 'medium' WHEN overall >= 0.5 THEN 'low' ELSE 'reject' END END AS tier,
    CASE WHEN error IS NULL THEN concat_ws('; ', {', '.join(f"CASE WHEN {k} < 0.7 THEN {quoted(m)} END" for k, m in a.SUGGESTIONS.items())},
      CASE WHEN CAST(word_count AS DOUBLE) / sentence_count > 25 THEN {quoted(a.SHORTER_SENTENCES)} END, CASE WHEN paragraph_count < 3 THEN {quoted(a.MORE_PARAGRAPHS)} END) END AS suggestions FROM t
)""".replace("list_stddev_pop([", "list_aggregate([").replace("uniqueness]))) + 0.4", "uniqueness], 'stddev_pop'))) + 0.4")
_SOURCES = f"concat_ws(',', CASE WHEN {sql_any('x', a.HISTORICAL)} THEN 'Historical knowledge base' END, CASE WHEN {sql_any('x', a.SCIENTIFIC + a.DOMAIN_TERMS['technology'])} THEN 'Scientific literature' END)"
_WHY = "CASE " + " ".join(f"WHEN {sql_any('x', terms + (a.DOMAIN_TERMS['technology'] if terms is a.SCIENTIFIC else []))} THEN {quoted(why)}" for terms, _, _, why, _ in reversed(a.CHECKS)) + f" ELSE {quoted(a.NO_CHECK[2])} END"
ORACLES |= {
    "basic_metrics": f"WITH {_ASSESS} SELECT doc_id, word_count, sentence_count, paragraph_count, CAST(strlen(text) AS BIGINT) AS character_count, error FROM v",
    "claim_checks": f"""WITH {_E}, c AS (SELECT doc_id, {_CLAIMS} AS cs FROM d), e AS (SELECT doc_id, i - 1 AS nth, cs[i] AS claim, lower(cs[i]) AS x FROM (SELECT *, unnest(range(1, len(cs) + 1)) AS i FROM c))
      SELECT doc_id, nth, claim, CAST({_CASCADE} AS DOUBLE) AS confidence, NOT {sql_any('x', a.CURRENT)} AS verified, {_WHY} AS explanation, {_SOURCES} AS sources FROM e""",
    "dimensions": f"WITH {_ASSESS} SELECT doc_id, {', '.join(f'CAST(round({x}, 6) AS DOUBLE) AS {x}' for x in ('completeness', 'relevance', 'language_quality', 'structure_quality', 'length_score', 'uniqueness'))} FROM v",
    "quality_scores": f"WITH {_TOTAL} SELECT doc_id, {', '.join(f'CASE WHEN error IS NULL THEN round({x}, 6) END AS {x}' for x in _FINAL)}, tier, suggestions, error FROM u",
    "quality_tiers": f"WITH {_TOTAL} SELECT coalesce(tier, 'not assessed') AS tier, count(*) AS documents, round(avg(CASE WHEN error IS NULL THEN overall END), 6) AS mean FROM u GROUP BY 1",
    "knowledge_join": f"WITH {_E}, c AS (SELECT unnest({_CLAIMS}) AS claim FROM d) SELECT length({sql_collapse('lower(claim)')}) % 2 = 0 AS fresh, count(*) AS claims FROM c GROUP BY 1",
    "quality_gate": f"WITH {_TOTAL} SELECT coalesce(CASE WHEN error IS NULL THEN overall END, 0.5) >= 0.3 AS kept, count(*) AS documents FROM u GROUP BY 1",
}
