"""Conversations in all twelve formats, with SQL made from the same table of templates."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import conversations as cv
from corpusloom.operators import templates as tp
from corpusloom.plans.fixture import LIBRARY, library
from corpusloom.plans.q_operators import _OVERVIEW
from corpusloom.plans.q_quality import quoted, sql_any, sql_trim

QUERIES, ORACLES = {}, {}
DOMAINS = ["Programming", "Web", "AI", "History"]


def _docs(spark, sf_dir):
    domain = F.element_at(F.array(*map(F.lit, DOMAINS)), (F.col("doc_id") % 4 + 1).cast("int"))
    return library(spark, sf_dir).select("doc_id", "title", "text", domain.alias("domain"), F.array(*[F.lit(x) for x in sorted({x.format for x in tp.TURNS})]).alias("formats"))


def templates(spark, sf_dir):
    """Every turn of every conversation: all formats for all documents."""
    made = tp.rendered(_docs(spark, sf_dir), "formats", "domain")
    return made.select("doc_id", "format", F.posexplode("conversation").alias("nth", "turn")).select("doc_id", "format", "nth", "turn.role", "turn.content")


def template_summary(spark, sf_dir):
    """Conversations, turns and characters by format and domain."""
    made = tp.rendered(_docs(spark, sf_dir), "formats", "domain")
    chars = F.aggregate("conversation", F.lit(0).cast("long"), lambda a, x: a + F.length(x["content"]))
    return made.groupBy("format", "domain").agg(F.count("*").alias("conversations"), F.sum(F.size("conversation")).alias("turns"), F.sum(chars).alias("chars"))


# -- the same in SQL -----------------------------------------------------------------------------------------------------

_LINES = f"list_transform(string_split(text, chr(10)), lambda x: {sql_trim('x')})"
_PICK = lambda cond: f"list_filter({_LINES}, lambda x: strlen(x) > 20 AND strlen(x) < 200 AND {cond})[1:20]"
_CODE = "list_concat(" + ", ".join(f"regexp_extract_all(text, {quoted(p)})[1:3]" for p in cv.CODE) + ")"
_FIRST = lambda words: f"list_filter(parts, lambda p: {sql_any('lower(p)', words)})[1]"
_SLOTS = f"""{LIBRARY}, s0 AS (SELECT doc_id, coalesce(title, '') AS title, coalesce(text, '') AS text, [{', '.join(map(quoted, DOMAINS))}][doc_id % 4 + 1] AS domain FROM library),
s1 AS (SELECT *, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda p: {sql_trim('p')}), lambda p: p <> '') AS parts FROM s0),
s AS (SELECT *, lower(title) AS lower, {_OVERVIEW} AS overview, array_to_string(parts[1:2], chr(10) || chr(10)) AS lead, array_to_string(parts[1:3], chr(10) || chr(10)) AS body, parts[3:102] AS rest,
  {_PICK("(contains(x, ':') OR starts_with(x, '- ') OR starts_with(x, '* '))")} AS points, {_PICK(f"regexp_matches(x, {quoted(tp.STEP)})")} AS steps, {_PICK(sql_any('lower(x)', tp.ADVICE))} AS advice,
  array_to_string(list_filter(list_transform({_CODE}[1:3], lambda x: {sql_trim('x')}), lambda x: strlen(x) > 10 AND strlen(x) < 200), chr(10) || chr(10)) AS code, {_FIRST(tp.PRO)} AS pro, {_FIRST(tp.CONTRA)} AS contra FROM s1)"""
_LISTS = {"parts", "rest", "points", "steps", "advice"}


def _block(name: str) -> str:
    cases = " ".join(f"WHEN {quoted(d)} THEN {quoted(text)}" for d, n, text in tp.BLOCKS if n == name and d != "*")
    general = next(text for d, n, text in tp.BLOCKS if n == name and d == "*")
    return f"(CASE domain {cases} ELSE {quoted(general)} END)" if cases else quoted(general)


def _filled(text: str) -> str:
    out, at = ["''"], 0
    for m in tp._SLOT.finditer(text):
        value = _block(m[1][7:]) if m[1].startswith("domain:") else {"item": "x", "n": "CAST(i AS VARCHAR)"}.get(m[1], m[1])
        out += [quoted(text[at : m.start()]), f"coalesce({value}, '')"]
        at = m.end()
    return " || ".join([*out, quoted(text[at:])])


def _when(when: str) -> str:
    out = ["true"]
    for part in filter(None, when.split("&")):
        absent, name, least = tp._CONDITION.fullmatch(part).groups()
        there = f"coalesce({'len' if name in _LISTS else 'length'}({name}) >= {least or 1}, false)"
        out.append(f"NOT {there}" if absent else there)
    return " AND ".join(out)


def _turn(x: tp.Turn) -> str:
    one = f"{{'role': {quoted(x.role)}, 'content': {_filled(x.text)}}}"
    made = f"list_transform({x.each}[1:{x.most}], lambda x, i: {one})" if x.each else f"[{one}]"
    return f"CASE WHEN {_when(x.when)} THEN {made} ELSE [] END"


_FORMATS = " UNION ALL ".join(
    f"SELECT doc_id, domain, {quoted(name)} AS format, flatten([{', '.join(_turn(x) for x in tp.TURNS if x.format == name)}]) AS c FROM s" for name in sorted({x.format for x in tp.TURNS})
)
QUERIES = {"templates": templates, "template_summary": template_summary}
ORACLES = {
    "templates": f"WITH {_SLOTS}, f AS ({_FORMATS}), e AS (SELECT doc_id, format, c, unnest(range(1, len(c) + 1)) AS i FROM f) SELECT doc_id, format, CAST(i - 1 AS INTEGER) AS nth, c[i].role AS role, c[i].content AS content FROM e",
    "template_summary": f"WITH {_SLOTS}, f AS ({_FORMATS}) SELECT format, domain, count(*) AS conversations, CAST(sum(len(c)) AS BIGINT) AS turns, CAST(sum(list_sum(list_transform(c, lambda t: length(t.content)))) AS BIGINT) AS chars FROM f WHERE len(c) > 0 GROUP BY ALL",
}
