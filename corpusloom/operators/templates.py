"""Conversations from templates: a table of turns with slots, conditions and repeats, compiled into column expressions.

A turn has format, role and text. `{name}` in the text is a slot, a column of the document or a block of text that depends on its domain
(`{domain:name}`). `when` is a condition on slots, parts joined by `&`: `name` (present), `!name` (absent) or `name>=n` (a list of at least n);
`each` names a list, for whose first `most` values the turn is repeated, with `{item}` and `{n}`. A conversation without a turn that
holds does not come out. Everything is one projection over the documents; blocks are one join by domain.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.operators import conversations as cv

_SLOT = re.compile(r"\{([\w:]+)\}")
_CONDITION = re.compile(r"(!?)(\w+)(?:>=(\d+))?")
TURN = "struct<role:string,content:string>"

# What a line of steps begins with, and words of advice.
STEP = r"^(\d+[.)]|Step |First|Then|Next|Finally)"
ADVICE = ["should", "always", "never", "avoid", "recommend"]
PRO, CONTRA = ["advantage", "benefit", "strength"], ["disadvantage", "drawback", "limit"]


@dataclass(frozen=True)
class Turn:
    format: str
    role: str
    text: str
    when: str = ""
    each: str = ""
    most: int = 0


TURNS = (
    Turn("explanation", "user", "Please explain {title}."),
    Turn("explanation", "assistant", "{overview}"),
    Turn("explanation", "user", "Which points matter most?", when="points"),
    Turn("explanation", "assistant", "{n}. {item}", each="points", most=5),
    Turn("qa", "user", "What is {lower} about?"),
    Turn("qa", "assistant", "{lead}"),
    Turn("qa", "user", "Is there more to say on part {n}?", each="rest", most=2),
    Turn("qa", "assistant", "{body}", when="rest"),
    Turn("code_example", "user", "Can you show me code for {title}?"),
    Turn("code_example", "assistant", "This is taken from the text:\n\n{code}", when="code"),
    Turn("code_example", "assistant", "The text has no code. {domain:sketch}", when="!code"),
    Turn("tutorial", "user", "I would like to learn {title} by doing."),
    Turn("tutorial", "assistant", "Step {n}: {item}", each="steps", most=6),
    Turn("tutorial", "assistant", "Let us read it part by part.\n\n{body}", when="!steps"),
    Turn("best_practices", "user", "What should I keep in mind about {lower}?"),
    Turn("best_practices", "assistant", "- {item}", each="advice", most=5),
    Turn("best_practices", "assistant", "{domain:habits}", when="!advice"),
    Turn("deep_dive", "user", "Take me deep into {title}."),
    Turn("deep_dive", "assistant", "Part {n}\n\n{item}", each="parts", most=8),
    Turn("deep_dive", "user", "And where is this used?"),
    Turn("deep_dive", "assistant", "{domain:uses}"),
    Turn("step_by_step", "user", "How do I go about {title}, one step at a time?"),
    Turn("step_by_step", "assistant", "{n}) {item}", each="steps", most=9),
    Turn("step_by_step", "assistant", "{n}) {item}", when="!steps", each="points", most=9),
    Turn("step_by_step", "assistant", "{overview}", when="!steps&!points"),
    Turn("troubleshooting", "user", "Something goes wrong with {lower}. Where do I look first?"),
    Turn("troubleshooting", "assistant", "{domain:checks}\n\n{overview}"),
    Turn("comparison", "user", "What speaks for {title}, and what against it?", when="pro&contra"),
    Turn("comparison", "assistant", "For it: {pro}\n\nAgainst it: {contra}", when="pro&contra"),
    Turn("interview", "user", "You know {title} well. How would you introduce it?", when="parts>=2"),
    Turn("interview", "assistant", "{lead}", when="parts>=2"),
    Turn("interview", "user", "What else should our readers know?", when="parts>=2"),
    Turn("interview", "assistant", "{item}", when="parts>=2", each="rest", most=3),
    Turn("case_study", "user", "Do you have a case that shows {lower} at work?"),
    Turn("case_study", "assistant", "The situation: {overview}"),
    Turn("case_study", "assistant", "What was done: {item}", each="advice", most=3),
    Turn("case_study", "assistant", "In practice: {domain:uses}"),
    Turn("debate", "user", "Debate {title} with me.", when="parts>=2"),
    Turn("debate", "assistant", "One side says: {lead}", when="parts>=2"),
    Turn("debate", "assistant", "The other side holds against it: {contra}", when="parts>=2&contra"),
    Turn("debate", "user", "Who is right?", when="parts>=2"),
    Turn("debate", "assistant", "{domain:judgement}", when="parts>=2"),
)

#: Blocks of text by domain; `*` is for all domains without one of their own.
BLOCKS = (
    ("*", "sketch", "One would begin with the inputs, work on them one by one, and return the result."),
    ("Programming", "sketch", "One would write a function that takes the inputs, checks them, and returns the result or an error."),
    ("*", "habits", "Begin small, check each step, and write down what you found."),
    ("Programming", "habits", "Keep functions short, test them, and handle every error where it occurs."),
    ("Web", "habits", "Check all input on the server, cache what is static, and measure before you tune."),
    ("*", "uses", "It is used wherever the same question comes up again and deserves a lasting answer."),
    ("AI", "uses", "It is used in training, in evaluation, and in deciding which data a model should see."),
    ("Web", "uses", "It is used behind pages that many people read and few people change."),
    ("*", "checks", "See what changed last, repeat the failure in a small case, and read the first error rather than the last."),
    ("Web", "checks", "See the status code, the headers and the log of the server, in this order."),
    ("*", "judgement", "Both have a point; what decides is the setting in which the question is asked."),
    ("AI", "judgement", "It depends on how the result is measured, and on whom the errors fall."),
)


def paragraphs(c: Column) -> Column:
    return F.filter(F.transform(t.paragraphs(c), t.trim), lambda p: p != "")


def picks(c: Column, like: Column | None, low: int = 20, high: int = 200, most: int = 20) -> Column:
    """The first lines, trimmed, of over `low` and under `high` bytes for which `like` holds."""
    kept = F.filter(F.transform(t.lines(c), t.trim), lambda x: (F.octet_length(x) > low) & (F.octet_length(x) < high) & like(x))
    return F.slice(kept, 1, most)


def slots(title: Column, c: Column) -> dict[str, Column]:
    """What the templates here fill in from a document."""
    parts = F.col("_parts")
    first = lambda words: F.get(F.filter(parts, lambda p: t.has_any(F.lower(p), words)), F.lit(0))
    return {
        "_parts": paragraphs(c), "title": title, "lower": F.lower(title), "overview": cv.overview(c), "parts": parts, "lead": F.array_join(F.slice(parts, 1, 2), "\n\n"),
        "body": F.array_join(F.slice(parts, 1, 3), "\n\n"), "rest": F.slice(parts, 3, 100), "points": picks(c, lambda x: t.has(x, ":") | F.startswith(x, F.lit("- ")) | F.startswith(x, F.lit("* "))),
        "steps": picks(c, lambda x: F.regexp_like(x, F.lit(STEP))), "advice": picks(c, lambda x: t.has_any(F.lower(x), ADVICE)), "code": F.array_join(cv.code_examples(c), "\n\n"), "pro": first(PRO), "contra": first(CONTRA),
    }


def load(turns: DataFrame) -> tuple[Turn, ...]:
    """Templates from a table (nth, format, role, text, when, each, most): configuration, one row a turn."""
    rows = turns.orderBy("nth").collect()
    return tuple(Turn(r.format, r.role, r.text, r.when or "", r.each or "", r.most or 0) for r in rows)


def check(turns: tuple[Turn, ...], lists: set[str], texts: set[str]) -> None:
    """Errors of a template table before anything runs: unknown slots and conditions, lists where texts belong."""
    for x in turns:
        for name in _SLOT.findall(x.text):
            if not (name in texts or name.startswith("domain:") or (x.each and name in ("item", "n"))):
                raise ValueError(f"{x.format}: no text slot {{{name}}}")
        if x.each and (x.each not in lists or x.most < 1):
            raise ValueError(f"{x.format}: cannot repeat over {x.each!r}")
        for part in filter(None, x.when.split("&")):
            m = _CONDITION.fullmatch(part)
            if not m or m[2] not in lists | texts or (m[3] and m[2] not in lists):
                raise ValueError(f"{x.format}: no condition {part!r}")


def filled(text: str, values: dict[str, Column]) -> Column:
    """A text with its slots filled in; absent ones are empty."""
    pieces, at = [F.lit("")], 0
    for m in _SLOT.finditer(text):
        pieces += [F.lit(text[at : m.start()]), F.coalesce(values[m[1]], F.lit(""))]
        at = m.end()
    return F.concat(*pieces, F.lit(text[at:]))


def _holds(when: str, values: dict[str, Column], lists: set[str]) -> Column:
    out = F.lit(True)
    for part in filter(None, when.split("&")):
        absent, name, least = _CONDITION.fullmatch(part).groups()
        size = F.size(values[name]) if name in lists else F.length(values[name])
        there = F.coalesce(size >= int(least or 1), F.lit(False))
        out = out & (~there if absent else there)
    return out


def conversation(turns: list[Turn], values: dict[str, Column], lists: set[str]) -> Column:
    """The turns that hold, as an array of role and content."""
    def piece(x: Turn) -> Column:
        def turn(known: dict[str, Column]) -> Column:
            return F.struct(F.lit(x.role).alias("role"), filled(x.text, known).alias("content"))

        made = F.transform(F.slice(values[x.each], 1, x.most), lambda item, i: turn(values | {"item": item, "n": (i + 1).cast("string")})) if x.each else F.array(turn(values))
        return F.when(_holds(x.when, values, lists), made).otherwise(F.array().cast(f"array<{TURN}>"))

    return F.concat(*map(piece, turns))


def with_blocks(docs: DataFrame, blocks: DataFrame, domain: str) -> DataFrame:
    """Adds `_blocks`, a map of the blocks (domain, name, text) of each document's domain over those of `*`."""
    maps = blocks.groupBy("domain").agg(F.map_from_entries(F.collect_list(F.struct("name", "text"))).alias("_own"))
    general = maps.where("domain = '*'").select(F.col("_own").alias("_all"))
    own = maps.where("domain <> '*'").select(F.col("domain").alias("_domain"), "_own")
    met = docs.join(own, docs[domain] == own["_domain"], "left").join(F.broadcast(general.limit(1)), F.lit(True), "left")  # one row
    none = F.create_map().cast("map<string,string>")
    general_only = F.map_filter(F.coalesce("_all", none), lambda k, _: ~F.coalesce(F.map_contains_key(F.coalesce("_own", none), k), F.lit(False)))
    return met.withColumn("_blocks", F.map_concat(F.coalesce("_own", none), general_only)).drop("_own", "_all", "_domain")


def rendered(docs: DataFrame, formats: str, domain: str, title: str = "title", text: str = "text", turns: tuple[Turn, ...] = TURNS, blocks: DataFrame | None = None, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per document and format of its list `formats` that has a conversation: the document's columns, format and conversation.

    `extra` adds slots. Null titles and texts are empty; unknown formats have no conversation; repeated rows give repeated results.
    """
    c = F.coalesce(F.col(text), F.lit(""))
    found = slots(F.coalesce(F.col(title), F.lit("")), c) | (extra or {})
    table = blocks if blocks is not None else docs.sparkSession.createDataFrame(list(BLOCKS), "domain string, name string, text string")
    own = docs.columns
    rows = with_blocks(docs.withColumn("_parts", found.pop("_parts")), table, domain).withColumns({f"_slot_{k}": v for k, v in found.items()})
    lists = {k for k in found if rows.schema[f"_slot_{k}"].dataType.typeName() == "array"}
    check(turns, lists, set(found) - lists)
    named = {name for x in turns for name in _SLOT.findall(x.text) if name.startswith("domain:")}
    values = {k: F.col(f"_slot_{k}") for k in found} | {n: F.try_element_at("_blocks", F.lit(n.partition(":")[2])) for n in named}
    each = rows.select(*own, *[x for x in rows.columns if x not in own], F.explode(F.array_distinct(formats)).alias("_format"))
    made = F.array().cast(f"array<{TURN}>")
    for name in sorted({x.format for x in turns}):
        made = F.when(F.col("_format") == name, conversation([x for x in turns if x.format == name], values, lists)).otherwise(made)
    return each.select(*own, F.col("_format").alias("format"), made.alias("conversation")).where(F.size("conversation") > 0)
