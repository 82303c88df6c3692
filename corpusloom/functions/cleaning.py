"""Text cleaning: a chain of named rules over a text column, with a report of what changed.

Rules are functions from Column to Column and run inside generated code. The order of `CHAIN` is part of its meaning:
white space comes first, so the line rule has an effect only where `line_aware` moves it to the front.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as t

ANY = frozenset({"*"})


@dataclass(frozen=True)
class Rule:
    name: str
    apply: Callable[[Column], Column]
    types: frozenset = field(default=ANY)

    def applicable(self, kind: str) -> bool:
        return "*" in self.types or kind in self.types


def collapse(c: Column) -> Column:
    return t.collapse(c)


#: Named character references that the SQL form decodes; `&amp;` last, so that what it yields is not decoded again.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#34;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def decode_basic(c: Column) -> Column:
    for ref, char in ENTITIES.items():
        c = F.replace(c, F.lit(ref), F.lit(char))
    return c


@F.pandas_udf(T.StringType())
def decode_all(c: pd.Series) -> pd.Series:
    """All HTML5 character references."""
    import html

    return c.map(html.unescape, na_action="ignore")


# Patterns of what the rules replace.
URL_TAIL = r"""[^\t\n\f\r <>"{}|\\^`\[\]]+"""
URLS = ("https?://" + URL_TAIL, r"www\." + URL_TAIL, "ftp://" + URL_TAIL)
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
#: The same matches in linear time: a match starts a run of name characters, or where the match before ended.
EMAIL_ONCE = r"(?:\G|(?<![a-zA-Z0-9._%+-]))[a-zA-Z0-9._%+-]++@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PRECISE = r"\b(\d+\.\d{2})\d{2,}\b"
MARKS = r"([!?.,:;]{3})[!?.,:;]+"
QUOTES, PLAIN = "“”‘’", "\"\"''"
#: Control characters but tab, line feed and carriage return.
CONTROLS = "".join(chr(c) for c in (*range(0x20), *range(0x7F, 0xA0)) if chr(c) not in "\t\n\r")
MOJIBAKE = (("â€™", "'"), ("â€œ", '"'), ("â€", '"'), ("Â ", " "), ("Â", ""))


def where_present(c: Column, mark: str, change: Callable[[Column], Column]) -> Column:
    """The change where the text has the mark without which it does nothing: a cheap test before a pattern."""
    return F.when(t.has(c, mark), change(c)).otherwise(c)


def drop_tags(c: Column, decode: Callable[[Column], Column] = decode_basic) -> Column:
    return t.collapse(decode(where_present(c, "<", lambda x: F.regexp_replace(x, "<[^>]*>", " "))))


def mask_urls(c: Column) -> Column:
    for pattern, mark in zip(URLS, ("://", "www.", "ftp://")):
        c = where_present(c, mark, lambda x, pattern=pattern: F.regexp_replace(x, pattern, "[URL]"))
    return c


def mask_emails(c: Column) -> Column:
    return where_present(c, "@", lambda x: F.regexp_replace(x, EMAIL_ONCE, "[EMAIL]"))


def shorten_numbers(c: Column) -> Column:
    return F.regexp_replace(c, PRECISE, "$1")


def tame_punctuation(c: Column) -> Column:
    return F.translate(F.regexp_replace(c, MARKS, "$1"), QUOTES, PLAIN)


def repair_encoding(c: Column, preserve_latin: bool = False) -> Column:
    for bad, good in MOJIBAKE[:3] if preserve_latin else MOJIBAKE:
        c = F.replace(c, F.lit(bad), F.lit(good))
    c = F.translate(c, " " + QUOTES + "–—﻿​", " " + PLAIN + "--")
    return F.regexp_replace(c, r"[\p{Cc}&&[^\n\t\r]]", "")


def drop_repeated_lines(c: Column) -> Column:
    """Without lines that equal the line before, both trimmed; blank lines stay."""
    ls = F.transform(t.lines(c), lambda x: F.struct(x.alias("line"), t.trim(x).alias("bare")))
    before = F.concat(F.array(F.lit(None).cast("struct<line:string,bare:string>")), ls)
    pairs = F.arrays_zip(ls.alias("now"), before.alias("before"))  # one longer than the lines: the last pair has no line
    kept = F.filter(pairs, lambda p: p["now"].isNotNull() & (p["before"].isNull() | (p["now"]["bare"] == "") | (p["now"]["bare"] != p["before"]["bare"])))
    return F.array_join(F.transform(kept, lambda p: p["now"]["line"]), "\n")


CHAIN: tuple[Rule, ...] = (
    Rule("whitespace_normalization", collapse),
    Rule("html_tag_removal", drop_tags, frozenset({"html", "text"})),
    Rule("url_cleaning", mask_urls),
    Rule("email_obfuscation", mask_emails),
    Rule("number_normalization", shorten_numbers, frozenset({"text", "html", "json"})),
    Rule("punctuation_cleaning", tame_punctuation),
    Rule("encoding_normalization", repair_encoding),
    Rule("duplicate_line_removal", drop_repeated_lines),
)


class Cleaner:
    """A chain of rules, which can be added to, switched off, or restricted by an allow list (which beats the deny list)."""

    def __init__(self, rules: tuple[Rule, ...] = CHAIN, line_aware: bool = False):
        self.rules = list(rules)
        if line_aware:
            self.rules.sort(key=lambda r: r.name != "duplicate_line_removal")
        self.off: set[str] = set()

    def add(self, rule: Rule) -> Cleaner:
        self.rules = [r for r in self.rules if r.name != rule.name] + [rule]
        return self

    def enable(self, name: str, on: bool = True) -> Cleaner:
        (self.off.discard if on else self.off.add)(name)
        return self

    def names(self) -> list[str]:
        return [r.name for r in self.rules if r.name not in self.off]

    def restricted(self, allow: list[str] | None = None, deny: list[str] | None = None) -> Cleaner:
        """With an allow list, exactly its rules are on; a deny list counts only without one."""
        for r in self.rules:
            self.enable(r.name, r.name in allow if allow else r.name not in (deny or []))
        return self

    def apply(self, df: DataFrame, text: str = "text", kind: str = "text") -> DataFrame:
        """Adds cleaned, rules_applied, original_length, cleaned_length, bytes_removed and compression_ratio.

        Each rule's text is a column of its own projection, so every rule is computed once per row.
        """
        out = df.withColumn("_c0", F.coalesce(F.col(text), F.lit("")))
        used = [r for r in self.rules if r.name not in self.off and r.applicable(kind)]
        for i, r in enumerate(used):
            out = out.withColumn(f"_c{i + 1}", r.apply(F.col(f"_c{i}")))
        changed = F.array_compact(F.array(*[F.when(F.col(f"_c{i}") != F.col(f"_c{i + 1}"), r.name) for i, r in enumerate(used)], F.lit(None).cast("string")))
        before, after = t.size_of(F.col("_c0")), t.size_of(F.col(f"_c{len(used)}"))
        return out.withColumns({
            "cleaned": F.col(f"_c{len(used)}"), "rules_applied": changed, "original_length": before, "cleaned_length": after,
            "bytes_removed": before - after, "compression_ratio": F.when(before > 0, (before - after) / before).otherwise(0.0),
        }).drop(*[f"_c{i}" for i in range(len(used) + 1)])


def clean_lines(c: Column, skip_contains: list[str] = (), skip_prefix: list[str] = (), min_bytes: int = 0) -> Column:
    """Trimmed lines of at least `min_bytes` without the given prefixes and (lower-cased) phrases, joined again."""

    def keep(x: Column) -> Column:
        ok = (F.octet_length(x) >= min_bytes) & (x != "")
        for p in skip_prefix:
            ok = ok & ~F.startswith(x, F.lit(p))
        for s in skip_contains:
            ok = ok & ~t.has(F.lower(x), s)
        return ok

    return F.array_join(F.filter(F.transform(t.lines(c), t.trim), keep), "\n")
