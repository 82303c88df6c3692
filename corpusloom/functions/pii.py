"""Personal data in texts: validated spans without overlaps, redaction, and the way back from redacted to original offsets.

Candidates come from patterns of bounded length, so the work is linear in the text; cards must pass the Luhn check, bank accounts the
remainder by 97, addresses their ranges, telephone numbers their count of digits. Of overlapping spans the kind listed first stays,
of one kind the earlier. Offsets count characters (code points), from 0, ends not included.

Defined cases: a null text has no spans and stays null; spans never cross a line; a text that already holds a mark such as `[EMAIL]` keeps it as text.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def luhn(text: str) -> bool:
    digits = [int(c) for c in text if c.isdigit()]
    doubled = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
    return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0 and len(set(digits)) > 1


def iban(text: str) -> bool:
    bare = text.replace(" ", "")
    return 15 <= len(bare) <= 34 and int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def address(text: str) -> bool:
    return all(int(x) < 256 and (x == "0" or x[0] != "0") for x in text.split("."))


def telephone(text: str) -> bool:
    return 8 <= sum(c.isdigit() for c in text) <= 15 and (text[0] == "+" or any(c in text for c in " -()"))


#: kind, pattern, check; in order of preference.
KINDS: tuple[tuple[str, re.Pattern, Callable[[str], bool] | None], ...] = (
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), iban),
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"), None),
    ("card", re.compile(r"(?<![0-9.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"), luhn),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"), address),
    ("phone", re.compile(r"(?<![0-9A-Za-z+.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{1,5}\)|[0-9]{2,5})(?:[ .-]?[0-9]{2,5}){1,4}(?![0-9A-Za-z])"), telephone),
)


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of the spans that stay, by start."""
    kept: list[tuple[int, int, str]] = []
    for kind, pattern, valid in KINDS:
        for m in pattern.finditer(text):
            if valid is None or valid(m.group()):
                i = bisect.bisect(kept, (m.start(), m.end(), kind))
                if (i == 0 or kept[i - 1][1] <= m.start()) and (i == len(kept) or kept[i][0] >= m.end()):
                    kept.insert(i, (m.start(), m.end(), kind))
    return [(k, a, b) for a, b, k in kept]


@F.pandas_udf(SPANS)
def spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(lambda x: None if x is None else [dict(zip(("kind", "start", "end"), s)) for s in spans_of(x)])


def values(c: Column, found: Column) -> Column:
    """The text of each span."""
    return F.transform(found, lambda s: F.substring(c, s["start"] + 1, s["end"] - s["start"]))


def mark(kind: Column) -> Column:
    return F.concat(F.lit("["), F.upper(kind), F.lit("]"))


def pieces(c: Column, found: Column) -> Column:
    """The text between the spans: one piece more than there are spans."""
    starts = F.concat(F.array(F.lit(0)), F.transform(found, lambda s: s["end"]))
    ends = F.concat(F.transform(found, lambda s: s["start"]), F.array(F.length(c)))
    return F.zip_with(starts, ends, lambda a, b: F.substring(c, a + 1, b - a))


def _woven(between: Column, fill: Column) -> Column:
    return F.array_join(F.flatten(F.zip_with(between, F.concat(fill, F.array(F.lit(""))), lambda p, f: F.array(p, f))), "")


def redacted(c: Column, found: Column) -> Column:
    """The text with a mark in place of each span."""
    return _woven(pieces(c, found), F.transform(found, lambda s: mark(s["kind"])))


def offsets(found: Column) -> Column:
    """For each span where its mark begins and ends in the redacted text: kind, start, end, original_start, original_end."""
    none = F.array().cast("array<struct<kind:string,start:int,end:int,original_start:int,original_end:int>>")
    zero = F.struct(F.lit(0).alias("shift"), none.alias("out"))

    def step(acc: Column, s: Column) -> Column:
        start = s["start"] + acc["shift"]
        end = start + F.length(mark(s["kind"]))
        one = F.struct(s["kind"].alias("kind"), start.alias("start"), end.alias("end"), s["start"].alias("original_start"), s["end"].alias("original_end"))
        return F.struct((end - s["end"]).alias("shift"), F.concat(acc["out"], F.array(one)).alias("out"))

    return F.aggregate(found, zero, step, lambda acc: acc["out"])


def original_offset(at: Column, table: Column) -> Column:
    """An offset of the redacted text in the original; inside a mark, the start of what it stands for."""
    before = F.filter(table, lambda o: o["start"] <= at)
    last = F.get(before, F.size(before) - 1)
    return F.when(F.size(before) == 0, at).when(at < last["end"], last["original_start"]).otherwise(at - last["end"] + last["original_end"])


def restored(redaction: Column, table: Column, held: Column) -> Column:
    """The original text from the redacted one, its offsets and the texts of the spans."""
    bare = F.transform(table, lambda o: F.struct(o["kind"].alias("kind"), o["start"].alias("start"), o["end"].alias("end")))
    return _woven(pieces(redaction, bare), held)
