"""Readability: counts, five published formulas, an overall score, levels and advice, all as columns."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as t
from corpusloom.sources.spread import small_batches

# Words of three syllables or more that count as easy.
EASY = [
    "however", "because", "important", "different", "available", "probably", "understand", "remember", "everything", "computer", "technology",
    "information", "business", "government", "community", "university", "education", "development", "management", "company",
]
STRIP = r"""[.,;:!?'"()\[\]{}\x{2014}\x{2013}-]"""


def words(c: Column) -> Column:
    """Lower-cased words without punctuation; what was only punctuation is no word."""
    return F.filter(F.transform(t.fields(c), lambda w: F.regexp_replace(F.lower(w), STRIP, "")), lambda w: w != "")


def syllables(w: Column) -> Column:
    """Vowel groups, less a final e, plus one for a consonant before a final `le`; at least one."""
    groups = F.regexp_count(w, F.lit("[aeiouy]+"))
    silent = F.when(F.endswith(w, F.lit("e")), 1).otherwise(0)
    le = F.when(F.regexp_like(w, F.lit("[^aeiouy]le$")), 1).otherwise(0)
    return F.greatest(F.lit(1), groups - silent + le)


def sentence_count(c: Column) -> Column:
    return F.greatest(F.lit(1), F.size(F.filter(F.split(c, "[.!?]+"), lambda s: t.trim(s) != ""))).cast("long")


#: Words whose counts a worker remembers; beyond that it begins anew.
REMEMBERED = 100_000
_SPACES = str.maketrans("\t\n\f\r", "    ")
_STRIP = re.compile(r"""[.,;:!?'"()\[\]{}\u2014\u2013-]""")
_VOWELS, _LE = re.compile("[aeiouy]+"), re.compile("[^aeiouy]le$")
COUNTED = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "n_syllables", "n_complex", "n_fields", "repeated")])


def word_counter(easy: list[str]) -> Callable[[str], tuple[int, int, int, int, int | None]]:
    """Words, syllables, complex words and fields (words before punctuation goes) of a text, and how many different words of over three bytes are over a twentieth of all.

    The last is null for a text without such a word.

    What a word adds is worked out once and remembered, so a text costs a look-up for each of its different words.
    """
    known: dict[str, tuple[int, int, int, str]] = {}
    simple = frozenset(easy)

    def of(word: str) -> tuple[int, int, int, str]:
        low = word.lower()
        bare = _STRIP.sub("", low)
        n = max(1, len(_VOWELS.findall(bare)) - bare.endswith("e") + bool(_LE.search(bare))) if bare else 0
        return (1 if bare else 0, n, 1 if n >= 3 and bare not in simple else 0, (word if low == word else low) if len(word.encode("utf-8", "replace")) > 3 else "")

    def count(text: str) -> tuple[int, int, int, int, int | None]:
        found = Counter(text.translate(_SPACES).split(" "))
        found.pop("", None)
        if len(known) > REMEMBERED:
            known.clear()
        words = syllables = hard = total = 0
        often: dict[str, int] = {}
        for word, times in found.items():
            one = known.get(word)
            if one is None:
                one = known[word] = of(word)
            words += times * one[0]
            syllables += times * one[1]
            hard += times * one[2]
            total += times
            if one[3]:
                often[one[3]] = often.get(one[3], 0) + times
        return words, syllables, hard, total, sum(n > total // 20 for n in often.values()) if often else None

    return count


def counted(easy: list[str]):
    """`word_counter` over Arrow batches; null texts have null counts. Per word, built-in expressions are many times slower."""

    @F.pandas_udf(COUNTED)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        count = word_counter(easy)
        for batch in texts:
            yield pd.DataFrame([(None,) * 5 if x is None else count(x) for x in batch], columns=COUNTED.names, dtype="Int64")

    return run


def counts(df: DataFrame, text: str = "text", easy: list[str] = EASY) -> DataFrame:
    """Adds words, sentences, syllables, complex words, characters, and the words repeated too often."""
    small_batches(df.sparkSession)
    out = df.withColumn("_n", counted(easy)(F.col(text)))
    letters = F.length(F.regexp_replace(F.col(text), r"[^\p{L}\p{Nd}]+", ""))
    return out.withColumns({
        "n_words": F.col("_n.n_words"), "n_sentences": sentence_count(F.col(text)), "n_syllables": F.col("_n.n_syllables"),
        "n_complex": F.col("_n.n_complex"), "n_characters": letters.cast("long"), "n_fields": F.col("_n.n_fields"), "n_repeated": F.col("_n.repeated"),
    }).drop("_n")


def scores(df: DataFrame) -> DataFrame:
    """Adds the five formulas and the overall score to `counts`; zeros where there are no words."""
    w, s, y, h, c = (F.col(x).cast("double") for x in ("n_words", "n_sentences", "n_syllables", "n_complex", "n_characters"))
    some = F.col("n_words") > 0
    of = lambda x: F.when(some, x).otherwise(0.0)
    out = df.withColumns({
        "flesch_kincaid": of(0.39 * (w / s) + 11.8 * F.try_divide(y, w) - 15.59), "flesch_ease": of(206.835 - 1.015 * (w / s) - 84.6 * F.try_divide(y, w)),
        "gunning_fog": of(0.4 * ((w / s) + 100.0 * F.try_divide(h, w))), "smog": of(1.0430 * F.sqrt(h * (30.0 / s)) + 3.1291),
        "ari": of(4.71 * F.try_divide(c, w) + 0.5 * (w / s) - 21.43),
    })
    grades = [F.greatest(F.lit(0.0), 100.0 - 5.0 * F.col(g)) for g in ("flesch_kincaid", "gunning_fog", "smog", "ari")]
    eased = F.col("flesch_ease") > 0
    total = sum(grades[1:], grades[0])
    overall = F.when(eased, (F.col("flesch_ease") + total) / 5.0).otherwise(total / 4.0)
    return out.withColumn("overall", of(overall)).withColumn("level", level(F.col("flesch_ease"), some)).withColumn("in_target_band", F.col("flesch_kincaid").between(8.0, 12.0))


def level(ease: Column, some: Column) -> Column:
    out = F.when(~some, "unreadable")
    for least, name in ((90, "very easy"), (80, "easy"), (70, "fairly easy"), (60, "standard"), (50, "fairly difficult"), (30, "difficult")):
        out = out.when(ease >= least, name)
    return out.otherwise("very difficult")


# What is advised, and what is said where nothing is.
LONG_SENTENCES = "Consider shortening sentences (average words per sentence is high)"
COMPLEX_WORDS = "Consider simplifying vocabulary (high percentage of complex words)"
LONG_WORDS = "Consider using shorter words when possible"
TOO_HARD = "Content may be too difficult for target audience"
TOO_SIMPLE = "Content may be overly simplified"
TOO_SHORT = "Content is quite short - consider expanding"
FEW_SENTENCES = "Consider breaking content into more sentences"
BALANCED = "Content readability is well-balanced"


def advice(low: float = 8.0, high: float = 12.0) -> Column:
    """Recommendations from the columns of `scores`; praise where none applies."""
    w, s = F.col("n_words").cast("double"), F.col("n_sentences").cast("double")
    share = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), w), F.lit(0.0))
    said = [
        (w / s > 20, LONG_SENTENCES), (share("n_complex") > 0.15, COMPLEX_WORDS), (share("n_syllables") > 1.7, LONG_WORDS),
        (F.col("flesch_kincaid") > high, TOO_HARD), (F.col("flesch_kincaid") < low, TOO_SIMPLE), (w < 100, TOO_SHORT), (s < 3, FEW_SENTENCES),
    ]
    found = F.array_compact(F.array(*[F.when(c, F.lit(m)) for c, m in said]))
    return F.when(F.size(found) == 0, F.array(F.lit(BALANCED))).otherwise(found)
