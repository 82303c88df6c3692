"""Corpus reports: totals by category, longest per source, size buckets, additive scores, duplicates, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as t

# Words that mark educational and technical texts.
EDUCATIONAL = [
    "definition", "concept", "theory", "principle", "method", "algorithm", "example", "explanation", "analysis", "research", "study", "development",
    "process", "system", "technique", "approach", "framework", "model",
]
TECHNICAL = [
    "implementation", "optimization", "architecture", "performance", "complexity", "efficiency", "scalability", "methodology",
]


def by_category(docs: DataFrame, category: str, chars: str) -> DataFrame:
    """Count, characters, integer average and share of all characters of each category; largest first."""
    sums = docs.groupBy(category).agg(F.count("*").alias("documents"), F.sum(chars).alias("chars"))
    total = sums.agg(F.sum("chars").alias("_total"))  # one row
    share = F.round(F.col("chars") * 100.0 / F.col("_total"), 6)
    return sums.join(F.broadcast(total)).select(category, "documents", "chars", F.expr("chars div documents").alias("average"), share.alias("share")).orderBy(F.desc("chars"), category)


def longest_per_key(docs: DataFrame, key: str, chars: str, tie: str) -> DataFrame:
    """The longest row of each key, by a grouped maximum: no key's rows are sorted or held."""
    best = docs.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in docs.columns if c != key]), F.struct(F.col(chars), -F.col(tie))).alias("r"))
    return best.select(key, "r.*")


def size_bucket(chars: Column) -> Column:
    return F.when(chars > 50_000, "large").when(chars > 20_000, "medium").otherwise("small")


def length_grade(words: Column, high: int = 2000, medium: int = 500) -> Column:
    return F.when(words > high, "high").when(words > medium, "medium").otherwise("low")


def additive_score(c: Column, host_bonus: Column, bands: tuple = ((10_000, 0.3), (5_000, 0.2), (1_000, 0.1))) -> Column:
    """Length band + 0.02 per educational word + bonus of the host + 0.03 per technical word; at most 1."""
    words, low, length = t.word_count(c), F.lower(c), F.lit(0.0)
    for least, x in reversed(bands):
        length = F.when(words > least, x).otherwise(length)
    return F.least(F.lit(1.0), length + 0.02 * t.how_many(low, EDUCATIONAL) + host_bonus + 0.03 * t.how_many(low, TECHNICAL))


# Length bands (more words than), words that count once each, their weights and limits, hosts and priorities.
BROAD = {
    "bands": [(15_000, 0.35), (8_000, 0.25), (3_000, 0.15), (1_000, 0.08)],
    "educational": [
        "definition", "concept", "theory", "principle", "method", "algorithm", "example", "explanation", "analysis", "research", "study", "development",
        "process", "system", "technique", "approach", "framework", "model", "implementation", "application", "solution", "methodology", "evaluation",
        "comparison", "classification", "structure", "function", "mechanism", "overview", "introduction", "foundation", "fundamental", "basic", "advanced",
        "history", "evolution", "progress", "innovation", "discovery", "invention",
    ],
    "technical": [
        "implementation", "optimization", "architecture", "performance", "complexity", "efficiency", "scalability", "methodology", "specification", "protocol", "interface", "abstraction",
        "encapsulation", "inheritance", "polymorphism", "modular", "distributed", "concurrent", "parallel", "synchronization",
    ],
    "hosts": [(["wikipedia.org"], 0.25), ([".edu"], 0.35), (["go.dev", "golang.org"], 0.3), ([".gov"], 0.2)], "priorities": {1: 0.05, 2: 0.02},
}
FOCUSED = {
    "bands": BROAD["bands"],
    "educational": [
        "algorithm", "method", "technique", "approach", "implementation", "analysis", "theory", "principle", "concept", "definition", "explanation", "example",
        "research", "study", "development", "system", "framework", "model", "optimization", "complexity", "performance", "efficiency", "scalability",
        "architecture", "design", "pattern", "structure", "function", "mechanism",
    ],
    "technical": ["computational", "mathematical", "statistical", "algorithmic", "systematic", "formal", "theoretical", "empirical", "experimental", "analytical", "quantitative", "qualitative", "optimization", "implementation", "evaluation"],
    "hosts": [(["wikipedia.org"], 0.25), ([".edu"], 0.35)], "priorities": {},
}
EDUCATIONAL_WEIGHT, EDUCATIONAL_MOST, TECHNICAL_WEIGHT, TECHNICAL_MOST = 0.015, 0.3, 0.02, 0.2


def banded_score(c: Column, url: Column, priority: Column, variant: dict) -> Column:
    """Length band + educational words + host + technical words + priority, each part with its limit; at most 1."""
    words, low = t.word_count(c), F.lower(c)
    length, host, rank = F.lit(0.0), F.lit(0.0), F.lit(0.0)
    for least, x in reversed(variant["bands"]):
        length = F.when(words > least, x).otherwise(length)
    for names, x in reversed(variant["hosts"]):
        host = F.when(t.has_any(url, names), x).otherwise(host)
    for number, x in variant["priorities"].items():
        rank = F.when(priority == number, x).otherwise(rank)
    educational = F.least(F.lit(EDUCATIONAL_MOST), EDUCATIONAL_WEIGHT * t.how_many(low, variant["educational"]))
    technical = F.least(F.lit(TECHNICAL_MOST), TECHNICAL_WEIGHT * t.how_many(low, variant["technical"]))
    return F.least(F.lit(1.0), length + educational + host + technical + rank)


def simple_grade(c: Column) -> Column:
    """high, medium or low by length, code words, paragraphs and teaching words."""
    words = t.word_count(c)
    points = F.when(words > 1000, 4).when(words > 500, 2).otherwise(0)
    for has in (t.has_any(c, ["function", "class"]), F.size(t.paragraphs(c)) > 5, t.has_any(c, ["example", "tutorial"])):
        points = points + F.when(has, 2).otherwise(0)
    return F.when(points >= 8, "high").when(points >= 5, "medium").otherwise("low")


def host_bonus(url: Column) -> Column:
    return F.when(t.has(url, "wikipedia.org"), 0.2).when(t.has(url, ".edu"), 0.3).when(t.has_any(url, ["go.dev", "golang.org"]), 0.25).otherwise(0.0)


def short_number(n: Column) -> Column:
    return F.when(n >= 1_000_000, F.format_string("%.1fM", n / 1e6)).when(n >= 1_000, F.format_string("%.1fK", n / 1e3)).otherwise(n.cast("string"))


def short_bytes(n: Column) -> Column:
    """Bytes in the largest unit of 1,024s that leaves at least one of it, ties to the even digit."""
    out = F.format_string("%d B", n.cast("long"))
    for power, unit in enumerate("KMGTPE", 1):
        out = F.when(n >= 1024**power, F.format_string(f"%.1f {unit}B", F.bround(n / float(1024**power), 1))).otherwise(out)
    return F.when(n.isNotNull(), out)


def short_url(url: Column, most: int = 60) -> Column:
    return F.when(F.octet_length(url) > most, F.concat(F.left(url, F.lit(most - 3)), F.lit("..."))).otherwise(url)


def progress(docs: DataFrame, category: str, status: Column, words: Column, chars: Column, quality: Column) -> DataFrame:
    """Totals and mean quality of what was kept, and the share of each outcome, by category: one grouped pass."""
    kept = status == "kept"
    share = lambda name: F.round(F.avg((status == name).cast("double")) * 100, 6).alias(name)
    return docs.groupBy(category).agg(
        F.count("*").alias("processed"), F.count_if(kept).alias("documents"), F.sum(F.when(kept, words)).alias("words"), F.sum(F.when(kept, chars)).alias("chars"),
        F.round(F.avg(F.when(kept, quality)), 6).alias("quality"), share("kept"), share("blocked"), share("filtered"),
    )


def curation(docs: DataFrame, category: str, words: Column, chars: Column) -> DataFrame:
    """Documents, words and characters of each category and, with a null category, of all."""
    return docs.rollup(category).agg(F.count("*").alias("documents"), F.sum(words).alias("words"), F.sum(chars).alias("chars"), F.grouping(category).cast("int").alias("all_of_them"))


def exact_duplicates(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Adds first_id, the least id of the documents with the same text; grouped by digest, joined back."""
    hashed = docs.withColumn("_digest", F.sha2(F.col(text), 256))
    first = hashed.groupBy("_digest").agg(F.min(key).alias("first_id"))
    return hashed.join(first, "_digest").drop("_digest")


def merged(*sets: DataFrame) -> DataFrame:
    """All rows of all sets, duplicates and all."""
    out = sets[0]
    for s in sets[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def expected_and_actual(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    both = actual.join(expected, key, "full_outer")
    return both.select(key, F.coalesce("actual", F.lit(0)).alias("actual"), F.coalesce("expected", F.lit(0)).alias("expected"), F.round(F.try_divide(F.coalesce("actual", F.lit(0)) * 100.0, F.col("expected").cast("double")), 6).alias("rate"))


def as_of(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, value: str, tie: str | None = None) -> DataFrame:
    """For each left row the right value of the same key latest at or before it: one shuffle of both, no range join.

    Of several values at one time that of the greatest `tie` counts, or the greatest value; null values count as absent.
    """
    rows = left.select("*", F.col(left_ts).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_value"), F.lit(None).cast(right.schema[tie or value].dataType).alias("_tie"))
    other = right.select(key, F.col(right_ts).alias("_at"), F.lit(0).alias("_side"), F.col(value).alias("_value"), F.col(tie or value).alias("_tie"))
    w = Window.partitionBy(key).orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    both = rows.unionByName(other, allowMissingColumns=True).withColumn(value, F.last("_value", ignorenulls=True).over(w))
    return both.where("_side = 1").drop("_at", "_side", "_value", "_tie")


def as_of_time(versions: DataFrame, key: str, ts: str, when: Column) -> DataFrame:
    """The state of every key at a time, from append-only versions."""
    return versions.where(F.col(ts) <= when).groupBy(key).agg(F.max_by(F.struct(*[c for c in versions.columns if c != key]), F.col(ts)).alias("v")).select(key, "v.*")
