"""Mixing sources to target weights with DataFrame functions only: block quotas, a splitting tree and permuted blocks.

A document belongs to one of `BLOCKS` blocks of its source, by a hash of its id and text. A source's target says how often
the mix takes each block: all blocks equally often, and some once more, in permuted order, so that the words taken come as near
to the target as whole blocks allow (a block that no longer fits is passed over; at the end the smallest left out joins if that
comes nearer). The draws of a block are dealt to output shards by a tree: at each node the exact quotas of the sources
are split between the two halves of its shards by a multivariate hypergeometric draw, one hypergeometric draw a source,
so shards are alike in number of draws and as mixed as a random deal would make them. A shard then takes disjoint runs of each
source's permuted draws, and `shuffled` orders the documents inside each shard by a hash.

What meets in one row is bounded: a source's list of at most `BLOCKS` blocks, the quotas of a node (one a source) and the list
of sources. Documents themselves only meet the block table, which Spark broadcasts if it is small and joins by (source, block)
if not; a source with a third of all rows is spread over its blocks.

Defined cases: null texts have size 0; a null source is a source of its own, the last one; a source without words has target 0
and, as targets stop at `MOST` times the size, nothing is taken beyond that; rows with one id and text share a block; null ids
are ids like any other; an empty table gives an empty table; extra columns are carried in a struct. All draws come from hashes of
`seed`, so a task that runs again, or another run, draws the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import table, written

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
BLOCKS, SHARDS, SEED = 4096, 64, 13
_SPACE = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D, in memory of the text's own size."""
    return F.length(F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w"), _SPACE, "")).cast("long")


def measured(docs: DataFrame, carry: dict[str, Column], text: str = "text", doc_id: str = "doc_id", source: str = "source", blocks: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """Columns `row` (of `carry`), source, size and block."""
    return docs.select(
        F.struct(*[c.alias(n) for n, c in carry.items()]).alias("row"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), F.lit(blocks)).cast("int").alias("block"),
    )


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then(value)`, with `value` worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(2.0**53)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """The marked among `drawn` of `total`, `marked` of them marked, for a uniform number `u`: the inverse of the distribution function.

    Weights follow from each other by their ratio, over the support or ten standard deviations and ten to either side of the
    mean, beyond which less lies than a double can tell.
    """
    low, high = F.greatest(F.lit(0), drawn + marked - total), F.least(drawn, marked)
    part = marked / F.greatest(total, F.lit(1))
    mean = drawn * part
    sd = F.sqrt(F.greatest(mean * (1 - part) * (total - drawn) / F.greatest(total - 1, F.lit(1)), F.lit(0.0)))
    first = F.greatest(low, F.floor(mean - 10 * sd) - 10)
    one, none = F.lit(1.0), F.lit(0.0)

    def following(p: Column, x: Column) -> Column:
        return p * (marked - x) * (drawn - x) / (x + 1) / F.greatest(total - marked - drawn + x + 1, F.lit(1))

    def found(xs: Column) -> Column:
        whole = F.aggregate(xs, F.struct(one.alias("p"), none.alias("sum")), lambda s, x: F.struct(following(s.p, x).alias("p"), (s["sum"] + s.p).alias("sum")), lambda s: u * s["sum"])
        start = F.struct(one.alias("p"), none.alias("sum"), whole.alias("goal"), F.element_at(xs, 1).alias("x"))
        return F.aggregate(
            xs, start,
            lambda s, x: F.struct(following(s.p, x).alias("p"), (s["sum"] + s.p).alias("sum"), s.goal.alias("goal"), F.when(s["sum"] < s.goal, x).otherwise(s.x).alias("x")),
            lambda s: s.x,
        )

    return _let(_let(first, lambda f: F.sequence(f, F.greatest(f, F.least(high, F.ceil(mean + 10 * sd) + 10)))), found)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """`sizes` (source, source_size and others) with nth (from 1 by source, null last), target, and whether it stops at `most` sizes.

    Sources in order of size by weight: one stops at its limit if what the earlier ones leave, by weight, is no less than that.
    The windows run over the list of sources.
    """
    everything = Window.partitionBy()
    ranked = sizes.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("nth") - 1) % len(weights) + 1).cast("int")).cast("double")
    ranked = ranked.withColumn("weight", weight).withColumn("limit", most * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "nth")
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    levelled = ranked.withColumn("level", (F.sum("source_size").over(everything) * share - before) / rest)
    full = F.col("limit") <= F.col("level") * F.col("weight")
    levelled = levelled.withColumn("full", full).withColumn("level", F.max(F.when(~full, F.col("level"))).over(everything))
    return levelled.withColumn("target", F.when(F.col("full"), F.col("limit")).otherwise(F.col("level") * F.col("weight"))).drop("weight", "limit", "level")


def _once_more(blocks: Column, words: Column) -> Column:
    """The blocks taken once more for `words` words, those that still fit, in their order; and the words left."""
    start = F.struct(words.alias("left"), F.array().cast("array<int>").alias("taken"))
    return F.aggregate(
        blocks, start,
        lambda s, b: F.when((b.words > 0) & (b.words <= s.left), F.struct((s.left - b.words).alias("left"), F.concat(s.taken, F.array(b.block)).alias("taken"))).otherwise(s),
    )


def planned(measures: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row a block: source, block, source_size, target, draws (an array of shard and repeat)."""
    sums = measures.groupBy("source", "block").agg(F.sum("size").alias("words"))
    place = F.xxhash64(F.lit(seed), F.col("source").isNull(), "source", "block")
    lists = sums.groupBy("source").agg(F.sum("words").alias("source_size"), F.sort_array(F.collect_list(F.struct(place.alias("place"), "block", "words"))).alias("blocks"))
    aimed = targets(lists, weights, share, most)
    aimed = aimed.withColumn("repeats", F.when(F.col("full"), F.lit(most)).otherwise(F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))).cast("int"))
    spare = F.greatest(F.round(F.col("target") - F.col("repeats") * F.col("source_size")).cast("long"), F.lit(0).cast("long"))
    aimed = aimed.withColumn("fits", _once_more(F.col("blocks"), spare))
    left_out = F.array_min(F.transform(F.filter("blocks", lambda b: (b.words > 0) & ~F.array_contains(F.col("fits.taken"), b.block)), lambda b: F.struct(b.words.alias("words"), b.block.alias("block"))))
    nearer = (left_out["words"] < 2 * F.col("fits.left")) & (F.col("repeats") < most)
    aimed = aimed.withColumn("more", F.when(nearer, F.concat("fits.taken", F.array(left_out["block"]))).otherwise(F.col("fits.taken")))

    def draw(block: Column, repeat: Column) -> Column:
        return F.struct(F.xxhash64(F.lit(seed + 1), F.col("nth"), block, repeat).alias("place"), block.alias("block"), repeat.cast("int").alias("repeat"))

    rounds = F.when(F.col("repeats") > 0, F.sequence(F.lit(0), F.col("repeats") - 1)).otherwise(F.array().cast("array<int>"))
    whole = F.flatten(F.transform(rounds, lambda r: F.transform("blocks", lambda b: draw(b.block, r))))
    drawn = aimed.withColumn("draws", F.sort_array(F.concat(whole, F.transform("more", lambda b: draw(b, F.col("repeats"))))))
    drawn = written(drawn.select("source", "nth", "source_size", "target", F.transform("blocks", lambda b: b.block).alias("blocks"), "draws"), "draws")
    dealt = shares(drawn.select("nth", F.size("draws").cast("long").alias("quota")), shards, seed)
    zipped = drawn.join(dealt, "nth", "left").select("source", "source_size", "target", F.explode(F.concat(
        F.transform("blocks", lambda b: F.struct(b.alias("block"), F.lit(None).cast("struct<shard:int,repeat:int>").alias("draw"))),
        F.zip_with("draws", F.coalesce("shards", F.array().cast("array<int>")), lambda d, s: F.struct(d.block.alias("block"), F.struct(s.alias("shard"), d.repeat.alias("repeat")).alias("draw"))),
    )).alias("one"))
    return zipped.groupBy("source", F.col("one.block").alias("block")).agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sort_array(F.collect_list("one.draw")).alias("draws"))


def shares(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """`quotas` (nth, quota) dealt to shards by the splitting tree: nth, shards (the shard of each of its draws, ascending)."""
    listed = F.sort_array(F.collect_list(F.struct("nth", "quota")))
    nodes = quotas.agg(listed.alias("of")).select(F.lit(0).alias("shard"), F.lit(shards).alias("width"), F.transform("of", lambda q: q.nth).alias("nths"), F.transform("of", lambda q: q.quota).alias("quotas"))
    nodes = nodes.withColumn("all", F.aggregate("quotas", F.lit(0).cast("long"), lambda a, q: a + q))
    for _ in range(max(shards - 1, 0).bit_length()):
        half = F.floor(F.col("width") / 2).cast("int")
        upto = [F.floor(F.col("all") * at / shards) for at in (F.col("shard"), F.col("shard") + half, F.col("shard") + F.col("width"))]
        start = F.struct((upto[2] - upto[0]).alias("total"), (upto[1] - upto[0]).alias("drawn"), F.array().cast("array<bigint>").alias("out"))

        def take(s: Column, q: Column) -> Column:
            x = hypergeometric(s.total, q.quota, s.drawn, uniform(F.lit(seed), F.col("shard"), F.col("width"), q.nth))
            return _let(x, lambda n: F.struct((s.total - q.quota).alias("total"), (s.drawn - n).alias("drawn"), F.concat(s.out, F.array(n)).alias("out")))

        lefts = F.aggregate(F.zip_with("nths", "quotas", lambda n, q: F.struct(n.alias("nth"), q.alias("quota"))), start, take, lambda s: s.out)

        def halves(left: Column) -> Column:
            right = F.zip_with("quotas", left, lambda q, x: q - x)
            return F.array(
                F.struct("shard", half.alias("width"), left.alias("quotas")),
                F.struct((F.col("shard") + half).alias("shard"), (F.col("width") - half).alias("width"), right.alias("quotas")),
            )

        sides = F.when(half == 0, F.array(F.struct("shard", "width", "quotas"))).otherwise(_let(lefts, halves))
        nodes = nodes.select(F.explode(sides).alias("side"), "nths", "all").select("side.*", "nths", "all")
    leaves = nodes.select("shard", F.explode(F.arrays_zip("nths", "quotas")).alias("q")).select("shard", F.col("q.nths").alias("nth"), F.col("q.quotas").cast("int").alias("quota"))
    each = F.sort_array(F.collect_list(F.struct("shard", "quota")))
    return leaves.groupBy("nth").agg(F.flatten(F.transform(each, lambda s: F.array_repeat(s.shard, s.quota))).alias("shards"))


def taken(measures: DataFrame, plan: DataFrame) -> DataFrame:
    """Columns row, source, size, source_size, target, draws: one row per document."""
    p = plan.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "source_size", "target", "draws")
    met = measures.join(p, measures["source"].eqNullSafe(p["_source"]) & (measures["block"] == p["_block"]), "left")
    return met.select("row", "source", "size", "source_size", "target", "draws")


def mix(found: DataFrame) -> DataFrame:
    """One row per drawn document: row, source, size, shard, repeat."""
    return found.select("row", "source", "size", F.explode("draws").alias("draw")).select("row", "source", "size", "draw.shard", "draw.repeat")


def shuffled(mixed: DataFrame, key: Column, partitions: int | None = None, seed: int = SEED) -> DataFrame:
    """The mix with its shards one after another, each in the order of a hash of `key` and repeat; a shard may span partitions."""
    order = [F.col("shard"), F.xxhash64(F.lit(seed + 2), key, F.col("repeat"))]
    dealt = mixed.repartitionByRange(partitions, *order) if partitions else mixed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = written(measured(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")}), "sizes")
    found = taken(measures, written(planned(measures), "blocks"))
    return found.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"), F.transform("draws", lambda d: d.shard).alias("shards"))
