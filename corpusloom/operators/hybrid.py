"""Search by words, by vector and by metadata at once, over an index of Parquet tables.

    postings/bucket=../tier=..   term and, of a block of documents, keys, lengths, positions and where each key's end; sorted by term
    terms/bucket=..              term, df and the greatest impact in each tier
    documents                    key, length and the attributes that filters use
    vectors/cell=..              key and unit vector, by nearest centroid

The impact of a term in a document is its BM25 weight but for the term's rarity. Postings lie in tiers of impact, so a query reads
the upper tiers first and stops when no document it has not met can still be among the best; only the documents that may are
completed from the lower tiers. A query's terms select buckets (partition filters), terms within files (pushed filters) and
tiers; a filter on attributes reaches the scan of `documents`. Vectors are searched in the cells nearest to the query. Both
rankings are fused by their ranks.

Postings are not shuffled: each task groups the words of its own documents, in blocks of about `BLOCK` bytes of text, and writes one
row a term, tier and block, so a frequent term is in as many tasks as its documents. What goes to the driver is bounded: the terms
of a query, one threshold a tier, `SAMPLE` vectors for the centroids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import vectors as v
from corpusloom.sources.spread import small_batches

K1, B = 1.2, 0.75
BUCKETS, TIERS, BLOCK = 16, 4, 8 << 20
CELLS, SAMPLE, ROUNDS = 16, 20_000, 8
#: Rank fusion: 1 / (RANK + rank).
RANK = 60
WORD, BETWEEN = r"[\p{L}\p{N}]+", r"[^\p{L}\p{N}]+"


def lowered(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit("")))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some lowered texts, in order, and the number of the text each is in."""
    split = pc.split_pattern_regex(texts, BETWEEN)
    words, of = split.flatten(), np.repeat(np.arange(len(texts)), split.value_lengths().to_numpy())
    full = pc.greater(pc.binary_length(words), 0)  # a text may begin or end between words
    return words.filter(full), of[full.to_numpy(zero_copy_only=False)]


@F.arrow_udf(T.IntegerType())
def n_words(texts: pa.Array) -> pa.Array:
    return pc.count_substring_regex(texts, WORD).cast(pa.int32())


def impact_of(tf, length, mean: float):
    """BM25 but for rarity, of columns or of numbers."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / (mean or 1.0)))


# -- writing -----------------------------------------------------------------------------------------------------------


def build(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", attributes: tuple[str, ...] = (), buckets: int = BUCKETS) -> Index:
    """Writes postings, terms and documents. Null and empty texts have no postings; keys must be unique and not null."""
    spark = docs.sparkSession
    small_batches(spark)
    docs.select(F.col(key).alias("key"), n_words(lowered(F.col(text))).alias("length"), *attributes).write.parquet(f"{path}/documents")
    index = Index(spark, path, buckets)
    rows = blocks(docs.select(F.col(key).alias("key"), lowered(F.col(text)).alias("text")), index.size[1]).withColumn("bucket", bucket_of(F.col("term"), buckets))
    rows.sortWithinPartitions("bucket", "tier", "term").write.partitionBy("bucket", "tier").parquet(f"{path}/postings")
    tops = [F.coalesce(F.max(F.when(F.col("tier") == i, F.col("top"))), F.lit(0.0)) for i in range(TIERS)]
    found = index._read("postings").groupBy("bucket", "term").agg(F.sum("n").alias("df"), F.array(*tops).alias("tops"))
    found.sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/terms")
    return index


#: Columns of the partitioned tables, which have no file to read them from while they are empty; `key` stands for the key's type.
LAYOUT = {
    "postings": "term string, n int, top double, keys array<{key}>, lengths array<int>, ends array<int>, positions array<int>, bucket int, tier int",
    "terms": "term string, df long, tops array<double>, bucket int",
    "vectors": "key {key}, vector array<double>, cell int",
}


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def blocks(docs: DataFrame, mean: float, most: int = BLOCK) -> DataFrame:
    """From key and lowered text: a row for each term, tier and block of documents, as the postings are stored but for the bucket.

    `n` keys and their documents' `lengths`; `positions` of all of them one after another, those of each key up to its number in
    `ends`; `top`, the greatest impact.
    """
    layout = LAYOUT["postings"].format(key=docs.schema["key"].dataType.simpleString())
    schema = T.StructType([f for f in T.StructType.fromDDL(layout) if f.name != "bucket"])

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held, size = [*held, batch], size + batch.nbytes
            if size >= most:
                yield from block(pa.Table.from_batches(held), mean)
                held, size = [], 0
        if held:
            yield from block(pa.Table.from_batches(held), mean)

    return docs.mapInArrow(group, schema)


def block(docs: pa.Table, mean: float) -> Iterator[pa.RecordBatch]:
    words, of = words_of(docs["text"].combine_chunks())
    if not len(words):
        return
    length = np.bincount(of, minlength=len(docs))
    at = np.arange(len(of)) - (np.cumsum(length) - length)[of]
    named = words.dictionary_encode()
    code = named.indices.to_numpy()
    order = np.argsort(code, kind="stable")  # by term, document and position
    code, of, at = code[order], of[order], at[order]
    # a posting is a term in a document
    first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (of[1:] != of[:-1])])
    tf, code, of = np.diff(np.r_[first, len(at)]), code[first], of[first]
    impact = impact_of(tf, length[of], mean)
    tier = np.minimum(np.floor(impact / (K1 + 1) * TIERS), TIERS - 1).astype(np.int32)
    order = np.argsort(code.astype(np.int64) * TIERS + tier, kind="stable")
    first, tf, code, of, impact, tier = (x[order] for x in (first, tf, code, of, impact, tier))
    ends = np.cumsum(tf)
    at = at[np.repeat(first - (ends - tf), tf) + np.arange(len(at))]
    # a row is a term's postings of one tier
    row = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (tier[1:] != tier[:-1])])
    bounds = np.r_[row, len(tf)]
    n, before = np.diff(bounds), (ends - tf)[row]
    keys = docs["key"].combine_chunks().take(pa.array(of))

    def listed(values, offsets) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, pa.int32()))

    columns = {
        "term": named.dictionary.take(pa.array(code[row])), "n": pa.array(n, pa.int32()), "top": pa.array(np.maximum.reduceat(impact, row)),
        "keys": listed(keys, bounds), "lengths": listed(length[of], bounds), "ends": listed(ends - np.repeat(before, n), bounds),
        "positions": listed(at, np.r_[before, len(at)]), "tier": pa.array(tier[row]),
    }
    yield from pa.table(columns).to_batches(max_chunksize=50_000)


def centroids(sample: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = 1) -> np.ndarray:
    """Spherical k-means: unit vectors around which the sample gathers."""
    rng = np.random.default_rng(seed)
    if not len(sample):
        return np.zeros((0, 0))
    centres = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = np.argmax(sample @ centres.T, 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centres)
    return centres


def build_vectors(vectors: DataFrame, path: str, key: str = "vec_id", column: str = "embedding", cells: int = CELLS, sample: int = SAMPLE) -> None:
    """Writes unit vectors by cell. Centroids come from the `sample` rows of least hash of the key; every vector with a direction is indexed."""
    rows = vectors.select(F.col(key).alias("key"), v.unit(F.col(column)).alias("vector")).where(F.col("vector").isNotNull() & (v.norm(F.col("vector")) > 0))
    drawn = rows.orderBy(F.xxhash64("key"), "key").limit(sample).select("vector").toPandas()["vector"]
    centres = centroids(np.stack(drawn.to_numpy()) if len(drawn) else np.zeros((0, 0)), cells)
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(cell=np.argmax(np.stack(pdf["vector"].to_numpy()) @ centres.T, 1).astype(np.int32))

    rows.mapInPandas(place, schema).repartition("cell").write.partitionBy("cell").parquet(f"{path}/vectors")
    listed = vectors.sparkSession.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
    listed.coalesce(1).write.parquet(f"{path}/centroids")


# -- searching ---------------------------------------------------------------------------------------------------------


@dataclass
class Index:
    spark: SparkSession
    path: str
    buckets: int = BUCKETS

    def _read(self, name: str) -> DataFrame:
        if name not in LAYOUT:
            return self.spark.read.parquet(f"{self.path}/{name}")
        key = self._read("documents").schema["key"].dataType.simpleString()
        return self.spark.read.schema(LAYOUT[name].format(key=key)).parquet(f"{self.path}/{name}")

    def documents(self, where: Column | None = None) -> DataFrame:
        docs = self._read("documents")
        return docs if where is None else docs.where(where)

    def postings(self, terms: list[str], lowest: int = 0, below: int = TIERS, positions: bool = False) -> DataFrame:
        """term, key, tf and impact (and positions) of some terms in tiers from `lowest`, under `below`: partition filters and a filter pushed into the files."""
        rows = self._read("postings").where(self._in_buckets(terms) & F.col("term").isin(terms) & (F.col("tier") >= lowest) & (F.col("tier") < below))
        end = lambda i: F.element_at("ends", i)
        begin = lambda i: F.when(i == 1, F.lit(0)).otherwise(F.element_at("ends", F.greatest(i - 1, F.lit(1))))
        one = lambda i: F.struct(
            F.element_at("keys", i).alias("key"), (end(i) - begin(i)).alias("tf"), F.element_at("lengths", i).alias("length"), *([F.slice("positions", begin(i) + 1, end(i) - begin(i)).alias("positions")] if positions else [])
        )
        each = rows.select("term", "bucket", "tier", F.inline(F.transform(F.sequence(F.lit(1), F.col("n")), one)))
        return each.withColumn("impact", impact_of(F.col("tf"), F.col("length"), self.size[1])).drop("length")

    def _in_buckets(self, terms: list[str]) -> Column:
        """A filter on the partitions that hold some terms."""
        numbers = self.spark.range(1).select(F.transform(F.array(*[F.lit(t) for t in terms]), lambda t: bucket_of(t, self.buckets))).first()[0] if terms else []
        return F.col("bucket").isin(sorted(set(numbers)))

    def _words(self, query: str) -> list[str]:
        return words_of(pa.array([self.spark.range(1).select(lowered(F.lit(query))).first()[0]]))[0].to_pylist()

    @cached_property
    def size(self) -> tuple[int, float]:
        """The number of documents and their mean length."""
        found = self._read("documents").agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
        return found.n, found.mean or 0.0

    def weights(self, query: str) -> dict[str, tuple[float, list[float]]]:
        """Of each term of the query that occurs: its rarity and its greatest impact in each tier."""
        terms, n = sorted(set(self._words(query))), self.size[0]
        rows = self._read("terms").where(self._in_buckets(terms) & F.col("term").isin(terms)).collect()
        return {r.term: (math.log(1 + (n - r.df + 0.5) / (r.df + 0.5)), list(r.tops)) for r in rows}

    def by_words(self, query: str, k: int, where: Column | None = None) -> DataFrame:
        """key and score (BM25) of the best `k` documents that have a word of the query, by score and key."""
        weights = self.weights(query)
        terms = sorted(weights)
        schema = self._read("documents").schema["key"]
        if not terms:
            return self.spark.createDataFrame([], T.StructType([schema, T.StructField("score", T.DoubleType())]))
        number = reduce(lambda c, t: c.when(F.col("term") == t, F.lit(terms.index(t))), terms[1:], F.when(F.col("term") == terms[0], F.lit(0)))
        rarity = F.element_at(F.array(*[F.lit(weights[t][0]) for t in terms]), number + 1)

        def scored(rows: DataFrame) -> DataFrame:
            rows = rows if where is None else rows.join(self.documents(where).select("key"), "key", "left_semi")
            return rows.groupBy("key").agg(F.sum(rarity * F.col("impact")).alias("score"), F.collect_set(number).alias("has"))

        for lowest in range(TIERS - 1, -1, -1):
            below = [weights[t][0] * max(weights[t][1][:lowest], default=0.0) for t in terms]
            met = scored(self.postings(terms, lowest))
            if lowest == 0:
                break
            best = met.orderBy(F.desc("score")).limit(k).agg(F.count("*").alias("n"), F.min("score").alias("least")).first()
            if best.n == k and sum(below) < best.least - 1e-9:
                missing = reduce(lambda a, b: a + b, [F.when(F.array_contains("has", i), 0.0).otherwise(b) for i, b in enumerate(below)])
                may = met.where(F.col("score") + missing >= best.least - 1e-9).select("key")
                met = scored(self.postings(terms).join(may, "key", "left_semi"))
                break
        return met.select("key", F.round("score", 9).alias("score")).orderBy(F.desc("score"), "key").limit(k)

    def by_phrase(self, phrase: str, where: Column | None = None) -> DataFrame:
        """key and the number of places where the phrase's words stand one after another."""
        words = self._words(phrase)
        rows = self.postings(sorted(set(words)), positions=True)
        if not words:
            return rows.select("key", F.lit(0).cast("long").alias("places"))
        rows = rows if where is None else rows.join(self.documents(where).select("key"), "key", "left_semi")
        # of each document that has all words, the positions of each; a place is where they agree once shifted
        found = rows.groupBy("key").agg(*[F.first(F.when(F.col("term") == w, F.col("positions")), ignorenulls=True).alias(f"at{words.index(w)}") for w in sorted(set(words))])
        shifted = [F.transform(f"at{words.index(w)}", partial(lambda i, x: x - i, i)) for i, w in enumerate(words)]
        return found.select("key", F.size(reduce(F.array_intersect, shifted)).cast("long").alias("places")).where("places > 0")

    def by_vector(self, query: list[float], k: int, where: Column | None = None, probes: int = CELLS) -> DataFrame:
        """key and similarity (cosine) of the nearest `k` documents in the `probes` cells nearest to the query."""
        q = np.array(query, float)
        q = q / (np.linalg.norm(q) or 1.0)
        order = sorted(((-float(np.dot(q, r.centre)), r.cell) for r in self._read("centroids").collect()))
        rows = self._read("vectors").where(F.col("cell").isin([c for _, c in order[:probes]]))
        rows = rows if where is None else rows.join(self.documents(where).select("key"), "key", "left_semi")
        unit = F.array(*[F.lit(float(x)) for x in q])
        return rows.select("key", F.round(v.dot(F.col("vector"), unit), 9).alias("similarity")).orderBy(F.desc("similarity"), "key").limit(k)

    def hybrid(self, query: str, vector: list[float], k: int, where: Column | None = None, depth: int = 100, probes: int = CELLS) -> DataFrame:
        """key, score, word_rank and vector_rank of the best `k`, by the sum of 1 / (`RANK` + rank) over the rankings' first `depth`."""
        sides = []
        for found, by in ((self.by_words(query, depth, where), "score"), (self.by_vector(vector, depth, where, probes), "similarity")):
            listed = found.agg(F.sort_array(F.collect_list(F.struct((-F.col(by)).alias("by"), "key"))).alias("all"))  # at most `depth` rows
            sides.append(listed.select(F.posexplode("all").alias("at", "x")).select("x.key", (F.col("at") + 1).alias("rank")))
        both = sides[0].withColumnRenamed("rank", "word_rank").join(sides[1].withColumnRenamed("rank", "vector_rank"), "key", "full_outer")
        score = sum((F.coalesce(1.0 / (RANK + F.col(c)), F.lit(0.0)) for c in ("word_rank", "vector_rank")), F.lit(0.0))
        return both.select("key", F.round(score, 9).alias("score"), "word_rank", "vector_rank").orderBy(F.desc("score"), "key").limit(k)
