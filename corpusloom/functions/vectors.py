"""Vectors: dot products, norms, nearest neighbours, and a deterministic text embedder."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIM = 384
_TOKEN = re.compile(r"[^\W_]+")


def dot(a: Column, b: Column) -> Column:
    """Dot product in double; 0 where lengths differ."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.when(F.size(a) == F.size(b), F.aggregate(products, F.lit(0.0), lambda s, x: s + x)).otherwise(0.0)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """`a` over its norm, which is bound once: inside the inner function it would be worked out for each number."""
    scaled = lambda n: F.when(n > 0, F.transform(a, lambda x: x / n)).otherwise(F.transform(a, lambda x: x.cast("double")))
    return F.element_at(F.transform(F.array(norm(a)), scaled), 1)


def nearest(vectors: DataFrame, query: list[float], k: int, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """The k vectors of greatest dot product with the query: one scan and a top-k."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return vectors.select(key, dot(F.col(column), q).alias("similarity")).orderBy(F.desc("similarity"), key).limit(k)


#: Vectors that a task compares with a block of queries at a time.
SLICE = 512


def same_length(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and vectors of the rows (key, vector) whose vectors are not null and of `n` numbers, without a Python object a number."""
    batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), n), False))
    numbers = pc.fill_null(pc.list_flatten(batch.column(1)), float("nan"))
    return batch.column(0).to_numpy(zero_copy_only=False), numbers.to_numpy(zero_copy_only=False).reshape(-1, n)


class Nearest:
    """The best `k` keys of each query of a block, as they are met: by score, then by key."""

    def __init__(self, queries: int, k: int):
        self.k, self.least = k, np.full(queries, -np.inf)
        self.which, self.own, self.scores = np.empty(0, np.int64), None, np.empty(0)

    def add(self, scores: np.ndarray, own: np.ndarray) -> None:
        """Scores of each query (rows) with each of the keys `own` (columns); what cannot be among the best goes at once."""
        bar = self.least
        if scores.shape[1] > self.k:
            bar = np.maximum(bar, np.partition(scores, -self.k, axis=1)[:, -self.k])
        which, at = np.nonzero((scores >= bar[:, None]) & (scores > -np.inf))
        self.own = own[at] if self.own is None else np.concatenate([self.own, own[at]])
        self.which, self.scores = np.concatenate([self.which, which]), np.concatenate([self.scores, scores[which, at]])
        order = np.lexsort((self.own, -self.scores, self.which))
        which = self.which[order]
        first = np.flatnonzero(np.r_[True, which[1:] != which[:-1]]) if len(which) else np.empty(0, np.int64)
        nth = np.arange(len(which)) - np.repeat(first, np.diff(np.append(first, len(which))))
        order = order[nth < self.k]
        self.which, self.own, self.scores = self.which[order], self.own[order], self.scores[order]
        full = np.bincount(self.which, minlength=len(self.least)) == self.k
        lowest = np.full(len(self.least), np.inf)
        np.minimum.at(lowest, self.which, self.scores)
        self.least = np.where(full, lowest, -np.inf)

    def ranked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.which, self.own if self.own is not None else np.empty(0, np.int64), self.scores


def nearest_of(queries: DataFrame, vectors: DataFrame, k: int, block: int = 1024, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, `key` and similarity of the `k` nearest vectors of each row of `queries` (query_id, q), itself left out.

    Query vectors reach the driver `block` at a time and go out with one scan of all vectors; each task keeps `k` for each query of
    the block, and those of all tasks are ranked. A task compares `SLICE` vectors at a time, so it holds a table of block x `SLICE`
    numbers, whatever the input. Similarities are compared at nine decimals, then by key.
    """
    found, waiting = [], []
    rows = vectors.select(key, F.transform(column, lambda x: x.cast("double")).alias("v"))
    kept = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField(key, vectors.schema[key].dataType), T.StructField("s", T.DoubleType())])

    def scan(ids: list, matrix: np.ndarray) -> DataFrame:
        names = np.array(ids)

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind, top = None, Nearest(len(names), k)
            for batch in batches:
                kind = batch.schema.field(0).type
                for at in range(0, batch.num_rows, SLICE):
                    own, these = same_length(batch.slice(at, SLICE), matrix.shape[1])
                    if len(own):
                        scores = np.round(matrix @ these.T, 9)
                        scores[names[:, None] == own[None, :]] = -np.inf
                        top.add(scores, own)
            if kind is not None:
                which, own, scores = top.ranked()
                yield pa.RecordBatch.from_arrays([pa.array(names[which]), pa.array(own, kind), pa.array(scores)], kept.names)

        return rows.mapInArrow(best, kept)

    def flush() -> None:
        if waiting:
            found.append(scan([w[0] for w in waiting], np.array([w[1] for w in waiting], float)))
            waiting.clear()

    for r in queries.toLocalIterator():
        waiting.append((r.query_id, r.q))
        if len(waiting) == block:
            flush()
    flush()
    if not found:
        return rows.select(F.lit(None).cast(kept[0].dataType).alias("query_id"), key, F.lit(0.0).alias("similarity")).limit(0)
    order = Window.partitionBy("query_id").orderBy(F.desc("s"), key)
    return reduce(DataFrame.union, found).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).select("query_id", key, F.col("s").alias("similarity"))


def gram_counts(text: str) -> list[int]:
    """How often each different letter trigram occurs, by sorting them as numbers: three code points of 21 bits."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], return_counts=True)[1].tolist() if len(codes) > 2 else []


def embedding(text: str) -> np.ndarray | None:
    """384 numbers from letter trigrams, word frequencies, a sine and a hash, of unit length; None for an empty text."""
    if not text:
        return None
    norm_text = " ".join(text.lower().split())
    scores = sorted(x for c, n in Counter(gram_counts(norm_text)).items() for x in [c / (1 + math.log(c))] * n)
    words = Counter(_TOKEN.findall(norm_text))
    total = sum(words.values())
    freqs = sorted(c / total for c in words.values()) if total else []
    i = np.arange(DIM)
    out = np.zeros(DIM, np.float32)
    n = min(len(scores), DIM)
    out[:n] = scores[:n]
    if freqs:
        out += np.float32(0.5) * np.array(freqs, np.float32)[i % len(freqs)]
    out += np.sin(np.pi * i / DIM).astype(np.float32)
    base = hashlib.sha256(norm_text.encode("utf-8", "replace"))
    for k in range(DIM):
        h = base.copy()
        h.update(chr(k).encode())
        out[k] += np.float32(0.3 * (int.from_bytes(h.digest()[:4], "big") / (2**32 - 1) - 0.5))
    length = float(np.sqrt((out.astype(np.float64) ** 2).sum()))
    return out / np.float32(length) if length else out


@F.pandas_udf(T.ArrayType(T.FloatType()))
def embed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: embedding(x) if x is not None else None)
