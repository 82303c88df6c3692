"""Quality classification: a Gaussian kernel over document statistics by random Fourier features.

Each text becomes `STATS` statistics (character classes, words, repetition, lines). Partitions sum the normal equations
of ridge regression over cosine features of the standardised statistics; a second set of labelled rows, in sums of a
fixed histogram, calibrates the fit by isotonic regression (pool adjacent violators).

All labelled rows outside the held-out fold are used: two thirds of them by fold for the fit, a third for the
calibration. Only sums of fixed size reach the driver.

Defined cases: null text counts as empty, an empty text has all statistics 0 and gets a score like any other; with
no labelled rows every score is 0.5; documents labelled more than once count with the mean label; null labels are
ignored. Repeated rows give repeated results. What is carried stays in a struct, so its names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bytewords import SPACES, split
from corpusloom.llm.common import arrow_scan, fold, matrix_rows, stacked, summed_by_key, table, written

CLASSES = 14
STATS = CLASSES + 16
FEATURES = 320
GAMMA = 0.012
RIDGE = 1e-3
BINS = 400

_CLASS = np.full(256, 11, np.int64)
for _chars, _k in ((range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), ([32, 9], 3), ([10, 13], 4), (b".", 5), (b",", 6), (b"!", 7), (b"?", 8), (b"|", 9), (b"#$%&*@~^=+<>\\/_", 10), ([*range(9), 11, 12, *range(14, 32), 127], 12), (range(128, 256), 13)):
    _CLASS[list(_chars)] = _k


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, how many different values and how often the commonest."""
    key = np.sort((doc.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    if not len(key):
        return np.zeros(n), np.zeros(n)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    run = np.diff(np.append(new, len(key)))
    owner = (key[new] >> np.uint64(44)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, owner, run)
    return np.bincount(owner, minlength=n).astype(float), most


def statistics(arr: pa.Array) -> np.ndarray:
    out = np.zeros((len(arr), STATS), np.float32)
    for s in range(0, len(arr), 512):
        part = arr.slice(s, 512)
        out[s : s + len(part)] = _statistics(part)
    return out


def _statistics(arr: pa.Array) -> np.ndarray:
    n = len(arr)
    w = split(arr, SPACES)
    from corpusloom.llm.bytewords import raw_bytes

    raw, at = raw_bytes(arr)
    size = np.diff(at)
    doc = np.repeat(np.arange(n), size)
    cls = _CLASS[raw]
    counts = np.bincount(doc * CLASSES + cls, minlength=n * CLASSES).reshape(n, CLASSES)
    some = np.maximum(size, 1)[:, None]
    words = np.maximum(w.counts, 1)
    lengths = w.ends - w.starts
    wdoc = w.doc
    per = lambda x: np.bincount(wdoc, x, minlength=n) / words
    h = w.hashes()
    mean = per(lengths)
    spread = np.sqrt(np.maximum(per(lengths.astype(float) ** 2) - mean**2, 0))
    distinct, most = _distinct(wdoc, h, n)
    again = np.zeros(len(h))
    if len(h):
        again[1:] = (h[1:] == h[:-1]) & (wdoc[1:] == wdoc[:-1])
    lower = np.concatenate([[0], np.cumsum((cls == 0) | (cls == 13))])
    upper = np.concatenate([[0], np.cumsum(cls == 1)])
    shout = (lower[w.ends] == lower[w.starts]) & (upper[w.ends] - upper[w.starts] > 1)
    last = cls[w.ends - 1] if len(h) else cls[:0]
    tail = (last >= 7) & (last <= 11)
    bare = (lengths <= 2) & ((last >= 5) & (last <= 11))
    pair = np.zeros(len(h), np.uint64)
    pair[1:] = h[1:] * np.uint64(0x9FB21C651E98DF25) + h[:-1]
    pairs, _ = _distinct(wdoc, pair, n)
    # lines
    breaks = cls == 4
    edge = np.zeros(len(raw), bool)
    edge[at[:-1][size > 0]] = True
    begins = np.flatnonzero(~breaks & (np.concatenate([[True], breaks[:-1]]) | edge)) if len(raw) else np.zeros(0, np.int64)
    ends_ = np.concatenate([breaks[1:], [True]]) if len(raw) else breaks
    if len(raw):
        ends_[at[1:][size > 0] - 1] = True
    stops = np.flatnonzero(~breaks & ends_) + 1
    ldoc = doc[begins]
    lines = np.bincount(ldoc, minlength=n)
    ldistinct, lmost = _distinct(ldoc, w.prefix_hash(begins, stops), n)
    short = np.bincount(ldoc, stops - begins < 30, minlength=n)
    many = np.maximum(lines, 1)
    rest = np.stack(
        [
            np.log1p(size) / 4, np.log1p(w.counts) / 4, np.log1p(mean), np.log1p(spread), distinct / words, most / words, per(again) * 2, per(shout) * 2,
            per(tail) * 2, per(bare) * 2, pairs / words, np.log1p(lines) / 3, ldistinct / many, lmost / many, short / many, np.log1p(w.counts / many),
        ],
        1,
    )
    return np.concatenate([np.sqrt(counts / some), rest], 1).astype(np.float32)


def stats_table(docs: DataFrame, carry: dict, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Columns `row` (a struct of `carry`), `key` and `x`, a text's statistics as 32-bit floats; written once and read by every pass."""
    kind = T.StructType([T.StructField("x", T.BinaryType())])

    def run(arr: pa.Array) -> list[pa.Array]:
        return [pa.array([r.tobytes() for r in statistics(arr)], pa.binary())]

    both = {"row": F.struct(*[c.alias(n) for n, c in carry.items()]), "key": F.col(key)}
    return written(arrow_scan(docs, text, both, kind, run).select("row.row", "row.key", "res.x"), "stats")


def _rows(x: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(x), np.float32).reshape(len(x), STATS).astype(np.float64)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    base: float
    ridge: np.ndarray | None = None
    knots: np.ndarray | None = None  # calibrated value of each bin of the raw fit

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(11)
        w, b = rng.normal(0, np.sqrt(2 * GAMMA), (STATS, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.sqrt(2 / FEATURES) * np.cos(z @ w + b), np.ones((len(x), 1))], 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.ridge

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((self.raw(x) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.ridge is None:
            return np.full(len(x), self.base)
        at = np.clip((self.raw(x) + 0.5) / 2 * BINS - 0.5, 0, BINS - 1)
        return np.interp(at, np.arange(BINS), self.knots)


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The least-squares non-decreasing fit, by pooling adjacent violators; bins without weight take their neighbours'."""
    blocks: list[list[float]] = []
    at = np.flatnonzero(weight > 0)
    for i in at:
        blocks.append([value[i] * weight[i], weight[i], 1])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, w, n = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w
            blocks[-1][2] += n
    fit = np.concatenate([np.full(int(n), s / w) for s, w, n in blocks])
    return np.interp(np.arange(len(value)), at, fit)


def _sums(rows: DataFrame, fn, per_slot: int) -> dict[int, np.ndarray]:
    """`fn` maps x and y of a batch to a matrix; the matrices are summed within partitions, then by slot of rows."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for p in parts:
            if len(p):
                m = fn(_rows(p["x"]), p["y"].to_numpy())
                total = m if total is None else total + m
        if total is not None:
            yield matrix_rows(total, per_slot)

    return summed_by_key(rows.select("x", "y").mapInPandas(run, "slot int, vec binary"), "f8")


def trained(rows: DataFrame) -> Model:
    """Fits rows of x (statistics), y (label from 0 to 1) and part (0: fit, other: calibrate)."""
    moments = stacked(_sums(rows, lambda x, y: np.concatenate([np.stack([x.sum(0), (x**2).sum(0)]), [[len(x), y.sum()] + [0.0] * (STATS - 2)]]), 3), (3, STATS), "f8")
    n, ones = moments[2, 0], moments[2, 1]
    if not n:
        return Model(np.zeros(STATS), np.ones(STATS), 0.5)
    mean = moments[0] / n
    scale = np.maximum(np.sqrt(np.maximum(moments[1] / n - mean**2, 0)), 1e-3)
    model = Model(mean, scale, float(ones / n))
    size = FEATURES + 1

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.features(x)
        return z.T @ np.concatenate([z, y[:, None]], 1)

    fit = stacked(_sums(rows.where("part = 0"), normal, 32), (-1, size + 1), "f8") if n else None
    if fit is None or fit.shape[0] != size:
        return model
    many = max(fit[-1, -2], 1.0)
    model.ridge = np.linalg.solve(fit[:, :-1] + RIDGE * many / FEATURES * np.eye(size), fit[:, -1])

    def histogram(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = model.bins(x)
        return np.stack([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)]).astype(float)

    cal = stacked(_sums(rows.where("part <> 0"), histogram, 2), (2, BINS), "f8")
    if not cal[0].sum():
        cal = stacked(_sums(rows, histogram, 2), (2, BINS), "f8")
    model.knots = isotonic(cal[1] / np.maximum(cal[0], 1), cal[0])
    return model


def label_rows(labels: DataFrame, name: str, key: str = "doc_id") -> DataFrame:
    """One row per labelled document: label_id, y."""
    return labels.where(F.col(name).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("label_id")).agg(F.avg(F.col(name).cast("double")).alias("y"))


def learned(stats: DataFrame, labels: DataFrame) -> Model:
    """Learns from labelled documents outside the held-out fold (remainder 1); remainder 0 fits, 2 calibrates."""
    train = stats.where(fold(F.col("key"), 3) != 1).select("key", "x")
    rows = train.join(label_rows(labels, "quality"), F.col("key") == F.col("label_id")).select("x", "y", fold(F.col("key"), 3).cast("int").alias("part"))
    return trained(written(rows, "labelled"))


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """Columns `row` and `res`: score and predicted, of a table that `stats_table` made."""
    results = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    schema = T.StructType([stats.schema["row"], T.StructField("res", results)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.frombuffer(b"".join(b.column(1).to_pylist()), np.float32).reshape(b.num_rows, STATS).astype(np.float64)
            score = np.clip(np.concatenate([model.score(x[s : s + 4096]) for s in range(0, len(x), 4096)]) if len(x) else np.zeros(0), 0, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.StructArray.from_arrays([pa.array(score), pa.array((score >= 0.5).astype(np.int32))], results.names)], ["row", "res"])

    return stats.select("row", "x").mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    stats = stats_table(docs, {"doc_id": F.col("doc_id")})
    return scored(stats, learned(stats, labels)).select("row.doc_id", (fold(F.col("row.doc_id"), 3) == 1).alias("held_out"), "res.*")
