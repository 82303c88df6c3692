"""Toxicity: non-negative positive-unlabelled learning in numpy.

Confirmed toxic examples are the positives; every other training text is unlabelled, toxic or not. The class prior comes
from the labels of the training fold. A linear classifier over hashed words and word beginnings minimises the
class-prior-corrected logistic risk, and where the corrected risk of the negatives falls below zero it steps back
instead (Kiryo et al., 2017), so it cannot profit from fitting unlabelled positives as negatives.

Confirmed examples are a bounded sample, at most `POSITIVES`, drawn by a hash of the id. The unlabelled side is all training
texts: sums over all partitions choose the `SELECTED` hashed features that best tell confirmed texts from the rest, and the
risk is minimised over shares of some `SHARE` texts, which together hold every text; the classifier is the mean of their
solutions. Only the confirmed texts' features are broadcast.

Defined cases: null text counts as empty; an empty text has no features and scores by the bias alone; with no
positive label every score is the prior (0 without labels). Null labels are ignored. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bytewords import NON_ALNUM, Words, split
from corpusloom.llm.common import arrow_scan, fold, matrix_rows, pieces, stacked, summed_by_key, table

BITS = 18
POSITIVES = 2500  # confirmed texts to learn from, at most: a bounded sample of labelled rows
SELECTED = 512  # size of the model
SHARE = 50_000  # unlabelled texts that are solved for at once; all are used
#: Word beginnings of these many bytes are features too.
HEADS = (5, 6, 7, 8, 9)
#: A feature's value is log(1 + DENSE * occurrences / (words + SHORT)).
DENSE, SHORT = 200.0, 20.0
THRESHOLD = 0.3


def hashed(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text number and feature number of every word and word beginning."""
    doc = w.doc
    docs, feats = [doc], [w.hashes() >> np.uint64(64 - BITS)]
    for k in HEADS:
        long = w.ends - w.starts >= k
        docs.append(doc[long])
        feats.append((w.prefix_hash(w.starts[long], w.starts[long] + k) ^ np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(64 - BITS))
    return np.concatenate(docs), np.concatenate(feats).astype(np.int64)


def valued(w: Words, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature and value of the different (text, feature) pairs; a value is a damped density among the text's words.

    Density rather than presence: in a long text a word that merely begins like a toxic one turns up by chance.
    """
    doc, feat = hashed(w)
    if chosen is not None:
        some = chosen[feat]
        doc, feat = doc[some], feat[some]
    key, count = np.unique(doc << BITS | feat, return_counts=True)
    doc = key >> BITS
    return doc, key & ((1 << BITS) - 1), np.log1p(DENSE * count / (w.counts[doc] + SHORT))


@dataclass
class Model:
    prior: float
    weights: np.ndarray | None = None  # of the selected features, by feature number; 0 elsewhere
    bias: float = 0.0

    def score(self, arr: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.full(len(arr), self.prior)
        out = np.empty(len(arr))
        chosen = self.weights != 0
        for s in range(0, len(arr), 1024):
            part = arr.slice(s, 1024)
            doc, feat, value = valued(split(part, NON_ALNUM), chosen)
            out[s : s + len(part)] = np.bincount(doc, self.weights[feat] * value, minlength=len(part))
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -30, 30)))


Rows = list[tuple[np.ndarray, np.ndarray]]


def moments(rows: Rows) -> np.ndarray:
    """Number of texts with each feature, and sums of its values and of their squares (features x 3)."""
    f, v = (np.concatenate([r[k] for r in rows]) if rows else np.zeros(0, np.int64) for k in (0, 1))
    return np.stack([np.bincount(f, x, minlength=1 << BITS) for x in (np.ones(len(f)), v, v * v)], 1)


def selected(pos: np.ndarray, n_pos: int, unl: np.ndarray, n_unl: float) -> np.ndarray:
    """Features whose mean among positives most exceeds that among the unlabelled, by z-score of the difference."""

    def mean_and_variance(m: np.ndarray, n: float) -> tuple[np.ndarray, np.ndarray]:
        n = max(n, 2)
        mean = m[:, 1] / n
        return mean, (m[:, 2] / n - mean**2 + 0.01 / n) / n

    (mp, vp), (mu, vu) = mean_and_variance(pos, n_pos), mean_and_variance(unl, n_unl)
    z = np.where(pos[:, 0] >= min(5, n_pos), (mp - mu) / np.sqrt(np.maximum(vp + vu, 1e-12)), 0)
    best = np.argsort(-z, kind="stable")[:SELECTED]
    return best[z[best] > 3]


def nonnegative_pu(
    pos: np.ndarray, unl: np.ndarray, prior: float, times: np.ndarray | None = None, steps: int = 400, rate: float = 0.05, l2: float = 2e-4
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise prior*R_p(+) + max(0, R_u(-) - prior*R_p(-)) with the logistic loss, by Adam.

    `times` says how often each unlabelled row stands.
    """
    share = np.full(len(unl), 1 / len(unl)) if times is None else times / times.sum()
    d = pos.shape[1]
    theta, m, v = np.zeros(d + 1), np.zeros(d + 1), np.zeros(d + 1)
    theta[-1] = np.log(max(prior, 1e-4) / max(1 - prior, 1e-4))
    sigmoid = lambda t: 1 / (1 + np.exp(-np.clip(t, -30, 30)))
    for t in range(1, steps + 1):
        w = theta[:-1].astype(unl.dtype)
        fp, fu = (pos @ w).astype(float) + theta[-1], (unl @ w).astype(float) + theta[-1]
        sp, su = sigmoid(fp), sigmoid(fu)
        below = share @ np.logaddexp(0, fu) - prior * np.logaddexp(0, fp).mean()
        up = lambda a, b: np.append(pos.T @ a.astype(pos.dtype) + unl.T @ b.astype(unl.dtype), a.sum() + b.sum())
        if below >= 0:
            g = up(-prior * (1 - sp) / len(fp) - prior * sp / len(fp), su * share)
        else:  # step back from a negative estimate
            g = -up(-prior * sp / len(fp), su * share)
        g[:-1] += l2 * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


_KIND = T.StructType([T.StructField("f", T.BinaryType()), T.StructField("v", T.BinaryType())])


def _features(docs: DataFrame, text: str, chosen: np.ndarray | None = None) -> DataFrame:
    """Columns f and v: feature numbers and values of each text, as bytes; of all features or of the chosen ones."""

    def run(arr: pa.Array) -> list[pa.Array]:
        doc, feat, value = valued(split(arr, NON_ALNUM), chosen)
        ends = np.searchsorted(doc, np.arange(len(arr) + 1))
        return [pa.array([x[a:b].astype(k).tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()) for x, k in ((feat, "<i4"), (value, "<f2"))]

    return arrow_scan(docs, text, {"id": F.col("doc_id")}, _KIND, run).select("res.f", "res.v")


def _read(f: list[bytes], v: list[bytes]) -> Rows:
    return [(np.frombuffer(x, "<i4").astype(np.int64), np.frombuffer(y, "<f2").astype(np.float32)) for x, y in zip(f, v)]


def all_moments(docs: DataFrame, text: str) -> np.ndarray:
    """`moments` of all texts, and their number in one row more: sums within partitions, then by rows of the matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(((1 << BITS) + 1, 3))
        for batch in batches:
            for part in pieces(batch, column=0):
                doc, feat, value = valued(split(part.column(0), NON_ALNUM))
                for k, x in enumerate((None, value, value * value)):
                    total[:-1, k] += np.bincount(feat, x, minlength=1 << BITS)
                total[-1, 0] += part.num_rows
        if total[-1, 0]:
            yield from pa.Table.from_pandas(matrix_rows(total.astype(np.float32), 1 << BITS - 4), preserve_index=False).to_batches()

    src = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    return stacked(summed_by_key(src.mapInArrow(run, "slot int, vec binary"), "f4"), (-1, 3), "f4").astype(float)


def dense(rows: Rows, place: np.ndarray, n: int) -> np.ndarray:
    x = np.zeros((len(rows), n), np.float32)
    for i, (f, v) in enumerate(rows):
        at = place[f]
        x[i, at[at >= 0]] = v[at >= 0]
    return x


def fitted(unlabelled: DataFrame, positives: np.ndarray, chosen: np.ndarray, prior: float, total: float) -> tuple[np.ndarray, float]:
    """The mean of the solutions for shares of all unlabelled texts, each of about `SHARE` of them with all positives.

    `unlabelled` has f and v. Equal rows are counted, and their copies dealt evenly to the shares, so that each share is
    like the whole and its size bounded however many texts are alike; most texts have none of the chosen features.
    """
    shares = max(1, round(total / SHARE))
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))
    sent = unlabelled.sparkSession.sparkContext.broadcast((positives, place))
    turn = F.pmod(F.xxhash64("f", "v"), F.lit(shares))
    counted = unlabelled.groupBy("f", "v").agg(F.count("*").alias("n"))
    # a row that stands n times goes n div shares times to each share, and once more to the next n mod shares of them
    whole, left = F.floor(F.col("n") / shares), F.col("n") % shares
    copies = F.transform(F.sequence(F.lit(0).cast("long"), F.least("n", F.lit(shares)) - 1), lambda j: F.struct(F.pmod(turn + j, F.lit(shares)).cast("int").alias("share"), (whole + (j < left).cast("long")).alias("times")))
    dealt = counted.select("f", "v", F.explode(copies).alias("x")).select("f", "v", "x.share", "x.times")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos, place = sent.value
        held: dict[int, list] = {}
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4))):
                held.setdefault(row[2], []).append(row)
        for share, rows in held.items():
            rows.sort(key=lambda r: (r[0], r[1]))  # rows come in any order: fix it
            x = dense(_read([r[0] for r in rows], [r[1] for r in rows]), place, pos.shape[1])
            w, bias = nonnegative_pu(pos, x, prior, np.array([r[3] for r in rows], float))
            n = float(sum(r[3] for r in rows))
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([(np.append(np.append(w, bias), 1.0) * n).tobytes()], pa.binary())], ["slot", "vec"])

    solved = dealt.repartitionById(shares, "share").mapInArrow(solve, "slot int, vec binary")
    sums = summed_by_key(solved, "f8")[0]
    return sums[:-2] / sums[-1], float(sums[-2] / sums[-1])


def learned(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """Learns from documents outside the held-out fold (remainder 2): confirmed toxic ones, and all as unlabelled."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 4) != 2)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    count, ones = known.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)), F.lit(0))).first()
    prior = ones / count if count else 0.0
    if not ones:
        return Model(prior)
    draw = F.xxhash64(F.col("doc_id"), F.lit(9))
    confirmed = known.where("toxic > 0").orderBy(draw, "doc_id").limit(POSITIVES).select("doc_id")
    train = docs.where(fold(F.col("doc_id"), 4) != 2).select("doc_id", text)
    own = train.join(F.broadcast(confirmed), "doc_id", "left_semi").dropDuplicates().orderBy(draw, text).limit(POSITIVES)
    got = _features(own, text).toArrow()
    pos = sorted(zip(got.column(0).to_pylist(), got.column(1).to_pylist()))
    if not pos:
        return Model(prior)
    pos = _read(*zip(*pos))
    unl = all_moments(train, text)
    chosen = selected(moments(pos), len(pos), unl[:-1], unl[-1, 0])
    if not len(chosen):
        return Model(prior)
    mark, place = np.zeros(1 << BITS, bool), np.full(1 << BITS, -1)
    mark[chosen], place[chosen] = True, np.arange(len(chosen))
    theta, bias = fitted(_features(train, text, mark), dense(pos, place, len(chosen)), chosen, prior, unl[-1, 0])
    weights = np.zeros(1 << BITS)
    weights[chosen] = theta
    return Model(prior, weights, bias)


RESULTS = T.StructType([T.StructField("score", T.DoubleType())])


def scored(docs: DataFrame, model: Model, carry: dict[str, Column], text: str = "text") -> DataFrame:
    """Columns `row` and `res`: score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return arrow_scan(docs, text, carry, RESULTS, lambda arr: [pa.array(sent.value.score(arr))])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = scored(docs, learned(docs, labels), {"doc_id": F.col("doc_id"), "held_out": fold(F.col("doc_id"), 4) == 2})
    return found.select("row.doc_id", "row.held_out", "res.score", (F.col("res.score") >= THRESHOLD).cast("int").alias("predicted"))
