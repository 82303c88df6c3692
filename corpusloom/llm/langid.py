"""Language identification by error-correcting output codes.

Each language has a codeword; one binary classifier over hashed byte n-grams of letters predicts each bit. Decoding
sums, for each codeword, the logistic loss of the predicted margins, weighted by how well each bit was learnt, and
takes the least; a text whose two best codewords are close is flagged as ambiguous.

The classifiers are fitted in numpy on a bounded sample of labelled rows, `sample` in all and equally many of each
language, drawn by a hash of id and text. Texts are scored whole, batch by batch.

Defined cases: a null text or one without a letter is `und` with score 0; with no labelled rows every text is `und`;
with one learned language every text with a letter has it. Ties go to the language first in order. Repeated rows
give repeated results. Null languages are not learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bytewords import raw_bytes
from corpusloom.llm.common import arrow_scan, fold, table

DIM = 2048
SAMPLE = 2400
#: Two best codewords closer than this, in probability, are ambiguous.
CLOSE = 0.2

_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 else 32 for c in range(256)], np.uint8)


def grams(arr: pa.Array) -> np.ndarray:
    """Unit vectors of damped counts of hashed byte trigrams, one row per text."""
    raw, at = raw_bytes(arr)
    out = np.zeros((len(at) - 1, DIM), np.float32)
    for s in range(0, len(at) - 1, 256):
        bounds = at[s : s + 257]
        data = _FOLD[raw[bounds[0] : bounds[-1]]].astype(np.uint32)
        if len(data) < 3:
            continue
        n = len(bounds) - 1
        h = (data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77) + data[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(21)
        doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(bounds))
        whole = doc[:-2] == doc[2:]
        counts = np.bincount((doc[:-2] * DIM + h)[whole], minlength=n * DIM).reshape(n, DIM)
        out[s : s + n] = np.sqrt(counts)
    norms = np.sqrt(np.einsum("ij,ij->i", out, out))
    out /= np.maximum(norms, 1e-9)[:, None]
    return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def codewords(k: int, seed: int = 5) -> np.ndarray:
    """k rows of +1 and -1: all splits for few classes, else the best of many random codes by least distance."""
    if k <= 1:
        return np.ones((k, 1), np.int8)
    if k <= 5:
        bits = 2 ** (k - 1) - 1
        return np.array([[1] * bits, *[[1 if c >> r & 1 else -1 for c in range(bits)] for r in range(k - 1)]], np.int8)
    width = max(15, 4 * int(np.ceil(np.log2(k))))
    rng, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(300):
        m = rng.integers(0, 2, (k, width)).astype(np.int8) * 2 - 1
        d = (width - m.astype(int) @ m.T.astype(int)) // 2 + np.eye(k, dtype=int) * width
        if d.min() > apart and np.all(np.abs(m.sum(0)) < k):
            best, apart = m, d.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # DIM x bits
    bias: np.ndarray
    trust: np.ndarray  # of each bit

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its probability, and the gap to the second best."""
        margins = x @ self.weights + self.bias
        agree = margins[:, None, :] * self.code[None, :, :]
        loss = (np.logaddexp(0, -agree) * self.trust).sum(2)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        top = p[np.arange(len(p)), best]
        p[np.arange(len(p)), best] = -1
        second = p.max(1) if p.shape[1] > 1 else np.zeros(len(p))
        return best, top, top - np.maximum(second, 0)


def fitted(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 120, ridge: float = 1e-4) -> Model:
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((DIM, 1), np.float32), np.ones(1, np.float32), np.ones(1, np.float32))
    target = code[y].astype(np.float32)
    bits = target.shape[1]
    w, b = np.zeros((DIM, bits), np.float32), np.zeros(bits, np.float32)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for t in range(1, steps + 1):
        f = x @ w + b
        g = -target / (1 + np.exp(target * f)) / len(x)
        gw, gb = x.T @ g + ridge * w, g.sum(0)
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        step = 0.3 / (1 - 0.9**t) * np.sqrt(1 - 0.99**t)
        w -= step * m / (np.sqrt(v) + 1e-8)
        b -= step * mb / (np.sqrt(vb) + 1e-8)
    right = (target * (x @ w + b) > 0).mean(0)
    trust = np.maximum(np.log(np.clip(right, 1e-3, 1 - 1e-3) / (1 - np.clip(right, 1e-3, 1 - 1e-3))), 0.05)
    return Model(languages, code, w, b, (trust / trust.mean()).astype(np.float32))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(F.col(lang).cast("string")).count().collect()}
    if not counts:
        return Model([], np.zeros((0, 1), np.int8), np.zeros((DIM, 1), np.float32), np.zeros(1, np.float32), np.ones(1, np.float32))
    languages, each = sorted(counts), max(20, sample // len(counts))
    draw = F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[c for k in languages for c in (F.lit(k), F.lit(min(1.0, each / counts[k])))])
    # repeated rows are drawn together: one of them is enough, and the sample stays bounded
    drawn = rows.where(draw < share[F.col(lang).cast("string")]).dropDuplicates([key, text, lang])
    kind = T.StructType([T.StructField("x", T.BinaryType())])

    def run(arr: pa.Array) -> list[pa.Array]:
        return [pa.array([r.tobytes() for r in grams(arr).astype(np.float16)], pa.binary())]

    got = arrow_scan(drawn, text, {"lang": F.col(lang).cast("string")}, kind, run).select("row.lang", "res.x").toArrow()
    if not got.num_rows:  # a draw can be empty where a language has a handful of rows
        got = arrow_scan(rows.orderBy(draw, key, text).limit(sample), text, {"lang": F.col(lang).cast("string")}, kind, run).select("row.lang", "res.x").toArrow()
    y = np.array([languages.index(v) for v in got.column("lang").to_pylist()])
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float16).reshape(len(y), DIM).astype(np.float32)
    order = np.lexsort((x @ np.arange(DIM, dtype=np.float32), y))  # rows come in any order: fix it
    return fitted(x[order], y[order], languages)


RESULTS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])


def predicted(df: DataFrame, model: Model, carry: dict[str, Column], text: str = "text") -> DataFrame:
    """Columns `row` and `res`: lang_pred, score, ambiguous."""

    def run(arr: pa.Array) -> list[pa.Array]:
        langs, scores, close = ["und"] * len(arr), np.zeros(len(arr)), np.zeros(len(arr), bool)
        known = np.array([has_letter(t) for t in arr.to_pylist()], bool)
        if model.languages and known.any():
            at = np.flatnonzero(known)
            for s in range(0, len(at), 1024):
                some = at[s : s + 1024]
                best, p, gap = model.decode(grams(arr.take(pa.array(some))))
                for i, k in zip(some.tolist(), best.tolist()):
                    langs[i] = model.languages[k]
                scores[some], close[some] = p, gap < CLOSE
        return [pa.array(langs, pa.string()), pa.array(np.clip(scores, 0, 1)), pa.array(close)]

    return arrow_scan(df, text, carry, RESULTS, run)


def learned(docs: DataFrame) -> Model:
    """The model of all documents but the held-out fold."""
    return train(docs.where(fold(F.col("doc_id"), 4) != 2))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predicted(docs, learned(docs), {"doc_id": F.col("doc_id"), "held_out": fold(F.col("doc_id"), 4) == 2})
    return found.select("row.doc_id", "row.held_out", "res.*")
