"""Language ID, the quality model and the language model held against plain computations of the same things."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import langid, quality

TEXTS = ["The cat and the dog", "", "ab", "abc", "Der Hund schläft nicht. Ça va? 中文字", "x" * 3000, "A1B2 c3\nd4", " \x00a\x7fb "]


def trigrams(text):
    """Damped counts of hashed byte trigrams; letters folded, every other ASCII character a space."""
    data = [c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 else 32 for c in text.encode()]
    counts = [0] * langid.DIM
    for a, b, c in zip(data, data[1:], data[2:]):
        counts[((a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & 0xFFFFFFFF) >> 21] += 1
    norm = math.sqrt(sum(counts)) or 1.0
    return [math.sqrt(n) / norm for n in counts]


def test_language_features():
    assert np.allclose(langid.grams(pa.array(TEXTS)), [trigrams(t) for t in TEXTS], atol=1e-6)


@pytest.mark.parametrize("k", [2, 4, 9])
def test_decoding_takes_the_codeword_of_least_weighted_loss(k):
    rng = np.random.default_rng(k)
    code = langid.codewords(k)
    bits = code.shape[1]
    model = langid.Model([f"l{i}" for i in range(k)], code, rng.normal(size=(langid.DIM, bits)).astype(np.float32), rng.normal(size=bits).astype(np.float32), rng.uniform(0.1, 2, bits).astype(np.float32))
    x = langid.grams(pa.array(TEXTS))
    best, p, gap = model.decode(x)
    for i in range(len(TEXTS)):
        margins = [sum(float(x[i, j]) * float(model.weights[j, b]) for j in np.flatnonzero(x[i])) + float(model.bias[b]) for b in range(bits)]
        loss = [sum(float(model.trust[b]) * math.log1p(math.exp(-int(code[c, b]) * margins[b])) for b in range(bits)) for c in range(k)]
        share = [math.exp(-v) / sum(math.exp(-w) for w in loss) for v in loss]
        ranked = sorted(range(k), key=lambda c: loss[c])
        assert best[i] == ranked[0] and p[i] == pytest.approx(share[ranked[0]], rel=1e-3) and gap[i] == pytest.approx(share[ranked[0]] - share[ranked[1]], abs=1e-3)


def test_a_flipped_bit_does_not_change_the_word():
    code = langid.codewords(9).astype(float)
    apart = min((code[i] != code[j]).sum() for i in range(9) for j in range(i))
    model = langid.Model([str(i) for i in range(9)], code.astype(np.int8), np.zeros((langid.DIM, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32), np.ones(code.shape[1], np.float32))
    rng = random.Random(1)
    for c in range(9):
        word = code[c].copy()
        for b in rng.sample(range(len(word)), (apart - 1) // 2):
            word[b] *= -1
        model.bias = (4 * word).astype(np.float32)
        assert model.decode(np.zeros((1, langid.DIM), np.float32))[0][0] == c


def test_normal_equations_of_partitions_equal_those_of_all_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, quality.STATS)).astype(np.float32)
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0).astype(float)
    part = np.array([zlib.crc32(str(i).encode()) % 3 for i in range(300)])
    rows = spark.createDataFrame([(bytearray(r.tobytes()), float(v), int(p)) for r, v, p in zip(x, y, part)], "x binary, y double, part int").repartition(5)
    model = quality.trained(rows)
    x = x.astype(float)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, np.maximum(x.std(0), 1e-3)) and model.base == pytest.approx(y.mean())
    z = model.features(x)[part == 0]
    ridge = np.linalg.solve(z.T @ z + quality.RIDGE * len(z) / quality.FEATURES * np.eye(z.shape[1]), z.T @ y[part == 0])
    assert np.allclose(model.ridge, ridge, rtol=1e-4, atol=1e-6)
    at = model.bins(x[part != 0])
    weight, good = np.bincount(at, minlength=quality.BINS), np.bincount(at, y[part != 0], minlength=quality.BINS)
    fit = quality.isotonic(good / np.maximum(weight, 1), weight.astype(float))
    assert np.all(np.diff(model.knots) >= -1e-12) and np.corrcoef(model.knots, fit)[0, 1] > 0.9


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(6)
    model = quality.Model(np.zeros(quality.STATS), np.ones(quality.STATS), 0.5)
    a = rng.normal(size=(40, quality.STATS)) * 0.5
    b = a + rng.normal(size=a.shape) * rng.uniform(0, 1.5, (40, 1))
    got = (model.features(a)[:, :-1] * model.features(b)[:, :-1]).sum(1)
    want = np.exp(-quality.GAMMA * ((a - b) ** 2).sum(1))
    assert np.abs(got - want).max() < 5 / math.sqrt(quality.FEATURES) and np.corrcoef(got, want)[0, 1] > 0.9


def test_isotonic_fit_against_brute_force():
    rng = np.random.default_rng(9)
    for _ in range(200):
        n = rng.integers(1, 8)
        value, weight = rng.uniform(size=n), rng.integers(1, 4, n).astype(float)
        # the fit at i is the greatest over starts of the least over ends of the mean between
        want = [max(min(np.average(value[a : b + 1], weights=weight[a : b + 1]) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        assert np.allclose(quality.isotonic(value, weight), want)


def test_carried_columns_of_the_language_id(spark):
    docs = spark.createDataFrame([(1, "le chat", "x")], "doc_id long, text string, lang_pred string")
    model = langid.Model(["fr"], np.ones((1, 1), np.int8), np.zeros((langid.DIM, 1), np.float32), np.ones(1, np.float32), np.ones(1, np.float32))
    r = langid.predicted(docs, model, {c: F.col(c) for c in docs.columns}).first()
    assert (r.row.lang_pred, r.res.lang_pred) == ("x", "fr")
