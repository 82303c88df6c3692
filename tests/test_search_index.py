"""The search index against brute force: words with early stop, phrases, vectors, filters and fusion."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import hybrid


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)] + ["Été", "x1"]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(62)], k=rng.choice([0, 3, 20, 80]))) for _ in range(400)]
    rows = [(i, t, rng.choice(["en", "fr"])) for i, t in enumerate(texts)] + [(900, None, "en"), (901, "", None), (902, "w0. " * 30_000 + "w1", "en")]
    path = str(tmp_path_factory.mktemp("index"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("term", F.lit("clash")).repartition(4)
    index = hybrid.build(docs, path, attributes=("lang",), buckets=4)
    nrng = np.random.default_rng(2)
    centres = nrng.normal(size=(12, 16))
    m = centres[nrng.integers(0, 12, 400)] + 0.4 * nrng.normal(size=(400, 16))
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)] + [(900, [0.0] * 16), (901, None)], "vec_id long, embedding array<double>").repartition(4)
    hybrid.build_vectors(vectors, path, cells=12)
    return index, rows, m


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def bm25(rows, query, lang=None):
    docs = {i: Counter(words_of(t)) for i, t, _ in rows}
    mean = sum(sum(c.values()) for c in docs.values()) / len(docs)
    df = Counter(w for c in docs.values() for w in c)
    out = []
    for i, _, of in rows:
        got = [w for w in set(words_of(query)) if docs[i][w]]
        if got and (lang is None or of == lang):
            n = sum(docs[i].values())
            out.append((-round(sum(math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * docs[i][w] * 2.2 / (docs[i][w] + 1.2 * (0.25 + 0.75 * n / mean)) for w in got), 7), i))
    return sorted(out)


@pytest.mark.parametrize("query,k,lang", [("w0", 5, None), ("w0 w50 été", 7, None), ("w1 w2 w40", 3, "fr"), ("W0 nowhere w55", 1000, "en"), ("w30", 1, None)])
def test_words_equal_brute_force(made, query, k, lang):
    index, rows, _ = made
    got = index.by_words(query, k, None if lang is None else F.col("lang") == lang).collect()
    want = bm25(rows, query, lang)[:k]
    assert [(-round(r.score, 7), r.key) for r in got] == want


def test_unknown_and_empty_queries(made):
    index, *_ = made
    assert index.by_words("nowhere", 5).count() == 0 == index.by_words("", 5).count() == index.by_phrase("nowhere w0").count()


def test_upper_tiers_suffice_for_a_clear_best(made, monkeypatch):
    index, rows, _ = made
    read = []
    plain = hybrid.Index.postings
    monkeypatch.setattr(hybrid.Index, "postings", lambda self, terms, lowest=0, below=hybrid.TIERS: read.append(lowest) or plain(self, terms, lowest, below))
    best = index.by_words("w0 w1", 3).collect()
    assert [r.key for r in best] == [i for _, i in bm25(rows, "w0 w1")[:3]]
    assert read[0] == 3 and 0 in read and len(read) < 5  # it stopped before the lowest tier and then completed what was left


def test_postings_are_pruned(made):
    index, *_ = made
    plan = index.postings(["w3", "w4"], 2)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bucket.*tier", plan.replace("\n", " ")) and re.search(r"PushedFilters: \[.*In\(term, \[w3,w4\]\)", plan)
    filtered = index.documents(F.col("lang") == "fr")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,fr)" in filtered


def test_phrases(made):
    index, rows, _ = made
    for phrase in ("w0 w1", "w0 w0", "w2 w0 w1", "w0 w0 w0"):
        want = {}
        n = len(phrase.split())
        for i, t, lang in rows:
            w = words_of(t)
            found = sum(w[p : p + n] == phrase.split() for p in range(len(w)))
            if found and lang == "en":
                want[i] = found
        assert {r.key: r.places for r in index.by_phrase(phrase, F.col("lang") == "en").collect()} == want


def test_recall_of_vectors_with_few_cells(made):
    index, _, m = made
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    hits = total = 0
    for i in range(0, 400, 50):  # every fiftieth row asks
        want = set(np.argsort(-(unit @ unit[i]), kind="stable")[:10].tolist())
        hits += len(want & {r.key for r in index.by_vector(m[i].tolist(), 10, probes=4).collect()})
        total += 10
    assert hits / total >= 0.9
    exact = [r.key for r in index.by_vector(m[5].tolist(), 10, probes=12).collect()]
    assert exact == np.argsort(-(unit @ unit[5]), kind="stable")[:10].tolist()


def test_fusion(made):
    index, rows, m = made
    got = index.hybrid("w40 w41 w42", m[3].tolist(), 8, F.col("lang") == "en", depth=20, probes=12).collect()
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    english = {i for i, _, lang in rows if lang == "en"}
    by_word = [i for _, i in bm25(rows, "w40 w41 w42", "en")[:20]]
    by_vector = [i for i in np.argsort(-(unit @ unit[3]), kind="stable").tolist() if i in english][:20]
    score = Counter()
    for listed in (by_word, by_vector):
        for n, i in enumerate(listed):
            score[i] += 1 / (61 + n)
    assert [r.key for r in got] == sorted(score, key=lambda i: (-round(score[i], 9), i))[:8]


def test_empty_tables(spark, tmp_path):
    index = hybrid.build(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path))
    hybrid.build_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>"), str(tmp_path))
    assert index.hybrid("x", [1.0, 0.0], 5).count() == 0
