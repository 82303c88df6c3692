"""Language ID, quality, toxicity, the language model and the Jaccard join: held-out accuracy, brute force, odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import jaccard, langid, maxent, quality, queries, toxicity
from corpusloom.llm.common import fold
from corpusloom.llm.components import components, contracted

from .odd import documents

AZ = str.maketrans({c: c + 32 for c in range(65, 91)})
SYLLABLES = {"en": "the and ing tion er st".split(), "fr": "le eau eux oi que ré".split(), "de": "der ung sch keit ich zu".split()}


def crc(i, k):
    return zlib.crc32(("" if i is None else str(i)).encode()) % k


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        lang = rng.choice(list(SYLLABLES))
        text, good, toxic = sentence(rng, lang, rng.randint(20, 120)), rng.random() < 0.7, rng.random() < 0.2
        if not good:
            text = " ".join(w + "***" for w in text.upper().split())
        if toxic:
            words = text.split()
            for _ in range(max(2, len(words) // 30)):
                words.insert(rng.randrange(len(words)), rng.choice(["scumbag", "moron"]))
            text = " ".join(words)
        rows.append((i, text, lang, "s", len(text)))
        labels.append((i, int(good), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).cache()
    return docs, spark.createDataFrame(labels + labels[:5] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int"), rows, {i: (q, t) for i, q, t in labels}


def test_language_id(spark, corpus):
    docs, _, rows, _ = corpus
    model = langid.learned(docs)
    got = {r.row.doc_id: r.res for r in langid.predicted(docs, model, {"doc_id": F.col("doc_id")}).collect()}
    held = [r for r in rows if crc(r[0], 4) == 2]
    assert np.mean([got[r[0]].lang_pred == r[2] for r in held]) > 0.97
    odd = langid.predicted(documents(spark), model, {"doc_id": F.col("doc_id"), "text": F.col("text")}).collect()
    assert len(odd) == 12
    for r in odd:
        assert (r.res.lang_pred == "und") == (not any(c.isalpha() for c in r.row.text or "")) and 0 <= r.res.score <= 1
    empty = langid.train(documents(spark, []))
    assert {r.res.lang_pred for r in langid.predicted(documents(spark), empty, {}|{"doc_id": F.col("doc_id")}).collect()} == {"und"}
    one = langid.train(documents(spark).where("lang = 'fr'"))
    assert {r.res.lang_pred for r in langid.predicted(documents(spark), one, {"doc_id": F.col("doc_id")}).collect()} == {"und", "fr"}


@pytest.mark.parametrize("k", [2, 3, 4, 5, 9, 40])
def test_codewords_differ(k):
    m = langid.codewords(k).astype(int)
    apart = (m.shape[1] - m @ m.T) // 2 + np.eye(k, dtype=int) * 99
    assert m.shape[0] == k and apart.min() >= (1 if k < 3 else 2)


def auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])


def test_quality(spark, corpus):
    docs, labels, _, truth = corpus
    stats = quality.stats_table(docs, {"doc_id": F.col("doc_id")})
    model = quality.learned(stats, labels)
    got = {r.row.doc_id: r.res for r in quality.scored(stats, model).collect()}
    held = [i for i in truth if crc(i, 3) == 1]
    assert auc([(got[i].score, truth[i][0]) for i in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    odd = quality.stats_table(documents(spark), {c: F.col(c) for c in documents(spark).columns})
    assert quality.scored(odd, model).where("res.score between 0 and 1 and row.score = 's' and row.row = 'x'").count() == 12
    assert {r.res.score for r in quality.scored(odd, quality.learned(odd, labels.limit(0))).collect()} == {0.5}
    assert quality.scored(odd.limit(0), model).count() == 0


def test_isotonic_fit():
    rng = np.random.default_rng(3)
    value, weight = rng.random(40), rng.integers(0, 4, 40).astype(float)
    fit = quality.isotonic(value, weight)
    assert np.all(np.diff(fit) >= -1e-12)
    seen = weight > 0
    # among non-decreasing step functions over prefixes and suffixes, none is closer
    best = ((fit - value) ** 2 * weight)[seen].sum()
    for cut in range(40):
        for a, b in ((value[:cut][weight[:cut] > 0], value[cut:][weight[cut:] > 0]),):
            if len(a) and len(b):
                wa, wb = weight[:cut][weight[:cut] > 0], weight[cut:][weight[cut:] > 0]
                ma, mb = np.average(a, weights=wa), np.average(b, weights=wb)
                if ma <= mb:
                    assert best <= ((a - ma) ** 2 * wa).sum() + ((b - mb) ** 2 * wb).sum() + 1e-9


def test_statistics_of_one_text_do_not_depend_on_its_batch():
    texts = ["a b c", "", "Line one.\nLine one.\nX!!", "word " * 50, "ÀÉ 中文", "\n\n", "TRUE *** TRUE"]
    together = quality.statistics(pa.array(texts))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], quality.statistics(pa.array([t]))[0])


def test_toxicity(spark, corpus):
    docs, labels, _, truth = corpus
    model = toxicity.learned(docs, labels)
    got = {r.row.doc_id: r.res.score for r in toxicity.scored(docs, model, {"doc_id": F.col("doc_id")}).collect()}
    held = [i for i in truth if crc(i, 4) == 2]
    assert auc([(got[i], truth[i][1]) for i in held]) > 0.98
    assert np.mean([(got[i] >= 0.3) == truth[i][1] for i in held]) > 0.95
    odd = toxicity.scored(documents(spark), model, {"doc_id": F.col("doc_id")}).collect()
    assert len(odd) == 12 and all(0 <= r.res.score <= 1 for r in odd)
    assert {r.res.score for r in toxicity.scored(documents(spark), toxicity.learned(docs, labels.limit(0)), {"doc_id": F.col("doc_id")}).collect()} == {0.0}


def test_nonnegative_risk_on_separable_points():
    rng = np.random.default_rng(1)
    pos = np.concatenate([np.ones((60, 1)), rng.random((60, 3))], 1)
    unl = np.concatenate([np.concatenate([np.ones((40, 1)), np.zeros((160, 1))]), rng.random((200, 3))], 1)
    w, b = toxicity.nonnegative_pu(pos, unl, 0.2)
    assert (pos @ w + b > 0).mean() > 0.95 and (unl[40:] @ w + b < 0).mean() > 0.95


def test_nonnegative_risk_against_differences():
    """The minimum over counted rows is that over the rows one by one, and no step away from it lowers the risk."""
    rng = np.random.default_rng(4)
    pos, unl, times = rng.random((40, 3)) + [0.6, 0, 0], rng.random((50, 3)), rng.integers(1, 6, 50)
    w, b = toxicity.nonnegative_pu(pos, unl, 0.2, times, steps=1500, rate=0.02)
    one, other = toxicity.nonnegative_pu(pos, np.repeat(unl, times, 0), 0.2, steps=1500, rate=0.02)
    assert np.allclose(w, one, atol=1e-6) and abs(b - other) < 1e-6

    def risk(w, b):
        loss = lambda x, sign: np.logaddexp(0, -sign * (x @ w + b))
        return 0.2 * loss(pos, 1).mean() + max(0, np.average(loss(unl, -1), weights=times) - 0.2 * loss(pos, -1).mean()) + 1e-4 * (w @ w)

    assert all(risk(w + s * d, b) > risk(w, b) - 1e-5 for d in np.eye(3) for s in (-0.05, 0.05)) and risk(w, b + 0.05) > risk(w, b) - 1e-5 < risk(w, b - 0.05)


def test_all_unlabelled_texts_count(spark, corpus, monkeypatch):
    """Moments over all texts against those of each text; shares deal every copy of every row once."""
    docs, labels, rows, truth = corpus
    texts = docs.select("doc_id", "text").union(documents(spark).select("doc_id", "text"))
    total = toxicity.all_moments(texts, "text")
    listed = [r.text or "" for r in texts.collect()]
    each = [tuple(x[1:] for x in [toxicity.valued(toxicity.split(pa.array([t]), toxicity.NON_ALNUM))])[0] for t in listed]
    assert total[-1, 0] == len(listed) and np.allclose(total[:-1], toxicity.moments(each), rtol=1e-3, atol=1e-4)
    monkeypatch.setattr(toxicity, "SHARE", 60)  # several shares
    model = toxicity.learned(docs, labels)
    got = {r.row.doc_id: r.res.score for r in toxicity.scored(docs, model, {"doc_id": F.col("doc_id")}).collect()}
    held = [i for i in truth if crc(i, 4) == 2]
    assert auc([(got[i], truth[i][1]) for i in held]) > 0.98


def test_toxicity_of_empty_and_repeated_documents(spark, corpus):
    docs, labels, *_ = corpus
    assert toxicity.learned(documents(spark, []), labels).weights is None
    copies = docs.where("doc_id < 40")
    for _ in range(4):
        copies = copies.union(copies)
    model = toxicity.learned(docs.union(copies), labels)
    assert toxicity.scored(documents(spark, []), model, {"doc_id": F.col("doc_id")}).count() == 0
    assert toxicity.scored(documents(spark), model, {c: F.col(c) for c in documents(spark).columns}).where("row.row = 'x' and res.score between 0 and 1").count() == 12


def test_language_model(spark, corpus):
    docs, _, rows, _ = corpus
    both = docs.select("doc_id", "text").union(documents(spark).select(F.col("doc_id") + 5000, "text"))
    texts = [(r.doc_id, r.text) for r in both.collect()]
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(AZ)) + [None] for _, t in texts]
    counts = Counter()
    for (i, _), w in zip(texts, words):
        if crc(i, 7) != 2:
            counts.update(w)
    total, per = sum(counts.values()), math.log10(sum(counts.values()) + len(counts) + 1)
    held = fold(F.col("doc_id"), 7) == 2
    train = both.where(~held)
    vocab = maxent.vocabulary(train, "text")
    lex = maxent.lexicon(vocab)
    w = maxent.trained(train, "text", lex)
    got = maxent.scored(both, vocab, lex, w, {"doc_id": F.col("doc_id"), "held_out": held}).collect()
    want = Counter((i, len(ws), sum(counts[x] > 0 for x in ws), total, round(sum(math.log10(counts[x] + 1) for x in ws) - len(ws) * per, 5)) for (i, _), ws in zip(texts, words))
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_continuations_sum_to_one(spark, corpus):
    docs = corpus[0]
    vocab = maxent.vocabulary(docs, "text")
    lex = maxent.lexicon(vocab)
    table = vocab.toPandas()
    cls = np.array([int(np.flatnonzero(lex.singles == np.uint64(h % 2**64))[0]) if np.uint64(h % 2**64) in lex.singles else maxent.SINGLES + e for h, e in zip(table.h, table.ending)])
    part = np.array([np.uint64(h % 2**64) >> np.uint64(60) for h in table.h]).astype(int)
    size = lex.mass + lex.kinds + 1
    bucket = cls >= maxent.SINGLES
    sums = np.bincount((cls * maxent.WAYS + part)[bucket], ((table.c + 1) / size[cls, part])[bucket], minlength=size.size).reshape(size.shape)
    assert np.allclose((sums + 1 / size)[maxent.SINGLES :], 1) and sorted(cls[~bucket]) == list(range(len(lex.singles)))
    assert lex.mass.sum() == table.c.sum() and lex.total == table.c.sum() and lex.types == len(table)
    w = np.random.default_rng(0).normal(0, 1, (1 << lex.bits, maxent.WAYS)).astype("f4")
    for bias in lex.biases():
        assert np.allclose(np.exp(bias).sum(1), 1, atol=1e-5)
        slots = np.random.default_rng(1).integers(0, len(w), (3, maxent.WAYS))
        every = [maxent.log_probabilities(w, np.repeat(bias[:1], maxent.WAYS, 0), np.repeat(slots[:, :1], maxent.WAYS, 1), np.arange(maxent.WAYS))]
        assert np.allclose(np.exp(every).sum(), 1, atol=1e-5)


def test_gradient_of_a_minibatch():
    """Sums of the gradient for each row of the table against differences of the log loss."""
    rng = np.random.default_rng(2)
    w, bias = rng.normal(0, 1, (12, maxent.WAYS)), np.log(rng.dirichlet(np.ones(maxent.WAYS), 40))
    slots, outcome = rng.integers(0, 12, (3, 40)), rng.integers(0, maxent.WAYS, 40)
    w, bias = w.astype("f4"), bias.astype("f4")

    def loss(w):
        z = bias.astype("f8") + sum(w[s] for s in slots)
        return (np.log(np.exp(z).sum(1)) - z[np.arange(40), outcome]).sum()

    at, many, sums = maxent.gradient(w, bias.copy(), slots, outcome)
    assert list(at) == sorted(set(slots.ravel())) and list(many) == [int((slots == i).sum()) for i in at]
    for i, row in zip(at, sums):
        for k in range(maxent.WAYS):
            up, down = w.astype("f8"), w.astype("f8")
            up[i, k] += 1e-5
            down[i, k] -= 1e-5
            assert abs((loss(up) - loss(down)) / 2e-5 - row[k]) < 1e-3
    before = loss(w.astype("f8"))
    maxent.descend(w, np.zeros(12, "f4"), np.ones(12, "f4"), bias.copy(), slots, outcome)
    assert loss(w.astype("f8")) < before


@pytest.mark.parametrize("n", [1, 2, 50, 3000])
def test_segment_sums(n):
    rng = np.random.default_rng(n)
    rows, starts = rng.random((n, 16)), np.unique(np.append(0, rng.integers(0, n, max(1, n // 3))))
    assert np.allclose(maxent.segment_sums(rows, starts), np.add.reduceat(rows, starts, axis=0))


def test_the_feature_table_grows_with_the_vocabulary():
    assert [maxent.slot_bits(n) for n in (0, 1000, 1 << 18, 1 << 19, 1 << 30)] == [14, 14, 15, 16, 17]


def test_language_model_without_training(spark):
    none = documents(spark, [])
    vocab = maxent.vocabulary(none, "text")
    lex = maxent.lexicon(vocab)
    got = maxent.scored(documents(spark), vocab, lex, maxent.trained(none, "text", lex), {"doc_id": F.col("doc_id")}).collect()
    assert len(got) == 12 and all(r.n_known == 0 and r.base_score == 0 and math.isfinite(r.score) for r in got)


# -- Jaccard -----------------------------------------------------------------------------------------------------------------


def brute_components(rows, k=3, percent=90):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(AZ))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            least[find(i)] = min(least.get(find(i), ident), ident)
    return Counter((ident, len(s), least.get(find(i), ident) if s else ident) for i, ((ident, _), s) in enumerate(zip(rows, sets)))


def test_jaccard_against_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    for i in range(60):  # chains of near copies
        w = list(base)
        for _ in range(rng.randint(0, 14)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(9999)}"
        rows.append((1000 + i, " ".join(w[: rng.choice([300, 300, 290, 280])])))
    for i in range(40):
        rows.append((2000 + i, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([2, 3, 12, 13, 40])))))
    rows += [(3000 + i, "Same TEXT for all of these here") for i in range(50)]
    monkeypatch.setattr(jaccard, "TILE_ROWS", 16)  # several tiles a band
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(tuple(r) for r in jaccard.joined(docs).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute_components(rows)
    assert jaccard.joined(docs.limit(0)).count() == 0


def test_jaccard_at_another_threshold(spark):
    """Links at 80 % reach sizes two bands of 90 % apart, and edits that share few minima."""
    rng = random.Random(80)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=7))
    rows = []
    for i in range(60):
        n = 54 + 5 * i
        base = [word() for _ in range(n)]
        edited = list(base)
        for at in range(n // 60, n, max(n * 50 // (n + 20), 40)):
            edited[at] = word()
        added = base + [word() for _ in range((n - 4) // 4 + i % 3 - 1)]
        rows += [(10 * i, " ".join(base)), (10 * i + 1, " ".join(added)), (10 * i + 2, " ".join(edited))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in jaccard.joined(docs, k=5, percent=80).select("doc_id", "n_shingles", "component_id").collect())
    want = brute_components(rows, 5, 80)
    assert got == want and len({c for _, _, c in want}) < len({c for _, _, c in brute_components(rows, 5, 90)})
    assert jaccard.keys_of(90) == 20 and (1 - 0.8**jaccard.ROWS) ** jaccard.keys_of(80) < 1e-9


def test_contracted_edges_are_stars_of_the_same_components():
    rng = np.random.default_rng(3)
    shapes = [rng.integers(-40, 40, (50, 2)), np.array([(i, i + 1) for i in range(300)]), np.array([(7, 7), (8, 9), (9, 8)]), np.empty((0, 2), np.int64)]
    for edges in shapes:
        a, b = contracted(edges[:, 0].astype(np.int64), edges[:, 1].astype(np.int64))
        least = {int(n): int(n) for n in edges.ravel()}
        for _ in range(len(edges)):
            for x, y in edges.tolist():
                least[x] = least[y] = min(least[x], least[y])
        assert dict(zip(a.tolist(), b.tolist())) == {n: low for n, low in least.items() if low != n}
        assert not set(a.tolist()) & set(b.tolist())


def test_components_of_a_long_path_over_many_tasks(spark):
    edges = [(i, i + 1) for i in range(400)]
    rows = components(spark.createDataFrame(edges, "a long, b long").repartition(16)).collect()
    assert len(rows) == 400 and {(r.a, r.b) for r in rows} == {(i, 0) for i in range(1, 401)}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (7, 9), (9, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        ra, rb = sorted((find(a), find(b)))
        root[rb] = ra
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).select("a", "b").collect())
    assert got == {x: find(x) for x in root if find(x) != x}


def test_linked_pairs_bound_loses_nothing():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(170, 201), replace=False), rng.integers(0, 1 << 63, rng.integers(0, 12), dtype=np.uint64)])) for _ in range(60)]
    pairs = jaccard.linked_pairs(sets, len(sets), 90)
    label = list(range(60))
    for i, j in pairs:
        label = [label[i] if x == label[j] else x for x in label]
    want = list(range(60))
    for i in range(60):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 90 * (len(sets[i]) + len(sets[j]) - n):
                want = [want[i] if x == want[j] else x for x in want]
    assert len(set(map(tuple, zip(label, want)))) == len(set(label)) == len(set(want))


def test_all_thirteen_are_registered():
    assert {int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES} == set(range(1, 14))
