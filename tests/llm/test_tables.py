"""Source divergence, point-in-time features and mixing: brute force, odd rows, empty tables."""

import datetime as dt
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import divergence, features, mixing

from .odd import ROWS, documents

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
AZ = str.maketrans({c: c + 32 for c in range(65, 91)})


def audited(rows, least, top):
    seen, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source, found = lang or "", source or "", Counter(TERM.findall((text or "").translate(AZ)))
        groups.add((lang, source))
        seen[lang, source] += found
        docs[lang] += Counter(dict.fromkeys(found, 1))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [w for w, n in docs[lang].items() if n >= least]
        mine = sorted(s for l, s in groups if l == lang)
        counts = {s: {w: seen[lang, s][w] for w in kept} for s in mine}
        share = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept}
        p, q = {s: share(counts[s]) for s in mine}, share({w: sum(counts[s][w] for s in mine) for w in kept})
        for s in mine:
            pairs = sorted((-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode(), o) for o in mine if o != s)
            terms = sorted((q[w] - p[s][w], w.encode(), w) for w in kept if counts[s][w] and p[s][w] > q[w])[:top]
            out |= {(lang, s, part, o, -v, i + 1) for part, found in (("pair", pairs), ("term", terms)) for i, (v, _, o) in enumerate(found)}
    return out


@pytest.mark.parametrize("seed,part_rows", [(1, 400_000), (2, 50)])
def test_divergence_against_brute_force(spark, monkeypatch, seed, part_rows):
    monkeypatch.setattr(divergence, "PART_ROWS", part_rows)
    rng = random.Random(seed)
    words = [f"w{chr(97 + i)}" for i in range(20)] + ["Été", "ÀB", "xİ", "\U0001f600z", "rare"]
    rows = [(i, " ".join(rng.choices(words, range(1, 26), k=rng.randint(0, 30))).replace("wa wb", "wa\x00wb 9"), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "B", None])) for i in range(300)]
    rows += [(1000, None, "none", "s"), (1001, "", "none", "t"), rows[0], (1002, "wa " * 30_000, "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5).withColumn("term", F.lit(1)).withColumn("shard", F.lit("x"))
    got = [tuple(r) for r in divergence.audit(docs, least=9, top=4).collect()]
    assert len(got) == len(set(got)) and set(got) == audited(rows, 9, 4)
    assert ("none", "s", "pair", "t", 0, 1) in got


def test_divergence_of_odd_and_no_rows(spark):
    got = {tuple(r) for r in divergence.audit(documents(spark), least=2, top=3).collect()}
    assert got == audited([r[:4] for r in ROWS], 2, 3)
    assert divergence.audit(documents(spark, [])).count() == 0


# -- features ----------------------------------------------------------------------------------------------------------

T0 = dt.datetime(2024, 1, 1)
CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string, chunk string"
SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int, client string"
LINES = "sale_id long, line_no int, item_id long, amount double, shipped_at timestamp_ntz, a string"


def us(t):
    return (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def cent(x):
    return 0 if x is None else math.floor(100 * x + 0.5)


def expected(clicks, sales, lines):
    out, late = [], dt.timedelta(minutes=240)
    unique = set(clicks)
    for sale_id, client, _, _, sold, *_ in sales:
        if client is None or sold is None:
            continue
        t = sold + dt.timedelta(seconds=zlib.crc32(b"" if sale_id is None else str(sale_id).encode()) % 259200)
        own = [s for s in sales if s[1] == client and s[4] is not None]
        label = any(t < s[4] <= t + dt.timedelta(days=7) for s in own)
        for d in (2, 14):
            since = t - dt.timedelta(days=d)
            c = [x for x in unique if x[3] == client and x[1] is not None and x[2] is not None and since < x[1] <= t and x[2] + late <= t]
            s = [x for x in own if x[5] is not None and since < x[4] <= t and x[5] + late <= t]
            ls = [x for y in s for x in lines if x[0] is not None and x[0] == y[0] and x[4] is not None and x[4] <= t]
            last = max(((x[1], x[0] is not None, x[0] or 0) for x in c), default=None)
            out.append((
                sale_id, d, us(t), label, len(c), sum(x[4] == "purchase" for x in c), sum(cent(x[5]) for x in c), last[2] if last and last[1] else None, len(s), sum(cent(x[3]) for x in s),
                len(ls), len({x[2] for x in ls if x[2] is not None}), sum(cent(x[3]) for x in ls),
            ))
    return sorted(map(repr, out))


def shop(rng, n):
    def moment(days):
        return T0 + dt.timedelta(seconds=rng.randrange(days * 86400 // 600) * 600, microseconds=rng.choice([0, 1]))

    def maybe(x, p=0.05):
        return None if rng.random() < p else x

    def client():
        return maybe(rng.choice([7, 7, 7, 1, 2, 3]))

    clicks = []
    for i in range(n):
        ts = moment(40)
        clicks.append((maybe(i // 2, 0.02), maybe(ts), maybe(ts + dt.timedelta(minutes=rng.choice([0, 5, 3000]))), client(), maybe(rng.choice(["view", "purchase"])), maybe(rng.uniform(-9, 99)), "{}", "x"))
    clicks += rng.sample(clicks, n // 10)
    sales = []
    for i in range(n // 2):
        sold = moment(40)
        sales.append((i, client(), "done", maybe(rng.uniform(0, 99)), maybe(sold), maybe(sold + dt.timedelta(minutes=rng.choice([0, 60, 9000]))), 1, "y"))
    sales += [(None, 7, "done", 5.0, T0, T0, 1, "y"), (3, 1, "done", 5.0, T0 + dt.timedelta(days=3), T0 + dt.timedelta(days=3), 1, "y"), (10**6, 9, "done", 1.0, dt.datetime(9000, 1, 1), T0, 1, "y")]
    lines = [(maybe(rng.choice([5, 5, *range(n // 2 + 9)])), 1, maybe(rng.randrange(6)), maybe(rng.uniform(0, 9)), maybe(moment(45).replace(hour=0, minute=0, second=0, microsecond=0)), "z") for _ in range(2 * n)]
    return clicks, sales, lines


@pytest.mark.parametrize("chunk_rows,block_rows", [(100_000, 200_000), (40, 30), (3, 200_000)])
def test_features_against_brute_force(spark, monkeypatch, chunk_rows, block_rows):
    monkeypatch.setattr(features, "BLOCK_ROWS", block_rows)
    clicks, sales, lines = shop(random.Random(chunk_rows), 240)
    frames = [spark.createDataFrame(rows, schema).repartition(3) for rows, schema in ((clicks, CLICKS), (sales, SALES), (lines, LINES))]
    got = features.features(*frames, large_rows=chunk_rows, chunk_rows=chunk_rows)
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected(clicks, sales, lines)
    for other in ("America/New_York", "UTC"):  # times have no zone, so the session's must not matter
        spark.conf.set("spark.sql.session.timeZone", other)
        try:
            assert features.features(*frames, large_rows=chunk_rows, chunk_rows=chunk_rows).agg(F.sum("t_us")).first()[0] == got.agg(F.sum("t_us")).first()[0]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_features_of_no_rows(spark):
    none = [spark.createDataFrame([], s) for s in (CLICKS, SALES, LINES)]
    assert features.features(*none).count() == 0
    sale = spark.createDataFrame([(1, 1, "done", 1.0, T0, None, 1, "y")], SALES)
    (two, fourteen) = sorted(features.features(none[0], sale, none[2]).collect())
    assert (two.d, fourteen.d, two.n_sales, two.label, two.last_click_id) == (2, 14, 0, False, None)


# -- mixing ------------------------------------------------------------------------------------------------------------


def test_hypergeometric_draws(spark):
    rng, rows = random.Random(5), [(0, 0, 0, 0.5)]
    for _ in range(300):
        n = rng.choice([1, 2, 5, 30, 400])
        rows.append((n, rng.randint(0, n), rng.randint(0, n), rng.random()))

    def inverse(total, marked, drawn, u):
        goal, sofar = u * math.comb(total, drawn), 0
        for x in range(max(0, drawn + marked - total), min(drawn, marked) + 1):
            sofar += math.comb(marked, x) * math.comb(total - marked, drawn - x)
            if sofar >= goal:
                return x

    for r in spark.createDataFrame(rows, "a long, b long, c long, u double").withColumn("x", mixing.hypergeometric(F.col("a"), F.col("b"), F.col("c"), F.col("u"))).collect():
        assert r.x == inverse(r.a, r.b, r.c, r.u)


def test_shares_are_exact_and_mixed(spark):
    quotas = {1: 700, 2: 1, 3: 0, 4: 299}
    dealt = {r.nth: r.shards for r in mixing.shares(spark.createDataFrame(list(quotas.items()), "nth int, quota long"), 10).collect()}
    assert {n: len(s) for n, s in dealt.items()} == quotas and all(s == sorted(s) for s in dealt.values())
    assert Counter(s for d in dealt.values() for s in d) == dict.fromkeys(range(10), 100)
    big = Counter(dealt[1])
    sd = math.sqrt(100 * 0.7 * 0.3 * 900 / 999)
    assert len(set(big.values())) > 1 and all(abs(n - 70) < 5 * sd for n in big.values())


def water(sizes, share):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, total = set(), share * sum(sizes.values())
    while True:
        rest = sum(weight[s] for s in sizes if s not in full)
        level = (total - sum(2 * sizes[s] for s in full)) / rest if rest else 0
        more = {s for s in sizes if s not in full and level * weight[s] >= 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in full else level * weight[s] for s in sizes}
        full |= more


@pytest.mark.parametrize("blocks,shards", [(4096, 64), (16, 3)])
def test_mix(spark, blocks, shards):
    rng = random.Random(blocks)
    rows = [(i, " \t\n\x0b\x0c\r".join(["wörd\x1f"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    rows += [(1000, None, "empty"), (1001, " \t", "empty"), (None, "x y", "é"), (None, "x y", "é"), (1002, "z " * 50_000, "\U0001f600"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("block", F.lit("x")).withColumn("draws", F.lit(1)).repartition(3)
    measures = mixing.measured(docs, {c: F.col(c) for c in docs.columns}, blocks=blocks)
    plan = mixing.planned(measures, shards=shards)
    got = mixing.taken(measures, plan).collect()
    assert len(got) == len(rows)
    sizes, taken, most = Counter(), Counter(), Counter()
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.row.text or "")) and r.row.block == "x"
        assert len(r.draws) <= 2
        sizes[r.source] += r.size
        taken[r.source] += r.size * len(r.draws)
        most[r.source] = max(most[r.source], r.size)
    want = water(dict(sizes), 1.5)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s, goal in want.items():
        assert abs(taken[s] - goal) <= max(most[s] / 2, sizes[s] / blocks * 2) + 1, s
    mixed = mixing.mix(mixing.taken(measures, plan))
    again = mixing.mix(mixing.taken(measures, mixing.planned(measures, shards=shards)))
    key = lambda df: sorted((str(r.row.doc_id), r.shard, r["repeat"]) for r in df.collect())
    assert key(mixed) == key(again)
    placed = mixing.shuffled(mixed, F.col("row.doc_id"), 4).withColumn("p", F.spark_partition_id()).collect()
    assert [r.shard for r in placed] == sorted(r.shard for r in placed) and len(placed) == sum(len(r.draws) for r in got)


def test_mix_of_no_rows(spark):
    docs = documents(spark, [])
    measures = mixing.measured(docs, {"doc_id": F.col("doc_id")})
    assert mixing.taken(measures, mixing.planned(measures)).count() == 0
    odd = mixing.measured(documents(spark), {"doc_id": F.col("doc_id")})
    assert mixing.taken(odd, mixing.planned(odd)).count() == len(ROWS)
