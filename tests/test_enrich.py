"""Personal data and categories: planted cases, brute force, round trips, linear time, held-out accuracy, odd rows."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import categories, pii


@pytest.mark.parametrize(
    "text,want",
    [
        ("write to ann.lee+x@mail.example.org, now", [("email", "ann.lee+x@mail.example.org")]),
        ("card 4111 1111 1111 1111 ok", [("card", "4111 1111 1111 1111")]), ("card 4111 1111 1111 1112 no", []), ("0000000000000000", []),
        ("DE89 3704 0044 0532 0130 00.", [("iban", "DE89 3704 0044 0532 0130 00")]), ("DE88 3704 0044 0532 0130 00", []),
        ("host 192.168.0.254 up", [("ip", "192.168.0.254")]), ("v 1.2.3.4.5 or 256.1.1.1 or 01.2.3.4", []),
        ("call +49 30 1234567 or (030) 123-4567", [("phone", "+49 30 1234567"), ("phone", "(030) 123-4567")]), ("in 2024 there were 12345678 items", []),
        ("a@b and @x.org and a@b.c", []), ("x@y.orgs@z.de", [("email", "x@y.orgs")]), ("", []),
    ],
)
def test_planted(text, want):
    assert [(k, text[a:b]) for k, a, b in pii.spans_of(text)] == want


def test_overlaps_against_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choices("0123456789 -.+@aA()E", k=rng.randint(0, 120)))
        kept = []
        for kind, pattern, valid in pii.KINDS:
            for m in pattern.finditer(text):
                if (valid is None or valid(m.group())) and all(m.end() <= a or b <= m.start() for _, a, b in kept):
                    kept.append((kind, m.start(), m.end()))
        assert pii.spans_of(text) == sorted(kept, key=lambda s: s[1])


@pytest.mark.parametrize("unit", ["1", "1 ", "a@", "a.", "12.", "+1-", "A1 ", "(12)", "a@b-", "DE89 "])
def test_linear_time(unit):
    text = unit * (400_000 // len(unit))
    begun = time.time()
    pii.spans_of(text)
    assert time.time() - begun < 8


def test_redaction_round_trip_and_offsets(spark):
    rng = random.Random(3)
    parts = ["é中", "\U0001f600", "[EMAIL]", " and ", "\n", "x@y.org", "10.0.0.1", "4111111111111111", "+49 30 1234567", ""]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 12)))) for i in range(200)] + [(999, None)]
    df = spark.createDataFrame(rows, "i int, t string").withColumn("s", pii.spans("t")).withColumns({"r": pii.redacted(F.col("t"), F.col("s")), "o": pii.offsets(F.col("s")), "v": pii.values(F.col("t"), F.col("s"))})
    df = df.withColumns({"back": pii.restored(F.col("r"), F.col("o"), F.col("v")), "at": F.transform(F.sequence(F.lit(0), F.length("r")), lambda i: pii.original_offset(i, F.col("o")))})
    for r in df.collect():
        if r.t is None:
            assert r.s is None and r.r is None
            continue
        spans = pii.spans_of(r.t)
        assert [(x.kind, x.start, x.end) for x in r.s] == spans and r.back == r.t
        want, at, places = "", 0, []
        for kind, a, b in spans + [(None, len(r.t), len(r.t))]:
            places += range(at, a)
            want += r.t[at:a]
            if kind:
                places += [a] * (len(kind) + 2)
                want += f"[{kind.upper()}]"
            at = b
        assert r.r == want and r["at"] == places + [len(r.t)]


def brute(train, text):
    words = lambda t: [int(hashlib.md5(w.encode()).hexdigest()[:4], 16) for w in re.findall(r"[^\W_]+", (t or "").lower())]
    docs, counts = Counter(), defaultdict(Counter)
    for t, label in train:
        if label is not None:
            docs[label] += 1
            counts[label].update(words(t))
    score = lambda c: math.log(docs[c] / sum(docs.values())) + sum(math.log((counts[c][w] + 1) / (sum(counts[c].values()) + 65536)) for w in words(text))
    return max(sorted(docs), key=score) if docs else None


def test_categories_against_brute_force(spark):
    rng = random.Random(5)
    pools = {"sport": "ball goal team run".split(), "money": "bank rate loan run".split(), "food": "salt soup bread Öl".split()}
    make = lambda c: " ".join(rng.choice(pools[c] + ["the", "a"]) for _ in range(rng.randint(0, 12)))
    train = [(make(c), c) for c in rng.choices(list(pools), [5, 2, 1], k=80)] + [("ball", None), (None, "money"), ("", "odd")]
    texts = [make(c) for c in rng.choices(list(pools), k=60)] + [None, "", "unheard of"]
    model = categories.trained(spark.createDataFrame(train, "text string, topic string").repartition(3), "topic")
    got = categories.categorised(spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "i int, text string, label string"), model).orderBy("i").collect()
    assert [r.category for r in got] == [brute(train, t) for t in texts] and got[0].label == "clash"


def test_categories_without_labels(spark):
    empty = spark.createDataFrame([], "text string, topic string")
    rows = spark.createDataFrame([("x",)], "text string")
    assert [r.category for r in categories.categorised(rows, categories.trained(empty, "topic")).collect()] == [None]
    assert categories.categorised(rows.limit(0), categories.trained(empty, "topic")).count() == 0
    many = spark.range(70).select(F.lit("x").alias("text"), F.col("id").cast("string").alias("topic"))
    with pytest.raises(ValueError, match="at most 64"):
        categories.trained(many, "topic")
