"""Cases of the review: odd inputs, and steps whose cost must not outgrow the input."""

import datetime as dt
import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import assessment, readability, technical, vectors
from corpusloom.operators import hybrid
from corpusloom.plans import fixture, q_operators
from corpusloom.sources.spread import spread
from corpusloom.streaming import events, joins


@pytest.mark.parametrize("text, unique", [("Re.", 0.0), ("a b c", 0.0), ("", 0.0), ("Word.", 0.9), ("over a of b", 0.9)])
def test_a_text_without_a_longer_word_is_not_unique(spark, text, unique):
    docs = readability.counts(spark.createDataFrame([(text,)], "text string"))
    got = docs.select(assessment.uniqueness(F.col("text")).alias("by_columns"), assessment.uniqueness(F.col("text"), F.col("n_repeated")).alias("by_counts")).first()
    assert tuple(got) == (pytest.approx(unique), pytest.approx(unique))


def test_activity_reads_and_writes_state_a_fixed_number_of_times():
    """However many requests a call brings, in whatever order and Arrow batches."""
    calls, held = [], {}

    class Value:
        def __init__(self, name):
            self.name = name

        def exists(self):
            calls.append("exists")
            return self.name in held

        def get(self):
            calls.append("get")
            return held[self.name]

        def update(self, value):
            calls.append("update")
            held[self.name] = value

        def clear(self):
            held.pop(self.name, None)

    class Handle:
        timers: set = set()

        def getValueState(self, name, schema):  # noqa: N802
            return Value(name)

        getMapState = getValueState  # noqa: N815

        def registerTimer(self, at):  # noqa: N802
            calls.append("timer")
            self.timers.add(at)

        def deleteTimer(self, at):  # noqa: N802
            calls.append("timer")
            self.timers.discard(at)

    class Times:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):  # noqa: N802
            return self.at

        getExpiryTimeInMs = getCurrentWatermarkInMs  # noqa: N815

    one = joins.Activity(10, T.StringType())
    one.init(Handle())
    us = [s * 1_000_000 for s in [*range(0, 2000, 5), *range(5000, 6000, 5)]]
    random.Random(1).shuffle(us)
    for part in (us[:300], us[300:]):  # a call each, of three Arrow batches
        calls.clear()
        frames = [pd.DataFrame({"us": part[i::3], "failed": [x % 10_000_000 == 0 for x in part[i::3]], "kind": ["v"] * len(part[i::3])}) for i in range(3)]
        assert list(one.handleInputRows(("a",), iter(frames), Times(0))) == []
        assert len(calls) <= 8
    first = pd.concat(one.handleExpiredTimer(("a",), Times(3_000_000), Times(2_005_000)))
    assert first.values.tolist() == [["a", 400, 200, 0, 1_995_000_000, "v=400"]] and Handle.timers >= {6_005_000}
    second = pd.concat(one.handleExpiredTimer(("a",), Times(9_000_000), Times(6_005_000)))
    assert second.values.tolist() == [["a", 200, 100, 5_000_000_000, 5_995_000_000, "v=200"]] and not held


def test_activity_of_known_kinds_stays_in_the_engine(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0, "x", True), ("a", t0 + dt.timedelta(seconds=900), "y", False), ("a", t0 + dt.timedelta(seconds=1800, microseconds=1), None, None), ("b", t0, "x", False), (None, t0, "x", True)]
    far = [("z", t0 + dt.timedelta(days=9), "x", False)]
    for i, part in enumerate((rows[1:], rows[:1], far)):  # the first request of a comes late
        spark.createDataFrame(part, "key string, ts timestamp, kind string, failed boolean").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema("key string, ts timestamp, kind string, failed boolean").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    out = joins.activity_of_kinds(stream, ["y", "x"], 900)
    assert "Python" not in out._jdf.queryExecution().analyzed().toString()
    got = {(r.key, r.requests, r.failed, r.last_us - r.first_us, r.kinds) for r in events.to_table(out, "kinds").collect()}
    assert got == {("a", 2, 1, 900_000_000, "x=1,y=1"), ("a", 1, 0, 0, None), ("b", 1, 0, 0, "x=1")}


def test_the_nearest_hold_little_while_vectors_pass():
    """As many candidates as the answer has, in whatever slices the vectors come; the same as ranking all, ties by key."""
    rng = np.random.default_rng(5)
    scores, own, k = np.round(rng.random((7, 400)), 1), rng.permutation(400), 5
    top = vectors.Nearest(7, k)
    for at in range(0, 400, 60):
        top.add(scores[:, at : at + 60], own[at : at + 60])
        assert len(top.scores) <= 7 * k
    want = [(q, *x) for q in range(7) for x in sorted(zip(own.tolist(), scores[q].tolist()), key=lambda x: (-x[1], x[0]))[:k]]
    assert list(zip(*(x.tolist() for x in top.ranked()))) == want


def test_nearest_of_leaves_out_nulls_and_other_lengths(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [1.0]), (4, [0.5, 0.9]), (5, [0.9, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = table.where("vec_id = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    assert [tuple(r) for r in vectors.nearest_of(asked, table, 2).orderBy(F.desc("similarity"), "vec_id").collect()] == [(0, 5, 0.899999976), (0, 1, 0.5)]


@pytest.mark.parametrize("text", ["", "ab", "abcabcabc", "ab\ud800cd\U0001f600cd\U0001f600c", "the theme of the theory"])
def test_trigrams_are_counted_as_numbers(text):
    assert sorted(vectors.gram_counts(text)) == sorted(Counter(text[i : i + 3] for i in range(len(text) - 2)).values())


def test_texts_are_dealt_out_whatever_their_files(spark, tmp_path):
    """One row group is one task of a scan; the files may be far smaller than the texts."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("same text "), 1000).alias("text"))
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    dealt = spread(spark.read.parquet(str(tmp_path / "d")))
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert dealt.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism and sum(sizes) == 400 and max(sizes) < 100


def test_formulas_are_judged_step_by_step_alike(spark):
    said = ["x^2 + y = 1", "(a + b * 2", "log(-1) + 3 / 0", "x + 0 = y = 2", "\\frac{a}{b}", "sin(x) ÷ 2", " ", "sqrt(-2)", "a" + " + 1" * 60]
    one = spark.createDataFrame([(x,) for x in said], "f string").select(technical.validated_formula(F.col("f"))["valid"].alias("v"))
    many = spark.range(1).select(technical.valid_formulas(F.array(*map(F.lit, said))).alias("v")).first().v
    assert many == [r.v for r in one.collect()]
    plan = spark.createDataFrame([("$a$",)], "t string").select(technical.technical_accuracy(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(t#") == 5


def test_assessment_lowers_a_text_once(spark):
    plan = assessment.assess(spark.createDataFrame([("a", {"title": "x"})], "text string, metadata map<string,string>"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(text#") <= 1


def test_counting_words_bounds_batches_and_memory(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    readability.counts(spark.createDataFrame([("a",)], "text string"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000 and readability.REMEMBERED <= 100_000


def shuffled(spark):
    """Bytes that the session's executors have written into shuffles."""
    time.sleep(1)  # the listeners may lag behind
    found = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


def test_an_index_does_not_shuffle_its_words(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(300)], k=2000)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    docs.write.parquet(f"{tmp_path}/d")
    before = shuffled(spark)
    index = hybrid.build(spark.read.parquet(f"{tmp_path}/d"), f"{tmp_path}/i")
    assert shuffled(spark) - before < sum(map(len, texts)) / 10
    rows = spark.read.parquet(f"{tmp_path}/i/postings").count()
    assert rows < 300 * hybrid.TIERS * 4 + 1 and index.postings([f"w{i}" for i in range(300)]).count() == sum(len(set(t.split())) for t in texts)


def test_a_phrase_shuffles_a_row_a_document_and_word(spark, tmp_path):
    """A text of one word over and over: its places stay together."""
    docs = spark.createDataFrame([(i, "w " * 20_000) for i in range(20)], "doc_id long, text string").repartition(4)
    index = hybrid.build(docs, str(tmp_path))
    found = index.by_phrase("w w w")
    assert found.collect() == found.collect() and {r.places for r in found.collect()} == {19_998}
    assert "explode(" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("size", [1, 1 << 20])
def test_blocks_hold_each_word_of_each_text_once(spark, size):
    texts = ["", " ", "a", " a b a ", "a-b_c a1 \u00e9t\u00e9", "\U0001f600\u4e00\u4e8c a\u0301", "b " * 500 + "a", "\u0130x", None, "A a"]
    docs = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(texts)], "key string, text string").repartition(2)
    lows = {r.key: r.text for r in docs.select("key", hybrid.lowered(F.col("text")).alias("text")).collect()}
    want = sorted((w, k, [p for p, x in enumerate(ws) if x == w], len(ws)) for k, t in lows.items() for ws in [re.findall(r"[^\W_]+", t)] for w in set(ws))
    mean, got = 3.0, []
    for r in hybrid.blocks(docs.select("key", hybrid.lowered(F.col("text")).alias("text")), mean, size).collect():
        assert r.n == len(r["keys"]) == len(r.ends) == len(r.lengths) and r.ends[-1] == len(r.positions)
        begins = [0, *r.ends[:-1]]
        impacts = [hybrid.impact_of(e - b, n, mean) for b, e, n in zip(begins, r.ends, r.lengths)]
        assert r.top == max(impacts) and {min(int(x / (hybrid.K1 + 1) * hybrid.TIERS), hybrid.TIERS - 1) for x in impacts} == {r.tier}
        got += [(r.term, k, r.positions[b:e], n) for k, b, e, n in zip(r["keys"], begins, r.ends, r.lengths)]
    assert sorted(got) == want
    assert docs.select(F.sum(hybrid.n_words(hybrid.lowered(F.col("text"))))).first()[0] == sum(len(x[2]) for x in want)


def test_a_unit_vector_takes_its_norm_once(spark):
    table = spark.createDataFrame([(0, [3.0, 4.0]), (1, [0.0, 0.0]), (2, None), (3, [])], "i long, a array<float>").select("i", vectors.unit(F.col("a")).alias("u"))
    assert {r.i: r.u for r in table.collect()} == {0: [0.6, 0.8], 1: [0.0, 0.0], 2: None, 3: []}
    assert table._jdf.queryExecution().analyzed().toString().lower().count("sqrt(") == 1


#: Texts, and the keywords that the SQL of conv_keywords gives in DuckDB 2.0.0.
KEYWORDS = [
    (None, ""), ("", ""), (" \n\t", ""), ("...\n", ""), ("The (Module), and\nmore", "module,module"), ("\xa0\nMore go", "go"), ("\x0bAbc\x0b\nx", "\x0babc\x0b"), ("abc\u3000 \r\nx", "abc\u3000"),
    ("İnterface İii", "interface,iii,interface"), ("x\nİNTERFACE", "interface"), ("ΟΔΟΣ endΣ", "οδοσ,endσ"), ("End\ua7cb End\U00010d50", "end\ua7cb,end\U00010d50"),
]


def test_keywords_are_those_of_the_sql(spark, tmp_path):
    docs = spark.createDataFrame([(i, x, "en", "s", 1) for i, (x, _) in enumerate(KEYWORDS)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (4, 1, 0), (4, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want = sorted((str(i), k) for i, (_, k) in enumerate(KEYWORDS) for _ in range(2 if i == 4 else 1))
    with duckdb.connect() as db:
        for name in ("documents", "labels"):
            db.execute(f"CREATE VIEW {name} AS FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
        assert sorted(db.execute(q_operators.ORACLES["conv_keywords"]).fetchall()) == want
    assert sorted(tuple(r) for r in q_operators.conv_keywords(spark, str(tmp_path)).collect()) == want


def test_keywords_join_labels_without_texts(spark, tmp_path):
    text = "".join(chr(0x4E00 + i * 7919 % 20_000) for i in range(20_000))
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("Title go\n"), F.col("id").cast("string"), F.lit(text)).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(40).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")
    joined = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffled(spark)
        assert {r.keywords for r in q_operators.conv_keywords(spark, str(tmp_path)).collect()} == {"title,go"}
        once = shuffled(spark) - before
        fixture.texts(spark, str(tmp_path)).foreach(lambda r: None)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joined)
    assert once < 1.2 * (shuffled(spark) - before - once)
