"""The versioned library and its data source."""

import datetime as dt
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import datasource as ds
from corpusloom.sources import versioned as vs

AT = dt.datetime(2024, 3, 5, 6)
SCHEMA = "id string, source_type string, url string, path string, text string, metadata map<string,string>, created_at timestamp"


def docs(spark, *rows):
    return spark.createDataFrame([(i, "web", f"https://x.org/{i}", None, t, {"k": t}, AT) for i, t in rows], SCHEMA)


def texts(df):
    return {r.id: r.text for r in df.collect()}


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "lib")
    assert vs.commit(docs(spark, ("a", "1"), ("b", "1"), ("c", "1")).repartition(2), path, "first, collected by the Library", "ann") == 1
    assert vs.commit(docs(spark, ("b", "2"), ("d", "2")), path, "second", "bob") == 2
    assert vs.remove(docs(spark, ("a", "")), path, "third") == 3
    assert vs.commit(docs(spark, ("a", "4")), path) == 4
    return path


def test_states_equal_a_replay(spark, store):
    want, replayed = [{"a": "1", "b": "1", "c": "1"}, {"a": "1", "b": "2", "c": "1", "d": "2"}, {"b": "2", "c": "1", "d": "2"}, {"a": "4", "b": "2", "c": "1", "d": "2"}], {}
    for version, state in enumerate(want, 1):
        for r in spark.read.format("library").load(store).where(F.col("version") == version).collect():
            replayed.pop(r.id, None) if r.deleted else replayed.update({r.id: r.text})
        assert texts(vs.state(spark, store, version)) == state == replayed
    assert texts(vs.state(spark, store)) == want[-1]
    assert [r.text for r in vs.history(spark, store, "a").collect()] == ["1", None, "4"]


def test_log_as_a_table(spark, store):
    vs.log(spark, store).createOrReplaceTempView("commits")
    got = spark.sql("SELECT version, parent, message, author, rows FROM commits ORDER BY version").collect()
    assert [tuple(r) for r in got] == [(1, 0, "first, collected by the Library", "ann", 3), (2, 1, "second", "bob", 2), (3, 2, "third", "", 1), (4, 3, "", "", 1)]
    assert [r.version for r in vs.attribution(vs.log(spark, store), "COLLECTED BY").collect()] == [1]


def test_invalid_rows_stay_out(spark, tmp_path):
    bad = spark.createDataFrame([("", "web", "u", "x"), ("ok", None, "u", "x"), ("ok", "web", None, "x"), ("fine", "web", "u", "x")], "id string, source_type string, url string, text string")
    vs.commit(bad.withColumn("extra", F.lit(1)), str(tmp_path))
    assert texts(vs.state(spark, str(tmp_path))) == {"fine": "x"}


def test_of_two_writers_one_wins(spark, store):
    results = []

    def write(name):
        try:
            results.append(vs.commit(docs(spark, (name, "x")), store, name, parent=4))
        except Exception as error:
            results.append("conflict" if "is there already" in str(error) else repr(error))

    both = [threading.Thread(target=write, args=(n,)) for n in ("left", "right")]
    [t.start() for t in both]
    [t.join() for t in both]
    assert sorted(map(str, results)) == ["5", "conflict"]
    state = texts(vs.state(spark, store))
    assert ("left" in state) != ("right" in state)
    assert vs.unreferenced(store) == []  # the loser's files are gone
    assert vs.commit(docs(spark, ("late", "x")), store, parent=4, retry=True) == 6


def test_failed_task_leaves_no_rows(spark, store):
    @F.udf("string")
    def fail(i):
        raise ValueError("no") if i == "z" else None

    with pytest.raises(Exception):
        vs.commit(docs(spark, ("y", "1"), ("z", "1")).withColumn("text", fail("id")), store)
    assert ds.latest(store) == 4 and "y" not in texts(vs.state(spark, store))


def test_filters_prune_files(spark, store):
    ds.register(spark)
    pushing = spark.read.format("library").option("pushdown", "true")
    chosen, whole = pushing.load(store).where("id = 'd'"), pushing.load(store)
    plan = spark._jvm.PythonSQLUtils.explainString(chosen._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [EqualTo(id,d)]" in plan
    assert chosen.rdd.getNumPartitions() == 1 < whole.rdd.getNumPartitions()
    assert texts(pushing.load(store).where("id IN ('d', 'c')")) == {"c": "1", "d": "2"} and texts(chosen) == {"d": "2"}
    plain = spark.read.format("library").load(store)  # without the option a DataFrame can be used with and without a filter
    assert (plain.where("id = 'd'").count(), plain.count(), plain.where("id = 'c'").count()) == (1, 7, 1)
    assert texts(spark.read.format("library").option("version", 1).load(store).where("id = 'b'")) == {"b": "1"}
    pushed = vs.rows(spark, store).where("id = 'd'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,d)" in pushed


def test_streams_resume_and_write_once(spark, store, tmp_path):
    copy, mark = str(tmp_path / "copy"), str(tmp_path / "mark")

    def run():
        q = vs.added(spark, store).select(F.col("id"), "source_type", "url", "path", "text", "metadata", "created_at", "deleted").writeStream.format("library").option("query", "q1")
        q = q.option("checkpointLocation", mark).option("path", copy).trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    assert texts(vs.state(spark, copy))  # all versions came in one batch; removals and documents of one id are told apart by version in the source
    first = ds.latest(copy)
    run()
    assert ds.latest(copy) == first
    vs.commit(docs(spark, ("new", "5")), store)
    run()
    assert ds.latest(copy) == first + 1 and texts(vs.state(spark, copy))["new"] == "5"
    # a batch that was committed, but whose end was lost, is not written twice
    for name in sorted(os.listdir(f"{mark}/commits")):
        if not name.startswith("."):
            last = name
    os.remove(f"{mark}/commits/{last}")
    os.remove(f"{mark}/commits/.{last}.crc")
    run()
    assert ds.latest(copy) == first + 1 and vs.unreferenced(copy) == []


def test_mirror_replays_commits(spark, store, tmp_path):
    copy = str(tmp_path / "mirror")
    assert vs.mirror(spark, store, copy) == 4 == vs.mirror(spark, store, copy)
    assert [json.dumps(c, sort_keys=True) for c in ds.commits(copy)] == [json.dumps(c, sort_keys=True) for c in ds.commits(store)]
    vs.commit(docs(spark, ("m", "1")), store)
    both = vs.merged(vs.state(spark, copy), vs.state(spark, store))
    assert texts(both)["m"] == "1" and both.count() == 5
    assert vs.mirror(spark, store, copy) == 5 and texts(vs.state(spark, copy)) == texts(vs.state(spark, store))


def test_index(spark, store):
    got = {r.id: (r.file_path, r.type, r.year, r.month) for r in vs.index(spark, store).collect()}
    assert got["d"] == ("documents/web/2024/03/d", "web", 2024, 3) and set(got) == {"a", "b", "c", "d"}
    paths = spark.createDataFrame([("documents/web/2024/03/d/metadata.json",), ("documents/web/2024/03/d/text.txt",), ("documents/ab/cd/abcd9/text.txt",), ("other/x/y.txt",), ("documents",)], "path string")
    rebuilt = {r.id: (r.file_path, r.type, r.year, r.month) for r in vs.index_of_paths(paths).collect()}
    assert rebuilt == {"d": ("documents/web/2024/03/d", "web", 2024, 3), "abcd9": ("documents/ab/cd/abcd9", None, None, None)}


def test_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    assert vs.commit(spark.createDataFrame([], SCHEMA), path) == 1
    assert vs.state(spark, path).count() == 0 and vs.index(spark, path).count() == 0
