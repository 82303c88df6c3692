"""Streams: joins within an interval, idle keys, cleaning on arrival, restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.streaming import events, joins

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def files(spark, folder, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in/{i:03d}")
    return spark.readStream.schema(spark.read.parquet(f"{folder}/in/*").schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{folder}/in")


@pytest.fixture(scope="module")
def two(spark, tmp_path_factory):
    rng = random.Random(9)
    schema = "key string, ts timestamp, n int"
    left = [(rng.choice("abc"), at(10 * i + rng.randint(0, 30)), i) for i in range(90)]
    right = [(rng.choice("abcd"), at(10 * i + rng.randint(0, 30)), 1000 + i) for i in range(90)]
    end = at(60 * 24 * 30)
    batches = lambda rows: [rows[i : i + 30] for i in range(0, 90, 30)] + [[("z", end, -1)], [("z", end + dt.timedelta(days=9), -2)]]
    streams = [files(spark, str(tmp_path_factory.mktemp(n)), batches(rows), schema) for n, rows in (("l", left), ("r", right))]
    return streams, left, right


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_equals_a_batch_join(spark, two, how):
    (l, r), left, right = two
    got = events.to_table(joins.within(l, r, "key", "1 hour", late="1 hour", how=how).select("n", "right_n"), f"join_{how}")
    want = [(a[2], b[2]) for a in left for b in right if a[0] == b[0] and a[1] - dt.timedelta(hours=1) <= b[1] <= a[1]]
    if how == "left":
        want += [(a[2], None) for a in left if a[2] not in {n for n, _ in want}]
    found = [(x.n, x.right_n) for x in got.where("n >= 0").collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_late_rows_of_a_join_are_dropped(spark, tmp_path):
    schema = "key string, ts timestamp, n int"
    l = files(spark, str(tmp_path / "l"), [[("a", at(0), 1)], [("a", at(6000), 2)], [("a", at(6001), 4)], [("a", at(1), 3)]], schema)
    r = files(spark, str(tmp_path / "r"), [[("a", at(0), 10)], [("a", at(6000), 20)], [("a", at(6001), 40)], [("a", at(6002), 50)]], schema)
    got = {(x.n, x.right_n) for x in events.to_table(joins.within(l, r, "key", "10 minutes", late="30 minutes"), "late").collect()}
    assert got == {(1, 10), (2, 20), (4, 20), (4, 40)}  # 3 came days behind the watermark


def periods(rows, idle):
    out, by = [], {}
    for key, ts, kind, failed in sorted(rows, key=lambda r: (r[0], r[1])):
        by.setdefault(key, []).append((ts, kind, failed))
    for key, mine in by.items():
        run = [mine[0]]
        for x in mine[1:] + [None]:
            if x is None or x[0] > run[-1][0] + dt.timedelta(seconds=idle):
                kinds = {}
                for _, k, _ in run:
                    kinds[k or ""] = kinds.get(k or "", 0) + 1
                out.append((key, len(run), sum(bool(f) for *_, f in run), run[0][0], run[-1][0], ",".join(f"{k}={kinds[k]}" for k in sorted(kinds))))
                run = []
            run.append(x)
    return sorted(map(repr, out))


def test_idle_keys_come_out_and_leave_no_state(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), at(5 * i), rng.choice(["x", "y", None]), rng.choice([True, False, None])) for i in range(60)]
    far = [("z", at(60 * 24 * 90), "x", False)]
    stream = files(spark, str(tmp_path), [rows[:20], rows[20:40], rows[40:], far, [("z", at(60 * 24 * 90 + 1), "x", False)]], "key string, ts timestamp, kind string, failed boolean")
    progress = str(tmp_path / "progress")
    events.run_to_end(joins.activity(stream, idle_s=900, late="10 minutes"), events.batch_files(str(tmp_path / "out")), progress)
    got = spark.read.parquet(str(tmp_path / "out")).where("key <> 'z'").select("key", "requests", "failed", F.timestamp_micros("first_us"), F.timestamp_micros("last_us"), "kinds").collect()
    assert sorted(repr(tuple(r)) for r in got) == periods(rows, 900)
    for name in ("sums", "kinds"):
        state = spark.read.format("statestore").option("stateVarName", name).load(progress)
        assert {r.key[0] for r in state.select("key").collect()} == {"z"}


def test_cleaning_on_arrival_resumes_and_reports_failures(spark, tmp_path):
    schema = "id int, text string"
    src = str(tmp_path / "src")
    spark.createDataFrame([(1, "a  b"), (2, None)], schema).write.parquet(src)
    stream = lambda: spark.readStream.schema(schema).parquet(src)

    def run():
        events.clean_on_arrival(stream(), str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
        return {(r.id, r.cleaned, r.event_type, r.error) for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    first = run()
    assert first == {(1, "a b", "document.cleaned", None), (2, "", "document.failed", "no text to clean")} == run()
    spark.createDataFrame([(3, "c\tc")], schema).write.mode("append").parquet(src)
    assert run() == first | {(3, "c c", "document.cleaned", None)}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_token_bucket_keeps_parts_of_a_refill(spark, tmp_path):
    times = [0, 0.1, 1.9, 2.0, 2.1, 10, 10.1]
    stream = files(spark, str(tmp_path), [[("k", T0 + dt.timedelta(seconds=s), i) for i, s in enumerate(times)]], "key string, ts timestamp, order int")
    got = {r.order: r.granted for r in events.to_table(events.token_bucket(stream.withColumn("order", F.col("order").cast("long")), 1, 1.0), "bucket").collect()}
    assert got == {0: True, 1: False, 2: True, 3: True, 4: False, 5: True, 6: False}


def test_two_runs_of_one_name_do_not_meet(spark, tmp_path):
    rows = [[("a", at(1), 1), ("b", at(2), 2)]]
    stream = files(spark, str(tmp_path), rows, "key string, ts timestamp, n int")
    count = lambda: {(r.key, r.n) for r in events.to_table(stream.groupBy("key").agg(F.count("*").alias("n")), "same", "complete").collect()}
    assert count() == {("a", 1), ("b", 1)} == count()
