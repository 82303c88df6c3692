"""Event streams: typed subscriptions, windows, deduplication, an adaptive limiter, and cleaning on arrival."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusloom.functions.cleaning import Cleaner
from corpusloom.sources.scratch import new_path, shared_dir


def source(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """A Parquet folder or file as a stream; a bounded number of files a trigger is the back-pressure, nothing is dropped."""
    schema = spark.read.parquet(path).schema
    where, _, name = path.rstrip("/").rpartition("/")
    if spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)).isDirectory():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", name).parquet(where)


def subscribe(events: DataFrame, *types: str) -> DataFrame:
    """Events of the given types; of all types where none is given."""
    return events.where(F.col("event_type").isin(*types)) if types else events


def timed(events: DataFrame) -> DataFrame:
    """With `ts` as a timestamp that watermarks accept."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_counts(events: DataFrame, window: str = "1 day", late: str = "2 days", slide: str | None = None) -> DataFrame:
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    return timed(events).withWatermark("ts", late).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "2 days") -> DataFrame:
    return timed(events).withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def deduplicated(events: DataFrame, keys: list[str], late: str = "2 days") -> DataFrame:
    return timed(events).withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def adaptive_delays(requests: DataFrame, first: float = 1.0, low: float = 0.1, high: float = 60.0, backoff_high: float = 30.0) -> DataFrame:
    """key, requests seen and current delay of each key of a stream (key, ts, order, ok, limited), as state.

    A limited request doubles the delay, up to 30 s; after ten requests a success lowers it by a sixth if of the last twenty
    over 90 % succeeded and under 10 % were limited. State is the delay, the count and the last twenty outcomes.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, delay, past = state.get if state.exists else (0, first, "")
        rows = pd.concat(list(batches)).sort_values(["ts", "order"])
        for ok, limited in zip(rows["ok"], rows["limited"]):
            seen += 1
            past = (past + ("L" if limited else "s" if ok else "f"))[-20:]
            if limited:
                delay = min(delay * 2, backoff_high)
            elif ok and seen >= 10 and past.count("s") / len(past) > 0.9 and past.count("L") / len(past) < 0.1:
                delay = max(delay / 1.2, low)
            delay = min(max(delay, low), high)
        state.update((seen, delay, past))
        yield pd.DataFrame({"key": [key[0]], "seen": [seen], "delay": [delay]})

    return requests.groupBy("key").applyInPandasWithState(step, "key string, seen long, delay double", "seen long, delay double, past string", "update", GroupStateTimeout.NoTimeout)


def checkpoint(spark: SparkSession, name: str) -> str:
    """The folder of a named stream's progress: the same name goes on where an earlier run stopped."""
    return f"{shared_dir(spark)}/streams/{name}"


def run_to_end(stream: DataFrame, sink: Callable[[DataFrame, int], None], progress: str, mode: str = "append") -> StreamingQuery:
    """Hands what is there now to `sink`, batch by batch, and waits; `progress` is the checkpoint, so a later call goes on after it."""
    query = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", progress).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def batch_files(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch as Parquet under its number, so a batch that runs again replaces itself."""
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")


def to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there now, from the beginning, and returns its rows; for bounded runs and checks.

    Batches are Parquet files in the shared folder. In complete mode the last batch is the result.
    """
    spark = stream.sparkSession
    path = new_path(spark, f"stream-{name}")
    run_to_end(stream, batch_files(f"{path}/rows"), f"{path}/progress", mode)
    rows = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])).option("recursiveFileLookup", "false").parquet(f"{path}/rows")
    if mode == "complete":
        rows = rows.join(rows.agg(F.max("batch").alias("batch")), "batch")
    return rows.select(*stream.columns)


def clean_on_arrival(docs: DataFrame, path: str, progress: str, cleaner: Cleaner | None = None, kind: str = "text", text: str = "text", trigger: dict | None = None) -> StreamingQuery:
    """Cleans documents as they are added: rows with event_type document.cleaned, or document.failed with an error, as Parquet by batch.

    A text that is null cannot be cleaned and fails; an error of a whole batch stops the stream, which goes on from `progress`. A batch
    that runs again replaces its files, so nothing is lost or written twice.
    """
    sink = batch_files(path)

    def each(batch: DataFrame, number: int) -> None:
        missing = F.col(text).isNull()
        cleaned = (cleaner or Cleaner()).apply(batch, text=text, kind=kind)
        sink(cleaned.withColumns({"event_type": F.when(missing, "document.failed").otherwise("document.cleaned"), "error": F.when(missing, "no text to clean")}), number)

    return docs.writeStream.foreachBatch(each).option("checkpointLocation", progress).trigger(**(trigger or {"availableNow": True})).start()


def token_bucket(requests: DataFrame, capacity: int = 10, refill_s: float = 1.0) -> DataFrame:
    """order, key, granted of a stream (key, ts, order): each key's bucket refills one token per whole `refill_s` passed.

    Time that does not fill a whole token is kept: the mark moves on by whole refills. State is the number of tokens and the mark.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(["ts", "order"])
        tokens, mark = state.get if state.exists else (capacity, rows["ts"].iloc[0].timestamp())
        granted = []
        for ts in rows["ts"]:
            passed = ts.timestamp() - mark
            if passed >= refill_s:
                tokens, mark = min(capacity, tokens + int(passed // refill_s)), mark + passed // refill_s * refill_s
            granted.append(tokens > 0)
            tokens -= tokens > 0
        state.update((tokens, mark))
        yield pd.DataFrame({"order": rows["order"], "key": key[0], "granted": granted})

    return requests.groupBy("key").applyInPandasWithState(step, "order long, key string, granted boolean", "tokens long, mark double", "append", GroupStateTimeout.NoTimeout)
