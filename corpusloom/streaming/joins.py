"""Two streams joined within an interval, and the statistics of keys that go when a key has been idle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def within(left: DataFrame, right: DataFrame, key: str, before: str, late: str = "2 days", how: str = "inner") -> DataFrame:
    """Each left row with the right rows of its key in the interval `before` it, its own time included; how: inner or left.

    Both have columns `key` and `ts` (a timestamp); the right's come back as right_<name>. Watermarks on both sides and the
    interval bound the state of either: a row goes when no partner can come any more, and then a left row without one comes out. Rows
    later than `late` are dropped.
    """
    l = left.withWatermark("ts", late)
    r = right.select(*[F.col(c).alias(f"right_{c}") for c in right.columns]).withWatermark("right_ts", late)
    near = (l[key] == r[f"right_{key}"]) & (r["right_ts"] <= l["ts"]) & (r["right_ts"] >= l["ts"] - F.expr(f"INTERVAL {before}"))
    return l.join(r, near, "left_outer" if how == "left" else "inner")


class Activity(StatefulProcessor):
    """A key's periods of activity: requests, failures and kinds until `idle_s` pass without a request; then they come out and are forgotten.

    State: the sums of the periods still open, in order of time, the counts by kind of each, and one timer at the end of the first. A call
    reads and writes state a fixed number of times, however many requests it brings: each Arrow batch is cut into periods, and
    those meet the open ones. A period ends by the watermark alone, so periods depend neither on batches nor on the order of arrival.
    """

    def __init__(self, idle_s: float, kind: T.DataType):
        self.idle_ms, self.kind = int(idle_s * 1000), kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "n array<long>, failed array<long>, first array<long>, last array<long>")
        self.kinds = handle.getValueState("kinds", "kinds array<map<string,long>>")

    def _periods(self) -> list[list]:
        """The open periods: [n, failed, first, last, counts by kind]."""
        if not self.sums.exists():
            return []
        return [[*one, dict(kinds)] for *one, kinds in zip(*self.sums.get(), self.kinds.get()[0])]

    def _ends(self, period: list) -> int:
        return period[3] // 1000 + self.idle_ms

    def _keep(self, periods: list[list]) -> None:
        if periods:
            self.sums.update(tuple([p[i] for p in periods] for i in range(4)))
            self.kinds.update(([p[4] for p in periods],))
            self.handle.registerTimer(self._ends(periods[0]))
        else:
            self.sums.clear()
            self.kinds.clear()

    def _cut(self, pdf: pd.DataFrame) -> list[list]:
        """The periods of a batch's rows alone."""
        us = pdf["us"].to_numpy(np.int64)
        order = np.argsort(us, kind="stable")
        us, failed, (codes, names) = us[order], pdf["failed"].to_numpy(bool)[order], pd.factorize(pdf["kind"].to_numpy()[order])
        starts = np.concatenate([[0], np.flatnonzero(np.diff(us) > self.idle_ms * 1000) + 1])
        stops = np.append(starts[1:], len(us))
        out = []
        for a, b in zip(starts.tolist(), stops.tolist()):
            kind, n = np.unique(codes[a:b], return_counts=True)
            out.append([b - a, int(failed[a:b].sum()), int(us[a]), int(us[b - 1]), {names[k]: c for k, c in zip(kind.tolist(), n.tolist())}])
        return out

    def _joined(self, periods: list[list]) -> list[list]:
        """Periods in order of time, those joined that no idle time lies between."""
        out: list[list] = []
        for p in sorted(periods, key=lambda x: x[2]):
            if out and p[2] <= out[-1][3] + self.idle_ms * 1000:
                q = out[-1]
                q[0], q[1], q[3] = q[0] + p[0], q[1] + p[1], max(q[3], p[3])
                for k, n in p[4].items():
                    q[4][k] = q[4].get(k, 0) + n
            else:
                out.append(p)
        return out

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        periods = self._periods()
        before = self._ends(periods[0]) if periods else None
        for pdf in rows:  # one Arrow batch at a time
            if len(pdf):
                periods = self._joined(periods + self._cut(pdf))
        if before is not None and before != self._ends(periods[0]):
            self.handle.deleteTimer(before)
        self._keep(periods)
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        past = max(expiredTimerInfo.getExpiryTimeInMs() + 1, timerValues.getCurrentWatermarkInMs())
        periods = self._periods()
        over = [p for p in periods if self._ends(p) < past]
        self._keep(periods[len(over) :])
        if over:
            n, failed, first, last, kinds = zip(*over)
            yield pd.DataFrame({
                "key": [key[0]] * len(over), "requests": n, "failed": failed, "first_us": first, "last_us": last,
                "kinds": [",".join(f"{k}={x[k]}" for k in sorted(x)) for x in kinds],
            })

    def close(self) -> None:
        pass


def activity(requests: DataFrame, idle_s: float, late: str = "2 days") -> DataFrame:
    """key, requests, failed, first_us, last_us and kinds of each period of activity of a stream (key, ts, kind, failed)."""
    spark: SparkSession = requests.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKS:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    kind = requests.schema["key"].dataType
    out = T.StructType([
        T.StructField("key", kind), *[T.StructField(c, T.LongType()) for c in ("requests", "failed", "first_us", "last_us")], T.StructField("kinds", T.StringType()),
    ])
    rows = requests.select("key", "ts", F.unix_micros("ts").alias("us"), F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("failed", F.lit(False)).alias("failed")).withWatermark("ts", late)
    return rows.groupBy("key").transformWithStateInPandas(Activity(idle_s, kind), out, "append", "eventtime")


def activity_of_kinds(requests: DataFrame, kinds: list[str], idle_s: int, late: str = "2 days") -> DataFrame:
    """The same rows for kinds known beforehand, as session windows: sums of fixed size that the engine keeps and joins itself.

    `activity` calls Python for every key of a batch, here no row leaves the engine. A request without a key or time has no period; one
    without a kind counts in `requests` alone.
    """
    rows = requests.where(F.col("key").isNotNull()).select("key", "ts", F.unix_micros("ts").alias("us"), "kind", F.coalesce("failed", F.lit(False)).alias("failed")).withWatermark("ts", late)
    counts = [F.count_if(F.col("kind") == k).alias(f"kind_{i}") for i, k in enumerate(kinds)]
    sums = rows.groupBy(F.session_window("ts", f"{idle_s} seconds"), "key").agg(F.count("*").alias("requests"), F.count_if("failed").alias("failed"), F.min("us").alias("first_us"), F.max("us").alias("last_us"), *counts)
    said = [F.when(F.col(f"kind_{i}") > 0, F.concat(F.lit(f"{k}="), F.col(f"kind_{i}").cast("string"))) for i, k in sorted(enumerate(kinds), key=lambda x: x[1])]
    return sums.select("key", "requests", "failed", "first_us", "last_us", F.nullif(F.concat_ws(",", *said), F.lit("")).alias("kinds"))
