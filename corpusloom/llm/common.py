"""Helpers shared by the training-data operators: Arrow scans, shared tables, partition sums."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
#: Partitions whose vectors are added up in one task before all are.
FAN = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % k


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where both are one process."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = spark.conf.get("corpusloom.scratch", None)
    if own is None:
        own = f"file://{tempfile.mkdtemp(prefix='corpusloom-')}"
        spark.conf.set("corpusloom.scratch", own)
    return own


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most `BATCH_ROWS` rows and `BATCH_BYTES`, or one longer row, for what runs from here on.

    Spark's default of 10,000 whole texts a batch is tens of MB in the JVM and again in each Python worker. A session that
    asks for smaller batches keeps them. The settings are read when a plan runs, after an operator has returned, so they
    stay set; they change no result.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = str(spark.conf.get(key)).removesuffix("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, str(most))


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone at exit; the folder is scratch space
        pass


def written(df: DataFrame, tag: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: cuts lineage and survives lost executors.

    The table is deleted when the driver's Python ends.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = f"{shared_dir(spark).rstrip('/')}/corpusloom-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_scan(
    df: DataFrame, text: str | Column, carry: dict[str, Column], results: T.StructType, fn: Callable[[pa.Array], list[pa.Array]], limit: int = 1 << 20
) -> DataFrame:
    """One result row per row of `df`: columns `row` (a struct of `carry`) and `res` (a struct of `results`).

    `fn` gets the text column of an Arrow batch (nulls already empty) and returns one array per field.
    It is called with at most `limit` bytes of text at a time (or one longer text), which bounds a worker's memory.
    The two structs keep extra columns apart from results, so clashing names cannot collide.
    """
    bounded_batches(df.sparkSession)
    src = df.select(
        F.struct(*[c.alias(n) for n, c in carry.items()]).alias("row"),
        F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).alias("text"),
    )
    schema = T.StructType([T.StructField("row", src.schema["row"].dataType), T.StructField("res", results)])
    names = results.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in pieces(batch, limit):
                    arrays = fn(part.column(1))
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.StructArray.from_arrays(arrays, names)], ["row", "res"])
        finally:
            _give_back()

    return src.mapInArrow(run, schema)


def _give_back() -> None:
    """Returns freed memory to the system: a worker is used again, and what one step needed would stand beside the next step's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def pieces(batch: pa.RecordBatch, limit: int = 1 << 20, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most `limit` text bytes each, or one row where that alone is longer."""
    ends = string_offsets(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def string_offsets(arr: pa.Array) -> np.ndarray:
    """Byte offsets of a string array's rows, as int64, one more than rows."""
    wide = pa.types.is_large_string(arr.type)
    kind = np.int64 if wide else np.int32
    return np.frombuffer(arr.buffers()[1], kind, len(arr) + 1 + arr.offset)[arr.offset :].astype(np.int64) if len(arr) else np.zeros(1, np.int64)


def summed_by_key(df: DataFrame, dtype: str, add_up: np.ufunc = np.add) -> dict[int, np.ndarray]:
    """Sums (or another reduction) of vectors `vec` (binary of `dtype`) by `slot`, as a tree: `FAN` partitions, then all.

    `df` has columns slot int, vec binary; its slots are a fixed number. A vector's place in the tree follows from the
    partition it came from, so a task that runs again deals it to the same place. Vectors are added one batch at a time.
    """
    bounded_batches(df.sparkSession)

    def add(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in groups:
            for slot, vec in zip(pdf["slot"], pdf["vec"]):
                v = np.frombuffer(vec, dtype)
                if slot in sums:
                    add_up(sums[slot], v, out=sums[slot])
                else:
                    sums[slot] = v.copy()
        if sums:
            yield pd.DataFrame({"slot": list(sums), "vec": [v.tobytes() for v in sums.values()]})

    schema = "slot int, vec binary"
    near = df.withColumn("near", F.floor(F.spark_partition_id() / FAN)).repartition("slot", "near").select("slot", "vec").mapInPandas(add, schema)
    return {r.slot: np.frombuffer(r.vec, dtype) for r in near.repartition("slot").mapInPandas(add, schema).collect()}


def matrix_rows(m: np.ndarray, rows_per_slot: int) -> pd.DataFrame:
    """A matrix cut into slots of whole rows, for `summed_by_key`."""
    slots = range(0, len(m), rows_per_slot)
    return pd.DataFrame({"slot": np.arange(len(slots), dtype=np.int32), "vec": [m[s : s + rows_per_slot].tobytes() for s in slots]})


def stacked(slots: dict[int, np.ndarray], shape: tuple[int, ...], dtype: str) -> np.ndarray:
    """The matrix that `matrix_rows` cut; where no partition sent a row, zeros, and none along an open dimension."""
    if not slots:
        return np.zeros([max(n, 0) for n in shape], dtype)
    return np.concatenate([slots[k] for k in sorted(slots)]).reshape(shape)
