"""Texts over all cores: a file of one row group is one task, however long its rows take."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

#: Bytes of files a task gets at most, and tasks a core at least: files may hold many times their size in texts.
PER_TASK, PER_CORE = 8 << 20, 4
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """`df` dealt out by a hash of its columns before work on its texts, whatever its files and row groups are.

    The number of tasks grows with the optimiser's estimate, which is from file sizes: nothing runs. Rows are dealt by hash, as
    dealing them in turn would sort them first.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(cores * PER_CORE, math.ceil(size / PER_TASK)), *df.columns)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most `BATCH_ROWS` rows and `BATCH_BYTES`, or one longer row; a session that asks for smaller ones keeps them.

    Spark's default of 10,000 whole texts is held several times over by each Python worker. The settings change no result.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = str(spark.conf.get(key)).removesuffix("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, str(most))
