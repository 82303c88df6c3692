"""Tables that a job writes for itself: in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset and all run on one machine, a temporary folder of the session."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = spark.conf.get("corpusloom.shared", None)
    if own is None:
        own = f"file://{tempfile.mkdtemp(prefix='corpusloom-')}"
        spark.conf.set("corpusloom.shared", own)
    return own


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _quietly(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the session may be gone at exit
        pass


def new_path(spark: SparkSession, tag: str) -> str:
    """A folder name that nobody else has; what is there goes when the driver's Python ends."""
    path = f"{shared_dir(spark)}/corpusloom-{tag}-{uuid.uuid4().hex}"
    atexit.register(_quietly, spark, path)
    return path


def written(df: DataFrame, tag: str) -> DataFrame:
    """`df` as a Parquet table: read again without working it out again, also after executors are lost."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
