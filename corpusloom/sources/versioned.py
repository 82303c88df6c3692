"""The versioned library: commits, states as of a commit, its log as a table, index, mirrors and attribution.

Rows live in `datasource`'s layout. A commit appends documents or marks of removal; a state is the latest row of every id up to a
version. Files are found by the log and read by Spark's own Parquet reader, so columns are pruned and filters pushed; which row of an
id is the latest is decided on ids and positions alone, and the texts are read once.
"""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.sources import datasource as ds
from corpusloom.sources import library

FILES = "name string, rows long, least string, most string"
LOG = f"version long, parent long, message string, author string, at timestamp, batch string, rows long, files array<struct<{FILES}>>"


def problem() -> Column:
    """Why a row is not a valid document; removals need an id only."""
    why = library.problem(F.col("id"), F.col("source_type"), F.col("url"), F.col("path"))
    return F.when(F.coalesce("deleted", F.lit(False)), F.when(library.blank(F.col("id")), "document ID is required")).otherwise(why)


def commit(docs: DataFrame, path: str, message: str = "", author: str = "", parent: int | None = None, retry: bool = False) -> int:
    """Appends the valid rows of `docs` (missing columns are null) as one commit and returns its version.

    Fails with a conflict where another commit follows `parent` already (None: the latest when the write begins), unless `retry`.
    Of several rows with one id in a commit the last one written counts.
    """
    ds.register(docs.sparkSession)
    schema = T._parse_datatype_string(ds.COLUMNS)
    whole = docs.select(*[(F.col(f.name) if f.name in docs.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    options = {"path": path, "message": message, "author": author, "retry": str(retry).lower()} | ({} if parent is None else {"parent": str(parent)})
    whole.where(problem().isNull()).write.format("library").options(**options).mode("append").save()
    return ds.latest(path)


def remove(ids: DataFrame, path: str, message: str = "", author: str = "", retry: bool = False) -> int:
    """Commits marks that the documents of these ids (column id) are gone."""
    return commit(ids.select(F.col("id"), F.lit(True).alias("deleted")), path, message, author, retry=retry)


def log(spark: SparkSession, path: str) -> DataFrame:
    """The commits as a table."""
    return spark.read.schema(LOG).option("multiLine", True).json(f"{path.rstrip('/')}/log/*.json")


def rows(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All rows of commits up to a version, with version, and file and position, which together order the rows of a commit."""
    entries = ds.commits(path, upto=version)
    names = [f"{path.rstrip('/')}/data/{f['name']}" for c in entries for f in c["files"]]
    of = log(spark, path).select("version", F.explode("files.name").alias("file"))
    schema = T._parse_datatype_string(ds.COLUMNS)
    found = spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema).withColumn("_metadata", F.struct(F.lit("").alias("file_name"), F.lit(0).cast("long").alias("row_index")))
    return found.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("position")).join(of, "file")


def state(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The documents as of a version: the latest row of each id, without removed ones."""
    every = rows(spark, path, version)
    place = F.struct("version", "file", "position")
    last = every.groupBy("id").agg(F.max(place).alias("p"), F.max_by(F.coalesce("deleted", F.lit(False)), place).alias("gone")).where(~F.col("gone")).select("id", "p.*")
    return every.join(last, ["id", "version", "file", "position"], "left_semi").drop("file", "position", "deleted")


def history(spark: SparkSession, path: str, ident: str) -> DataFrame:
    """All versions of one document."""
    return rows(spark, path).where(F.col("id") == ident).orderBy("version", "file", "position").drop("file", "position")


def id_of(path: Column) -> Column:
    """A document's id from the path of one of its files: the name of the folder that holds it."""
    return F.nullif(F.get(F.split(path, "/"), F.size(F.split(path, "/")) - 2), F.lit(""))


def index(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """id, file path, type, year and month of every document of a state: what an index has when it is built anew."""
    at = F.col("created_at")
    where = library.dated_path(F.col("source_type"), at, F.col("id"))
    return state(spark, path, version).select("id", where.alias("file_path"), F.col("source_type").alias("type"), F.year(at).alias("year"), F.month(at).alias("month"), "version")


def index_of_paths(paths: DataFrame, column: str = "path") -> DataFrame:
    """An index rebuilt from file paths alone, one row an id: documents/<type>/<year>/<month>/<id>/<file>, or by hash without type and month."""
    parts = F.split(F.col(column), "/")
    dated = F.size(parts) == 6
    one = paths.where(F.startswith(F.col(column), F.lit("documents/"))).select(
        id_of(F.col(column)).alias("id"), F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/").alias("file_path"),
        F.when(dated, F.get(parts, F.lit(1))).alias("type"), F.when(dated, F.get(parts, F.lit(2)).try_cast("int")).alias("year"), F.when(dated, F.get(parts, F.lit(3)).try_cast("int")).alias("month"),
    )
    return one.where(F.col("id").isNotNull()).groupBy("id").agg(F.min(F.struct("file_path", "type", "year", "month")).alias("at")).select("id", "at.*")


def mirror(spark: SparkSession, path: str, copy: str) -> int:
    """Replays on `copy` the commits it lacks, in order, and returns its version; what fails midway goes on at the next call."""
    done = ds.latest(copy)
    for c in ds.commits(path, done):
        data = [f"{path.rstrip('/')}/data/{f['name']}" for f in c["files"]]
        if data:
            fs, root = ds.store(copy)
            fs.create_dir(f"{root}/data", recursive=True)
            # files never change, so they keep their names; tasks copy them

            def carry(batches, path=path, copy=copy):
                import pandas as pd

                for names in batches:
                    for name in names["name"]:
                        (a, start), (b, end) = ds.store(path), ds.store(copy)
                        pafs.copy_files(f"{start}/data/{name}", f"{end}/data/{name}", source_filesystem=a, destination_filesystem=b)
                    yield pd.DataFrame({"n": [len(names)]})

            listed = spark.createDataFrame([(f["name"],) for f in c["files"]], "name string")
            listed.repartition(min(len(data), 64)).mapInPandas(carry, "n int").agg(F.sum("n")).collect()
        ds.append(copy, c["files"], c["version"] - 1, c["message"], c["author"], c["batch"], at=c["at"])
    return ds.latest(copy)


def merged(primary: DataFrame, mirrored: DataFrame) -> DataFrame:
    """The primary's documents, and the mirror's where the primary has none."""
    return library.hybrid(primary, mirrored)


def attribution(entries: DataFrame, marker: str) -> DataFrame:
    """Commits whose message names the marker (any case), newest first."""
    return entries.where(F.contains(F.lower("message"), F.lit(marker.lower()))).select("version", "message", "author", "at", "rows").orderBy(F.desc("version"))


def added(spark: SparkSession, path: str, after: int = 0) -> DataFrame:
    """The library as a stream of events: document.added, document.removed."""
    ds.register(spark)
    stream = spark.readStream.format("library").option("path", path).option("after", after).load()
    return stream.withColumn("event_type", F.when(F.coalesce("deleted", F.lit(False)), "document.removed").otherwise("document.added"))


def unreferenced(path: str) -> list[str]:
    """Data files that no commit names: what failed or lost writes left behind."""
    fs, root = ds.store(path)
    there = {i.base_name for i in fs.get_file_info(pafs.FileSelector(f"{root}/data", allow_not_found=True))}
    return sorted(there - {f["name"] for c in ds.commits(path) for f in c["files"]})
