"""The versioned library as a Spark data source: `spark.read.format("library")`, `readStream`, `write` and `writeStream`.

    data/<name>.parquet        rows, written once and never changed
    log/<version>.json         one commit: version, parent, message, author, at, batch, and its files with their rows and least and greatest id

A task writes a file and sends its description as a commit message; the commit is one log file that must not exist yet, so of two
writers from one parent one wins and the other's write fails (or, with option `retry`, follows). Files that no log entry names are
not part of the library: a failed task leaves no rows. A streaming write records its query and batch in the entry, and a
batch that is already there is not written again. Readers take the files of all commits up to a version. A streaming reader's offsets are versions.

With option `pushdown`, equality filters on `id` leave out files by the ids in the log and row groups by Parquet's statistics. It is off unless
asked for, because this version of Spark keeps what a Python source has pruned with the relation: a DataFrame that is used once with a filter and
once without would lose rows. `versioned.rows` reads the same files with Spark's own reader, which prunes and pushes without that risk.

Options: path; version (read as of); pushdown; parent, message, author, retry (write); query (streaming write: the name that makes batches unique).
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import os
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage,
)

COLUMNS = "id string, source_type string, url string, path string, text string, metadata map<string,string>, created_at timestamp, deleted boolean"
RETRIES = 20


class Conflict(RuntimeError):
    """Another writer has committed the version this one wanted."""


def store(path: str) -> tuple[pafs.FileSystem, str]:
    fs, root = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")
    return fs, root.rstrip("/")


def _created(fs: pafs.FileSystem, root: str, name: str, content: bytes) -> bool:
    """A file with all its content, or False where there is one of that name already."""
    draft = f"{root}/log/.{uuid.uuid4().hex}"
    fs.create_dir(f"{root}/log", recursive=True)
    with fs.open_output_stream(draft) as out:
        out.write(content)
    try:
        if isinstance(fs, pafs.LocalFileSystem):
            os.link(draft, name)
        elif isinstance(fs, pafs.HadoopFileSystem):  # a rename onto a file that exists fails there
            fs.move(draft, name)
            return True
        else:
            raise NotImplementedError(f"no exclusive creation of files on {fs.type_name}")
    except (FileExistsError, OSError) as error:
        if not isinstance(error, FileExistsError) and fs.get_file_info(name).type == pafs.FileType.NotFound:
            raise
        fs.delete_file(draft)
        return False
    fs.delete_file(draft)
    return True


def commits(path: str, after: int = 0, upto: int | None = None) -> list[dict]:
    """The log's entries with after < version <= upto, in order. Only their names are listed to choose them."""
    fs, root = store(path)
    names = fs.get_file_info(pafs.FileSelector(f"{root}/log", allow_not_found=True))
    found = sorted((int(i.base_name[:-5]), i.path) for i in names if i.base_name.endswith(".json") and not i.base_name.startswith("."))
    out = []
    for version, name in found:
        if after < version and (upto is None or version <= upto):
            with fs.open_input_stream(name) as f:
                out.append(json.loads(f.read()))
    return out


def latest(path: str) -> int:
    fs, root = store(path)
    names = fs.get_file_info(pafs.FileSelector(f"{root}/log", allow_not_found=True))
    return max((int(i.base_name[:-5]) for i in names if i.base_name.endswith(".json") and not i.base_name.startswith(".")), default=0)


def append(path: str, files: list[dict], parent: int | None, message: str = "", author: str = "", batch: str | None = None, retry: bool = False, at: str | None = None) -> int:
    """Commits files: as the version after `parent` (None: after the latest). With `retry` a lost race is run again from the new latest."""
    fs, root = store(path)
    version = (latest(path) if parent is None else parent) + 1
    for _ in range(RETRIES):
        entry = {
            "version": version, "parent": version - 1, "message": message, "author": author, "batch": batch,
            "at": at or dt.datetime.now(dt.timezone.utc).isoformat(timespec="microseconds"), "rows": sum(f["rows"] for f in files), "files": files,
        }
        if _created(fs, root, f"{root}/log/{version:020d}.json", json.dumps(entry).encode()):
            return version
        if not retry:
            break
        version = latest(path) + 1
        if batch is not None and any(c["batch"] == batch for c in commits(path, entry["parent"])):
            return version - 1
    raise Conflict(f"version {version} of {path} is there already")


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int  # 0: the task had none, and there is no file
    least: str | None
    most: str | None


def _write(path: str, batches: Iterator[pa.RecordBatch]) -> Written:
    """One file of a task's rows; no file where there are none."""
    fs, root = store(path)
    name, out, ids, rows = f"{uuid.uuid4().hex}.parquet", None, [], 0
    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(f"{root}/data", recursive=True)
                out = pq.ParquetWriter(f"{root}/data/{name}", batch.schema, filesystem=fs)
            out.write_batch(batch)
            rows += batch.num_rows
            if "id" in batch.schema.names:
                own = pc.min_max(batch["id"]).as_py()
                ids += [str(x) for x in own.values() if x is not None]
    finally:
        if out is not None:
            out.close()
    return Written(name, rows, min(ids, default=None), max(ids, default=None))


def _delete(path: str, messages: Iterable[WriterCommitMessage | None]) -> None:
    fs, root = store(path)
    for m in messages:
        if m is not None and m.rows:
            with contextlib.suppress(FileNotFoundError):
                fs.delete_file(f"{root}/data/{m.name}")


def _files(messages: Iterable[Written | None]) -> list[dict]:
    return [asdict(m) for m in messages if m is not None and m.rows]


class Library(DataSource):
    @classmethod
    def name(cls) -> str:
        return "library"

    def schema(self) -> str:
        return f"{COLUMNS}, version long"

    def reader(self, schema: T.StructType) -> Reader:
        pushed = str(self.options.get("pushdown", "")).lower() == "true"
        return (PushedReader if pushed else Reader)(dict(self.options), schema)

    def streamReader(self, schema: T.StructType) -> StreamReader:
        return StreamReader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        return Writer(dict(self.options))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(dict(self.options))


class Part(InputPartition):
    def __init__(self, name: str, version: int, ids: list[str] | None = None):
        self.name, self.version, self.ids = name, version, ids


def _parts(entries: list[dict], ids: list[str] | None = None) -> list[Part]:
    """A partition for each file that may hold one of `ids`."""

    def may(f: dict) -> bool:
        return ids is None or f["least"] is None or any(f["least"] <= i <= f["most"] for i in ids)

    return [Part(f["name"], c["version"], ids) for c in entries for f in c["files"] if may(f)]


def _read(path: str, part: Part, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    fs, root = store(path)
    want = to_arrow_schema(schema)
    chosen = None if part.ids is None else [("id", "in", part.ids)]
    rows = pq.read_table(f"{root}/data/{part.name}", filesystem=fs, filters=chosen, columns=[n for n in want.names if n != "version"])
    for batch in rows.to_batches(max_chunksize=1000):
        columns = [pa.array([part.version] * batch.num_rows, pa.int64()) if f.name == "version" else batch[f.name].cast(f.type) for f in want]
        yield pa.RecordBatch.from_arrays(columns, schema=want)


class Reader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.schema, self.version, self.ids = options["path"], schema, int(options["version"]) if options.get("version") else None, None

    def partitions(self) -> list[Part]:
        return _parts(commits(self.path, upto=self.version), self.ids)

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition, self.schema)


class PushedReader(Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Equality and membership on id choose files, row groups and rows here; the other filters are left to Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("id",):
                own = [f.value] if isinstance(f, EqualTo) else [v for v in f.value if v is not None]
                self.ids = own if self.ids is None else [i for i in self.ids if i in own]
            else:
                yield f


class StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.schema, self.start = options["path"], schema, int(options.get("after", 0))

    def initialOffset(self) -> dict:
        return {"version": self.start}

    def latestOffset(self) -> dict:
        return {"version": max(latest(self.path), self.start)}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return _parts(commits(self.path, start["version"], end["version"]))

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition, self.schema)


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.options = options["path"], options
        self.parent = int(options["parent"]) if options.get("parent") else latest(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _write(self.path, iterator)

    def commit(self, messages: list[Written | None]) -> None:
        o = self.options
        append(self.path, _files(messages), self.parent, o.get("message", ""), o.get("author", ""), retry=str(o.get("retry", "")).lower() == "true")

    def abort(self, messages: list[Written | None]) -> None:
        _delete(self.path, messages)


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict):
        self.path, self.options = options["path"], options

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _write(self.path, iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        batch = f"{self.options.get('query', '')}:{batchId}"
        if any(c["batch"] == batch for c in commits(self.path)):
            _delete(self.path, messages)
            return
        o = self.options
        append(self.path, _files(messages), None, o.get("message", ""), o.get("author", ""), batch, retry=True)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        _delete(self.path, messages)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, with its filters pushed."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Library)
