"""Trees of many small files: listing, packed reading, and writing by exact name.

Spark's file sources list on the driver, skip names that begin with ``_`` or
``.``, and name the files that they write.  Where a tree's paths are data
(``<movie>/<song>.txt``), that is not enough:

* ``list_files`` lists level by level, the folders of a level in parallel, and
  reads no content.  Paths are as they are on disk, never percent-encoded.
* ``read_files`` reads the files that a column names.  Rows are dealt to tasks
  by running sums of bytes (an open file costs some, too), so that a task gets
  many small files or one large one, and an error is a value of its row.
* ``NamedFiles`` is a data source writer: rows (path, content) become files of
  just these names.  Tasks write to a folder of their own attempt; only a commit
  moves the files of the attempts that Spark accepted, so failed, killed and
  repeated tasks leave nothing.

File systems are those of pyarrow (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import contextlib
import posixpath
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from textsieve.operators.numbering import with_running_sum
from textsieve.operators.sets import key_digest, one_per_key
from textsieve.session import write_scratch

#: bytes that a task reads, what opening a file counts for, and bytes put out together
TASK_BYTES, OPEN_BYTES, BATCH_BYTES = 64 << 20, 256 << 10, 16 << 20
#: moves at a time when files are committed
MOVERS = 16

LISTING = T.StructType([T.StructField("path", T.StringType()), T.StructField("parent", T.StringType()), T.StructField("name", T.StringType()),
                        T.StructField("is_dir", T.BooleanType()), T.StructField("length", T.LongType())])


def open_fs(base: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a location: a URI, ``file:/...`` as Hadoop writes it, or a plain local path."""
    if base.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + base[5:].lstrip("/")
    if "://" in base:
        return pafs.FileSystem.from_uri(base)
    return pafs.LocalFileSystem(), base


# ---------------------------------------------------------------- listing

def _list_folders(base: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(base)
        for b in batches:
            for folder in b.column("path").to_pylist():
                found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
                for a in range(0, len(found), 10_000):
                    part = found[a:a + 10_000]
                    yield pa.RecordBatch.from_pydict({
                        "path": pa.array([x.path for x in part], pa.string()), "parent": pa.array([posixpath.basename(folder)] * len(part), pa.string()),
                        "name": pa.array([x.base_name for x in part], pa.string()),
                        "is_dir": pa.array([x.type == pafs.FileType.Directory for x in part], pa.bool_()),
                        "length": pa.array([x.size or 0 for x in part], pa.int64())})

    return run


def list_files(spark: SparkSession, base: str, suffix: str = "") -> DataFrame:
    """(path, parent, name, length) of every file below ``base`` whose name ends with ``suffix``; no content is read.

    A level's folders are listed in parallel and its entries are a written
    table; the driver sees one count per level.  A base that does not exist has
    no files.
    """
    _, root = open_fs(base)
    folders = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string")
    files = spark.createDataFrame([], LISTING)
    while True:
        level = write_scratch(folders.repartition("path").mapInArrow(_list_folders(base), LISTING), "listing")
        files = files.unionByName(level.filter("not is_dir"))
        folders = level.filter("is_dir").select("path")
        if not folders.limit(1).count():
            break
    return files.filter(F.endswith("name", F.lit(suffix))).drop("is_dir")


# ---------------------------------------------------------------- reading

def _read_contents(base: str, schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(base)
        for b in batches:
            done, content, error, held = 0, [], [], 0
            for i, path in enumerate(b.column("path").to_pylist()):
                body = reason = None
                if path is not None:
                    try:
                        with fs.open_input_stream(path) as f:
                            body = f.read()
                    except FileNotFoundError:
                        reason = "not found"
                    except Exception as e:  # noqa: BLE001  (whatever a file system raises is that row's outcome)
                        reason = f"{type(e).__name__}: {e}"[:500]
                content.append(body)
                error.append(reason)
                held += len(body or b"")
                if held >= BATCH_BYTES:
                    yield _with_contents(b.slice(done, i + 1 - done), content, error, schema)
                    done, content, error, held = i + 1, [], [], 0
            if content:
                yield _with_contents(b.slice(done), content, error, schema)

    return run


def _with_contents(rows: pa.RecordBatch, content: list, error: list, schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(content, pa.binary()), pa.array(error, pa.string())], names=schema.fieldNames())


def read_files(files: DataFrame, base: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The rows with ``content`` (binary) and ``error`` (null, "not found", or what reading raised) of the file each names.

    ``files`` has ``path`` (absolute, on the file system of ``base``; null:
    no file) and ``length``, the bytes expected, by which rows are dealt to tasks.
    """
    schema = T.StructType([*files.schema.fields, T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())])
    summed = write_scratch(with_running_sum(files, F.col("length") + OPEN_BYTES, "path", name="_bytes"), "dealt")
    tasks = (summed.agg(F.max("_bytes")).first()[0] or 0) // task_bytes + 1
    task = F.expr(f"_bytes div {task_bytes}")
    # a task's files are neighbours: one folder is read by few tasks
    dealt = summed.withColumn("_task", task).repartitionByRange(int(tasks), "_task").drop("_bytes", "_task")
    return dealt.mapInArrow(_read_contents(base, schema), schema)


def universal_newlines(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def read_text_files(spark: SparkSession, base: str, suffix: str = ".txt") -> DataFrame:
    """(movie_name, song_name, path, content) of every ``<base>/.../<movie>/<song><suffix>``.

    Contents are whole UTF-8 texts with '\\n' for '\\r\\n' and lone '\\r'; a
    file that cannot be read is an error.
    """
    files = read_files(list_files(spark, base, suffix).select("path", "parent", "name", "length"), base)
    bad = F.raise_error(F.concat(F.lit("cannot read "), F.col("path"), F.lit(": "), F.col("error")))
    text = F.coalesce(F.col("content"), bad.cast("binary"))
    return files.select(F.col("parent").alias("movie_name"), F.left("name", F.length("name") - F.lit(len(suffix))).alias("song_name"), "path",
                        universal_newlines(F.decode(text, "UTF-8")).alias("content"))


# ---------------------------------------------------------------- writing

@dataclass
class Written(WriterCommitMessage):
    folder: str
    files: int


def safe_path(path: str | None) -> str:
    """A relative path below the base, or an error."""
    parts = (path or "").split("/")
    if not path or any(p in ("", ".", "..") or "\0" in p for p in parts):
        raise ValueError(f"not a relative file path: {path!r}")
    return path


class NamedFilesWriter(DataSourceArrowWriter):
    """Stages files by attempt beside the base; a commit moves those of the accepted attempts to their names."""

    def __init__(self, base: str, overwrite: bool):
        self.base, self.overwrite = base.rstrip("/"), overwrite
        self.staging = f"{self.base}.staging-{uuid.uuid4().hex}"

    def _open(self) -> tuple[pafs.FileSystem, str, str]:
        fs, base = open_fs(self.base)
        return fs, base, open_fs(self.staging)[1]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, _, staging = self._open()
        name = uuid.uuid4().hex  # of this attempt
        made: set[str] = set()
        n = 0
        for b in iterator:
            for path, content in zip(b.column("path").to_pylist(), b.column("content")):
                at = f"{staging}/{name}/{safe_path(path)}"
                folder = posixpath.dirname(at)
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                with fs.open_output_stream(at) as f:
                    f.write(content.as_buffer() if content.is_valid else b"")
                n += 1
        return Written(name, n)

    def commit(self, messages: list[Written | None]) -> None:
        fs, base, staging = self._open()
        into = f"{staging}/tree" if self.overwrite else base
        fs.create_dir(into, recursive=True)
        for m in messages:
            if m is not None and m.files:
                _merge_folder(fs, f"{staging}/{m.folder}", into)
        if self.overwrite:  # the old tree stays until the new one is whole
            if fs.get_file_info(base).type != pafs.FileType.NotFound:
                fs.move(base, f"{staging}/old")
            fs.move(into, base)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _, staging = self._open()
        with contextlib.suppress(FileNotFoundError):
            fs.delete_dir(staging)


def _merge_folder(fs: pafs.FileSystem, source: str, into: str) -> None:
    """Move a folder's entries: whole folders that are new, files over files, the others entry by entry."""
    found = fs.get_file_info(pafs.FileSelector(source))
    there = {x.base_name: x.type for x in fs.get_file_info(pafs.FileSelector(into))}
    deeper = [x.base_name for x in found if x.type == pafs.FileType.Directory and there.get(x.base_name) == pafs.FileType.Directory]
    moved = [x.base_name for x in found if x.base_name not in set(deeper)]
    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(lambda n: fs.move(f"{source}/{n}", f"{into}/{n}"), moved))
    for n in deeper:
        _merge_folder(fs, f"{source}/{n}", f"{into}/{n}")


class NamedFiles(DataSource):
    """``df.write.format("named_files").mode("append" or "overwrite").save(base)`` for rows (path, content binary)."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema: T.StructType, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], overwrite)


def write_named_files(df: DataFrame, base: str, path: Column, content: Column, order_col: str, mode: str = "overwrite") -> None:
    """One file per path (relative, with folders) holding exactly ``content``; of several records with one path the last by ``order_col``.

    ``overwrite`` replaces the tree when all is written; ``append`` adds to it
    and replaces files of the same name.  A null content is an empty file; a
    null, empty or unsafe path is an error and nothing is written.
    """
    df.sparkSession.dataSource.register(NamedFiles)
    rows = df.select(path.alias("path"), content.cast("binary").alias("content"), F.col(order_col).alias("order"))
    out = one_per_key(rows, key_digest(F.col("path")), F.col("order"), last=True).select("path", "content")
    out.write.format("named_files").mode(mode).save(base)
