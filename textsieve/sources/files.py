"""File sources and sinks: CSV, text trees, binary files, zip archives, tables.

* CSV columns are bound by header name and cast to an explicit schema (never
  inferred); the options make quoted fields with embedded newlines and doubled
  quotes round-trip; the writer keeps leading / trailing spaces.
* A text tree is ``<base>/<movie>/<song>.txt``; the two path parts become
  columns.  Spark's text source reports percent-encoded paths, so they are
  decoded (a literal '+' is protected first).
* Tables are Parquet directories.  ``append_rows`` appends; ``append_new`` makes
  an append idempotent with a null-safe anti-join on key columns, so
  re-running an ingest adds nothing.
"""

from __future__ import annotations

import csv
import io
import zipfile

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsieve import patterns as P
from textsieve.functions import text as TX
from textsieve.operators.candidates import derived_audio_path
from textsieve.operators.numbering import with_row_index
from textsieve.operators.sets import key_digest, one_per_key, union_all
from textsieve.session import write_scratch
from textsieve.sources import trees as TR
from textsieve.sources.tables import read_table  # noqa: F401  (re-exported: S7/S8 scans)

CSV_READ = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "mode": "FAILFAST", "enforceSchema": "false"}
CSV_WRITE = {"header": "true", "escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, index_col: str | None = None, mixed_headers: bool = False) -> DataFrame:
    """CSV with a header row, columns taken by header name and cast to ``schema``.

    The order of the file's columns does not matter; a column that the header
    lacks is an error.  ``index_col`` names an unnamed leading index column
    (written by a writer that kept its row index), which ``schema`` calls _c0.

    Files of one folder must have one header (another order is an error, not
    swapped values); with ``mixed_headers`` the files are grouped by their own
    headers, each group is bound by name, and the groups are put together."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if mixed_headers:
        groups = csv_headers(spark, path).groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
        frames = [read_csv(spark, sorted(g["paths"]), schema, index_col) for g in sorted(groups, key=lambda g: g["header"])]
        return union_all(*frames) if frames else spark.createDataFrame([], schema)
    raw = spark.read.options(**CSV_READ).csv(path)
    if index_col and "_c0" in raw.columns:
        first = spark.read.options(**{**CSV_READ, "header": "false"}).csv(path).first()
        if first is not None and not first[0]:  # the header itself has no name there, and must match in every file
            names = [T.StructField("" if c == "_c0" else c, T.StringType()) for c in raw.columns]
            raw = spark.read.options(**CSV_READ).schema(T.StructType(names)).csv(path).toDF(*raw.columns)
        raw = raw.withColumnRenamed("_c0", index_col)
    named = [(index_col if index_col and f.name == "_c0" else f.name, f.dataType) for f in schema.fields]
    return raw.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in named])


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """(path, header): the first record of every ``.csv`` file below ``path``; only the heads of the files are read."""
    def run(batches):
        fs, _ = TR.open_fs(path)
        for b in batches:
            found = []
            for p in b.column("path").to_pylist():
                with fs.open_input_stream(p) as f, io.TextIOWrapper(f, encoding="utf-8", newline="") as t:
                    found.append(next(csv.reader(t), []))
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(found, pa.list_(pa.string()))], names=["path", "header"])

    return TR.list_files(spark, path, ".csv").select("path").mapInArrow(run, "path string, header array<string>").filter("size(header) > 0")


def write_csv(df: DataFrame, path: str, columns=None, mode: str = "overwrite", index_order=None) -> None:
    """CSV with a header, fields in ``columns`` order, spaces preserved.

    With ``index_order`` (columns) rows are numbered 0, 1, ... in that order and
    the number is a leading column without a name, as a writer that keeps its
    row index does; ``read_csv(index_col=...)`` reads it."""
    out = df.select(*columns) if columns else df
    if index_order:
        numbered = with_row_index(df.withColumn("_out", F.struct(*out.columns)), *index_order, name="_row_id")
        out = numbered.select(F.col("_row_id").alias(""), "_out.*")
    out.write.mode(mode).options(**CSV_WRITE).csv(path)


# Folder name of records whose slug is empty.
EMPTY_SLUG = "_untitled"


def decode_spark_path(col) -> Column:
    """File path as reported by the text source -> real path ('%20' -> ' ')."""
    return F.url_decode(F.replace(TX._c(col), F.lit("+"), F.lit("%2B")))


def read_text_tree(spark: SparkSession, base: str, suffix: str = ".txt") -> DataFrame:
    """(movie_name, song_name, path, content) for every ``<base>/<movie>/<song><suffix>``.

    Contents are read whole; '\\r\\n' and lone '\\r' become '\\n' (text-mode reads)."""
    raw = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}").text(base, wholetext=True)
        .select(decode_spark_path(F.col("_metadata.file_path")).alias("path"), F.col("value"))
    )
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    return raw.select(
        F.element_at(parts, -2).alias("movie_name"),
        F.left(name, F.length(name) - len(suffix)).alias("song_name"),
        "path",
        F.replace(F.replace(F.col("value"), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")).alias("content"),
    )


def lyrics_file_body(song, movie, source, url, lyrics) -> Column:
    """``Song: <s>\\nMovie: <m>\\nSource: <x>\\nURL: <u>\\n\\n<lyrics>``; NULL parts are empty.

    The second version of these files has no URL line: pass ``url=None``."""
    def part(c):
        return F.coalesce(TX._c(c), F.lit(""))

    link = [] if url is None else [F.lit("\nURL: "), part(url)]
    return F.concat(F.lit("Song: "), part(song), F.lit("\nMovie: "), part(movie), F.lit("\nSource: "), part(source),
                    *link, F.lit("\n\n"), part(lyrics))


def folder_slug(col) -> Column:
    """The slug, or a name of its own for an empty one (a folder must have a name)."""
    s = F.coalesce(TX.slug(col), F.lit(""))
    return F.when(s == "", F.lit(EMPTY_SLUG)).otherwise(s)


def song_file_path(movie: Column, song: Column, suffix: str = ".txt") -> Column:
    """``<movie>/<song>.txt`` of names as they are; only what no file name may hold ('/' and NUL) becomes '_', an empty name ``EMPTY_SLUG``."""
    def part(c: Column) -> Column:
        name = F.translate(F.coalesce(c, F.lit("")), "/\0", "__")
        return F.when(name.isin("", ".", ".."), F.lit(EMPTY_SLUG)).otherwise(name)

    return F.concat(part(movie), F.lit("/"), part(song), F.lit(suffix))


def write_text_tree(df: DataFrame, base: str, movie_col: str, song_col: str, body: Column, order_col: str,
                    mode: str = "overwrite", per_song: bool = True) -> None:
    """One text file per record under ``movie_slug=<m>/song_slug=<s>/``.

    That is an export for readers of files.  With ``per_song=False`` the records
    of a movie share Parquet files under ``movie_slug=<m>/`` (columns song_slug,
    content), which is the form for very many records.

    Records whose slugs collide keep the last one by ``order_col`` (the
    behaviour of repeated writes to the same file).  The text writer ends each
    file with one '\\n' (Spark does not allow an empty record separator); the
    parsers strip trailing whitespace, so re-reading is unaffected."""
    keyed = df.select(
        folder_slug(movie_col).alias("movie_slug"), folder_slug(song_col).alias("song_slug"),
        body.alias("value"), F.col(order_col).alias("_o"),
    )
    key = key_digest(F.col("movie_slug"), F.col("song_slug"))
    last = one_per_key(keyed, key, F.col("_o"), last=True).drop("_o")
    if per_song:
        last.write.mode(mode).partitionBy("movie_slug", "song_slug").text(base)
    else:
        last.withColumnRenamed("value", "content").write.mode(mode).partitionBy("movie_slug").parquet(base)


def read_slug_tree(spark: SparkSession, base: str) -> DataFrame:
    """(movie_slug, song_slug, content) from a tree written by ``write_text_tree``
    (partition directories; the record separator Spark appended is removed)."""
    df = spark.read.text(base, wholetext=True)
    return df.select("movie_slug", "song_slug", F.regexp_replace("value", "\n\\z", "").alias("content"))


def read_binary_files(spark: SparkSession, base: str, glob: str = "*") -> DataFrame:
    """(path, length, content) of every file under ``base`` matching ``glob``."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        .load(base).select(F.regexp_replace("path", "^file:", "").alias("path"), "length", "content")
    )


ZIP_MEMBERS = T.ArrayType(T.StructType([
    T.StructField("member", T.StringType()), T.StructField("content", T.BinaryType()),
]))


@F.pandas_udf(ZIP_MEMBERS)
def _zip_members(blobs: pd.Series) -> pd.Series:
    def members(b):
        if b is None:
            return None
        with zipfile.ZipFile(io.BytesIO(b)) as z:
            return [{"member": i.filename, "content": z.read(i)} for i in z.infolist() if not i.is_dir()]

    return blobs.map(members)


def zip_members(archives: DataFrame, content_col: str = "content") -> DataFrame:
    """One row per archive member: (archive path, member name, member bytes)."""
    return archives.select(
        F.col("path").alias("archive"), F.explode(_zip_members(F.col(content_col))).alias("m")
    ).select("archive", "m.member", "m.content")


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at ``path``; errors of the file system are raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def append_rows(df: DataFrame, path: str) -> None:
    """Append all rows; creates the table when it does not exist."""
    df.write.mode("append").parquet(path)


def append_new(spark: SparkSession, df: DataFrame, path: str, keys, order_col: str | None = None) -> int:
    """Append rows whose key is not yet in the table at ``path``; returns the
    number of rows appended.  Creates the table when it does not exist.

    NULL keys are equal to each other.  Of the batch's rows with one key the
    first by ``order_col`` is taken, without an order the least by the beginnings
    (64 characters) of the other columns; of equal ones the least by a digest of
    the row, so a replay adds nothing.  Only key columns of the table are read;
    an unreadable table raises and stays as it is."""
    keys = list(keys)
    rest = [F.left(F.col(f"`{f.name}`").cast("string"), F.lit(64)) if f.dataType == T.StringType() else F.col(f"`{f.name}`")
            for f in df.schema.fields if f.name not in keys and not isinstance(f.dataType, T.MapType)]
    order = F.col(order_col) if order_col else F.struct(*[c.alias(f"o{i}") for i, c in enumerate(rest)]) if rest else None
    one = one_per_key(df, key_digest(*[F.col(k) for k in keys]), order)
    if table_exists(spark, path):
        old = spark.read.parquet(path).select(*[F.col(k).alias(f"_old_{k}") for k in keys])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_old_{k}"))
        one = one.join(old, same, "left_anti")
    # written before the append, which must not read the table that it adds to
    new = write_scratch(one.select(*df.columns), "append")
    append_rows(new, path)
    return new.count()


def with_training_flags(df: DataFrame) -> DataFrame:
    """Constant status columns of the training catalog."""
    return df.withColumns({k: F.lit(v) for k, v in P.TRAINING_FLAGS.items()})


def attach_audio(catalog: DataFrame, files: DataFrame, base: str, song_col: str = "song_name",
                 category_col: str = "category") -> DataFrame:
    """Catalog rows joined to audio files on the derived path; ``content`` is
    NULL for a missing file (left equi-join, no per-row file checks)."""
    cat = catalog.withColumn("path", derived_audio_path(category_col, song_col, base)).withColumn(
        "filename", F.concat(F.replace(F.col(song_col), F.lit(" "), F.lit("_")), F.lit(".wav")))
    return cat.join(files.select("path", "content"), "path", "left")


def attach_files(catalog: DataFrame, base: str, relative_path: Column) -> DataFrame:
    """Catalog rows with the files that exist for them, read in two phases.

    Adds file_path, length, content, error and outcome.  The files below
    ``base`` are listed without their contents and joined to the rows on
    ``relative_path``; only files that a row names are read.  Outcome is
    ``missing`` (no such file, or a null path), ``uploaded`` (read) or
    ``failed`` (listed, but reading it raised ``error``).  Rows that name one
    file each get its content.
    """
    spark = catalog.sparkSession
    root = TR.open_fs(base)[1].rstrip("/")
    row = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in catalog.columns])
    wanted = catalog.select(row.alias("_row"), F.concat(F.lit(f"{root}/"), relative_path).alias("_wanted"))
    listed = TR.list_files(spark, base).select(F.col("path"), F.col("length"))
    rows = wanted.join(listed, F.col("_wanted") == F.col("path"), "left")
    read = TR.read_files(rows.filter("path is not null"), base)
    none = rows.filter("path is null").withColumns({"content": F.lit(None).cast("binary"), "error": F.lit(None).cast("string")})
    outcome = (F.when(F.col("path").isNull(), P.OUTCOME_MISSING).when(F.col("error").isNull(), P.OUTCOME_UPLOADED).otherwise(P.OUTCOME_FAILED))
    return read.unionByName(none).select("_row.*", F.col("path").alias("file_path"), "length", "content", "error", outcome.alias("outcome"))


def upload_files(catalog: DataFrame, base: str, relative_path: Column, table_path: str) -> DataFrame:
    """Append the rows whose file could be read, with its content, to the table; returns (outcome, n) of all rows.

    The outcomes are written first: the table gets exactly the rows that the
    report counts as uploaded, and each file is read once.
    """
    staged = write_scratch(attach_files(catalog, base, relative_path), "staged")
    append_rows(staged.filter(F.col("outcome") == P.OUTCOME_UPLOADED).drop("outcome", "error", "file_path", "length"), table_path)
    return staged.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def upload_report(attached: DataFrame) -> DataFrame:
    """(status, n): uploaded vs skipped-missing counts."""
    status = F.when(F.col("content").isNull(), F.lit("missing")).otherwise(F.lit("uploaded"))
    return attached.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))
