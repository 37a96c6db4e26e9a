"""Content-addressed WARC archive: payload bytes once, exact record headers beside them.

An archive is a folder with two tables:

* ``payloads`` (digest, payload): every distinct payload once, by its SHA-256;
* ``headers`` (record_id, digest, inline, header): one row a record, with the
  exact bytes of its WARC and HTTP headers.  ``inline`` says whether the
  record's block holds the payload; a revisit's does not, it names the record
  that does.

Records are put together again by joining both on the digest.  Digests are
verified: copies that meet while payloads are reduced to one are compared byte
by byte, and a reader hashes every stored payload again.

Payloads are reduced to one in two steps, within each task of the scan and then
by digest, so a payload that a third of all pages share travels once a task.
Everything else (who comes first, the headers) works on rows without payloads.

``write_warc_files`` puts an archive's records into WARC files, and
``read_warc_files`` takes such files apart for ``archive_records``.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.session import scratch_path
from textsieve.sources import trees

from .shared import Scratch, table

#: payloads under this size are never revisited
MIN_BYTES = 100
#: digests that a task remembers before it forgets them and starts again (a copy more is harmless there)
REMEMBERED = 1 << 18
#: copies of one row numbered together
COPIES = 1 << 16
#: bytes of a WARC file
FILE_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"

# --- fixed values: the archive format's own names ---
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL, END = "\r\n", "\r\n\r\n"
# --- end of fixed values ---


def digest_of(payload: Column) -> Column:
    return F.unhex(F.sha2(payload, 256))


def payload_of(text: Column) -> Column:
    """UTF-8 bytes of a text, none for null; binary columns stay as they are."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


# ---------------------------------------------------------------- payloads

def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose digest the task has not put out yet."""
    seen: set[bytes] = set()
    for b in batches:
        new = []
        for i, d in enumerate(b.column("digest").to_pylist()):
            if d not in seen:
                seen.add(d)
                new.append(i)
        if len(seen) > REMEMBERED:
            seen.clear()
        if new:
            yield b if len(new) == b.num_rows else b.take(pa.array(new))


def _one_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first of the rows with one digest, which lie together; the others must hold the same bytes."""
    digest, payload = None, None
    for b in batches:
        new = []
        column = b.column("payload")
        for i, d in enumerate(b.column("digest").to_pylist()):
            if d != digest:
                digest, payload = d, column[i]
                new.append(i)
            elif not column[i].equals(payload):
                raise ValueError(f"two payloads with the digest {d.hex()}")
        if new:
            yield b if len(new) == b.num_rows else b.take(pa.array(new))


def distinct_payloads(payloads: DataFrame) -> DataFrame:
    """(digest, payload) of every distinct value of the column ``payload`` (binary, not null)."""
    schema = "digest binary, payload binary"
    rows = payloads.select(digest_of(F.col("payload")).alias("digest"), "payload").mapInArrow(_first_seen, schema)
    return rows.repartition("digest").sortWithinPartitions("digest").mapInArrow(_one_of_each, schema)


# ---------------------------------------------------------------- headers

def record_id(*parts: Column) -> Column:
    """A name for a record that follows from its parts: urn:uuid from their SHA-256."""
    h = F.sha2(F.to_json(F.struct(*[p.cast("string").alias(f"p{i}") for i, p in enumerate(parts)]), {"ignoreNullFields": "false"}), 256)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, without one for null; line breaks in a value are percent-encoded."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(EOL)), F.lit(""))


def page_headers(keys: DataFrame) -> DataFrame:
    """(record_id, digest, inline, header) of pages, given (page, url, digest, n_bytes, nth, shared, first_page, first_url).

    Where ``shared``, ``first_*`` name the record whose zeroth copy is the
    response; the other records revisit it.
    """
    is_first = F.col("page").eqNullSafe(F.col("first_page")) & F.col("url").eqNullSafe(F.col("first_url")) & (F.col("nth") == 0)
    revisit = F.col("shared") & ~is_first
    hex_digest = F.lower(F.hex("digest"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}"), _field("Content-Type", F.lit("text/html; charset=utf-8")), _field("Content-Length", F.col("n_bytes")), F.lit(EOL))
    of_first = record_id(F.col("first_page"), F.col("first_url"), hex_digest, F.lit(0))
    own = record_id(F.col("page"), F.col("url"), hex_digest, F.col("nth"))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n_bytes"))
    head = F.concat(
        F.lit(VERSION + EOL), _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")), _field("WARC-Record-ID", F.col("record_id")),
        _field("WARC-Date", F.lit(DATE)), _field("WARC-Target-URI", F.col("url")), _field("Page-ID", F.col("page")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), hex_digest)), _field("WARC-Profile", F.when(revisit, PROFILE)),
        _field("WARC-Refers-To", F.when(revisit, of_first)), _field("Content-Type", F.lit("application/http;msgtype=response")),
        _field("Content-Length", block), F.lit(EOL), http)
    return keys.withColumn("record_id", own).select("record_id", "digest", (~revisit).alias("inline"), head.cast("binary").alias("header"))


def header_field(header: Column, name: str) -> Column:
    """The value of a field of a record's WARC header, null where it has none."""
    value = F.regexp_extract(header, rf"(?i)\r\n{name}: *([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


# ---------------------------------------------------------------- archives

def archive_pages(pages: DataFrame, base: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
                  min_bytes: int = MIN_BYTES) -> None:
    """Write one record per page to the archive ``base``.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest id (nulls last, then url) is a response and the others revisit
    it; smaller ones are all responses.  Null texts are empty payloads, a null
    url has no header line, repeated rows are records of their own (the
    first copy counts as smaller), an empty table gives an empty archive, extra
    columns are ignored.
    """
    scratch = Scratch(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), payload_of(F.col(text_col)).alias("payload"))
    distinct_payloads(rows.select("payload")).write.parquet(f"{base}/payloads")
    keys = scratch.put("keys", rows.select("page", "url", digest_of(F.col("payload")).alias("digest"), F.octet_length("payload").alias("n_bytes"))
                       .groupBy("page", "url", "digest", "n_bytes").agg(F.count("*").alias("copies")))
    key = F.struct(F.col("page").isNull().alias("none"), "page", "url")
    many = keys.filter(F.col("n_bytes") >= min_bytes).groupBy(F.col("digest").alias("d")).agg(F.min(key).alias("first"))
    many = scratch.put("first", many.select("d", F.col("first.page").alias("first_page"), F.col("first.url").alias("first_url"), F.lit(True).alias("shared")))
    named = keys.join(many, F.col("digest") == F.col("d"), "left").withColumn("shared", F.coalesce("shared", F.lit(False)))
    # number the copies of a row, a bounded number at a time
    parts = named.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))))
    last = F.least(F.col("copies"), (F.col("part") + 1) * COPIES) - 1
    numbered = parts.withColumn("nth", F.explode(F.sequence(F.col("part") * COPIES, last)))
    page_headers(numbered).write.parquet(f"{base}/headers")
    scratch.drop("keys", "first")


def archive_records(records: DataFrame, base: str) -> None:
    """Write given records, (header binary, payload binary), to the archive ``base``; nulls are empty."""
    rows = records.select(payload_of(F.col("header")).alias("header"), payload_of(F.col("payload")).alias("payload"))
    distinct_payloads(rows.select("payload")).write.parquet(f"{base}/payloads")
    name = header_field(F.col("header").cast("string"), "WARC-Record-ID")
    rows.select(name.alias("record_id"), digest_of(F.col("payload")).alias("digest"), F.lit(True).alias("inline"), "header").write.parquet(f"{base}/headers")


def headers(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema("record_id string, digest binary, inline boolean, header binary").parquet(f"{base}/headers")


def payloads(spark: SparkSession, base: str) -> DataFrame:
    """(stored, payload) of the archive; a payload that does not match its digest is an error."""
    stored = spark.read.schema("digest binary, payload binary").parquet(f"{base}/payloads")
    bad = F.raise_error(F.concat(F.lit("stored payload does not match its digest "), F.hex("digest")))
    checked = F.when(digest_of(F.col("payload")) == F.col("digest"), F.col("digest")).otherwise(bad.cast("binary"))
    return stored.select(checked.alias("stored"), "payload")


def joined(spark: SparkSession, base: str, name: str, of_payload: Column) -> DataFrame:
    """Every header with an expression over its payload (never null); a header without a payload is an error."""
    kept = payloads(spark, base).select("stored", of_payload.alias(name))
    rows = headers(spark, base).join(kept, F.col("digest") == F.col("stored"), "left").drop("stored")
    bad = F.raise_error(F.concat(F.lit("no payload with the digest "), F.hex("digest")))
    return rows.withColumn(name, F.coalesce(name, bad.cast(kept.schema[name].dataType)))


def original_records(spark: SparkSession, base: str) -> DataFrame:
    """(record_id, record): the exact bytes of every record, headers, block and end, for records whose block holds the payload."""
    rows = joined(spark, base, "payload", F.col("payload"))
    body = F.when(F.col("inline"), F.col("payload")).otherwise(F.lit(b""))
    return rows.select("record_id", F.concat("header", body, F.lit(END.encode())).alias("record"))


def read_pages(spark: SparkSession, base: str) -> DataFrame:
    """The records of an archive of pages, from their headers and stored payloads.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to (the
    page of the record that a revisit names).
    """
    rows = joined(spark, base, "payload_bytes", F.octet_length("payload").cast("long"))
    head = F.col("header").cast("string")
    rows = rows.select("record_id", "payload_bytes", F.lower(F.hex("digest")).alias("payload_digest"), header_field(head, "Page-ID").cast("long").alias("page_id"),
                       header_field(head, "WARC-Type").alias("record_type"), header_field(head, "WARC-Refers-To").alias("names"))
    at = (headers(spark, base).filter("inline").select(F.col("record_id").alias("at"), header_field(F.col("header").cast("string"), "Page-ID").cast("long").alias("refers_to")))
    return (rows.join(at, F.col("names") == F.col("at"), "left")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


# ---------------------------------------------------------------- files

def split_records(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header, payload) of the records of a WARC file, plain or gzip; an HTTP block's own headers belong to the header."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)  # all members
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        head = data[at:end + 4]
        found = re.search(rb"(?im)^content-length: *([0-9]+)\r$", head)
        if end < 0 or not head.startswith(b"WARC/") or not found:
            raise ValueError(f"no WARC record at byte {at}")
        start, stop = end + 4, end + 4 + int(found[1])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        http = re.search(rb"(?im)^content-type: *application/http", head)
        cut = data.find(b"\r\n\r\n", start, stop) + 4 if http else start
        cut = cut if cut > 3 else start
        yield data[at:cut], data[cut:stop]
        at = stop + 4


def read_warc_files(spark: SparkSession, base: str, suffix: str = ".warc") -> DataFrame:
    """(header, payload) of every record in the WARC files below ``base``, as ``archive_records`` takes them; a damaged file is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, data, error in zip(*(b.column(c) for c in ("path", "content", "error"))):
                if error.is_valid:
                    raise OSError(f"cannot read {path.as_py()}: {error.as_py()}")
                held, size = [], 0
                for r in split_records(data.as_py()):
                    held.append(r)
                    size += len(r[1])
                    if size >= trees.BATCH_BYTES:
                        yield _records(held)
                        held, size = [], 0
                if held:
                    yield _records(held)

    files = trees.read_files(trees.list_files(spark, base, suffix).select("path", "length"), base)
    return files.mapInArrow(run, "header binary, payload binary")


def _records(held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([h for h, _ in held], pa.binary()), pa.array([p for _, p in held], pa.binary())], names=["header", "payload"])


def write_warc_files(records: DataFrame, base: str, file_bytes: int = FILE_BYTES) -> None:
    """Write ``original_records`` as WARC files of about ``file_bytes`` below ``base``, which is replaced when all are written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"records-{part:06d}-{n:06d}.warc"]), pa.array([b"".join(held)], pa.binary())], names=["path", "content"])

        for b in batches:
            for r in b.column("record").to_pylist():
                held.append(r)
                size += len(r)
                if size >= file_bytes:
                    yield out()
                    n, held, size = n + 1, [], 0
        if held:
            yield out()

    spark = records.sparkSession
    spark.dataSource.register(trees.NamedFiles)
    # a task that fails writes its files again under the same names; only a commit shows them
    records.select("record").mapInArrow(run, "path string, content binary").write.format("named_files").mode("overwrite").save(base)


def op13_warc(spark, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "warc")
    archive_pages(table(spark, sf_dir, "pages"), base)
    return read_pages(spark, base)


OP13_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS first,
             row_number() OVER (PARTITION BY d ORDER BY page_id) AS nth FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND nth > 1 THEN first END AS refers_to
FROM f
"""
