"""The content-addressed archive against a brute-force version, and its exact round trip."""

import gzip
import hashlib
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textsieve.llm import warc


def brute(pages):
    rows = []
    for i, u, h in pages:
        raw = (h or "").encode()
        rows.append((i is None, i or 0, u is not None, u or "", i, raw))
    rows.sort()
    first, out = {}, []
    for *_, i, raw in rows:
        d = hashlib.sha256(raw).hexdigest()
        if len(raw) >= 100 and d in first:
            out.append((i, len(raw), d, "revisit", first[d]))
        else:
            first.setdefault(d, i)
            out.append((i, len(raw), d, "response", None))
    return sorted(map(repr, out))


def pages_of(spark):
    rng = random.Random(5)
    bodies = ["<p>" + "x" * 97, "<p>" + "x" * 96, "é" * 50, "é" * 49, None, "", "a\r\nWARC-Type: revisit\r\n" + "y" * 100, "z" * 200_000]
    pages = [(rng.choice([None, *range(40)]), rng.choice([None, "http://a/", "http://b/\r\nWARC-Type: evil\r\nPage-ID: 5\r\n"]), rng.choice(bodies)) for _ in range(150)]
    pages += [(77, "http://c/", "c" * 300)] * 40
    return pages, spark.createDataFrame(pages, "page_id long, url string, html string").repartition(6)


def test_pages_equal_brute_force(spark, tmpdir_path, monkeypatch):
    pages, df = pages_of(spark)
    monkeypatch.setattr(warc, "COPIES", 7)
    base = f"{tmpdir_path}/a"
    warc.archive_pages(df.withColumns({c: F.lit(0) for c in ("digest", "payload", "a b", "page", "n_bytes")}), base)
    got = sorted(repr(tuple(r)) for r in warc.read_pages(spark, base).collect())
    assert got == brute(pages)
    heads = warc.headers(spark, base)
    assert heads.select("record_id").distinct().count() == len(pages)
    # every distinct payload is stored once
    assert warc.payloads(spark, base).count() == len({h or "" for _, _, h in pages})
    for r in warc.original_records(spark, base).collect():
        head, _, rest = r["record"].partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert len(rest) == int(fields[b"Content-Length"]) + 4 and rest.endswith(b"\r\n\r\n")
        http, _, body = rest[:-4].partition(b"\r\n\r\n")
        if fields[b"WARC-Type"] == b"response":
            assert b"sha256:" + hashlib.sha256(body).hexdigest().encode() == fields[b"WARC-Payload-Digest"]
        else:
            assert body == b"" and fields[b"WARC-Refers-To"].startswith(b"<urn:uuid:")


def test_empty_table(spark, tmpdir_path):
    warc.archive_pages(pages_of(spark)[1].limit(0), f"{tmpdir_path}/e")
    assert warc.read_pages(spark, f"{tmpdir_path}/e").count() == 0


def test_given_records_come_back_byte_for_byte(spark, tmpdir_path):
    rng = random.Random(6)
    records = [(b"WARC/1.0\r\nwarc-record-id: <urn:uuid:%d>\r\n\r\n" % i + bytes(rng.randrange(256) for _ in range(20)), rng.choice([b"", b"\xff\x00" * 90, b"p" * 5])) for i in range(60)]
    base = f"{tmpdir_path}/r"
    warc.archive_records(spark.createDataFrame([*records, (None, None)], "header binary, payload binary").repartition(4), base)
    got = sorted((r["record_id"], bytes(r["record"])) for r in warc.original_records(spark, base).filter("record_id is not null").collect())
    assert got == sorted((f"<urn:uuid:{i}>", h + p + b"\r\n\r\n") for i, (h, p) in enumerate(records))
    assert warc.payloads(spark, base).count() == 3


def test_damaged_and_missing_payloads_are_errors(spark, tmpdir_path):
    base = f"{tmpdir_path}/d"
    warc.archive_records(spark.createDataFrame([(b"h", b"one"), (b"h", b"two")], "header binary, payload binary"), base)
    good = spark.read.parquet(f"{base}/payloads").collect()
    spark.createDataFrame([(good[0]["digest"], b"changed"), tuple(good[1])], "digest binary, payload binary").write.mode("overwrite").parquet(f"{base}/payloads")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.original_records(spark, base).collect()
    spark.createDataFrame([tuple(good[1])], "digest binary, payload binary").write.mode("overwrite").parquet(f"{base}/payloads")
    with pytest.raises(Exception, match="no payload with the digest"):
        warc.original_records(spark, base).collect()


def test_equal_digests_of_other_bytes_are_an_error():
    b = pa.RecordBatch.from_pydict({"digest": [b"d", b"d"], "payload": [b"x", b"y"]})
    with pytest.raises(ValueError, match="two payloads"):
        list(warc._one_of_each(iter([b])))
    same = pa.RecordBatch.from_pydict({"digest": [b"d", b"e"], "payload": [b"x", b"y"]})
    assert [r for out in warc._one_of_each(iter([same.slice(0, 1), same])) for r in out.to_pylist()] == same.to_pylist()


def test_files_and_archives_hold_the_same_records(spark, tmpdir_path):
    pages, df = pages_of(spark)
    warc.archive_pages(df, f"{tmpdir_path}/a")
    records = sorted(bytes(r["record"]) for r in warc.original_records(spark, f"{tmpdir_path}/a").collect())
    warc.write_warc_files(warc.original_records(spark, f"{tmpdir_path}/a"), f"{tmpdir_path}/files", file_bytes=3000)
    names = os.listdir(f"{tmpdir_path}/files")
    assert len(names) > 5 and all(n.endswith(".warc") for n in names)
    packed = f"{tmpdir_path}/files/{names[0]}"
    with open(packed, "rb") as f:
        whole = f.read()
    with open(packed, "wb") as f:
        f.write(gzip.compress(whole[:0]) + gzip.compress(whole))
    warc.archive_records(warc.read_warc_files(spark, f"{tmpdir_path}/files"), f"{tmpdir_path}/b")
    assert sorted(bytes(r["record"]) for r in warc.original_records(spark, f"{tmpdir_path}/b").collect()) == records
    assert warc.payloads(spark, f"{tmpdir_path}/b").count() == len({h or "" for _, _, h in pages})
    with open(packed, "wb") as f:
        f.write(whole[:-7])
    with pytest.raises(Exception, match="does not end where it says"):
        warc.read_warc_files(spark, f"{tmpdir_path}/files").count()
    assert warc.read_warc_files(spark, f"{tmpdir_path}/none").count() == 0


def test_records_of_other_kinds():
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 9\r\n\r\na: b\r\n\r\nc\r\n\r\n"
    bare = b"WARC/1.0\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: 4\r\n\r\nHTTP\r\n\r\n"
    got = list(warc.split_records(info + bare))
    assert got[0][1] == b"a: b\r\n\r\nc" and got[1][1] == b"HTTP"
    assert b"".join(h + p + b"\r\n\r\n" for h, p in got) == info + bare
    for bad in (b"x", info[:30], info.replace(b"Length: 9", b"Length: x"), info.replace(b"Length: 9", b"Length: 5")):
        with pytest.raises(ValueError):
            list(warc.split_records(bad))
