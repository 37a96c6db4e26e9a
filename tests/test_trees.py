"""Trees of small files: exact names, packed reading, commits, errors per file, row numbers."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textsieve.operators import numbering as N
from textsieve.plans import lifecycles as L
from textsieve.sources import files as IO
from textsieve.sources import trees as TR

ODD = [("M 1", "a%20b"), ("M+1", "50%"), ("పాట", "తెలుగు + x"), ("_hidden", ".dot"), ("M 1", "__"), ("a=b", "c:d?e#f")]


def tree_of(base):
    return {os.path.relpath(os.path.join(d, f), base): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(base) for f in fs}


def write(spark, base, rows, mode="overwrite"):
    df = spark.createDataFrame(rows, "seq int, path string, body string")
    TR.write_named_files(df, base, F.col("path"), F.col("body"), "seq", mode)


def test_exact_names_come_back(spark, tmpdir_path):
    base = f"{tmpdir_path}/tree"
    df = spark.createDataFrame([(i, m, s, f"x\r\n{i}\ry") for i, (m, s) in enumerate(ODD)], "i int, m string, s string, t string").repartition(4)
    TR.write_named_files(df, base, IO.song_file_path(F.col("m"), F.col("s")), F.col("t"), "i")
    assert set(tree_of(base)) == {f"{m}/{s}.txt" for m, s in ODD}
    got = {(r["movie_name"], r["song_name"]): r["content"] for r in TR.read_text_files(spark, base).collect()}
    assert got == {k: f"x\n{i}\ny" for i, k in enumerate(ODD)}
    assert os.listdir(tmpdir_path) == ["tree"]
    # as Hadoop writes a local location
    assert TR.list_files(spark, f"file:{base}", ".txt").count() == len(ODD)


def test_names_that_no_file_can_have(spark, tmpdir_path):
    rows = [(1, "a/b", None), (2, "", "x\0y"), (3, None, ".."), (4, ".", "z")]
    df = spark.createDataFrame(rows, "i int, m string, s string")
    TR.write_named_files(df, f"{tmpdir_path}/t", IO.song_file_path(F.col("m"), F.col("s")), F.lit("x"), "i")
    assert set(tree_of(f"{tmpdir_path}/t")) == {"a_b/_untitled.txt", "_untitled/x_y.txt", "_untitled/_untitled.txt", "_untitled/z.txt"}


def test_last_write_wins_in_a_batch_and_over_a_tree(spark, tmpdir_path):
    base = f"{tmpdir_path}/t"
    write(spark, base, [(1, "m/a", "old"), (3, "m/a", "new"), (3, "m/a", "new"), (2, "m/a", "mid"), (None, "n/b", None)])
    assert tree_of(base) == {"m/a": b"new", "n/b": b""}
    write(spark, base, [(1, "m/a", "newer"), (1, "m/c/d", "deep"), (1, "o", "top")], "append")
    assert tree_of(base) == {"m/a": b"newer", "n/b": b"", "m/c/d": b"deep", "o": b"top"}
    write(spark, base, [(1, "only/x", "1")])
    assert tree_of(base) == {"only/x": b"1"}
    write(spark, base, [], "append")
    assert tree_of(base) == {"only/x": b"1"}


@pytest.mark.parametrize("bad", ["../x", "/abs", "a//b", "a/./b", "", None, "a\0"])
def test_unsafe_paths_write_nothing(spark, tmpdir_path, bad):
    write(spark, f"{tmpdir_path}/t", [(1, "m/a", "old")])
    with pytest.raises(Exception, match="not a relative file path"):
        write(spark, f"{tmpdir_path}/t", [(1, "m/new", "x"), (2, bad, "y")])
    assert tree_of(tmpdir_path) == {"t/m/a": b"old"}


def test_failed_and_repeated_attempts_leave_nothing(tmpdir_path):
    def rows(n, fail=False):
        yield pa.RecordBatch.from_pydict({"path": [f"m{i}/s" for i in range(n)], "content": [b"%d" % n] * n})
        if fail:
            raise RuntimeError("executor lost")

    base = f"{tmpdir_path}/t"
    w = TR.NamedFilesWriter(base, False)
    with pytest.raises(RuntimeError):
        w.write(rows(5, fail=True))  # killed after it wrote files
    lost = w.write(rows(4))  # a speculative copy whose result Spark does not take
    kept = w.write(rows(3))
    w.commit([kept, None])
    assert lost.files == 4 and tree_of(tmpdir_path) == {f"t/m{i}/s": b"3" for i in range(3)}
    w = TR.NamedFilesWriter(base, True)
    w.write(rows(9))
    w.abort([])
    assert set(tree_of(tmpdir_path)) == {f"t/m{i}/s" for i in range(3)} and os.listdir(tmpdir_path) == ["t"]


def test_a_failing_job_keeps_the_old_tree(spark, tmpdir_path):
    write(spark, f"{tmpdir_path}/t", [(1, "m/a", "old")])
    df = spark.range(0, 200, 1, 4).select(F.col("id").alias("seq"), F.concat(F.lit("m/"), F.col("id").cast("string")).alias("path"),
                                          F.when(F.col("id") == 150, F.raise_error(F.lit("boom")).cast("string")).otherwise("x").alias("body"))
    with pytest.raises(Exception, match="boom"):
        TR.write_named_files(df, f"{tmpdir_path}/t", F.col("path"), F.col("body"), "seq")
    assert tree_of(tmpdir_path) == {"t/m/a": b"old"}


def test_listing_reads_no_content_and_reading_packs_files(spark, tmpdir_path):
    base = f"{tmpdir_path}/t"
    write(spark, base, [(i, f"f{i % 7}/d{i % 3}/s{i}.bin", "x" * i) for i in range(120)])
    files = TR.list_files(spark, base, ".bin")
    assert "content" not in files.columns and files.agg(F.sum("length")).first()[0] == sum(range(120))
    assert TR.list_files(spark, f"{tmpdir_path}/nothing").count() == 0
    few = TR.read_files(files, base, task_bytes=10 * TR.OPEN_BYTES)
    parts = few.groupBy(F.spark_partition_id()).count().collect()
    assert 10 <= len(parts) <= 14 and max(r["count"] for r in parts) <= 30
    assert {(r["name"], len(r["content"]), r["error"]) for r in few.collect()} == {(f"s{i}.bin", i, None) for i in range(120)}


def catalog(spark):
    return spark.createDataFrame([("O Papa Lali", "Solo / Lullaby"), ("Gone", "Solo / Lullaby"), ("A Folder", "Duet / Folk"), ("Never", "X"), (None, "X"), ("O Papa Lali", "Solo / Lullaby")],
                                 "song_name string, category string")


def test_upload_outcomes_and_table_agree(spark, tmpdir_path, monkeypatch):
    base, path = f"{tmpdir_path}/audio", IO.derived_audio_path("category", "song_name")
    write(spark, base, [(1, "Solo_-_Lullaby/O_Papa_Lali.wav", "RIFF"), (2, "Solo_-_Lullaby/Gone.wav", "x"), (3, "Duet_-_Folk/A_Folder.wav", "y"), (4, "other/unused.wav", "z")])
    listed = TR.list_files(spark, base).cache()
    assert listed.count() == 4
    monkeypatch.setattr(TR, "list_files", lambda *a: listed)
    # between listing and reading one file goes and one can no longer be read
    os.remove(f"{base}/Solo_-_Lullaby/Gone.wav")
    os.remove(f"{base}/Duet_-_Folk/A_Folder.wav")
    os.makedirs(f"{base}/Duet_-_Folk/A_Folder.wav")
    rows = catalog(spark).withColumns({"a b": F.lit(1), "content": F.lit(2)}).drop("content")
    got = {(r["song_name"], r["outcome"], bytes(r["content"] or b""), r["error"] == "not found") for r in IO.attach_files(rows, base, path).collect()}
    assert got == {("O Papa Lali", "uploaded", b"RIFF", False), ("Gone", "failed", b"", True), ("A Folder", "failed", b"", False), ("Never", "missing", b"", False), (None, "missing", b"", False)}
    report = {r["outcome"]: r["n"] for r in IO.upload_files(rows, base, path, f"{tmpdir_path}/table").collect()}
    assert report == {"uploaded": 2, "failed": 2, "missing": 2}
    table = spark.read.parquet(f"{tmpdir_path}/table").collect()
    assert len(table) == report["uploaded"] and all(bytes(r["content"]) == b"RIFF" and r["a b"] == 1 for r in table)


def test_lyrics_files_by_exact_name_are_ingested(spark, tmpdir_path):
    res = spark.createDataFrame([(1, "Song A", "Movie X", "found", "u", "...  one"), (2, "Song A!", "Movie X", "found", "u", "...two"), (3, "B", "Y", "missing", None, None)],
                                "song_id long, song_name string, movie string, outcome string, url string, lyrics string")
    L.write_lyrics_files(res, f"{tmpdir_path}/t", exact=True)
    assert set(tree_of(f"{tmpdir_path}/t")) == {"Movie_X/Song_A.txt"}
    L.ingest_text_tree(spark, f"{tmpdir_path}/t", f"{tmpdir_path}/songs")
    assert [tuple(r) for r in spark.read.parquet(f"{tmpdir_path}/songs").collect()] == [("Movie_X", "Song_A", "two")]


def test_row_index_is_gapless_in_order(spark):
    df = spark.range(0, 5000, 1, 7).select(F.pmod(F.xxhash64("id"), F.lit(11)).alias("g"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"), "id")
    rows = N.with_row_index(df, "g", F.desc("id"), name="n", start=3).collect()
    assert sorted(r["n"] for r in rows) == list(range(3, 5003))
    ordered = sorted(rows, key=lambda r: r["n"])
    assert [(r["g"], -r["id"]) for r in ordered] == sorted((r["g"], -r["id"]) for r in rows)
    assert N.with_row_index(df.limit(0), "g").count() == 0
    total = 0
    for r in sorted(N.with_running_sum(df, "v", "id").collect(), key=lambda r: r["id"]):
        assert r["running"] == total
        total += r["v"] or 0
    p = N.with_row_index(df, "id")._jdf.queryExecution().toString()
    assert "Window" not in p and "SinglePartition" not in p


def test_csv_headers_in_another_order(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/c")
    for name, text in (("a", "movie,song\nM1,S1\n"), ("b", 'song,movie\n"S ""2""\nx",M2\n'), ("c", "movie,song\nM3,\n"), ("empty", "")):
        with open(f"{tmpdir_path}/c/{name}.csv", "w", encoding="utf-8") as f:
            f.write(text)
    with pytest.raises(Exception):
        IO.read_csv(spark, f"{tmpdir_path}/c", "movie string, song string").collect()
    got = {tuple(r) for r in IO.read_csv(spark, f"{tmpdir_path}/c", "movie string, song string", mixed_headers=True).collect()}
    assert got == {("M1", "S1"), ("M2", 'S "2"\nx'), ("M3", None)}


def test_csv_with_unnamed_row_index(spark, tmpdir_path):
    df = spark.createDataFrame([(5, "b", " x"), (1, "a", None), (3, "a", "y,z")], "seq int, m string, t string")
    IO.write_csv(df, f"{tmpdir_path}/c", columns=["t", "m"], index_order=["m", "seq"])
    back = IO.read_csv(spark, f"{tmpdir_path}/c", "_c0 long, m string, t string", index_col="row_id")
    assert sorted(tuple(r) for r in back.collect()) == [(0, "a", None), (1, "a", "y,z"), (2, "b", " x")]
