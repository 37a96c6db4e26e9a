import os
import zipfile

import pytest
from pyspark.sql import functions as F

from textsieve.sources import catalog as CAT
from textsieve.sources import files as IO

PENDING_SCHEMA = "_c0 INT, song_name STRING, movie_album STRING, singers STRING"
ROWS = [
    (1, "Vaana Chinuku - BGM", "Megham - BGM", " Singer One"),
    (2, "Paata Paata", "Kotha Kadha", " Singer Two,  Singer Three"),
    (3, 'He said ""hi""', "Movie, With Comma", None),
    (4, "Line\nbreak", "A / B", ""),
]


def test_csv_roundtrip_with_index_quotes_newlines_spaces(spark, tmpdir_path):
    df = spark.createDataFrame(ROWS, PENDING_SCHEMA)
    path = os.path.join(tmpdir_path, "pending")
    IO.write_csv(df, path)
    back = IO.read_csv(spark, path, PENDING_SCHEMA, index_col="row_id")
    assert back.columns == ["row_id", "song_name", "movie_album", "singers"]
    # an empty field reads back as NULL (as a pandas reader gives NaN)
    exp = [tuple(None if v == "" else v for v in r) for r in ROWS]
    assert sorted(tuple(r) for r in back.collect()) == sorted(exp)


def test_text_tree_write_and_read(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "tree")
    for movie, song, body in [("Movie A", "Song 1", "a\r\nb"), ("Movie+B", "Song%2", "x...\n  body")]:
        os.makedirs(os.path.join(base, movie), exist_ok=True)
        with open(os.path.join(base, movie, song + ".txt"), "w", encoding="utf-8", newline="") as f:
            f.write(body)
    got = {(r["movie_name"], r["song_name"]): r["content"] for r in IO.read_text_tree(spark, base).collect()}
    assert got == {("Movie A", "Song 1"): "a\nb", ("Movie+B", "Song%2"): "x...\n  body"}


def test_write_text_tree_last_write_wins(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "Ee Velalo", "M 1", "first"), (2, "Ee Velalo!", "M 1", "second")],
                               "seq int, song string, movie string, lyrics string")
    base = os.path.join(tmpdir_path, "out")
    body = IO.lyrics_file_body(F.col("song"), F.col("movie"), F.lit("src"), F.lit("u"), F.col("lyrics"))
    IO.write_text_tree(df, base, "movie", "song", body, "seq")
    back = spark.read.text(base, wholetext=True).collect()
    assert len(back) == 1 and back[0]["value"] == "Song: Ee Velalo!\nMovie: M 1\nSource: src\nURL: u\n\nsecond\n"
    assert back[0]["movie_slug"] == "M_1" and back[0]["song_slug"] == "Ee_Velalo"


def test_binary_files_attach_audio_and_report(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "audio")
    os.makedirs(os.path.join(base, "Solo_-_Lullaby"))
    with open(os.path.join(base, "Solo_-_Lullaby", "O_Papa_Lali.wav"), "wb") as f:
        f.write(b"RIFF")
    cat = CAT.training_catalog(spark).where(F.col("song_name").isin("O Papa Lali", "Maate Raani"))
    files = IO.read_binary_files(spark, base, "*.wav")
    att = IO.attach_audio(cat, files, base)
    got = {r["song_name"]: r["content"] for r in att.collect()}
    assert got["O Papa Lali"] == bytearray(b"RIFF") and got["Maate Raani"] is None
    assert {r["status"]: r["n"] for r in IO.upload_report(att).collect()} == {"uploaded": 1, "missing": 1}


def test_zip_members(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("dir/x.txt", "hello")
        z.writestr("y.csv", "a,b\n1,2\n")
    arch = IO.read_binary_files(spark, tmpdir_path, "*.zip")
    got = {r["member"]: bytes(r["content"]) for r in IO.zip_members(arch).collect()}
    assert got == {"dir/x.txt": b"hello", "y.csv": b"a,b\n1,2\n"}


def test_append_new_is_idempotent(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "songs")
    df = spark.createDataFrame([("m", "a", "x"), ("m", "b", "y")], "movie_name string, song_name string, lyrics string")
    assert IO.append_new(spark, df, path, ["movie_name", "song_name"]) == 2
    more = spark.createDataFrame([("m", "b", "y"), ("m", "c", "z")], df.schema)
    assert IO.append_new(spark, more, path, ["movie_name", "song_name"]) == 1
    assert IO.append_new(spark, more, path, ["movie_name", "song_name"]) == 0
    assert spark.read.parquet(path).count() == 3


def test_append_new_replays_rows_with_null_keys(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "songs")
    rows = [("m", None, "x"), (None, None, "y"), ("m", "a", "z"), ("m", None, "later")]
    df = spark.createDataFrame(rows, "movie_name string, song_name string, lyrics string")
    assert [IO.append_new(spark, df, path, ["movie_name", "song_name"]) for _ in range(3)] == [3, 0, 0]
    assert sorted(r["lyrics"] for r in spark.read.parquet(path).collect()) == ["later", "y", "z"]


def test_append_new_leaves_an_unreadable_table_alone(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "songs")
    df = spark.createDataFrame([("m", "a")], "movie_name string, song_name string")
    IO.append_new(spark, df, path, ["movie_name", "song_name"])
    broken = os.path.join(path, "part-broken.parquet")
    with open(broken, "wb") as f:
        f.write(b"not a parquet file")
    before = sorted(os.listdir(path))
    with pytest.raises(Exception):
        IO.append_new(spark, spark.createDataFrame([("m", "b")], df.schema), path, ["movie_name", "song_name"])
    assert sorted(os.listdir(path)) == before


def test_csv_columns_are_bound_by_name(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "c")
    IO.write_csv(spark.createDataFrame([("M", "S", 3)], "movie string, song string, n int"), path)
    row = IO.read_csv(spark, path, "n long, song string, movie string").first()
    assert row.asDict() == {"n": 3, "song": "S", "movie": "M"}
    with pytest.raises(Exception):
        IO.read_csv(spark, path, "singer string").collect()


def test_lyrics_files_with_null_parts_and_empty_slugs(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "!!!", None, "words"), (2, "B", "M", None)], "seq int, song string, movie string, lyrics string")
    body = IO.lyrics_file_body("song", "movie", F.lit("src"), None, "lyrics")
    for per_song, read in ((True, lambda p: IO.read_slug_tree(spark, p)), (False, spark.read.parquet)):
        base = os.path.join(tmpdir_path, f"tree{per_song}")
        IO.write_text_tree(df, base, "movie", "song", body, "seq", per_song=per_song)
        got = {(r["movie_slug"], r["song_slug"]): r["content"] for r in read(base).collect()}
        assert got == {(IO.EMPTY_SLUG, IO.EMPTY_SLUG): "Song: !!!\nMovie: \nSource: src\n\nwords", ("M", "B"): "Song: B\nMovie: M\nSource: src\n\n"}


def test_training_catalog(spark):
    cat = CAT.training_catalog(spark)
    assert cat.count() == 40
    assert cat.columns == ["song_name", "movie_name", "category", "Downloaded", "Vocals_Extracted",
                           "DeReverbed", "Notes"]
    r = cat.first()
    assert (r["Downloaded"], r["Notes"]) == ("No", "")


def test_written_tree_reads_back_and_ingests(spark, tmpdir_path):
    from textsieve.functions import structure as ST

    df = spark.createDataFrame([(1, "Song A", "Movie X", "pallavi...\n  అమ్మ\nనాన్న")],
                               "seq int, song string, movie string, lyrics string")
    base = os.path.join(tmpdir_path, "tree2")
    body = IO.lyrics_file_body(F.col("song"), F.col("movie"), F.lit("src"), F.lit("u"), F.col("lyrics"))
    IO.write_text_tree(df, base, "movie", "song", body, "seq")
    back = IO.read_slug_tree(spark, base)
    row = back.select("movie_slug", "song_slug", ST.after_marker("content").alias("lyrics")).first()
    assert tuple(row) == ("Movie_X", "Song_A", "అమ్మ\nనాన్న")
