import os

import pytest

from textsieve import patterns as P
from textsieve.streaming import incremental as INC


def _write(base, movie, song, body):
    os.makedirs(os.path.join(base, movie), exist_ok=True)
    with open(os.path.join(base, movie, song + ".txt"), "w", encoding="utf-8") as f:
        f.write(body)


def test_stream_ingest_appends_once(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    table = os.path.join(tmpdir_path, "songs")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    _write(landing, "MovieA", "Song1", "Song: x\n...\n lyrics one")
    q = INC.stream_text_tree_ingest(spark, landing, table, checkpoint=ckpt)
    q.awaitTermination()
    _write(landing, "MovieA", "Song2", "plain two ")
    _write(landing, "MovieB", "Song1", "three")
    q = INC.stream_text_tree_ingest(spark, landing, table, checkpoint=ckpt)
    q.awaitTermination()
    rows = sorted(tuple(r) for r in spark.read.parquet(table).collect())
    assert rows == [("MovieA", "Song1", "lyrics one"), ("MovieA", "Song2", "plain two"), ("MovieB", "Song1", "three")]
    # a fresh checkpoint replays every file; the key anti-join appends nothing
    q = INC.stream_text_tree_ingest(spark, landing, table, checkpoint=ckpt + "2")
    q.awaitTermination()
    assert spark.read.parquet(table).count() == 3


def test_stream_quality_gate(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "docs")
    words = " ".join("w" + chr(97 + i % 26) + chr(97 + i // 26) for i in range(40))
    spark.createDataFrame([(1, words), (2, "too short")], "doc_id long, text string").write.parquet(src)
    out = os.path.join(tmpdir_path, "clean")
    q = INC.stream_quality_gate(spark, src, out, "doc_id long, text string", script=P.LATIN, density_chars="w",
                                checkpoint=os.path.join(tmpdir_path, "ck"))
    q.awaitTermination()
    got = spark.read.parquet(out).collect()
    assert [r["doc_id"] for r in got] == [1] and got[0]["word_count"] == 40


def test_stream_restart_loses_nothing(spark, tmpdir_path):
    src, out, ckpt = (os.path.join(tmpdir_path, x) for x in ("docs", "clean", "ck"))
    words = " ".join("w" + chr(97 + i % 26) + chr(97 + i // 26) for i in range(40))
    for first in (0, 100):
        spark.range(first, first + 50).selectExpr("id AS doc_id", f"'{words}' AS text").write.mode("append").parquet(src)
        INC.stream_quality_gate(spark, src, out, "doc_id long, text string", script=P.LATIN, density_chars="w", checkpoint=ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 100
    with pytest.raises(TypeError):  # the checkpoint belongs to the sink and must be named
        INC.stream_quality_gate(spark, src, out, "doc_id long, text string")


def test_stream_ingest_extract_song_parser(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    table = os.path.join(tmpdir_path, "songs")
    _write(landing, "MovieC", "page1", "song:\nPata\ntelugu\nఅమ్మ\nనాన్న\nEnglish")
    q = INC.stream_text_tree_ingest(spark, landing, table, parser="extract_song",
                                    checkpoint=os.path.join(tmpdir_path, "ck"))
    q.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(table).collect()] == [("MovieC", "Pata", "అమ్మ\nనాన్న")]
