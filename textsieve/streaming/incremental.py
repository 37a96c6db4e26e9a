"""Structured Streaming forms of the incremental steps.

* ``stream_text_tree_ingest``: new ``<movie>/<song>.txt`` files landing in a
  directory are parsed and appended to the songs table.  Each micro-batch is
  appended with a key anti-join (``foreachBatch``), so a replayed batch after a
  failure appends nothing twice.
* ``stream_quality_gate``: new Parquet document files flow through the
  metrics + gate + features pass into a Parquet sink (stateless, append).

The checkpoint location is a required argument: it belongs to the stream's
sink for as long as that lives, so that a restarted stream goes on where it
stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textsieve import patterns as P
from textsieve.functions import structure as ST
from textsieve.operators import quality as Q
from textsieve.sources import files as IO


def _parsed_tree_stream(spark: SparkSession, landing_dir: str, parser: str, script: P.Script) -> DataFrame:
    raw = (
        spark.readStream.option("maxFilesPerTrigger", 1000)
        .text(f"{landing_dir.rstrip('/')}/*/*.txt", wholetext=True)
        .select(IO.decode_spark_path(F.col("_metadata.file_path")).alias("path"), "value")
    )
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    content = F.replace(F.replace(F.col("value"), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    base = raw.select(F.element_at(parts, -2).alias("movie_name"), F.left(name, F.length(name) - 4).alias("file_song"),
                      content.alias("content"))
    if parser == "after_marker":
        return base.select("movie_name", F.col("file_song").alias("song_name"),
                           ST.after_marker("content").alias("lyrics"))
    parsed = base.select("movie_name", ST.extract_song("content", script).alias("s"))
    return parsed.select("movie_name", "s.song_name", "s.lyrics")


def stream_text_tree_ingest(spark: SparkSession, landing_dir: str, table_path: str, parser: str = "after_marker",
                            script: P.Script = P.TELUGU, *, checkpoint: str,
                            available_now: bool = True) -> StreamingQuery:
    keys = ["movie_name", "song_name"]

    def upsert(batch: DataFrame, batch_id: int) -> None:
        IO.append_new(batch.sparkSession, batch, table_path, keys)

    writer = (
        _parsed_tree_stream(spark, landing_dir, parser, script).writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def stream_quality_gate(spark: SparkSession, source_dir: str, out_dir: str, schema, id_col: str = "doc_id",
                        text_col: str = "text", script: P.Script = P.TELUGU,
                        density_chars: str = P.TELUGU_DENSITY_CHARS, *, checkpoint: str) -> StreamingQuery:
    docs = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(source_dir)
    clean = Q.clean_corpus(docs, id_col, text_col, script, density_chars)
    return (
        clean.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out_dir)
    )
