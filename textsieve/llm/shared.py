"""Shared pieces: input shaping, scratch tables in the cluster's shared folder."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsieve.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, which may hold dots, spaces and quotes."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns of a frame as one struct, so that no name of theirs can clash; ``select("row.*")`` gives them back."""
    return F.struct(*[column(c) for c in df.columns]) if df.columns else F.lit(None)


def fields(ddl: str, **more: T.DataType) -> T.StructType:
    """A schema from plain DDL and further fields of given types (whose names DDL might not hold)."""
    return T.StructType([*T.StructType.fromDDL(ddl).fields, *[T.StructField(n, t) for n, t in more.items()]])


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) only, so that extra input columns can never clash with internal names."""
    return df.select(column(id_col).cast("long").alias("id"), column(text_col).cast("string").alias("text"))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table this run has written (any Hadoop file system)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Written intermediate tables: they cut lineage and survive lost executors.

    ``put`` writes a frame as Parquet under ``spark.checkpoint.dir`` and reads
    it back; ``drop`` deletes tables that no later read needs.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.paths.pop(name, None)
            if path:
                with contextlib.suppress(Exception):  # a leftover scratch table is harmless
                    delete_path(self.spark, path)
