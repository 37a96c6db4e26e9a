"""Table sources: Parquet scans with column pruning.

Text operators are CPU-bound (regex, arrays).  Where the caller knows that a
table has fewer splits than the job has cores (a few large row groups),
``spread`` deals its rows to that many partitions; by default nothing is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, columns=None, spread: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    return df.repartition(spread) if spread else df
