"""Tables by name: bucketed by a key digest, appended without moving the table, replaced by swapping.

A table keeps the 256-bit digest of its key columns in ``row_key`` and is
bucketed and sorted by it.  Null keys are equal to each other.  An append joins
the batch to the table on that column: the batch is shuffled to the table's
buckets, the table is read bucket by bucket without an exchange.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.operators.sets import key_digest, one_per_key
from textsieve.session import write_scratch

KEY = "row_key"


def _key_hex(keys) -> F.Column:
    return F.lower(F.hex(key_digest(*[F.col(k) for k in keys])))


def _save(rows: DataFrame, name: str, buckets: int) -> None:
    # one task per bucket, so a write adds one file to each
    rows.repartition(buckets, KEY).write.mode("append").format("parquet").bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(name)


def buckets_of(spark: SparkSession, name: str) -> int:
    """The number of buckets of a table; 0 if it is not bucketed by the key."""
    info = {r["col_name"].strip(): r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return int(info["Num Buckets"]) if info.get("Bucket Columns") == f"[`{KEY}`]" else 0


def replace_table(df: DataFrame, name: str, keys, buckets: int) -> None:
    """Create the table ``name`` from ``df``, or replace it.

    The rows are written to a table of another name, which then takes the
    name's place; if writing fails, the old table is as it was.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    staged, old = f"{name}_new_{mark}", f"{name}_old_{mark}"
    try:
        _save(df.withColumn(KEY, _key_hex(keys)), staged, buckets)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    replaced = spark.catalog.tableExists(name)
    if replaced:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        if replaced:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    if replaced:
        spark.sql(f"DROP TABLE {old}")


def read_named(spark: SparkSession, name: str, columns=None) -> DataFrame:
    """The table's rows without the key digest, or some of its columns."""
    return spark.table(name).select(*columns) if columns else spark.table(name).drop(KEY)


def new_rows(df: DataFrame, name: str, keys, order_col: str | None = None) -> DataFrame:
    """The rows of ``df`` whose key the table lacks, one per key (the first by ``order_col``, or the least by a digest), with ``row_key``."""
    digest = key_digest(*[F.col(k) for k in keys])
    one = one_per_key(df, digest, F.col(order_col) if order_col else None).withColumn(KEY, _key_hex(keys))
    # a merge join reads the table by its buckets
    return one.hint("merge").join(df.sparkSession.table(name).select(KEY), KEY, "left_anti").select(*df.columns, KEY)


def append_new_to(df: DataFrame, name: str, keys, order_col: str | None = None) -> int:
    """Append the rows of ``df`` whose key is not in the table yet; returns their number.  A repeated call adds nothing."""
    buckets = buckets_of(df.sparkSession, name)
    if not buckets:
        raise ValueError(f"{name} is not bucketed by {KEY}")
    columns = [c for c in df.sparkSession.table(name).columns if c != KEY]
    fresh = write_scratch(new_rows(df.select(*columns), name, keys, order_col), "append")
    _save(fresh, name, buckets)
    return fresh.count()
