"""Vectors as rows of equal length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch


def _checked(df: DataFrame, id_col: str, vec_col: str, kind: str) -> tuple[DataFrame, int]:
    """(id, v, good), with usable vectors filled up to the dimension, and the dimension."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{kind}>").alias("v"))
    good = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("good", good)
    dim = rows.filter("good").agg(F.max(F.size("v"))).first()[0] or 0
    padded = F.when(F.col("good") & (F.size("v") < dim), F.concat("v", F.array_repeat(F.lit(0.0).cast(kind), F.lit(dim) - F.size("v")))).otherwise(F.col("v"))
    return rows.withColumn("v", padded), dim


def split_vectors(df: DataFrame, id_col: str, vec_col: str, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """(id, v) of usable vectors, (id) of the others, and the dimension.

    Null vectors, and vectors that are zero or hold null or non-finite
    components, are not usable.  Shorter vectors are as if zeros followed.
    """
    rows, dim = _checked(df, id_col, vec_col, "double")
    usable = scratch.put("vectors", rows.filter("good").select("id", "v"))
    return usable, rows.filter("not good").select("id"), dim


def packed_vectors(df: DataFrame, id_col: str, vec_col: str, scratch: Scratch) -> tuple[DataFrame, DataFrame, int, str]:
    """``split_vectors`` with vectors as bytes: (id, digest, h, v) of the usable ones, (id) of the others, the dimension,
    and the type of the components (single precision stays so, all else is double).

    ``digest`` (128 bits) is the same for equal vectors only; ``h`` is 63 bits of it.
    """
    element = getattr(df.select(F.col(vec_col).alias("v")).schema["v"].dataType, "elementType", None)
    kind = "float" if isinstance(element, T.FloatType) else "double"
    rows, dim = _checked(df, id_col, vec_col, kind)
    numpy_kind = np.dtype(np.float32 if kind == "float" else np.float64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = dim * numpy_kind.itemsize
        for b in batches:
            if b.num_rows:
                raw = (matrix(b.column("v"), dim) + numpy_kind.type(0)).tobytes()  # -0.0 becomes 0.0
                digests = [hashlib.blake2b(raw[i:i + width], digest_size=16).digest() for i in range(0, len(raw), width)]
                h = np.frombuffer(b"".join(digests), np.uint64)[::2] >> np.uint64(1)
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(digests, pa.binary()), pa.array(h.astype(np.int64)), binary_array(raw, width)],
                                                 names=["id", "digest", "h", "v"])

    packed = rows.filter("good").select("id", "v").mapInArrow(pack, "id long, digest binary, h long, v binary")
    return scratch.put("vectors", packed), rows.filter("not good").select("id"), dim, numpy_kind.name


def binary_array(raw: bytes, width: int) -> pa.Array:
    """Bytes as binary values of one width."""
    n = len(raw) // width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(width)), pa.py_buffer(raw)])


def packed_matrix(col: pa.Array, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(-1, dim).astype(float)


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dim)
