"""Set logic: normalized anti/semi joins, keep-first de-duplication, unions.

Scale notes
-----------
* Anti/semi joins are plain equi-joins; Spark (with AQE) picks broadcast when
  the runtime size of the key side is under the broadcast threshold and a
  sort-merge join otherwise.  No side is force-broadcast, because the
  extracted / processed key sets grow with the data.
* Key sides are not made distinct: repeated keys cannot change a semi or anti
  join, and an aggregate between the shuffle and the join would keep AQE from
  splitting a hot left-side key.
* Keep-first takes the least order per 256-bit key digest (hash aggregates with
  one fixed-width row per key and task) and joins the winners back by order
  and digest, so texts are neither sorted nor a shuffle key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textsieve import patterns as P
from textsieve.functions import text as T


def _key_fn(key: str) -> Callable[[Column], Column]:
    if key == "compat":
        return lambda c: T.normalize_key(c)
    if key == "slug":
        return lambda c: T.normalize_key(T.slug(c))
    raise ValueError(f"unknown key mode {key!r}")


def pending(catalog: DataFrame, done: DataFrame, catalog_col: str, done_col: str, key: str = "compat") -> DataFrame:
    """Catalog rows whose normalized name is not among the done names.

    ``key="compat"``: lower -> strip -> '_' to ' ' on both sides (a slugged
    file name therefore only matches a catalog name without punctuation);
    ``key="slug"`` slugs both sides first.  Left rows, including duplicates and
    all columns, are preserved.
    """
    fn = _key_fn(key)
    done_keys = done.select(fn(F.col(done_col)).alias("_k"))
    return catalog.withColumn("_k", fn(F.col(catalog_col))).join(done_keys, "_k", "left_anti").drop("_k")


def semi_lower(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """Distinct left values whose lower-case form is among the right's raw values."""
    vals = left.select(F.col(left_col).alias("value")).distinct()
    keys = right.select(F.col(right_col).alias("_r"))
    return vals.join(keys, F.lower(vals["value"]) == keys["_r"], "left_semi")


def anti_lower(right: DataFrame, right_col: str, matched: DataFrame, matched_col: str = "value") -> DataFrame:
    """Right rows whose raw value is not a lower-cased matched value."""
    keys = matched.select(F.lower(F.col(matched_col)).alias("_m"))
    return right.join(keys, right[right_col] == keys["_m"], "left_anti")


def key_digest(*cols: Column) -> Column:
    """256 bits of a key of any columns; nulls are equal to each other."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)]), {"ignoreNullFields": "false"}), 256))


def row_digest(df: DataFrame) -> Column:
    """128 bits of a whole row (maps as JSON)."""
    cols = [F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema.fields]
    cols = [F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c for f, c in zip(df.schema.fields, cols)]
    return F.concat(F.hex(F.xxhash64(F.lit(1), *cols)), F.lit("-"), F.hex(F.xxhash64(F.lit(2), *cols)))


def one_per_key(df: DataFrame, key: Column, order: Column | None = None, last: bool = False) -> DataFrame:
    """One row per ``key`` (a digest): the first in ``order`` (or the last), of equal ones the least by a digest of the row.

    The choice is made on fixed-width rows and joined back, so texts are neither
    sort nor shuffle keys; rows that repeat as a whole count once.
    """
    keyed = df.withColumns({"_d": key, "_row": row_digest(df)})
    best = (F.max if last else F.min)(F.struct(*([order.alias("o")] if order is not None else []), "_row"))
    small = keyed.groupBy("_d").agg(best.alias("_w")).select(F.col("_d").alias("_k"), F.col("_w._row").alias("_r"))
    kept = keyed.join(small, (F.col("_d") == F.col("_k")) & (F.col("_row") == F.col("_r")), "left_semi")
    copies = Window.partitionBy("_d", "_row").orderBy("_row")  # as the join has dealt the rows
    return kept.withColumn("_nth", F.row_number().over(copies)).filter("_nth = 1").drop("_d", "_row", "_nth")


def keep_first(df: DataFrame, key_col: str, order_col: str, key_fn: Callable[[Column], Column] | None = F.lower,
               drop_empty: bool = True, unique_order: bool = False) -> DataFrame:
    """One row per key: the row with the smallest ``order_col``; the survivor keeps
    its own casing and columns.  Empty / NULL keys are dropped (without
    ``drop_empty`` NULL is a key).  Of rows equal in key and order the least by a
    digest stays, once; a caller that knows that no two rows of a key are equal
    in ``order_col`` may say ``unique_order`` and saves that step."""
    k = key_fn(F.col(key_col)) if key_fn is not None else F.col(key_col)
    rows = df.where(T.non_empty(k)) if drop_empty else df
    digest = F.coalesce(F.unhex(F.sha2(k.cast("string"), 256)), F.lit(b""))
    if not unique_order:
        return one_per_key(rows, digest, F.col(order_col))
    keyed = rows.withColumn("_d", digest)
    first = keyed.groupBy("_d").agg(F.min(order_col).alias("_o")).select(F.col("_d").alias("_w"), "_o")
    return keyed.join(first, (F.col("_d") == F.col("_w")) & F.col(order_col).eqNullSafe(F.col("_o")), "left_semi").drop("_d")


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenate by column name, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def fallback_rows(primary: DataFrame, fallback: DataFrame, key_col: str, order_col: str) -> DataFrame:
    """Fallback rows with a non-empty key not already in ``primary`` (exact
    case) and not repeating an earlier fallback row's key."""
    fb = fallback.where(T.non_empty(F.col(key_col)))
    fb = fb.join(primary.select(key_col), key_col, "left_anti")
    return keep_first(fb, key_col, order_col, key_fn=None)


def fallback_union(primary: DataFrame, fallback: DataFrame, min_rows: int = P.FALLBACK_MIN_ROWS) -> DataFrame:
    """``primary`` plus ``fallback`` when primary has fewer than ``min_rows`` rows.

    The row count is a scalar subquery, so the condition is evaluated on the
    cluster and the plan stays lazy."""
    n = primary.select(F.count(F.lit(1))).scalar()
    return primary.unionByName(fallback.where(n < min_rows))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values; NULL is a value of its own (like pandas ``unique``)."""
    return df.select(col).distinct()
