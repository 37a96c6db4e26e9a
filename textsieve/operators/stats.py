"""Corpus statistics: profile, exact quantiles, histograms, KDE, formatted means.

Scale notes
-----------
* Every statistic first collapses rows to ``(column, value, count)`` with a
  partial + final hash aggregate, so a value that holds a third of all rows is
  one row after the map-side combine.
* Exact quantiles are found by radix selection.  A double's bits, with the lower
  ones of negative numbers flipped, sort as the doubles do; a pass is one hash
  aggregate over all columns that counts the values by their next ``BITS`` bits,
  below the prefixes that hold a requested rank.  Four passes fix all 64 bits,
  and a prefix with few distinct values is read at once instead.  Nothing is
  sorted, joined or windowed, and the driver sees at most 2^BITS counts per
  requested rank and pass.
* Multi-pass statistics read the source once: the value-count table is written
  as Parquet in ``spark.checkpoint.dir`` (when the statistic is called, lineage
  cut) and every later pass scans that table instead of re-running the
  upstream text pipeline.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsieve import patterns as P
from textsieve.session import write_scratch

#: bits that a pass of the selection tells apart, and distinct values that are read at once
BITS, READ_VALUES = 16, 4096
DESCRIBE_STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def _long_values(df: DataFrame, cols) -> DataFrame:
    """(name, v) for every non-null value of every column in ``cols``."""
    pairs = [F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in cols]
    return df.select(F.explode(F.array(*pairs)).alias("_r")).select("_r.name", "_r.v").where(F.col("v").isNotNull())


def value_counts(df: DataFrame, cols, materialize: bool = True) -> DataFrame:
    """(name, v, cnt): distinct values per column with multiplicity (written: and key, see ``sort_key``).

    With ``materialize`` the table is written below the checkpoint directory
    so the several passes of a statistic do not recompute the source."""
    vc = _long_values(df, cols).groupBy("name", "v").agg(F.count(F.lit(1)).alias("cnt"))
    return write_scratch(_keyed(vc), "value-counts") if materialize else vc


def sort_key(v: Column) -> Column:
    """A long that orders as the double does (-0.0 as 0.0, NaN last)."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), v + F.lit(0.0)).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def _buckets(vc: DataFrame, done: int, bits: int, prefixes: list[tuple[str, int]] | None) -> pd.DataFrame:
    """Counts of the values by their first ``done + bits`` bits, of all or of those with one of the prefixes (name, first ``done`` bits)."""
    rows = vc
    if prefixes is not None:
        rows = rows.where(reduce(Column.__or__, [(F.col("name") == n) & (F.shiftright("key", 64 - done) == p) for n, p in prefixes]))
    out = (rows.groupBy("name", F.shiftright("key", 64 - done - bits).alias("prefix"))
           .agg(F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("distinct"), F.sum(F.col("v") * F.col("cnt")).alias("sum"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    return out.toPandas().sort_values(["name", "prefix"], ignore_index=True)


def _keyed(vc: DataFrame) -> DataFrame:
    return vc if "key" in vc.columns else vc.withColumn("key", sort_key(F.col("v")))


def order_statistics(vc: DataFrame, ranks: dict[str, list[int]], first: pd.DataFrame, bits: int = BITS, most: int = READ_VALUES) -> dict[tuple[str, int], float]:
    """The values at the given ranks (from 0) of each column; ``first`` is the first pass over the value-count table."""
    out: dict[tuple[str, int], float] = {}
    todo = [(name, k, k, None) for name, ks in ranks.items() for k in ks]  # column, rank, rank in the prefix, prefix
    done, step, table = 0, min(bits, 64), first
    while todo:
        small, open_ = [], []
        for (name, up), part in _by_parent(table, step, done):
            ends = part["n"].cumsum().to_numpy()
            for t in [t for t in todo if t[0] == name and (t[3] is None or t[3] == up)]:
                i = int(np.searchsorted(ends, t[2], "right"))
                row, within = part.iloc[i], t[2] - (int(ends[i - 1]) if i else 0)
                if row["lo"] == row["hi"] or row["distinct"] == 1:
                    out[t[0], t[1]] = float(row["lo"])
                else:
                    (small if row["distinct"] <= most else open_).append((name, t[1], within, int(row["prefix"])))
        done += step
        if small:  # a bounded number of values per rank
            found = vc.where(reduce(Column.__or__, [(F.col("name") == n) & (F.shiftright("key", 64 - done) == p) for n, p in {(t[0], t[3]) for t in small}]))
            values = found.select("name", F.shiftright("key", 64 - done).alias("prefix"), "key", "v", "cnt").toPandas().sort_values("key")
            for (name, up), part in values.groupby(["name", "prefix"]):
                ends = part["cnt"].cumsum().to_numpy()
                for t in [t for t in small if t[0] == name and t[3] == up]:
                    out[name, t[1]] = float(part["v"].iloc[int(np.searchsorted(ends, t[2], "right"))])
        todo = open_
        if todo:
            step = min(bits, 64 - done)
            table = _buckets(vc, done, step, sorted({(t[0], t[3]) for t in todo}))
    return out


def _by_parent(table: pd.DataFrame, step: int, done: int):
    """The rows of a pass by column and the prefix that they refine."""
    up = table["prefix"] // (1 << step) if done else table["prefix"] * 0
    return ((key, part.reset_index(drop=True)) for key, part in table.groupby([table["name"], up.rename("up")]))


def _quantiles(vc: DataFrame, probs, first: pd.DataFrame, bits: int = BITS, most: int = READ_VALUES) -> list[tuple[str, float, float]]:
    """(column, p, value): x[floor h] + (x[ceil h] - x[floor h]) * (h - floor h) at h = (n - 1) * p."""
    at = {(name, p): (int(n) - 1) * p for name, n in first.groupby("name")["n"].sum().items() for p in map(float, probs)}
    ranks: dict[str, set[int]] = {}
    for (name, _), h in at.items():
        ranks.setdefault(name, set()).update((math.floor(h), math.ceil(h)))
    x = order_statistics(vc, {n: sorted(k) for n, k in ranks.items()}, first, bits, most)
    return [(name, p, x[name, math.floor(h)] + (x[name, math.ceil(h)] - x[name, math.floor(h)]) * (h - math.floor(h))) for (name, p), h in at.items()]


def quantiles_from_counts(vc: DataFrame, probs, buckets: int = 1 << BITS, most: int = READ_VALUES) -> DataFrame:
    """(name, p, value) linear-interpolated quantiles from a value-count table; a pass tells ``buckets`` (a power of two) apart."""
    bits, keyed = max(1, math.ceil(math.log2(buckets))), _keyed(vc)
    rows = _quantiles(keyed, probs, _buckets(keyed, 0, bits, None), bits, most)
    return vc.sparkSession.createDataFrame(rows, "name string, p double, value double")


def exact_quantiles(df: DataFrame, cols, probs, buckets: int = 1 << BITS) -> DataFrame:
    return quantiles_from_counts(value_counts(df, cols), probs, buckets)


def moments_from_counts(vc: DataFrame) -> DataFrame:
    """(name, n, mean, std, min, max) with a two-pass (stable) sample variance."""
    first = vc.groupBy("name").agg(
        F.sum("cnt").alias("n"),
        (F.sum(F.col("v") * F.col("cnt")) / F.sum("cnt")).alias("mean"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    ss = (
        vc.join(F.broadcast(first.select("name", "mean")), "name")
        .groupBy("name")
        .agg(F.sum(F.col("cnt") * (F.col("v") - F.col("mean")) * (F.col("v") - F.col("mean"))).alias("ss"))
    )
    return first.join(ss, "name").select(
        "name", "n", "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("ss") / (F.col("n") - 1))).alias("std"),
        "min", "max",
    )


def profile(df: DataFrame, cols, digits: int | None = None) -> DataFrame:
    """``describe()``-style profile: one row per statistic, one column per input
    column (count, mean, sample std, min, 25/50/75 % linear, max).  Columns
    without values have count 0 and NULL statistics.  ``digits`` rounds."""
    vc = value_counts(df, cols)
    first = _buckets(vc, 0, BITS, None)
    by = first.groupby("name").agg(n=("n", "sum"), sum=("sum", "sum"), lo=("lo", "min"), hi=("hi", "max"))
    stats = {(name, stat): float(v) for name, r in by.iterrows() for stat, v in (("count", r["n"]), ("mean", r["sum"] / r["n"]), ("min", r["lo"]), ("max", r["hi"]))}
    # two-pass sample variance
    mean = reduce(lambda e, n: F.when(F.col("name") == n, F.lit(stats[n, "mean"])).otherwise(e), by.index, F.lit(0.0))
    squares = vc.groupBy("name").agg(F.sum(F.col("cnt") * (F.col("v") - mean) * (F.col("v") - mean)).alias("ss")).collect()
    stats |= {(r["name"], "std"): math.sqrt(r["ss"] / (by["n"][r["name"]] - 1)) for r in squares if by["n"][r["name"]] > 1}
    stats |= {(name, f"{int(p * 100)}%"): v for name, p, v in _quantiles(vc, [0.25, 0.5, 0.75], first)}
    rows = [(s, *[stats.get((c, s), 0.0 if s == "count" else None) for c in cols]) for s in DESCRIBE_STATS]
    schema = T.StructType([T.StructField("stat", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in cols]])
    out = df.sparkSession.createDataFrame(rows, schema).coalesce(1)
    return out if digits is None else out.select("stat", *[F.round(F.col(f"`{c}`"), digits).alias(c) for c in cols])


def with_bin_index(df: DataFrame, v: Column, lo: Column, hi: Column, n: Column, out: str = "bin",
                   keep=()) -> DataFrame:
    """Adds the 1-based bin of v in ``n`` equal bins over [lo, hi], last bin closed.

    Same arithmetic as numpy.histogram: a scaled index corrected against the
    linspace edges (edge_i = i * step + lo, last edge = hi).  Each step is its
    own projection so the expression tree stays linear in size.
    """
    step = (hi - lo) / n

    def edge(i):
        return F.when(i == n, hi).otherwise(i * step + lo)

    i = F.col("_bi")
    return (
        df.select(v.alias("_bv"), *keep)
        .withColumn("_bi", F.floor(((F.col("_bv") - lo) / (hi - lo)) * n))
        .withColumn("_bi", F.when(i == n, n - 1).otherwise(i))
        .withColumn("_bi", F.when(F.col("_bv") < edge(i), i - 1).otherwise(i))
        .withColumn("_bi", F.when((F.col("_bv") >= edge(i + 1)) & (i != n - 1), i + 1).otherwise(i))
        .select((F.col("_bi") + 1).alias(out), *keep)
    )


def _range_struct(vc: DataFrame) -> Column:
    """Scalar subquery struct(lo, hi, cnt) over a value-count table, with
    numpy's widening of a degenerate range."""
    st = vc.agg(F.min("v").alias("mn"), F.max("v").alias("mx"), F.sum("cnt").alias("cnt"))
    st = st.select(F.struct(
        F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.coalesce("mn", F.lit(0.0))).alias("lo"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.coalesce("mx", F.lit(1.0))).alias("hi"),
        F.col("cnt").alias("cnt"),
    ))
    return st.scalar()


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """(bin, bin_lo, bin_hi, n) for ``bins`` equal-width bins over [min, max],
    empty bins included; same bin edges and assignment as numpy.histogram
    (no value at all: the range is [0, 1])."""
    return histogram_from_counts(value_counts(df.select(col), [col]), bins)


def histogram_from_counts(vc: DataFrame, nbins: int) -> DataFrame:
    spark = vc.sparkSession
    n = F.lit(nbins)
    # The range is a scalar subquery; project it once per side and read fields
    # from the column, so it is evaluated once instead of once per reference.
    r = F.col("_r")
    binned = with_bin_index(vc.select("v", "cnt", _range_struct(vc).alias("_r")), F.col("v"), r["lo"], r["hi"], n,
                            keep=["cnt", "_r"])
    counts = binned.groupBy("bin").agg(F.sum("cnt").alias("n"))
    scaffold = spark.range(1, nbins + 1).select(F.col("id").alias("bin"), _range_struct(vc).alias("_r"))
    step = (r["hi"] - r["lo"]) / n
    return scaffold.join(counts, "bin", "left").select(
        "bin",
        ((F.col("bin") - 1) * step + r["lo"]).alias("bin_lo"),
        F.when(F.col("bin") == n, r["hi"]).otherwise(F.col("bin") * step + r["lo"]).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
    )


def auto_bin_count(df: DataFrame, col: str) -> int:
    """numpy ``bins='auto'`` (numpy >= 2.1): width = min(max(FD, sqrt / 2), Sturges)
    with FD = 2 IQR n^(-1/3), Sturges = range / (log2 n + 1), sqrt = range / sqrt n;
    bins = ceil(range / width), 1 for a zero width.  The sqrt floor bounds the
    bin count by 2 sqrt(n).

    Returns a single number (an aggregate of bounded size) to the driver.
    """
    return _auto_bins(value_counts(df.select(col), [col]))


def _auto_bins(vc: DataFrame) -> int:
    vc = _keyed(vc)
    first = _buckets(vc, 0, BITS, None)
    if first.empty:
        return 1
    n, mn, mx = int(first["n"].sum()), float(first["lo"].min()), float(first["hi"].max())
    low, high = (v for *_, v in _quantiles(vc, [0.25, 0.75], first))
    iqr = high - low
    lo, hi = (mn - 0.5, mx + 0.5) if mn == mx else (mn, mx)
    sturges = (mx - mn) / (math.log2(n) + 1.0)
    fd = 2.0 * iqr * n ** (-1.0 / 3.0)
    sqrt_w = (mx - mn) / math.sqrt(n)
    width = min(max(fd, sqrt_w / 2), sturges)
    return int(math.ceil((hi - lo) / width)) if width else 1


def auto_histogram(df: DataFrame, col: str) -> DataFrame:
    """Histogram with numpy's automatic bin count."""
    vc = value_counts(df.select(col), [col])
    return histogram_from_counts(vc, _auto_bins(vc))


def gaussian_kde(df: DataFrame, col: str, grid: int = P.KDE_GRID, digits: int | None = None) -> DataFrame:
    """(point, x, density): Gaussian KDE with Scott's bandwidth
    (sample std * n^(-1/5)) on ``grid`` evenly spaced points from min to max.

    Duplicate values are pre-aggregated; a task then sums the kernels of its
    values in Arrow batches and puts out one row per grid point.  (One Spark
    aggregate with a sum per grid point was measured too: 26 s against 8 s
    here at sf0.01, its generated code is too large to be compiled.)  Values
    without variance (none, one, or all equal) have no curve: no rows.
    ``digits`` rounds."""
    vc = value_counts(df.select(col), [col])
    mom = moments_from_counts(vc).select(F.struct(
        "n", "min", "max", (F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("bw")
    ))
    # Subqueries cannot appear inside lambdas, and each reference would run the
    # subquery again: project the scalar struct once, then read its fields.
    base = vc.select("v", "cnt", mom.scalar().alias("_s")).select(
        "v", "cnt", F.col("_s.min").alias("lo"), F.col("_s.max").alias("hi"), F.col("_s.n").alias("n"),
        F.col("_s.bw").alias("bw")).where("bw > 0")

    def sums(batches):
        """One row per grid point and task: the kernel sums of the task's values."""
        total = head = None
        for b in batches:
            if not b.num_rows:
                continue
            v, cnt = b.column("v").to_numpy(), b.column("cnt").to_numpy()
            if total is None:
                head = {c: b.column(c)[0].as_py() for c in ("lo", "hi", "n", "bw")}
                x = np.arange(grid) * ((head["hi"] - head["lo"]) / (grid - 1)) + head["lo"]
                x[-1] = head["hi"]
                total = np.zeros(grid)
            for i in range(0, len(v), 4096):
                z = (x[:, None] - v[None, i:i + 4096]) / head["bw"]
                total += np.exp(-0.5 * z * z) @ cnt[i:i + 4096]
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(1, grid + 1)), pa.array(x), pa.array(total), pa.array(np.full(grid, head["n"], np.int64)),
                 pa.array(np.full(grid, head["bw"], np.float64))], names=["point", "x", "w", "n", "bw"])

    out = base.mapInArrow(sums, "point long, x double, w double, n long, bw double").groupBy("point", "x", "n", "bw").agg(F.sum("w").alias("w"))
    density, x = F.col("w") / (F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi))), F.col("x")
    if digits is not None:
        density, x = F.round(density, digits), F.round(x, digits)
    return out.select("point", x.alias("x"), density.alias("density"))


def formatted_mean(df: DataFrame, col: str, name: str = "mean", fmt: str = "%.2f") -> DataFrame:
    return df.agg(F.format_string(fmt, F.avg(F.col(col))).alias(name))
