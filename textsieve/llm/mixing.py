"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Token counts of (source, language, topic) cells are raked until the marginals
of every dimension meet their targets as far as the cells can: no cell is given
more tokens than it has, a value that is asked for more than it has gives all it
has, and the rest is spread over the dimension's other values by their targets.
``report`` returns what was asked for, there and reached.  A document is kept with the probability that its cell's raked tokens
imply, by a hash of its id, so a run repeats exactly and lost tasks draw the
same again.

Counts cover all documents and every value of a dimension is raked by itself,
however many there are.  The cells are a written table; up to ``DRIVER_CELLS``
of them the driver rakes, more are raked by the same steps as written tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch, column, table, whole_row

DIMENSIONS = ("source", "lang", "topic")
#: cells that the driver rakes at most
DRIVER_CELLS = 50_000
ROUNDS, TOLERANCE = 500, 1e-9
NONE = "(none)"
#: share of all tokens to keep, and the exponent that tempers natural shares where no targets are given
KEEP, TEMPER = 0.8, 0.7
SEED = 17


def form_topic():
    """A coarse topic by form, from the counts of ``counted``: table, list, short, long or prose."""
    n = F.col("n_tokens")
    return (F.when(F.col("n_bars") * 10 > n, "table").when((F.col("n_lines") > 10) & (F.col("n_lines") * 4 > n), "list")
            .when(n < 50, "short").when(n >= 1000, "long").otherwise("prose"))


def counted(rows: DataFrame) -> DataFrame:
    """``text`` replaced by n_tokens (words between ASCII white space), n_bars (| and tabs) and n_lines; null texts are empty."""
    keep = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*keep, *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_bars", "n_lines")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pc.fill_null(b.column("text"), "")
            words = pc.list_value_length(pc.ascii_split_whitespace(pc.ascii_trim_whitespace(text)))
            words = pc.if_else(pc.equal(pc.binary_length(pc.ascii_trim_whitespace(text)), 0), 0, words)
            count = lambda x: pc.cast(pc.count_substring(text, x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in keep], pc.cast(words, pa.int64()), pc.add(count("|"), count("\t")), pc.add(count("\n"), 1)],
                names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def capped(shares: np.ndarray, have: np.ndarray, total: float) -> np.ndarray:
    """``total`` dealt by shares, none over what it has: what full values cannot take goes to the others by their shares."""
    out, full = np.zeros(len(shares)), np.zeros(len(shares), bool)
    while True:
        open_ = np.where(full, 0.0, shares)
        if not open_.sum():
            return out
        out = np.where(full, have, open_ / open_.sum() * (total - have[full].sum()))
        over = ~full & (shares > 0) & (out >= have)
        if not over.any():
            return out
        full |= over
        out = np.where(full, have, 0.0)


def rake(tokens: np.ndarray, codes: np.ndarray, targets: list[np.ndarray], total: float, rounds: int = ROUNDS,
         tolerance: float = TOLERANCE) -> np.ndarray:
    """Tokens to take of each cell: marginals proportional to the targets as far as the cells' tokens allow.

    tokens: of each cell; codes[d]: the cells' category in dimension d;
    targets[d]: shares of its categories; total: tokens to take.
    """
    want = [capped(t, np.bincount(c, tokens, len(t)), total) for t, c in zip(targets, codes)]
    w = tokens.astype(float) * (total / max(tokens.sum(), 1))
    for _ in range(rounds):
        last = w
        for code, goal in zip(codes, want):
            have = np.bincount(code, w, len(goal))
            w = w * np.divide(goal, have, out=np.ones_like(goal), where=have > 0)[code]
            w = np.minimum(w, tokens)
        if np.abs(w - last).max(initial=0.0) <= tolerance * max(total, 1.0):
            break
    return w


def rake_table(cells: DataFrame, goals: dict[str, DataFrame], total: float, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``rake`` for any number of cells: the written table with the column w.

    goals: (value, goal) of each dimension, in tokens.  A step joins the
    marginals' factors, one row per value, with the cells; both are written.
    """
    scratch = Scratch(cells.sparkSession)
    have = cells.agg(F.sum("tokens")).first()[0] or 0
    w, name = scratch.put("raked", cells.withColumn("w", F.col("tokens") * F.lit(float(total / max(have, 1))))), "raked"
    for i in range(rounds):
        w = w.withColumn("last", F.col("w"))
        for d, goal in goals.items():
            marginal = w.groupBy(F.col(d).alias("value")).agg(F.sum("w").alias("have")).join(goal, "value")
            factor = F.when(F.col("have") > 0, F.col("goal") / F.col("have")).otherwise(1.0)
            factors = scratch.put(f"factors{i}-{d}", marginal.select("value", factor.alias("factor")))
            step = w.join(factors, F.col(d) == F.col("value")).withColumn("w", F.least(F.col("w") * F.col("factor"), F.col("tokens").cast("double")))
            w = scratch.put(f"raked{i}-{d}", step.select(*cells.columns, "w", "last"))
            scratch.drop(name, f"factors{i}-{d}")
            name = f"raked{i}-{d}"
        if (w.agg(F.max(F.abs(F.col("w") - F.col("last")))).first()[0] or 0.0) <= tolerance * max(total, 1.0):
            break
    return w.drop("last")


def _by_driver(cells: DataFrame, targets, keep: float, temper: float) -> DataFrame:
    """(s, l, t, probability) of at most ``DRIVER_CELLS`` cells."""
    rows = cells.orderBy(*DIMENSIONS).toPandas()
    tokens = rows["tokens"].to_numpy(float)
    codes, goals = [], []
    for d in DIMENSIONS:
        names, code = np.unique(rows[d].to_numpy(str), return_inverse=True)
        natural = np.bincount(code, tokens, len(names))
        goal = np.array([targets[d].get(x, 0.0) for x in names], float) if targets and d in targets else natural ** temper
        codes.append(code)
        goals.append(goal if goal.sum() > 0 else np.ones(len(names)))
    w = rake(tokens, codes, goals, keep * tokens.sum())
    rows["probability"] = np.divide(w, tokens, out=np.ones_like(w), where=tokens > 0)
    return cells.sparkSession.createDataFrame(
        [(*map(str, r[:3]), float(r[3])) for r in rows[[*DIMENSIONS, "probability"]].itertuples(index=False)],
        "s string, l string, t string, probability double")


def _by_tables(cells: DataFrame, targets, keep: float, temper: float, scratch: Scratch) -> DataFrame:
    """(s, l, t, probability) of any number of cells."""
    total = keep * (cells.agg(F.sum("tokens")).first()[0] or 0)
    goals = {}
    for d in DIMENSIONS:
        values = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").cast("double").alias("n"))
        if targets and d in targets:
            asked = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in targets[d].items()], "name string, share double")
            values = values.join(asked, F.col("value") == F.col("name"), "left").select("value", "n", F.coalesce("share", F.lit(0.0)).alias("share"))
        else:
            values = values.select("value", "n", F.pow("n", F.lit(float(temper))).alias("share"))
        values = scratch.put(f"shares-{d}", values)
        whole = values.agg(F.sum("share")).first()[0]
        goals[d] = _capped_goals(values if whole else values.withColumn("share", F.lit(1.0)), total, f"goals-{d}", scratch)
    share = F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(1.0)
    return rake_table(cells, goals, total).select(*[F.col(d).alias(x) for d, x in zip(DIMENSIONS, "slt")], share.alias("probability"))


def _capped_goals(values: DataFrame, total: float, name: str, scratch: Scratch) -> DataFrame:
    """``capped`` for any number of values: (value, goal) of a table (value, share, n); each step is one aggregate and a written table."""
    values, last = scratch.put(f"{name}-0", values.withColumn("full", F.lit(False))), f"{name}-0"
    for i in range(1, 100):
        row = values.agg(F.sum(F.when(~F.col("full"), F.col("share"))), F.sum(F.when(F.col("full"), F.col("n")))).first()
        factor = (total - (row[1] or 0.0)) / row[0] if row[0] else 0.0
        over = ~F.col("full") & (F.col("share") > 0) & (F.col("share") * factor >= F.col("n"))
        if not row[0] or not values.filter(over).limit(1).count():
            break
        values = scratch.put(f"{name}-{i}", values.withColumn("full", F.col("full") | over))
        scratch.drop(last)
        last = f"{name}-{i}"
    return values.select("value", F.when(F.col("full"), F.col("n")).otherwise(F.col("share") * factor).alias("goal"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", topic=None, targets: dict[str, dict[str, float]] | None = None,
        keep: float = KEEP, temper: float = TEMPER, seed: int = SEED, carry: bool = False) -> DataFrame:
    """Every row with its cell, tokens, probability, draw and whether it is kept.

    Columns: id, source, lang, topic, n_tokens, probability, draw, kept, and on
    request row (all input columns).  A dimension without targets aims at its
    natural shares to the power ``temper``; target categories that do not occur
    are ignored and occurring ones without a target get none.  Null categories
    are the category "(none)".  The draw is a hash of the id, or of the text
    where the id is null.  Cells without tokens are kept whole, and so are
    documents without words in them; repeated rows share one draw; an empty
    table gives no rows.
    """
    own = [whole_row(docs).alias("row")] if carry else []
    given = [topic.cast("string").alias("given")] if topic is not None else []
    rows = counted(docs.select(
        column(id_col).cast("long").alias("id"), F.coalesce(column(id_col).cast("long"), F.xxhash64(column(text_col).cast("string"))).alias("drawn"),
        column(text_col).cast("string").alias("text"),
        *[F.coalesce(F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string"), F.lit(NONE)).alias(c) for c in ("source", "lang")],
        *given, *own))
    rows = rows.withColumn("topic", F.coalesce(F.col("given") if given else form_topic(), F.lit(NONE)))
    rows = rows.select("id", "drawn", "n_tokens", *DIMENSIONS, *(["row"] if carry else []))
    scratch = Scratch(docs.sparkSession)
    counts = scratch.put("counted", rows.drop("row"))  # every text is read once for its counts
    cells = scratch.put("cells", counts.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")))
    if cells.count() <= DRIVER_CELLS:
        cell = F.broadcast(_by_driver(cells, targets, keep, temper))
    else:
        cell = _by_tables(cells, targets, keep, temper, scratch)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("drawn")), F.lit(1 << 53)) / F.lit(float(1 << 53))
    out = (rows if carry else counts).join(cell, (F.col("source") == F.col("s")) & (F.col("lang") == F.col("l")) & (F.col("topic") == F.col("t")))
    return out.select(
        "id", *DIMENSIONS, "n_tokens", "probability", draw.alias("draw"), (draw < F.col("probability")).alias("kept"), *(["row"] if carry else []))


def report(mixed: DataFrame, targets: dict[str, dict[str, float]] | None = None, keep: float = KEEP, temper: float = TEMPER) -> DataFrame:
    """(dimension, value, asked, available, expected, kept): tokens per value of what ``mix`` returned with these parameters.

    ``expected`` is what the probabilities give, ``kept`` what the draw kept; a
    value that has less than it was asked for shows in ``available``.
    """
    values = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in DIMENSIONS])).alias("v")
    rows = (mixed.select(values, "n_tokens", "probability", "kept").groupBy("v.dimension", "v.value")
            .agg(F.sum("n_tokens").alias("available"), F.sum(F.col("n_tokens") * F.col("probability")).alias("expected"),
                 F.sum(F.when(F.col("kept"), F.col("n_tokens")).otherwise(0)).alias("kept")))
    given = [(d, v, float(x)) for d, of in (targets or {}).items() for v, x in of.items()]
    asked = mixed.sparkSession.createDataFrame(given, "d string, x string, share double")
    rows = rows.join(asked, (F.col("dimension") == F.col("d")) & (F.col("value") == F.col("x")), "left")
    share = F.when(F.col("dimension").isin(list(targets or {})), F.coalesce("share", F.lit(0.0))).otherwise(F.pow(F.col("available").cast("double"), F.lit(float(temper))))
    whole = rows.groupBy("dimension").agg(F.sum(share).alias("shares"), (F.sum("available") * F.lit(keep)).alias("total"))
    return rows.join(F.broadcast(whole), "dimension").select(  # three rows
        "dimension", "value", (share / F.col("shares") * F.col("total")).alias("asked"), "available", "expected", "kept")


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
