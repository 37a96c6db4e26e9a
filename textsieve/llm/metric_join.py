"""Embedding near-duplicates: an exact metric range join.

Cosine >= c is a Euclidean distance of at most r = sqrt(2 - 2c) between unit
vectors.  Pivots partition the vectors: a vector is at home in the cell of its
nearest pivot.  It is also a guest of every cell that may be home to a vector
within r.  By the triangle inequality that needs d(x, pivot) <= d(x, own
pivot) + 2r and d(x, pivot) <= radius of the cell + r.

Every vector is written once, in blocks: neighbouring cells together, large
cells in parts.  A block is one row, at most ``BLOCK_BYTES`` of vectors.  Each
pair of blocks that can hold links is read from that table by one task, which
compares the homes of each cell with its guests.  The pairs are a cartesian
product of the table with itself, so no vector is copied for another block and
nothing of this step is shuffled; disk grows with the input, not with its
square.  Equal vectors are one row of a block with a multiplicity; the ids come
in at the end.  A pair of blocks puts out one count per linked vector and a
spanning forest of its links, never the pairs.  Where vectors have no clusters
every cell borders on every other; the comparisons are then quadratic.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components
from .shared import Scratch, table
from .vectors import packed_matrix, packed_vectors

#: vectors per pivot, most pivots, and vectors that pivots are chosen from (smallest digests, about so many)
PER_PIVOT, MAX_PIVOTS, PIVOT_SAMPLE = 2048, 256, 4096
#: blocks of a table that fits in so many, most bytes of a block's vectors, least vectors of a block, and guests that are compared at once
BLOCKS, BLOCK_BYTES, HOMES, GUESTS = 16, 8 << 20, 1024, 2048
#: cosines this close are a tie, which the first pivot wins; slack for distances that only prune (they are rounded; cosines are verified)
TIE, SLACK = 1e-12, 1e-5
#: slack of single precision, which only preselects
SINGLE = 1e-4


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the square
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _sample(packed: DataFrame, n: int, dim: int, kind: str) -> np.ndarray:
    """Unit vectors of the smallest digests, about PIVOT_SAMPLE different ones."""
    least = packed.filter(F.col("h") <= int(min(1.0, PIVOT_SAMPLE / n) * (2**63 - 1))) if n > PIVOT_SAMPLE else packed
    rows = least.groupBy("digest").agg(F.first("v").alias("v")).orderBy("digest").limit(2 * PIVOT_SAMPLE).collect()
    return _unit(np.array([np.frombuffer(r["v"], kind) for r in rows], float).reshape(-1, dim))


def choose_pivots(x: np.ndarray, n: int) -> np.ndarray:
    """Pivots far from each other, from a sample of n vectors."""
    picked, far = [0], np.full(len(x), np.inf)
    while len(picked) < min(max(1, math.ceil(n / PER_PIVOT)), MAX_PIVOTS, len(x)):
        far = np.minimum(far, ((x - x[picked[-1]]) ** 2).sum(axis=1))
        picked.append(int(far.argmax()))
    return x[picked]


def leading_axes(x: np.ndarray, cosine: float) -> np.ndarray | None:
    """Orthonormal axes, strongest first, on which a cosine is bounded most cheaply: what they miss of two
    vectors adds at most the product of its lengths.  None: all components are compared.

    The number of axes only decides about time; it comes from pairs of the sample.
    """
    dim = x.shape[1]
    if not 16 <= dim <= 2048 or len(x) < 256:
        return None
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    few, full = x[:512], x[:512] @ x.T
    best, cost = None, 0.75 + 0.028 * dim  # nanoseconds a pair, as measured; 100 for a pair that is verified in vain
    for k in (7, 15, 23, 31, 47, 63, 95, 127, 191, 255, 383, 511):
        if k < dim:
            y = x @ axes[:, :k]
            rest = np.sqrt(np.maximum(1 - (y * y).sum(axis=1), 0))
            vain = ((y[:512] @ y.T + np.outer(rest[:512], rest) >= cosine - SINGLE) & (full < cosine)).sum() / (len(few) * len(x))
            if (now := 0.75 + 0.028 * (k + 1) + 100 * vain) < cost:
                best, cost = np.ascontiguousarray(axes[:, :k]), now
    return best


def _distance(cos: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cos, 0))


def _own(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot (the first of those that tie, so equal vectors always have the same) and the distance to it."""
    cos = x @ pivots.T
    own = (cos >= cos.max(axis=1, keepdims=True) - TIE).argmax(axis=1)
    return own, _distance(cos[np.arange(len(x)), own])


def _homes(pivots: np.ndarray, dim: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own, d = _own(_unit(packed_matrix(b.column("v"), dim, kind)), pivots)
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(d), b.column("h")], names=["cell", "d", "h"])

    return run


def _layout(pivots: np.ndarray, size: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First block and number of blocks of each cell, and the number of all: neighbouring cells share a block up to
    ``rows`` vectors, larger cells have blocks of their own."""
    left, order = list(range(len(pivots))), [0]
    left.remove(0)
    while left:
        order.append(min(left, key=lambda c: ((pivots[c] - pivots[order[-1]]) ** 2).sum()))
        left.remove(order[-1])
    first, parts, block, held = np.zeros(len(pivots), np.int64), np.ones(len(pivots), np.int64), 0, 0
    for c in order:
        if held and held + size[c] > rows:
            block, held = block + 1, 0
        first[c], parts[c] = block, max(1, math.ceil(size[c] / rows))
        block, held = (block + parts[c], 0) if parts[c] > 1 else (block, held + size[c])
    return first, parts, int((first + parts).max())


def _touching(pivots: np.ndarray, radius: np.ndarray, first: np.ndarray, parts: np.ndarray, n: int, r: float) -> list[list[int]]:
    """For each block the blocks from it on that may hold vectors within r of its own."""
    near = _distance(pivots @ pivots.T) <= radius[:, None] + radius + r + SLACK
    touch = [{b} for b in range(n)]
    for i, j in zip(*np.nonzero(near | np.eye(len(pivots), dtype=bool)), strict=True):
        for a in range(first[i], first[i] + parts[i]):
            touch[a].update(b for b in range(first[j], first[j] + parts[j]) if b >= a)
    return [sorted(map(int, t)) for t in touch]


def _deal(pivots: np.ndarray, first: np.ndarray, parts: np.ndarray, dim: int, kind: str):
    """Every vector to its block; those that are equal within a batch as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            digests = np.array(b.column("digest").to_pylist(), "S16")  # compared as 16 bytes each; ends of zeros make no difference
            at, of, mult = np.unique(digests, return_index=True, return_inverse=True, return_counts=True)[1:]
            ids = np.full(len(at), np.iinfo(np.int64).max)
            own_id = b.column("id").is_valid().to_numpy(zero_copy_only=False)
            np.minimum.at(ids, of[own_id], b.column("id").fill_null(0).to_numpy()[own_id])
            named = np.zeros(len(at), bool)
            named[of[own_id]] = True
            v = b.column("v").take(pa.array(at))
            cell, _ = _own(_unit(packed_matrix(v, dim, kind)), pivots)
            block = first[cell] + b.column("h").to_numpy()[at] % parts[cell]
            yield pa.RecordBatch.from_arrays([
                pa.array(block.astype(np.int32)), pa.array(cell.astype(np.int32)), b.column("digest").take(pa.array(at)),
                pa.array(ids, mask=~named), pa.array(mult.astype(np.int64)), v],
                names=["block", "cell", "digest", "id", "mult", "v"])

    return run


def _pack(touch: list[list[int]]):
    """One row for each block: its vectors by cell, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, dict[bytes, list]] = {}
        for b in batches:
            for block, cell, digest, i, mult, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (x := blocks.setdefault(block, {}).get(digest)) is None:
                    blocks[block][digest] = [cell, digest, i, mult, v]
                else:
                    x[2] = i if x[2] is None else x[2] if i is None else min(i, x[2])
                    x[3] += mult
        for block, held in blocks.items():
            cell, digest, i, mult, v = zip(*sorted(held.values(), key=lambda x: x[:2]), strict=True)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block], pa.int32()), "touch": pa.array([touch[block]], pa.list_(pa.int32())), "digest": [list(digest)],
                "id": pa.array([i], pa.list_(pa.int64())), "mults": pa.array([mult], pa.list_(pa.int64())),
                "cell": [np.array(cell, np.int32).tobytes()], "mult": [np.array(mult, np.int64).tobytes()], "v": [b"".join(v)]})

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, label) pairs that connect exactly what the links (a, b) connect, at most one per node."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _at_least(x: np.ndarray, least: float, near: np.ndarray) -> np.ndarray:
    """Where x >= least, by eight at a time, as that is rare.  ``near`` is room for the comparison."""
    near[len(x) & -8:len(x) + -len(x) % 8] = False
    np.greater_equal(x, np.float32(least), out=near[:len(x)])
    eights = np.flatnonzero(near[:len(x) + -len(x) % 8].view(np.uint64))
    at = (eights[:, None] * 8 + np.arange(8)).ravel()
    return at[near[at]]


class _Block:
    """The vectors of a block: units, their cells (each a range of rows), and what single precision compares."""

    def __init__(self, block: int, cell: pa.Buffer, mult: pa.Buffer, v: pa.Buffer, dim: int, kind: str, pivots: np.ndarray, axes: np.ndarray | None):
        self.x = _unit(np.frombuffer(v, kind).reshape(-1, dim).astype(float))
        self.key, self.mult = (block << 32) + np.arange(len(self.x)), np.frombuffer(mult, np.int64).astype(float)
        cells = np.frombuffer(cell, np.int32)
        self.cells, self.start = np.unique(cells, return_index=True)
        self.end = np.append(self.start[1:], len(cells))
        self.d = _distance((self.x * pivots[cells]).sum(axis=1))
        self.radius = np.maximum.reduceat(self.d, self.start)
        self.x32 = self.x.astype(np.float32)
        self.short = self.x32
        if axes is not None:
            y = self.x @ axes
            self.short = np.column_stack([y, np.sqrt(np.maximum(1 - (y * y).sum(axis=1), 0))]).astype(np.float32)

    def visits(self, other: _Block, pivots: np.ndarray, r: float) -> np.ndarray:
        """Which cells of another block a vector visits (its own one too)."""
        d = _distance(self.x @ pivots[other.cells].T)
        return (d <= self.d[:, None] + 2 * r + SLACK) & (d <= other.radius + r + SLACK)


def _links(a: _Block, b: _Block, cosine: float, pivots: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of links of the vectors of two blocks (of a block with itself: of its vectors, and none), and a forest."""
    same, count_a, fa, fb, held = a is b, np.zeros(len(a.x)), [], [], 0
    count_b = count_a if same else np.zeros(len(b.x))
    homes, guests = a.visits(b, pivots, r).any(axis=1), b.visits(a, pivots, r)
    out, near, step = np.empty(512 * GUESTS, np.float32), np.zeros(512 * GUESTS, bool), max(1, (1 << 21) // a.x.shape[1])
    for c in range(len(a.cells)):
        rows, cols = a.start[c] + np.flatnonzero(homes[a.start[c]:a.end[c]]), np.flatnonzero(guests[:, c])
        if same:
            cols = cols[cols >= a.start[c]]  # each pair once
        home, guest = a.short[rows], b.short[cols]
        for s in range(0, len(rows), 512):
            for t in range(0, len(cols), GUESTS):
                x, y = home[s:s + 512], guest[t:t + GUESTS]
                cos = np.matmul(x, y.T, out=out[:len(x) * len(y)].reshape(len(x), len(y)))
                at = _at_least(cos.ravel(), cosine - SINGLE, near)
                if not len(at):
                    continue
                p, q = rows[s:s + 512], cols[t:t + GUESTS]
                if a.short is not a.x32 and len(at) > cos.size // 64:
                    at = _at_least(np.matmul(a.x32[p], b.x32[q].T, out=cos).ravel(), cosine - SINGLE, near)
                for k in range(0, len(at), step):
                    u, v = np.divmod(at[k:k + step], len(q))
                    ok = (a.x[p[u]] * b.x[q[v]]).sum(axis=1) >= cosine
                    if same:
                        ok &= p[u] < q[v]
                    u, v = u[ok], v[ok]
                    count_a[p] += np.bincount(u, b.mult[q[v]], len(p))
                    count_b[q] += np.bincount(v, a.mult[p[u]], len(q))
                    u, v = _forest(a.key[p[u]], b.key[q[v]])
                    fa.append(u), fb.append(v)
                    held += len(u)
                if held > 4 * (len(a.x) + len(b.x)):
                    fa, fb = ([f] for f in _forest(np.concatenate(fa), np.concatenate(fb)))
                    held = len(fa[0])
    none = np.zeros(0, np.int64)
    return (count_a.astype(np.int64), none if same else count_b.astype(np.int64), *_forest(np.concatenate([none, *fa]), np.concatenate([none, *fb])))


def _compare(cosine: float, dim: int, kind: str, pivots: np.ndarray, axes: np.ndarray | None, r: float):
    """Links of pairs of blocks: a count per linked vector, and a forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, _Block] = {}  # the last pair's
        for batch in batches:
            for at in range(batch.num_rows):
                pair = [batch.column(f"block{i}")[at].as_py() for i in (0, 1)]
                kept = {n: x for n, x in kept.items() if n in pair}
                for i, n in enumerate(pair):
                    if n not in kept:
                        kept[n] = _Block(n, *(batch.column(f"{c}{i}")[at].as_buffer() for c in ("cell", "mult", "v")), dim, kind, pivots, axes)
                a, b = kept[pair[0]], kept[pair[1]]
                n, m, u, v = _links(a, b, cosine, pivots, r)
                p, q = np.flatnonzero(n), np.flatnonzero(m)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (
                    (a.key[p], b.key[q], u), (n[p], m[q], np.zeros(len(u), np.int64)), (a.key[p], b.key[q], v))], names=["key", "links", "to"])

    return run


@contextlib.contextmanager
def _rows_one_by_one(spark: SparkSession):
    """Python gets a row at a time, as each is two blocks (Spark 4.0 counts rows of a batch, not their bytes)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """(id, n_links, component, kept): one row per input row.

    Links are pairs of rows of cosine >= ``cosine`` in double precision.
    Unusable vectors (see ``split_vectors``) link with nothing.  ``component``
    is the smallest id reachable, ``kept`` marks it.  Equal vectors are linked;
    repeated rows (equal ids too) count as other vectors of their group, and so
    do different vectors of one id.  Null ids link like others: ``component`` is
    the smallest id that is not null, or null if the group has none, and a null
    id is kept only there; rows of an id in several groups keep their own
    group's values.  ``kept`` marks all rows of a group with its smallest id.
    An empty table gives no rows; extra columns are ignored.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    packed, rest, dim, kind = packed_vectors(df, id_col, vec_col, scratch)
    alone = rest.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"), F.lit(True).alias("kept"))
    n = packed.agg(F.approx_count_distinct("h")).first()[0]  # sizes only: what it misses makes blocks larger or smaller
    if not n:
        return alone
    r = math.sqrt(max(2 - 2 * cosine, 0.0))
    sample = _sample(packed, n, dim, kind)
    pivots, axes = choose_pivots(sample, n), leading_axes(sample, cosine)
    stats = {row["cell"]: row for row in packed.select("h", "v").mapInArrow(_homes(pivots, dim, kind), "cell int, d double, h long")
             .groupBy("cell").agg(F.approx_count_distinct("h").alias("n"), F.max("d").alias("radius")).collect()}  # one row per pivot
    size, radius = (np.array([stats[c][k] if c in stats else x for c in range(len(pivots))]) for k, x in (("n", 0), ("radius", -np.inf)))
    rows = max(1, min(max(HOMES, math.ceil(n / BLOCKS)), BLOCK_BYTES // (dim * np.dtype(kind).itemsize)))
    first, parts, n_blocks = _layout(pivots, size, rows)
    touch = _touching(pivots, radius, first, parts, n_blocks, r)
    dealt = packed.mapInArrow(_deal(pivots, first, parts, dim, kind), "block int, cell int, digest binary, id long, mult long, v binary")
    # most files hold a single block
    blocks = scratch.put("blocks", dealt.repartition(4 * n_blocks, "block").mapInArrow(
        _pack(touch), "block int, touch array<int>, digest array<binary>, id array<long>, mults array<long>, cell binary, mult binary, v binary"))
    ids = scratch.put("ids", packed.select("id", "digest"))
    scratch.drop("vectors")
    a, b = (blocks.select(*more, *[F.col(c).alias(f"{c}{i}") for c in ("block", "cell", "mult", "v")]) for i, more in enumerate((["touch"], [])))
    pairs = a.join(b.hint("shuffle_replicate_nl"), F.array_contains("touch", F.col("block1"))).drop("touch")  # read pair by pair, not shuffled
    with _rows_one_by_one(spark):
        found = scratch.put("found", pairs.mapInArrow(_compare(cosine, dim, kind, pivots, axes, r), "key long, links long, to long"))
    counts = scratch.put("counts", found.groupBy(F.col("key").alias("ckey")).agg(F.sum("links").alias("links")))
    comp = scratch.put("components", connected_components(found.filter("key <> to"), "key", "to"))
    each = blocks.select("block", F.posexplode(F.arrays_zip("digest", "id", "mults")).alias("at", "x"))
    distinct = each.select((F.shiftleft(F.col("block").cast("long"), 32) + F.col("at")).alias("key"), "x.digest", "x.id", F.col("x.mults").alias("mult"))
    classes = (distinct.join(counts, F.col("key") == F.col("ckey"), "left").join(comp, F.col("key") == F.col("node"), "left")
               .select("digest", "id", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("root", "key").alias("root")))
    classes = scratch.put("classes", classes)
    scratch.drop("blocks", "found", "counts", "components")
    least = scratch.put("least", classes.groupBy(F.col("root").alias("top")).agg(F.min("id").alias("component")))
    # once each, also if rounding ever dealt copies of a vector to two blocks (they are linked then, so their values agree)
    named = (classes.join(least, F.col("root") == F.col("top")).groupBy(F.col("digest").alias("named"))
             .agg(F.max("n_links").alias("n_links"), F.min("component").alias("component")))
    named = scratch.put("named", named)
    out = ids.join(named, F.col("digest") == F.col("named")).select("id", "n_links", "component", F.col("id").eqNullSafe(F.col("component")).alias("kept"))
    return out.unionByName(alone)


def op4_embeddings(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "embeddings"))
    return out.withColumnRenamed("id", "vec_id").withColumnRenamed("component", "component_id")
