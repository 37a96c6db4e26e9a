"""Approximate nearest neighbours by largest inner product: a vantage-point tree per shard.

Inner product becomes a metric by one more component: with M the greatest norm,
x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) have the squared distance
|q|^2 + M^2 - 2 q.x, so nearest means largest inner product.  Rows are dealt to
shards of bounded size; a task builds a shard's tree once and searches it for
one block of queries after another.  A subtree is skipped when the triangle inequality
puts it farther away than ``factor`` times the query's current k-th distance
(at first that among a bounded sample of all rows, the same for every shard):
factor one is exact, a smaller one prunes more.  How much recall a factor costs
depends on the vectors, so unless the caller names one, the smallest that
reaches ``TARGET`` on a bounded sample is taken.  Every row is indexed.

Scores of what is found are computed again on the original vectors by one
fixed order of summation, so equal vectors have equal scores and ties go to
the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch, table
from .vectors import matrix, split_vectors

SHARD_ROWS, QUERY_ROWS, LEAF = 4096, 1024, 64
#: factors tried, and the recall that the chosen one must reach on the sample: at most SAMPLE_ROWS rows and SAMPLE_QUERIES queries, by hash
FACTORS, TARGET = (0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9), 0.98
SAMPLE_ROWS, SAMPLE_QUERIES = 4096, 256
#: points of a shard that give every query a first k-th distance
PROBE = 512


class VpTree:
    """Nodes as (vantage point, near child, far child, distance ranges of the two); leaves as index arrays."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x = x
        self.leaf = leaf
        self.root = self._build(np.arange(len(x)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        # of a few candidates, the point whose distances spread most
        sample = self.x[rows[:: max(1, len(rows) // 32)]]
        tries = rows[:: max(1, len(rows) // 8)][:8]
        spread = [np.sqrt(((sample - self.x[t]) ** 2).sum(axis=1)).std() for t in tries]
        vp = int(tries[int(np.argmax(spread))])
        d = np.sqrt(((self.x[rows] - self.x[vp]) ** 2).sum(axis=1))
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        near, far = order[:half], order[half:]
        return (vp, self._build(rows[near]), self._build(rows[far]), (d[near[0]], d[near[-1]]), (d[far[0]], d[far[-1]]))


def kth_score(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th best score among some rows, a lower bound of that among more rows; -inf with fewer than k."""
    s = q @ x.T
    s[q_ids[:, None] == x_ids[None, :]] = -np.inf
    return np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] >= k else np.full(len(q), -np.inf)


class Search:
    """The k best rows of a shard, whose tree is given, for a block of queries."""

    def __init__(self, q: np.ndarray, q_ids: np.ndarray, tree: VpTree, x: np.ndarray, x_ids: np.ndarray, top_norm: float, k: int, factor: float,
                 least: np.ndarray | None = None):
        self.q, self.q_ids, self.tree, self.x, self.x_ids, self.k, self.factor = q, q_ids, tree, x, x_ids, k, factor
        self.bound = (q * q).sum(axis=1) + top_norm * top_norm
        self.lifted = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
        self.score = np.full((len(q), k), -np.inf)
        self.row = np.full((len(q), k), -1)
        self.seen = 0
        self.least = kth_score(q, q_ids, x[::max(1, len(x) // PROBE)], x_ids[::max(1, len(x) // PROBE)], k) if least is None else least
        self._walk(self.tree.root, np.arange(len(q)))

    def _tau(self, at: np.ndarray) -> np.ndarray:
        kth = np.maximum(self.score[at, -1], self.least[at])
        return np.sqrt(np.maximum(self.bound[at] - 2 * kth, 0))

    def _walk(self, node, at: np.ndarray) -> None:
        if not len(at):
            return
        if isinstance(node, np.ndarray):
            self._leaf(node, at)
            return
        vp, near, far, near_range, far_range = node
        d = np.sqrt(np.maximum(((self.lifted[at] - self.tree.x[vp]) ** 2).sum(axis=1), 0))
        for child, (low, high) in ((near, near_range), (far, far_range)):
            gap = np.maximum(np.maximum(d - high, low - d), 0)
            self._walk(child, at[gap <= self.factor * self._tau(at) + 1e-9])

    def _leaf(self, rows: np.ndarray, at: np.ndarray) -> None:
        self.seen += len(rows) * len(at)
        s = self.q[at] @ self.x[rows].T
        kth = np.maximum(self.score[at, -1], self.least[at])
        i, j = np.nonzero(s >= (kth - 1e-9 * (1 + np.abs(kth)))[:, None])
        i, j = at[i], rows[j]
        other = self.q_ids[i] != self.x_ids[j]
        i, j = i[other], j[other]
        if not len(i):
            return
        new = np.unique(i)
        score = np.concatenate([(self.q[i] * self.x[j]).sum(axis=1), self.score[new].ravel()])
        query = np.concatenate([i, np.repeat(new, self.k)])
        row = np.concatenate([j, self.row[new].ravel()])
        ids = np.where(row >= 0, self.x_ids[row], np.iinfo(np.int64).max)
        order = np.lexsort((ids, -score, query))
        query = query[order]
        first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
        nth = np.arange(len(query)) - np.repeat(first, np.diff(np.concatenate([first, [len(query)]])))
        keep = nth < self.k
        self.score[new] = score[order][keep].reshape(len(new), self.k)
        self.row[new] = row[order][keep].reshape(len(new), self.k)


def lifted_tree(x: np.ndarray, top_norm: float) -> VpTree:
    """The tree of rows in the space where inner product is a metric."""
    lift = np.sqrt(np.maximum(top_norm * top_norm - (x * x).sum(axis=1), 0))
    return VpTree(np.concatenate([x, lift[:, None]], axis=1))


def sample_of(df: DataFrame, most: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of at most ``most`` rows, those of the least hash."""
    rows = df.orderBy(F.xxhash64("key"), "key").limit(most).select("id", "v").collect()
    return np.array([r["id"] for r in rows], np.int64), np.array([r["v"] for r in rows], np.float64).reshape(len(rows), dim)


def calibrated_factor(sample: tuple, queries: tuple, top_norm: float, k: int) -> float:
    """The smallest of ``FACTORS`` whose recall among the sample's rows is ``TARGET`` (1 if none is)."""
    (ids, x), (q_ids, q) = sample, queries
    tree, least = lifted_tree(x, top_norm), kth_score(q, q_ids, x, ids, k)
    exact = Search(q, q_ids, tree, x, ids, top_norm, k, 1.0, least)
    there = exact.row >= 0
    for factor in FACTORS:
        low = np.where(there, exact.score, np.inf).min(axis=1, initial=np.inf)
        found = Search(q, q_ids, tree, x, ids, top_norm, k, factor, least)
        if (found.score >= low[:, None]).sum() >= TARGET * there.sum():  # as good as the k-th
            return factor
    return 1.0


def _bounded(sent, dim: int, k: int):
    """Queries with the k-th best score among the sample's rows, which no shard needs to go below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = sent.value
        for b in batches:
            if b.num_rows:
                least = np.concatenate([kth_score(matrix(p.column("v"), dim), p.column("id").to_numpy(), x, ids, k) for p in (b.slice(a, 512) for a in range(0, b.num_rows, 512))])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(least)], names=[*b.schema.names, "least"])

    return run


FOUND = "query_id long, vec_id long, key long, score double, scored long"


def _search(dim: int, top_norm: float, k: int, factor: float, query_rows: int):
    """Rows sorted by shard, each shard's own before its queries: a shard's tree is built once and searched by one block of queries after another."""
    def results(tree: VpTree | None, x: tuple, q: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids = np.concatenate([b.column("id").to_numpy() for b in q])
        s = Search(np.concatenate([matrix(b.column("v"), dim) for b in q]), ids, tree, x[0], x[1], top_norm, k, factor,
                   np.concatenate([b.column("least").to_numpy(zero_copy_only=False) for b in q]))
        i, n = np.nonzero(s.row >= 0)
        scored = np.zeros(len(i), np.int64)
        scored[:1] = s.seen  # of this block, once
        return pa.RecordBatch.from_arrays([pa.array(s.q_ids[i]), pa.array(x[1][s.row[i, n]]), pa.array(x[2][s.row[i, n]]), pa.array(s.score[i, n]), pa.array(scored)],
                                          names=["query_id", "vec_id", "key", "score", "scored"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, own, held, tree, x = None, [], [], None, None
        for b in batches:
            sh, is_query = b.column("shard").to_numpy(), b.column("query").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((sh[1:] != sh[:-1]) | (is_query[1:] != is_query[:-1])) + 1
            for part in (b.slice(a, z - a) for a, z in zip([0, *cuts], [*cuts, b.num_rows])):
                if not part.num_rows:
                    continue
                if part.column("shard")[0].as_py() != shard or not part.column("query")[0].as_py():
                    if held:
                        yield results(tree, x, held)
                        held = []
                    if part.column("shard")[0].as_py() != shard:
                        shard, own, tree = part.column("shard")[0].as_py(), [], None
                if not part.column("query")[0].as_py():
                    own.append(part)
                    continue
                if not own:
                    continue  # a shard without rows has nothing to find
                if tree is None:
                    x = (np.concatenate([matrix(p.column("v"), dim) for p in own]), *(np.concatenate([p.column(c).to_numpy() for p in own]) for c in ("id", "key")))
                    tree = lifted_tree(x[0], top_norm)
                for a in range(0, part.num_rows, query_rows):
                    held.append(part.slice(a, query_rows))
                    if sum(p.num_rows for p in held) >= query_rows:
                        yield results(tree, x, held)
                        held = []
        if held:
            yield results(tree, x, held)

    return run


def nearest(df: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, factor: float | None = None,
            shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product that are found for each query.

    ``is_query`` is a condition on the column ``id``; a query's own id is no
    candidate.  Unusable vectors (see ``split_vectors``) take no part, nor do
    rows with a null id; repeated rows are indexed once; other vectors of one id
    are candidates of their own, and a query with several vectors gives each
    candidate its best score over them; fewer than k candidates give fewer rows;
    an empty table gives none; extra columns are ignored.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    usable, _, dim = split_vectors(df.filter(F.col(id_col).isNotNull()), id_col, vec_col, scratch)
    usable = scratch.put("indexed", usable.distinct().withColumn("key", F.monotonically_increasing_id()))
    queries = usable.filter(is_query)
    n, m = usable.count(), queries.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n or not m:
        return spark.createDataFrame([], schema)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    top_norm = math.sqrt(usable.agg(F.max(norm)).first()[0]) * (1 + 1e-12)
    sample = sample_of(usable, SAMPLE_ROWS, dim)
    factor = factor or calibrated_factor(sample, sample_of(queries, SAMPLE_QUERIES, dim), top_norm, k)
    queries = queries.mapInArrow(_bounded(spark.sparkContext.broadcast(sample), dim, k), T.StructType([*queries.schema.fields, T.StructField("least", T.DoubleType())]))
    shards = math.ceil(n / shard_rows)
    own = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")
    # all queries, in blocks, against every shard
    rows = (usable.select(own.alias("shard"), F.lit(False).alias("query"), "id", "key", "v", F.lit(None).cast("double").alias("least"))
            .unionByName(queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("query"), "id", "key", "v", "least")))
    found = (rows.repartition(shards, "shard").sortWithinPartitions("shard", "query")
             .mapInArrow(_search(dim, top_norm, k, factor, query_rows), FOUND))
    # a query with several vectors: of each candidate the best score
    found = found.groupBy("query_id", "vec_id", "key").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "key")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op6_nearest(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
