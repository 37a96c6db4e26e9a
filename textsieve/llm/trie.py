"""Prefix trie of conversations, by union-find over neighbours in sorted order.

A conversation is a path: one fixed-width digest per turn, end to end.  Equal
paths are one sequence with several members.  Distinct sequences are sorted; two
neighbours share as many leading turns as their longest common prefix (LCP), and
these LCPs are the edges of a forest.  Taking edges by descending depth, a
union-find component is a subtree: it is lifted to the edge's depth (each depth
that it passes is a node with one child), and joining two components makes a
branching node.

Sorted sequences are cut into blocks of bounded size.  What a block cannot know
are the nodes on its two outer paths, which neighbours may share: they stay
open, and the block is contracted to these two paths with what hangs on each
depth.  Blocks are merged FAN at a time, by the same union-find, until one is
left, so no task holds more than a block or 2 * FAN paths.

A node is known by its smallest member and depth.  Children that were finished
while their parent was open name it by the digest of its path, and learn its
smallest member by a join at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, table

#: characters of a turn's digest: 18 bytes of its SHA-256 (144 bits) in base 64
WIDTH = 24
#: sequences, and bytes of their paths, of one block
BLOCK_ROWS, BLOCK_BYTES = 4096, 8 << 20
#: blocks merged by one task
FAN = 64
#: member ids joined into one piece of text before they are shuffled
ID_PIECE = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()

# ---------------------------------------------------------------- conversations to paths


def turn_lists(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): array of (digest, size) in order; size = UTF-8 bytes of the text.

    Turns are ordered by number (nulls first), then role, then the text's
    digest; null roles and texts are empty; repeated rows are turns of their
    own; rows without a conversation are left out.
    """
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    sha = F.unhex(F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t).cast("binary"), 256))
    rows = rows.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), r.alias("role"), F.base64(F.substring(sha, 1, 18)).alias("digest"), F.octet_length(t).alias("size")).alias("t"))
    turns = F.transform(F.sort_array(F.collect_list("t")), lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def as_paths(turns: Column) -> list[Column]:
    return [F.array_join(F.transform(turns, lambda x: x["digest"]), "").alias("path"), F.transform(turns, lambda x: x["size"]).alias("sizes")]


def _id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted ids with one key, as decimals joined by commas, a bounded number at a time."""
    key, ids = None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([len(ids)], pa.int64()),
                                           pa.array([",".join(map(str, ids))], pa.string())], names=["key", "low", "n", "ids"])

    for b in batches:
        for k, i in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist()):
            if ids and (k != key or len(ids) >= ID_PIECE):
                yield piece()
                ids = []
            key = k
            ids.append(i)
    if ids:
        yield piece()


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number, least and SHA-256 of the ids of every key, from pieces in order; nothing but the hash's state is held."""
    key = state = None
    low = n = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([low], pa.int64()), pa.array([n], pa.int64()), pa.array([state.hexdigest()])], names=["low", "n", "sha"])

    for b in batches:
        for k, first, count, ids in zip(*(b.column(c).to_pylist() for c in ("key", "low", "n", "ids"))):
            if k != key:
                if state is not None:
                    yield out()
                key, low, n, state = k, first, 0, hashlib.sha256()
            state.update(("," if n else "").encode() + ids.encode())
            n += count
    if state is not None:
        yield out()


def distinct_sequences(paths: DataFrame) -> DataFrame:
    """(path, sizes, n, low, sha): every distinct path with the number, least and digest of its members."""
    members = paths.select(F.unhex(F.sha2(F.col("path").cast("binary"), 256)).alias("key"), "conv_id")
    # a path that a third of all conversations share is spread over tasks before its ids are joined
    pieces = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_id_pieces, "key binary, low long, n long, ids string")
    ends = pieces.repartition("key").sortWithinPartitions("key", "low").mapInArrow(_id_digests, "low long, n long, sha string")
    return paths.join(ends, F.col("conv_id") == F.col("low")).select("path", "sizes", "n", "low", "sha")


# ---------------------------------------------------------------- forests

#: a finished node; the names of it and of its parent where they were open before
NODE = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: an outer path of a block (side 0: first, 1: last) and what hangs on its depths
OUTER = ("part int, block long, side int, path string, sizes array<int>, "
         "gifts array<struct<at:int, n:long, low:long, children:long, leaves:long, saved:long, sha:string>>")
ROWS = f"{NODE}, node string, parent string, {OUTER}"
NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]


class Hung:
    """What hangs on a node: members and finished children of it (not what open children will bring)."""

    __slots__ = ("n", "low", "children", "leaves", "saved", "sha", "rows")

    def __init__(self, n=0, low=None, children=0, leaves=0, saved=0, sha=None, rows=None):
        self.n, self.low, self.children, self.leaves, self.saved, self.sha, self.rows = n, low, children, leaves, saved, sha, rows or []

    def add(self, x: "Hung") -> "Hung":
        if len(x.rows) > len(self.rows):
            self.rows, x.rows = x.rows, self.rows
        self.rows.extend(x.rows)
        self.n, self.children, self.leaves, self.saved = self.n + x.n, self.children + x.children, self.leaves + x.leaves, self.saved + x.saved
        self.low = x.low if self.low is None else self.low if x.low is None else min(self.low, x.low)
        self.sha = self.sha or x.sha
        return self


class Path:
    """A sequence and what hangs on its depths."""

    def __init__(self, path: str, sizes: list[int], hung: dict[int, Hung]):
        self.path, self.sizes, self.hung = path, sizes, hung
        self._names: list[str] | None = None

    def name(self, depth: int) -> str:
        """The digest of the path down to a depth."""
        if self._names is None:
            h = hashlib.sha256()
            self._names = [h.hexdigest()[:36]]
            for a in range(0, len(self.path), WIDTH):
                h.update(self.path[a:a + WIDTH].encode())
                self._names.append(h.copy().hexdigest()[:36])
        return self._names[depth]


def shared_turns(a: str, b: str) -> int:
    """The number of leading turns that two paths share."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * WIDTH:mid * WIDTH] == b[low * WIDTH:mid * WIDTH]:
            low = mid
        else:
            high = mid - 1
    return low


class Tree:
    """A union-find component: the subtree below one node of neighbouring paths [first, last]."""

    __slots__ = ("depth", "here", "above", "first", "last")

    def __init__(self, at: int, path: Path):
        self.depth = len(path.sizes)
        self.above = dict(path.hung)
        self.here = self.above.pop(self.depth, None) or Hung()
        self.first = self.last = at


def contract(paths: list[Path], whole: bool, named: bool) -> tuple[list[list], list[Path]]:
    """Nodes of neighbouring sorted paths, and the outer paths with what hangs on them.

    ``whole``: there are no neighbours, so every node is finished and no path
    remains.  ``named``: the paths come from earlier contractions, so finished
    nodes carry the names by which their children know them.
    """
    rows: list[list] = []
    last = len(paths) - 1
    outer: tuple[dict, dict] = ({}, {})
    trees = [Tree(i, p) for i, p in enumerate(paths)]
    up = list(range(len(paths)))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def leave(t: Tree) -> None:
        """Finish the node that the tree stands on, or leave it open; then step up."""
        h, depth, path = t.here, t.depth, paths[t.first if t.first == 0 else t.last]
        if not whole and (t.first == 0 or t.last == last):
            for r in h.rows:
                r[9] = path.name(depth)
            h.rows = []
            if h.n:
                outer[0 if t.first == 0 else 1][depth] = h
            t.here = Hung()
        else:
            if depth:
                h.saved += (h.n - 1) * path.sizes[depth - 1]
            h.leaves += h.children == 0
            for r in h.rows:
                r[2] = h.low
            row = [h.low, depth, None, h.n, h.children, h.leaves, h.saved, h.sha or NO_ENDS, path.name(depth) if named else None, None]
            rows.append(row)
            t.here = Hung(h.n, h.low, 1, h.leaves, h.saved, None, [row])
        t.depth -= 1
        if t.depth in t.above:
            t.here.add(t.above.pop(t.depth))

    depth_of = [shared_turns(a.path, b.path) for a, b in zip(paths, paths[1:])]
    for e in sorted(range(last), key=lambda e: -depth_of[e]):
        a, b = trees[find(e)], trees[find(e + 1)]
        for t in (a, b):
            while t.depth > depth_of[e]:
                leave(t)
        up[find(e + 1)] = find(e)
        a.here.add(b.here)
        if len(b.above) > len(a.above):
            a.above, b.above = b.above, a.above
        for d, h in b.above.items():
            a.above[d] = a.above[d].add(h) if d in a.above else h
        a.last = b.last
    t = trees[find(0)]
    while t.depth >= 0:
        leave(t)
    left = [] if whole else [Path(paths[i].path, paths[i].sizes, outer[side]) for side, i in enumerate([0, last][:1 + (last > 0)])]
    return rows, left


def _batch(rows: list[list], left: list[Path], part: int, block: int) -> pa.RecordBatch:
    """Finished nodes and outer paths as rows of one schema."""
    gift = pa.struct([("at", pa.int32()), ("n", pa.int64()), ("low", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()),
                      ("saved", pa.int64()), ("sha", pa.string())])
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string(),
             pa.list_(pa.int32()), pa.list_(gift)]
    none = [None] * len(left)
    columns = [[r[c] for r in rows] + none for c in range(10)]
    for of_path in ([part] * len(left), [block] * len(left), list(range(len(left))), [p.path for p in left], [p.sizes for p in left],
                    [[{"at": d, "n": h.n, "low": h.low, "children": h.children, "leaves": h.leaves, "saved": h.saved, "sha": h.sha}
                      for d, h in p.hung.items()] for p in left]):
        columns.append([None] * len(rows) + of_path)
    names = [*NODE_COLUMNS, "node", "parent", "part", "block", "side", "path", "sizes", "gifts"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _blocks(block_rows: int):
    """A task's sorted sequences, contracted a block at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, size = TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            for path, sizes, n, low, sha in zip(*(b.column(c).to_pylist() for c in ("path", "sizes", "n", "low", "sha"))):
                if held and (len(held) >= block_rows or size + len(path) > BLOCK_BYTES):
                    yield _batch(*contract(held, False, False), part, block)
                    held, size, block = [], 0, block + 1
                held.append(Path(path, sizes, {len(sizes): Hung(n, low, sha=sha)}))
                size += len(path)
        if held:
            yield _batch(*contract(held, False, False), part, block)

    return run


def _merge(whole: bool):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        found = sorted(rows.select(["block", "side", "path", "sizes", "gifts"]).to_pylist(), key=lambda r: (r["block"], r["side"]))
        paths = [Path(r["path"], r["sizes"], {g["at"]: Hung(g["n"], g["low"], g["children"], g["leaves"], g["saved"], g["sha"]) for g in r["gifts"]})
                 for r in found]
        return pa.Table.from_batches([_batch(*contract(paths, whole, True), 0, key[0].as_py())])

    return run


def prefix_trie(paths: DataFrame, fan: int = FAN, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every node of the trie of (conv_id, path, sizes), as ``as_paths`` gives them; conv_id is unique.

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  A
    conversation without turns ends at the root; an empty table has no nodes.
    """
    spark = paths.sparkSession
    scratch = Scratch(spark)
    paths = scratch.put("paths", paths.select("conv_id", "path", "sizes"))
    sequences = scratch.put("sequences", distinct_sequences(paths))
    level = scratch.put("blocks", sequences.repartitionByRange("path").sortWithinPartitions("path").mapInArrow(_blocks(block_rows), ROWS))
    levels = [level]
    # blocks in order: those of a task follow those of the tasks before it
    first, total = [], 0
    for r in level.filter("side = 0").groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():  # one row a task
        first.append((r["part"], total))
        total += r["n"]
    if not total:
        return level.filter("side is null").select(*NODE_COLUMNS).withColumn("depth", F.col("depth").cast("long"))
    offsets = spark.createDataFrame(first, "p int, before long")
    open_paths = level.filter("side is not null").join(offsets, F.col("part") == F.col("p")).withColumn("block", F.col("block") + F.col("before"))
    while True:
        whole = total <= fan
        merged = (open_paths.withColumn("group", F.expr(f"block div {fan}")).select("group", "block", "side", "path", "sizes", "gifts")
                  .groupBy("group").applyInArrow(_merge(whole), ROWS))
        level = scratch.put(f"merged-{len(levels)}", merged)
        levels.append(level)
        if whole:
            break
        open_paths, total = level.filter("side is not null"), -(-total // fan)
    nodes = levels[0]
    for x in levels[1:]:
        nodes = nodes.unionByName(x)
    nodes = nodes.filter("side is null")
    known = nodes.filter("node is not null").select(F.col("node").alias("name"), F.col("conv_id").alias("found"))
    done = nodes.filter("parent is null").select(*NODE_COLUMNS)
    late = nodes.filter("parent is not null").join(known, F.col("parent") == F.col("name")).withColumn("parent_conv_id", F.col("found")).select(*NODE_COLUMNS)
    return done.unionByName(late).withColumn("depth", F.col("depth").cast("long"))


# ---------------------------------------------------------------- query

def rebuild(turns: DataFrame, every: int = 5, heads: int = 9) -> DataFrame:
    """Conversation c begins with the first h turns of conversation c - c % every, h = crc32(c as decimal) % heads."""
    c = F.col("conv_id")
    heads_of = turns.filter(c % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("int")
    rows = turns.join(heads_of, c - c % every == F.col("base"), "left").withColumn("h", h)
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return rows.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def op12_trie(spark, sf_dir: str) -> DataFrame:
    turns = rebuild(turn_lists(table(spark, sf_dir, "conversations")))
    return prefix_trie(turns.select("conv_id", *as_paths(F.col("turns"))))


OP12_SQL = r"""
WITH o AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT conv_id, l, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: xor(c >> 1, 3988292384 * (c & 1))))) % 9 AS h
  FROM o
), r AS (
  SELECT h.conv_id, list_concat(coalesce(list_slice(b.l, 1, h.h), []), list_slice(h.l, h.h + 1, len(h.l))) AS l
  FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 5
), p AS (
  SELECT conv_id, len(l) AS size, d, sha256(to_json(list_slice(l, 1, d))::VARCHAR) AS k, sha256(to_json(list_slice(l, 1, d - 1))::VARCHAR) AS up,
         CASE WHEN d > 0 THEN octet_length(encode(l[d].text)) ELSE 0 END AS bytes
  FROM r, unnest(range(0, len(l) + 1)) AS u(d)
), n AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(up) AS up, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends
  FROM p GROUP BY d, k
), c AS (
  SELECT n.*, m.conv_id AS parent_conv_id, (SELECT count(*) FROM n x WHERE x.d = n.d + 1 AND x.up = n.k) AS n_children
  FROM n LEFT JOIN n m ON n.d > 0 AND m.d = n.d - 1 AND m.k = n.up
), s AS (
  SELECT p.d, p.k, sum((c.n_children = 0)::BIGINT) AS n_leaves, sum((c.n_convs - 1) * c.bytes) AS saved
  FROM c JOIN p ON p.conv_id = c.conv_id AND p.d <= c.d GROUP BY p.d, p.k
)
SELECT c.conv_id, c.d::BIGINT AS depth, c.parent_conv_id, c.n_convs, c.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, c.ends AS ends_sha256
FROM c JOIN s ON s.d = c.d AND s.k = c.k
"""
