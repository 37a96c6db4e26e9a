"""Resharding by minimum-cost flow: move the fewest bytes from the old shards into new capacities.

The rows of an old shard fall into blocks by hash, ``BLOCKS`` or as many as keep
the largest shard's blocks at about ``BLOCK_BYTES``.  Old shard sizes
and new capacities are a transport problem whose cost is the bytes moved (a
byte that stays in the shard of its number is free); its solution says how many
bytes go from each old shard to each new one.  Blocks are then laid end to end
in each old shard and cut at the solution's boundaries, so whole blocks move
and only a block at a boundary is split between rows.  The driver sees block
and shard totals (shards x BLOCKS, or one per ``BLOCK_BYTES``), never rows.  Only shards that lose or gain
rows are written again: a row's key is its place (old shard, block, number in
the block), so whole rows are dealt once, by new shard, and placed as planned.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsieve.session import scratch_path

from .shared import Scratch, table

BLOCKS, BLOCK_BYTES = 256, 256 << 20
#: bytes of a row besides its text
ROW_BYTES = 16
#: tasks that write a shard, at least, and the bytes that one writes
WRITERS, WRITE_BYTES = 8, 512 << 20


class FlowNetwork:
    """Minimum-cost flow by successive shortest paths, for small networks of integer capacities."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, capacity: int, cost: int) -> int:
        """Add an arc and its residual; returns its number."""
        for x, y, room, c in ((a, b, capacity, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(room)
            self.cost.append(c)
        return len(self.to) - 2

    def _shortest(self, s: int, t: int) -> list[int] | None:
        """Arcs of a cheapest path with room (queue-based Bellman-Ford, residual costs may be negative)."""
        far = [None] * len(self.out)
        via = [-1] * len(self.out)
        far[s], queue, queued = 0, deque([s]), {s}
        while queue:
            x = queue.popleft()
            queued.discard(x)
            for e in self.out[x]:
                y, d = self.to[e], far[x] + self.cost[e]
                if self.room[e] and (far[y] is None or d < far[y]):
                    far[y], via[y] = d, e
                    if y not in queued:
                        queued.add(y)
                        queue.append(y)
        if far[t] is None:
            return None
        path = []
        while t != s:
            path.append(via[t])
            t = self.to[via[t] ^ 1]
        return path[::-1]

    def solve(self, s: int, t: int) -> None:
        while path := self._shortest(s, t):
            amount = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= amount
                self.room[e ^ 1] += amount


def transfers(old: dict[int, int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """Bytes from each old shard to each new one (staying bytes too) that move the fewest bytes."""
    if sum(old.values()) > sum(capacity):
        raise ValueError("the new shards cannot hold the old ones")
    names = sorted(k for k, v in old.items() if v)
    net = FlowNetwork(2 + len(names) + len(capacity))
    s, t = 0, 1
    arcs = {}
    for i, k in enumerate(names):
        net.arc(s, 2 + i, old[k], 0)
        for j in range(len(capacity)):
            arcs[k, j] = net.arc(2 + i, 2 + len(names) + j, old[k], int(k != j))
    for j, c in enumerate(capacity):
        net.arc(2 + len(names) + j, t, c, 0)
    net.solve(s, t)
    return {kj: net.room[e ^ 1] for kj, e in arcs.items() if net.room[e ^ 1]}


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


class Transfers(dict):
    """Bytes by (old shard, new shard), and what places a row: its columns, block starts, cuts and slot shifts."""

    columns: list[Column]
    starts: DataFrame
    bounds: DataFrame
    offsets: DataFrame


def _columns(old_shard, id_col: str, text_col: str, blocks: int) -> list[Column]:
    """id, size, text_crc32, old_shard and block of a row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    own, crc = F.col(id_col).cast("long"), F.crc32(text)
    return [own.alias("id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), crc.alias("text_crc32"),
            F.coalesce(old_shard.cast("int"), F.lit(0)).alias("old_shard"), _block(own, crc, blocks).alias("block")]


def _block(own: Column, crc: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(own, crc), F.lit(blocks)).cast("int")


def _numbered(rows: DataFrame, *dealt: str) -> DataFrame:
    """nth, a row's place in its block, and the bytes before it; rows that tie are alike in all that places them."""
    order = Window.partitionBy(*dealt, "old_shard", "block").orderBy("text_crc32", "id", "size")
    return (rows.withColumn("nth", F.row_number().over(order).cast("long"))
            .withColumn("before", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")))


def _begun(rows: DataFrame, starts: DataFrame, bounds: DataFrame) -> DataFrame:
    """With the bytes before the row's block in its old shard, and the old shard's cuts."""
    return (rows.join(F.broadcast(starts), (F.col("old_shard") == F.col("ks")) & (F.col("block") == F.col("kb")))
            .join(F.broadcast(bounds), F.col("old_shard") == F.col("kc")))


def _shard_at(byte: str) -> Column:
    """The new shard of a byte of the old shard."""
    return F.expr(f"element_at(filter(cuts, c -> c.upto > {byte}), 1).shard")


def _middle(rows: DataFrame) -> DataFrame:
    return rows.withColumn("middle", F.col("first") + F.col("before") + F.expr("size div 2")).withColumn("shard", _shard_at("middle"))


def _slotted(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    return (rows.join(F.broadcast(offsets), (F.col("shard") == F.col("fj")) & (F.col("old_shard") == F.col("fs")) & (F.col("block") == F.col("fb")))
            .withColumn("slot", F.col("nth") + F.col("shift")))


def reshard(docs: DataFrame, old_shard, shards: int, id_col: str = "doc_id", text_col: str = "text",
            capacity: list[int] | None = None, blocks: int | None = None) -> tuple[DataFrame, Transfers]:
    """(id, size, text_crc32, old_shard, shard, slot) per row, and the byte transfers that led there.

    ``old_shard`` is a column of small integers (null counts as shard 0).
    ``capacity`` defaults to equal shares of all bytes.  Slots are gapless from
    0 in each shard.  A null text is empty; null ids and repeated rows are rows
    like any other; an empty table gives no rows and no transfers.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    sized = scratch.put("sized", docs.select(*_columns(old_shard, id_col, text_col, 1)[:-1]))
    largest = sized.groupBy("old_shard").agg(F.sum("size").alias("b")).agg(F.max("b")).first()[0] or 0
    blocks = blocks or max(BLOCKS, -(-largest // BLOCK_BYTES))
    columns = _columns(old_shard, id_col, text_col, blocks)
    rows = scratch.put("rows", _numbered(sized.withColumn("block", _block(F.col("id"), F.col("text_crc32"), blocks))))
    # block totals: old shards x blocks numbers
    totals = rows.groupBy("old_shard", "block").agg(F.sum("size").alias("size")).orderBy("old_shard", "block").collect()
    old: dict[int, int] = {}
    start = []
    for r in totals:
        start.append((r["old_shard"], r["block"], old.get(r["old_shard"], 0)))
        old[r["old_shard"]] = old.get(r["old_shard"], 0) + r["size"]
    flow = Transfers(transfers(old, capacity or equal_capacities(sum(old.values()), shards)))
    # cut each old shard's bytes at the flow's boundaries, the staying part first
    cuts: dict[int, list[tuple[int, int]]] = {k: [] for k in old}
    for (k, j), amount in sorted(flow.items(), key=lambda x: (x[0][0], x[0][0] != x[0][1], x[0][1])):
        cuts[k].append(((cuts[k][-1][0] if cuts[k] else 0) + amount, j))
    starts = spark.createDataFrame(start, "ks int, kb int, first long")  # shards x blocks rows
    bounds = spark.createDataFrame([(k, [{"upto": u, "shard": j} for u, j in c]) for k, c in cuts.items()],
                                   "kc int, cuts array<struct<upto:long,shard:int>>")  # one row per old shard
    placed = scratch.put("placed", _middle(_begun(rows, starts, bounds)).select("id", "size", "text_crc32", "old_shard", "block", "nth", "shard"))
    # pieces of blocks: a shard's slots are its pieces end to end
    pieces = placed.groupBy("shard", "old_shard", "block").agg(F.count("*").alias("c"), F.min("nth").alias("least"))
    offset, filled = [], {}
    for r in pieces.orderBy("shard", "old_shard", "block").collect():  # blocks plus one more for each cut
        at = filled.get(r["shard"], 0)
        offset.append((r["shard"], r["old_shard"], r["block"], at - r["least"]))
        filled[r["shard"]] = at + r["c"]
    offsets = spark.createDataFrame(offset, "fj int, fs int, fb int, shift long")
    out = _slotted(placed, offsets).select("id", "size", "text_crc32", "old_shard", "shard", "slot")
    flow.columns, flow.starts, flow.bounds, flow.offsets = columns, starts, bounds, offsets
    scratch.drop("sized", "rows")
    return out, flow


def affected_shards(flow: dict[tuple[int, int], int]) -> list[int]:
    """Shards that lose or gain bytes; the others' files stay as they are."""
    return sorted({x for (k, j) in flow if k != j for x in (k, j)})


def rewrite_affected(docs: DataFrame, assigned: DataFrame, flow: Transfers, root: str, write_bytes: int = WRITE_BYTES) -> list[int]:
    """Write the new content of the affected shards below ``root`` as shard=<n> folders; returns their numbers.

    ``assigned`` and ``flow`` are what ``reshard`` returned for ``docs``.  Files
    hold all columns and the slot; columns named shard or slot are replaced.
    Null and repeated ids are rows like any other.  Without affected shards
    nothing is written.  A shard is written by as many tasks as keep each at
    about ``write_bytes``, ``WRITERS`` at least.  Readers take affected shards from ``root`` and the
    other shards from where they are.
    """
    shards = affected_shards(flow)
    if not shards:
        return shards
    keep = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    rows = docs.select(*flow.columns, F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
    # an old shard's rows go to affected shards if it is one itself, and stay if not
    rows = _begun(rows.filter(F.col("old_shard").isin(shards)), flow.starts, flow.bounds)
    # a block's rows go together to where its first byte goes, so nearly all rows are where they are written
    filled: dict[int, int] = {}
    for (_, j), amount in flow.items():
        filled[j] = filled.get(j, 0) + amount
    writers = max(WRITERS, -(-max(filled.values()) // write_bytes))
    rows = rows.withColumn("dest", _shard_at("first")).withColumn("writer", F.pmod("block", F.lit(writers)))
    rows = rows.repartition(len(shards) * writers, "dest", "writer")
    rows = _slotted(_middle(_numbered(rows, "dest", "writer")), flow.offsets)
    rows.select("row.*", "slot", "shard").write.mode("overwrite").partitionBy("shard").parquet(root)
    written, due = docs.sparkSession.read.parquet(root).count(), assigned.filter(F.col("shard").isin(shards)).count()
    if written != due:
        raise RuntimeError(f"{written} rows were written to the affected shards instead of {due}")
    return shards


def resharded(docs: DataFrame, old_shard, shards: int, root: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row after the affected shards are written below ``root``: theirs as read from the files."""
    assigned, flow = reshard(docs, old_shard, shards, id_col, text_col)
    names = ["id", "size", "text_crc32", "shard", "slot"]
    written = rewrite_affected(docs, assigned, flow, root)
    if not written:
        return assigned.select(*names)
    schema = T.StructType([f for f in docs.schema.fields if f.name.lower() not in ("shard", "slot")]).add("slot", T.LongType()).add("shard", T.IntegerType())
    files = docs.sparkSession.read.schema(schema).parquet(root)
    files = files.select(*_columns(F.lit(0), id_col, text_col, 1)[:3], "shard", "slot")
    return files.unionByName(assigned.filter(~F.col("shard").isin(written)).select(*names))


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    """Documents that lie in 32 shards by source (so one is a third of all) into 40 equal ones."""
    docs = table(spark, sf_dir, "documents")
    out = resharded(docs, F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(32)), 40, scratch_path(spark, "shards"))
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
