"""SimHash near-duplicates: fingerprints, and an exact search by the general pigeonhole principle.

A fingerprint is 64 bits over the word shingles of a text.  Two texts are
linked when their fingerprints differ in at most ``max_bits`` bits.  The search
is exact:

1. Bits that are correlated over all fingerprints are grouped into the same
   partition, so that the bits of different partitions are nearly independent.
2. Thresholds T_i with sum(T_i) = max_bits - m + 1 lose no pair (general
   pigeonhole: a pair over every threshold would differ in at least
   sum(T_i + 1) = max_bits + 1 bits).  They may be unequal; -1 skips a
   partition.  Dynamic programming picks the allocation with the least
   estimated work, from counts taken over all fingerprints.
3. Every fingerprint is put under its own value of partition i and probes all
   values within T_i bits of it; rows that meet are verified by popcount.

Only distinct fingerprints are searched (copies cost nothing).  A task walks
its sorted buckets and emits the links of a spanning forest of each bucket,
never all pairs of it.  Buckets over ``CELL_ROWS`` rows are split into pairs of
chunks that go to different tasks, so a bucket of any size is searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import Scratch, id_and_text, table

BITS = 64
SEED = 42
#: rows of a bucket that one task compares at once; larger buckets are split into pairs of chunks
CELL_ROWS = 16_384
ONE = np.uint64(1)


# ---------------------------------------------------------------- fingerprints

def shingle_hashes(text: str | None, words: int = 3) -> list[int]:
    """XXH64 (seed 42) of every run of ``words`` words, repeats included; a shorter text is one shingle."""
    if not text:
        return []
    toks = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space only
    if not toks:
        return []
    joined = b" ".join(toks)
    h = xxhash.xxh64_intdigest
    if len(toks) <= words:
        return [h(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, toks), np.int64, len(toks)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [h(joined[a:b], SEED) for a, b in zip(starts[: len(toks) - words + 1].tolist(), ends[words - 1:].tolist())]


def fingerprint(text: str | None, words: int = 3) -> int:
    """A bit is one if it is set in over half the shingle hashes; no word at all: zero."""
    hs = shingle_hashes(text, words)
    if not hs:
        return 0
    total = np.zeros(BITS, np.int64)
    for i in range(0, len(hs), 65_536):
        part = np.array(hs[i:i + 65_536], dtype="<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(2 * total > len(hs), bitorder="little")
    return int(bits.view("<u8")[0])


def text_digest(text_col: str):
    return F.xxhash64(F.col(text_col).cast("string"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, traced: bool = False) -> DataFrame:
    """(id, fp long) of every row, and on request digest, a hash of the text; fp holds the 64 bits as a signed long."""
    more = ["digest"] if traced else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in b.column("text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fps.view(np.int64)), *map(b.column, more)], names=["id", "fp", *more])

    rows = id_and_text(docs, id_col, text_col)
    if traced:
        rows = rows.withColumn("digest", text_digest("text"))
    return rows.mapInArrow(run, "id long, fp long" + ", digest long" * traced)


# ---------------------------------------------------------------- partitions and thresholds

def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each pair of bits in how many both are set (64 x 64), over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for b in batches:
            v = np.ascontiguousarray(b.column("fp").to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(v, axis=1, bitorder="little").astype(np.float32)
            n, both = n + len(bits), both + (bits.T @ bits).astype(np.float64)
        cells = np.concatenate([[float(n)], both.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "x"])

    rows = fps.mapInArrow(run, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect()  # 4097 rows
    out = np.zeros(BITS * BITS + 1)
    for r in rows:
        out[r["cell"]] = r["x"]
    return int(out[0]), out[1:].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of near equal size; each bit joins the open partition it is most correlated with."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0.0)
    room = [BITS // m + (i < BITS % m) for i in range(m)]
    # seeds far apart: the most balanced bit, then the bits least correlated with the seeds
    seeds = [int(np.argmin(np.abs(p - 0.5)))]
    while len(seeds) < m:
        far = corr[:, seeds].max(axis=1)
        far[seeds] = np.inf
        seeds.append(int(np.argmin(far)))
    parts = [[s] for s in seeds]
    rest = [b for b in range(BITS) if b not in seeds]
    rest.sort(key=lambda b: (-corr[b, seeds].max(), b))
    for b in rest:
        fit = [(-corr[b, part].mean(), len(part), i) for i, part in enumerate(parts) if len(part) < room[i]]
        parts[min(fit)[2]].append(b)
    return [sorted(x) for x in parts]


def ball(bits: int, t: int) -> int:
    """Values within t bits of a value."""
    total, c = 0, 1
    for k in range(t + 1):
        total += c
        c = c * (bits - k) // (k + 1)
    return total


def estimated_work(n: int, both: np.ndarray, part: list[int], t: int) -> float:
    """Rows put out plus pairs that meet, if two fingerprints differ in each bit as often as over all rows.

    The number of differing bits of a random pair inside the partition is a sum
    of independent bits (the correlated ones share a partition, which makes
    more pairs meet than this, alike for every threshold).
    """
    if t < 0:
        return 0.0
    p = np.diag(both)[part] / max(n, 1)
    dist = np.zeros(len(part) + 1)
    dist[0] = 1.0
    for d in 2 * p * (1 - p):
        dist[1:] = dist[1:] * (1 - d) + dist[:-1] * d
        dist[0] *= 1 - d
    return n * ball(len(part), t) * 1.0 + 0.5 * n * n * float(dist[: t + 1].sum())


def allocate(work: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds from -1 up, one per partition, with sum(T_i + 1) = budget and the least total work."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in work:  # options[k]: the work of threshold k - 1
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, ts) in best.items():
            for k in range(min(len(options) - 1, budget - used) + 1):
                cand = (cost + options[k], [*ts, k - 1])
                if used + k not in nxt or cand < nxt[used + k]:
                    nxt[used + k] = cand
        best = nxt
    return best[budget]


def plan_search(fps: DataFrame, max_bits: int = 3, partitions: tuple[int, ...] = (2, 3, 4)) -> list[tuple[list[int], int]]:
    """[(bits of the partition, its threshold)], the cheapest over the given numbers of partitions."""
    n, both = bit_statistics(fps)
    found = []
    for m in partitions:
        parts = group_bits(n, both, m)
        work = [[estimated_work(n, both, p, t) for t in range(-1, max_bits + 1)] for p in parts]
        cost, ts = allocate(work, max_bits + 1)
        found.append((cost, m, [(p, t) for p, t in zip(parts, ts) if t >= 0]))
    return min(found, key=lambda x: x[:2])[2]


# ---------------------------------------------------------------- probe and verify

def _masks(part: list[int], t: int) -> tuple[np.uint64, np.ndarray]:
    """The partition's bit mask, and all patterns of at most t of its bits (0 first)."""
    own = np.uint64(sum(1 << b for b in part))
    flips = [sum(1 << b for b in c) for k in range(t + 1) for c in combinations(part, k)]
    return own, np.array(flips, dtype=np.uint64)


def _probes(rows: DataFrame, plan: list[tuple[list[int], int]], col: str = "fp") -> DataFrame:
    """(part, value, <col>): every fingerprint under all values within T_i bits of its own value of partition i.

    With a column ``part`` in the rows, only that partition's values are put out.
    """
    masks = [_masks(p, t) for p, t in plan]
    given = "part" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps, last = (b.column(c).to_numpy(zero_copy_only=False) for c in ("fp", col))
            part = b.column("part").to_numpy(zero_copy_only=False) if given else None
            for i, (own, flips) in enumerate(masks):
                fp, y = (fps, last) if part is None else (fps[part == i], last[part == i])
                fp = fp.view(np.uint64) if part is None else np.ascontiguousarray(fp).view(np.uint64)
                step = max(1, 262_144 // len(flips))
                for a in range(0, len(fp), step):
                    value = ((fp[a:a + step] & own)[:, None] ^ flips[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(value), i, np.int32)), pa.array(value.view(np.int64)),
                        pa.array(np.repeat(y[a:a + step], len(flips)))], names=["part", "value", col])

    return rows.mapInArrow(run, f"part int, value long, {col} long")


def _large_buckets(fps: DataFrame, plan: list[tuple[list[int], int]], cell_rows: int) -> DataFrame:
    """(p, v, k): buckets to split into k chunks.

    Own values are counted first; only the frequent ones are spread over the
    values that probe them.  What the others add to a bucket stays below one
    chunk, so no chunk holds more than about twice ``cell_rows``.
    """
    own = [(_masks(p, 0)[0], max(ball(len(p), t) for p, t in plan)) for p, t in plan]
    value = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(int(m.view(np.int64)))).alias("v"))
                                for i, (m, _) in enumerate(own)])).alias("x")
    often = (fps.select(value).groupBy("x.part", "x.v").agg(F.count("*").alias("c"))
             .filter(F.col("c") * max(n for _, n in own) > cell_rows).select("part", F.col("v").alias("fp"), "c"))
    return (_probes(often, plan, "c").groupBy("part", "value").agg(F.sum("c").alias("c")).filter(F.col("c") > cell_rows)
            .select(F.col("part").alias("p"), F.col("value").alias("v"), F.ceil(F.col("c") / cell_rows).cast("int").alias("k")))


def _forest(x: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the values at most max_bits apart (search from each row over the unvisited)."""
    left, a, b = np.arange(len(x)), [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            i = front.pop()
            hit = np.bitwise_count(x[left] ^ x[i]) <= max_bits
            if hit.any():
                new = left[hit]
                a.append(np.full(len(new), x[i])), b.append(x[new])
                front.extend(new.tolist())
                left = left[~hit]
    if not a:
        return x[:0], x[:0]
    return np.concatenate(a), np.concatenate(b)


def _verify_sorted(max_bits: int):
    """Links of a task's rows, sorted by (part, value, cell): small buckets together, large ones by search."""
    small = 32

    def links(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(key)]]))
        size_of = np.repeat(sizes, sizes)
        a, b = [], []
        tiny = size_of <= small
        for s in range(1, min(small, int(sizes.max(initial=1)))):  # rows s apart within a bucket
            ok = (key[s:] == key[:-s]) & tiny[s:]
            i = np.flatnonzero(ok)
            if not len(i):
                break
            hit = i[np.bitwise_count(fp[i] ^ fp[i + s]) <= max_bits]
            a.append(fp[hit]), b.append(fp[hit + s])
        for st, n in zip(starts[sizes > small], sizes[sizes > small]):
            x, y = _forest(np.unique(fp[st:st + n]), max_bits)
            a.append(x), b.append(y)
        x, y = (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])
        lo, hi = np.minimum(x.view(np.int64), y.view(np.int64)), np.maximum(x.view(np.int64), y.view(np.int64))
        keep = lo != hi
        pairs = np.unique(np.stack([lo[keep], hi[keep]], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        for b in batches:
            part = b.column("part").to_numpy(zero_copy_only=False).astype(np.uint64)
            value = b.column("value").to_numpy(zero_copy_only=False).view(np.uint64)
            cell = b.column("cell").to_numpy(zero_copy_only=False).astype(np.uint64)
            # one number per (part, value, cell); two buckets that share it are only compared needlessly
            key = value * np.uint64(0x9E3779B97F4A7C15) + part * np.uint64(0xC2B2AE3D27D4EB4F) + cell * np.uint64(0x165667B19E3779F9)
            k = np.concatenate([held_k, key])
            f = np.concatenate([held_f, b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(k):
                continue
            last = np.flatnonzero(k != k[-1])
            cut = int(last[-1]) + 1 if len(last) else 0  # the last bucket may go on in the next batch
            if cut:
                x, y = links(k[:cut], f[:cut])
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])
            held_k, held_f = k[cut:], f[cut:]
        if len(held_k):
            x, y = links(held_k, held_f)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

    return run


def hamming_links(fps: DataFrame, max_bits: int = 3, partitions: tuple[int, ...] = (2, 3, 4),
                  cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect exactly what pairs within ``max_bits`` connect.

    ``fps`` has one column ``fp`` of distinct longs and should be a written
    table (it is read several times).
    """
    plan = plan_search(fps, max_bits, partitions)
    probes = _probes(fps, plan)
    big = Scratch(fps.sparkSession).put("big-buckets", _large_buckets(fps, plan, cell_rows))
    # a bucket of k chunks becomes cells (x, y), x <= y; a row of chunk r goes to the k cells with r
    r = F.pmod(F.xxhash64("fp"), F.col("k").cast("long")).cast("int")
    cells = F.when(F.col("k").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.least(r, j) * F.col("k") + F.greatest(r, j) + 1))
    dealt = (probes.join(big, (F.col("part") == F.col("p")) & (F.col("value") == F.col("v")), "left")
             .select("part", "value", "fp", F.explode(cells).alias("cell")))
    return (dealt.repartition("part", "value", "cell").sortWithinPartitions("part", "value", "cell")
            .mapInArrow(_verify_sorted(max_bits), "a long, b long").distinct())


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                   max_bits: int = 3, traced: bool = False) -> DataFrame:
    """(id, fp, component): component = smallest id reachable over links, itself included.

    On request also digest, a hash of the text, and root, the group's smallest
    fingerprint (ids that repeat can be the smallest of several groups).

    Null and empty texts and texts without words have fingerprint zero and are
    linked like any other; equal rows each get a row; rows with a null id are
    kept and get the smallest id of their group that is not null; an empty
    table gives no rows.  Extra columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.put("fingerprints", fingerprints(docs, id_col, text_col, words, traced))
    classes = scratch.put("classes", rows.groupBy("fp").agg(F.min("id").alias("low")))
    links = hamming_links(classes.select("fp"), max_bits)
    comp = scratch.put("components", connected_components(links, "a", "b"))
    low = (classes.join(comp, classes["fp"] == comp["node"])
           .groupBy(F.col("root").alias("r")).agg(F.min("low").alias("component")))
    low = scratch.put("lowest", low)
    named = scratch.put("named", comp.join(low, F.col("root") == F.col("r")).select("node", "component", "root"))
    found = scratch.put("found", classes.join(named, classes["fp"] == named["node"], "left")
                        .select(F.col("fp").alias("f"), F.coalesce("component", "low").alias("component"), F.coalesce("root", "fp").alias("root")))
    scratch.drop("classes", "components", "lowest", "named")
    return rows.join(found, rows["fp"] == found["f"]).select("id", "fp", "component", *(["digest", "root"] if traced else []))


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    out = simhash_groups(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))
