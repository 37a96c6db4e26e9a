"""Exact removal of repeated byte strings, by blockwise suffix sorting with cover-sample ranks.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else
(in another text or the same one) is removed.  Suffixes are only compared to
that depth.  The steps:

1. *Buckets.*  The string that starts at position i has one anchor: the k-gram
   in it with the least hash, leftmost first.  Equal strings have equal anchors
   at equal distances, so the anchor's k-gram names the suffix bucket.
   Consecutive positions with one anchor form a run; a run and the bytes its
   strings cover are one *context*.  Only buckets with two runs or more matter.
2. *Copies.*  Equal contexts are counted, not sorted: a context that occurs
   twice is repeated as a whole, and one of its copies stays as a partner.
3. *Sorting.*  Contexts of buckets with different contexts are cut into blocks
   of ``BLOCK`` neighbouring suffixes and dealt by the bytes that all suffixes
   of a block share, which refines the bucket.  A task sorts its suffixes one
   bounded group of buckets at a time: by the first bytes, and long ties by the
   precomputed ranks of a cover sample.  Contexts are laid out with their
   anchors on multiples of the period, so suffixes that can be equal have equal
   residues, and the sample of every PERIOD-th position covers their only
   difference, zero.  Memory depends on the group, not on the corpus.
4. Blocks over ``BLOCK_ROWS`` contexts (a passage that very many texts share)
   are dealt again suffix by suffix and counted, so no task gets a large one.

Hashes of 64 bits only deal out work.  Whole contexts (step 2) and the suffixes
of step 4 are equal when two independent 64-bit hashes of their bytes agree
(other byte tables and other bases): 128 bits, and no bytes are compared there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, column, fields, table, whole_row

LENGTH = 200
GRAM = 40
BLOCK = 32
BLOCK_ROWS = 4096
PERIOD = 32
#: suffixes looked at together; longer texts are cut into overlapping pieces
PIECE = 1 << 20
#: bytes of contexts sorted together
GROUP_BYTES = 4 << 20

U = np.uint64
_rng = np.random.default_rng(20240229)
BYTE, BYTE2 = (_rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1) for _ in range(2))
BASE, BASE2 = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
POS_BITS = 22
POS = U((1 << POS_BITS) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hashes:
    """Hashes of any substring of a byte array (polynomial, modulo 2^64)."""

    def __init__(self, a: np.ndarray, byte: np.ndarray = BYTE, base: np.uint64 = BASE):
        size = 1 << max(12, int(len(a)).bit_length())
        self.back = _powers(pow(int(base), -1, 1 << 64), size)
        self.sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(byte[a] * _powers(int(base), size)[: len(a)], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return _mix((self.sums[k:] - self.sums[:-k]) * self.back[:n])


def runs_of(a: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of the suffixes of texts that lie end to end in ``a``: first suffix, anchor, number, the anchor's hash and two of the context."""
    n = len(a) - LENGTH + 1
    if n <= 0:
        return {}
    h = Hashes(a)
    g = h.grams(GRAM)
    m = (g & ~POS) | np.arange(len(g), dtype=np.uint64)  # by hash, then leftmost
    width, want = 1, LENGTH - GRAM + 1
    while width * 2 <= want:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if want > width:
        m = np.minimum(m[: len(m) - (want - width)], m[want - width:])
    whole = np.zeros(len(a) + 1, np.int32)  # a suffix needs LENGTH bytes of its own text
    begins = np.concatenate([[0], ends[:-1]])
    ok = ends - begins >= LENGTH
    whole[begins[ok]] += 1
    np.subtract.at(whole, ends[ok] - LENGTH + 1, 1)
    at = np.flatnonzero(np.cumsum(whole[:n]) > 0)
    if not len(at):
        return {}
    p = (m[at] & POS).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
    s, e, p = at[new], at[np.concatenate([new[1:], [len(at)]]) - 1], p[new]
    shape = (p - s).astype(np.uint64) * U(0xC2B2AE3D27D4EB4F) + (e - s).astype(np.uint64) * U(0x165667B19E3779F9)
    other = Hashes(a, BYTE2, BASE2)
    return {"s": s, "p": p, "n": e - s + 1, "h1": g[p], "h2": _mix(h.of(s, e + LENGTH) + shape), "h3": _mix(other.of(s, e + LENGTH) ^ shape)}


def _pieces(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, row of each text, its offset in the row's text): whole texts together, long ones in pieces."""
    arr = col.cast(pa.large_binary())
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset: arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(arr):
        size = off[i + 1] - off[i]
        if size > PIECE:
            for a in range(0, int(size) - LENGTH + 1, PIECE - LENGTH + 1):
                part = data[off[i] + a: min(off[i] + a + PIECE, off[i + 1])]
                yield part, np.array([len(part)]), np.array([i]), np.array([a])
            i += 1
            continue
        j = int(np.searchsorted(off, off[i] + PIECE, "right")) - 1
        yield data[off[i]:off[j]], off[i + 1:j + 1] - off[i], np.arange(i, j), np.zeros(j - i, np.int64)
        i = j


RUN = "id long, rk long, s int, d int, n int, h1 long, h2 long, h3 long"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, rks = b.column("id"), b.column("rk")
        for a, ends, rows, offs in _pieces(b.column("text").fill_null("")):
            r = runs_of(a, ends)
            if r:
                k = np.searchsorted(ends, r["s"], "right")
                begin = np.concatenate([[0], ends[:-1]])[k]
                take = pa.array(rows[k])
                yield pa.RecordBatch.from_arrays([
                    ids.take(take), rks.take(take), pa.array((r["s"] - begin + offs[k]).astype(np.int32)),
                    pa.array((r["p"] - r["s"]).astype(np.int32)), pa.array(r["n"].astype(np.int32)),
                    *[pa.array(r[h].view(np.int64)) for h in ("h1", "h2", "h3")]],
                    names=["id", "rk", "s", "d", "n", "h1", "h2", "h3"])


# ---------------------------------------------------------------- sorting

SUFFIXES = "key long, id long, rk long, i int, n int, d int, body binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts cut into blocks of neighbouring suffixes: those with one d // BLOCK, dealt by the bytes they share."""
    for b in batches:
        out: dict[str, list] = {k: [] for k in ("key", "id", "rk", "i", "n", "d", "body")}
        for id_, rk, text, runs in zip(b.column("id").to_pylist(), b.column("rk").to_pylist(), b.column("text"), b.column("runs").to_pylist()):
            raw = text.as_py().encode("utf-8")
            firsts, blocks = [], []
            for r in runs:
                p, i, last = r["s"] + r["d"], r["s"], r["s"] + r["n"] - 1
                while i <= last:
                    q = (p - i) // BLOCK
                    to = min(last, p - q * BLOCK)
                    firsts.append((i, to - i + 1, p - i))
                    blocks.append((p - q * BLOCK, q, r["h1"]))
                    i = to + 1
            for (i, n, d), (core, q, h1) in zip(firsts, blocks):
                shared = hashlib.blake2b(raw[core:core + LENGTH - BLOCK + 1], digest_size=8, salt=q.to_bytes(2, "little"),
                                         key=(h1 & (1 << 64) - 1).to_bytes(8, "little")).digest()
                out["key"].append(int.from_bytes(shared, "little", signed=True))
                out["id"].append(id_), out["rk"].append(rk), out["i"].append(i), out["n"].append(n), out["d"].append(d)
                out["body"].append(raw[i:i + n + LENGTH - 1])
        yield pa.RecordBatch.from_arrays([
            pa.array(out["key"], pa.int64()), pa.array(out["id"], pa.int64()), pa.array(out["rk"], pa.int64()),
            pa.array(out["i"], pa.int32()), pa.array(out["n"], pa.int32()), pa.array(out["d"], pa.int32()),
            pa.array(out["body"], pa.binary())], names=list(out))


def _words(a: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a big-endian number (zeros after the end)."""
    x = np.concatenate([a, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(a), np.uint64)
    for k in range(8):
        out = (out << U(8)) | x[k:k + len(a)]
    return out


def _rank(keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks of rows by several keys, the first one first."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        x = k[order]
        new[1:] |= x[1:] != x[:-1]
    out = np.empty(len(order), np.uint64)
    out[order] = np.cumsum(new).astype(np.uint64)
    return out


def repeated_suffixes(key: np.ndarray, d: np.ndarray, n: np.ndarray, bodies: list[bytes]) -> np.ndarray:
    """For each suffix of the bodies (all n of each, in turn): does an equal LENGTH-byte string start in another body?

    Suffixes are sorted by bucket, distance to the anchor, first bytes and
    cover-sample ranks; equal ones are neighbours.
    """
    # lay the bodies out with their anchors on multiples of the period
    size = np.fromiter(map(len, bodies), np.int64, len(bodies))
    begin, at = np.empty(len(bodies), np.int64), 0
    room = size + 2 * PERIOD + (-size) % PERIOD
    at = np.concatenate([[0], np.cumsum(room)[:-1]])
    at += (-at) % PERIOD
    begin = at + (-d) % PERIOD
    a = np.zeros(int(begin[-1] + size[-1] + 6 * PERIOD), np.uint8)
    for x, body in zip(begin.tolist(), bodies):
        a[x:x + len(body)] = np.frombuffer(body, np.uint8)
    word = _words(a)
    # ranks of the sample by PERIOD bytes, doubled twice to 128 bytes
    q = np.arange(0, len(a) - 5 * PERIOD, PERIOD)
    grid = np.arange(0, len(a) - PERIOD, PERIOD)
    rank = _rank([word[grid + k] for k in range(0, PERIOD, 8)])
    for step in (1, 2):
        nxt = np.concatenate([rank[step:], np.zeros(step, np.uint64)])
        rank = _rank([rank, nxt])
    # every suffix: shift to the next sample position, the same for all suffixes it can equal
    i = np.repeat(begin, n) + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
    row = np.repeat(np.arange(len(bodies)), n)
    dist = np.repeat(d, n) - (i - np.repeat(begin, n))
    sample = -(-i // PERIOD)
    keys = [key[row], dist, *(word[i + k] for k in range(0, PERIOD, 8)), rank[sample], rank[sample + 1],
            *(word[i + k] for k in range(LENGTH - 40, LENGTH, 8))]
    order = np.lexsort(keys[::-1])
    same = np.ones(len(order) - 1, bool)
    for k in keys:
        x = k[order]
        same &= x[1:] == x[:-1]
    out = np.zeros(len(order), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated stretches of a task's blocks, sorted by key; a group holds whole buckets."""
    held: list[tuple] = []
    size = 0

    def group(rows: list[tuple]) -> pa.RecordBatch | None:
        key = np.array([r[0] for r in rows], np.int64)
        _, inv, count = np.unique(key, return_inverse=True, return_counts=True)
        rows = [r for r, c in zip(rows, count[inv].tolist()) if c > 1]
        if not rows:
            return None
        key, n, d = (np.array([r[k] for r in rows], np.int64) for k in (0, 4, 5))
        hit = repeated_suffixes(key, d, n, [r[6] for r in rows])
        off = np.cumsum(n) - n
        pos = np.where(hit, np.arange(len(hit)) - np.repeat(off, n), -1)
        last = np.maximum.reduceat(pos, off)
        first = np.minimum.reduceat(np.where(hit, pos, 1 << 30), off)
        got = [(r[1], r[2], r[3] + int(f), r[3] + int(z) + LENGTH) for r, f, z in zip(rows, first, last) if z >= 0]
        return pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()),
                                           pa.array([g[2] for g in got], pa.int32()), pa.array([g[3] for g in got], pa.int32())],
                                          names=["id", "rk", "a", "b"])

    for b in batches:
        for r in zip(*(b.column(c).to_pylist() for c in ("key", "id", "rk", "i", "n", "d", "body"))):
            if size >= GROUP_BYTES and r[0] != held[-1][0]:
                if (x := group(held)) is not None:
                    yield x
                held, size = [], 0
            held.append(r)
            size += len(r[6])
    if held and (x := group(held)) is not None:
        yield x


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every suffix of a block by itself, with two hashes of its LENGTH bytes."""
    for b in batches:
        for id_, rk, i, n, body in zip(*(b.column(c).to_pylist() for c in ("id", "rk", "i", "n", "body"))):
            a, k = np.frombuffer(body, np.uint8), np.arange(n)
            x, y = Hashes(a).of(k, k + LENGTH), Hashes(a, BYTE2, BASE2).of(k, k + LENGTH)
            yield pa.RecordBatch.from_arrays([pa.array([id_] * n, pa.int64()), pa.array([rk] * n, pa.int64()),
                                              pa.array((i + k).astype(np.int32)), pa.array(x.view(np.int64)),
                                              pa.array(y.view(np.int64))], names=["id", "rk", "i", "x", "y"])


# ---------------------------------------------------------------- operator

def repeated_spans(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, rk, spans): repeated byte ranges [a, b) of each text, overlapping ones not yet joined.

    ``rows`` has id, rk (a hash of the text) and text.
    """
    scratch = Scratch(rows.sparkSession)
    runs = scratch.put("runs", rows.mapInArrow(_runs, RUN))
    shared = scratch.put("buckets", runs.groupBy("h1").agg(F.count("*").alias("c")).filter("c > 1").select(F.col("h1").alias("g1")))
    runs = scratch.put("shared-runs", runs.join(shared, F.col("h1") == F.col("g1")).drop("g1"))
    scratch.drop("runs", "buckets")
    contexts = scratch.put("contexts", runs.groupBy("h1", "h2", "h3").agg(
        F.count("*").alias("c"), F.min(F.struct("id", "rk", "s", "d", "n")).alias("one")))
    mixed = scratch.put("mixed", contexts.groupBy("h1").agg(F.count("*").alias("k")).filter("k > 1").select(F.col("h1").alias("g1")))
    # whole contexts that occur more than once
    twice = contexts.filter("c > 1").select(F.col("h2").alias("g2"), F.col("h3").alias("g3"))
    copies = (runs.join(twice, (F.col("h2") == F.col("g2")) & (F.col("h3") == F.col("g3")))
              .select("id", "rk", F.col("s").alias("a"), (F.col("s") + F.col("n") + F.lit(LENGTH - 1)).alias("b")))
    # one of each context of buckets with several, as blocks of suffixes
    todo = (contexts.join(mixed, F.col("h1") == F.col("g1")).select("one.*", "h1")
            .groupBy(F.col("id").alias("tid"), F.col("rk").alias("trk")).agg(F.collect_list(F.struct("s", "d", "n", "h1")).alias("runs")))
    texts = rows.join(todo, F.col("id").eqNullSafe(F.col("tid")) & (F.col("rk") == F.col("trk"))).select("id", "rk", "text", "runs")
    blocks = scratch.put("blocks", texts.mapInArrow(_blocks, SUFFIXES))
    large = scratch.put("large-blocks", blocks.groupBy("key").agg(F.count("*").alias("c")).filter(F.col("c") > block_rows)
                        .select(F.col("key").alias("big")))
    dealt = blocks.join(large, F.col("key") == F.col("big"), "left")
    sorted_ = (dealt.filter("big is null").drop("big").repartition("key").sortWithinPartitions("key")
               .mapInArrow(_sort, "id long, rk long, a int, b int"))
    singles = scratch.put("singles", dealt.filter("big is not null").drop("big").mapInArrow(_single, "id long, rk long, i int, x long, y long"))
    again = scratch.put("again", singles.groupBy("x", "y").agg(F.count("*").alias("c")).filter("c > 1")
                        .select(F.col("x").alias("gx"), F.col("y").alias("gy")))
    found = singles.join(again, (F.col("x") == F.col("gx")) & (F.col("y") == F.col("gy"))).select(
        "id", "rk", F.col("i").alias("a"), (F.col("i") + LENGTH).alias("b"))
    return (copies.unionByName(sorted_).unionByName(found)
            .groupBy(F.col("id").alias("sid"), F.col("rk").alias("srk")).agg(F.collect_list(F.struct("a", "b")).alias("spans")))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint maximal ranges; touching ones join."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True,
                   digests: bool = False, carry: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans; on request kept (text), kept_sha256 and row (all input columns).

    Texts are UTF-8 bytes, null is empty; matches never cross texts; ranges are
    judged on the input.  ``kept`` drops what is left of characters that were
    cut.  Texts under LENGTH bytes stay whole.  Repeated rows are copies of each
    other and lose every byte that a LENGTH-byte string covers; a null id is an id like
    any other; an empty table gives no rows.
    """
    text = column(text_col).cast("string")
    own = whole_row(docs) if carry else F.struct(text.alias(text_col))
    # the key holds the text's hash, so that two rows with one id stay apart
    full = docs.select(column(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("rk"), own.alias("row"))
    of_row = F.col("row").getField(text_col).cast("string").alias("text")
    spans = repeated_spans(full.select("id", "rk", of_row), block_rows)
    schema = fields("id long, n_bytes long, n_removed long, n_spans long" + ", kept string" * keep_text + ", kept_sha256 string" * digests,
                    **({"row": full.schema["row"].dataType} if carry else {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")}
            for t, found in zip(b.column("text"), b.column("spans").to_pylist()):
                raw = (t.as_py() or "").encode("utf-8")
                gone = _merge([(x["a"], x["b"]) for x in found or ()])
                cuts = [0, *(x for ab in gone for x in ab), len(raw)]
                left = b"".join(raw[cuts[k]:cuts[k + 1]] for k in range(0, len(cuts), 2)) if gone else raw
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(len(raw) - len(left))
                out["n_spans"].append(len(gone))
                if keep_text:
                    out["kept"].append(left.decode("utf-8", "ignore"))
                if digests:
                    out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            cols = {"id": b.column("id"), **{k: pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")}}
            cols |= {k: pa.array(out[k], pa.string()) for k, on in (("kept", keep_text), ("kept_sha256", digests)) if on}
            cols |= {"row": b.column("row")} if carry else {}
            yield pa.RecordBatch.from_pydict(cols)

    joined = full.join(spans, F.col("id").eqNullSafe(F.col("sid")) & (F.col("rk") == F.col("srk")), "left")
    return joined.select("id", of_row, "spans", *(["row"] if carry else [])).mapInArrow(run, schema)


def op2_suffixes(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), keep_text=False, digests=True)
    return out.withColumnRenamed("id", "doc_id")
