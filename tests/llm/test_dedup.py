"""SimHash, suffix-array and embedding duplicates, and components, against brute force."""

import hashlib
import random
import re
import threading
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textsieve.llm import metric_join, shared, simhash, suffixes
from textsieve.llm.components import connected_components
from textsieve.llm.shared import Scratch


def roots(nodes, links):
    """Smallest node reachable, by repeated relaxation."""
    low = {n: n for n in nodes}
    while True:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            for x in (a, b):
                if low[x] != m:
                    low[x], changed = m, True
        if not changed:
            return low


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)] + [(100, i) for i in range(101, 140)],
    [(5, 3), (3, 5), (9, 8), (8, 7), (7, 3), (-4, 20)],
])
def test_components(spark, links):
    out = connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    real = [x for x in links if x[0] != x[1]]
    expected = roots({x for p in real for x in p}, real)
    assert {r["node"]: r["root"] for r in out} == expected
    assert len(out) == len(expected)


# ---------------------------------------------------------------- SimHash

def slow_fingerprint(text, words=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint():
    rng = random.Random(3)
    texts = [None, "", " \n\t", "One", "one two", "ÀB c d E\x0bf g", "a b c a b c a b c", " ".join(rng.choices("abcdef", k=3000))]
    texts += [" ".join(rng.choices(["x", "YY", "zé", " q"], k=rng.randint(1, 40))) for _ in range(50)]
    assert [simhash.fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]


def planted_fingerprints(seed, n=400):
    rng = random.Random(seed)
    out = {0, 7, (1 << 64) - 1}
    for _ in range(n // 8):
        x = rng.getrandbits(64)
        for _ in range(8):
            out.add(x)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
    base = rng.getrandbits(64)
    out |= {base ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)}  # a dense group
    return sorted(out)


@pytest.mark.parametrize("partitions,cell_rows", [((2, 3, 4), 16384), ((2,), 40), ((3,), 16), ((4,), 30)])
def test_hamming_links_connect_what_pairs_connect(spark, partitions, cell_rows):
    fps = planted_fingerprints(1)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    table = Scratch(spark).put("fps", spark.createDataFrame([(x,) for x in signed], "fp long"))
    links = [(r["a"], r["b"]) for r in simhash.hamming_links(table, 3, partitions, cell_rows).collect()]
    a = np.array(fps, dtype=np.uint64)
    pairs = [(signed[i], signed[j]) for i in range(len(a)) for j in (np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= 3) + i + 1)]
    near = {tuple(sorted(p)) for p in pairs}
    assert all(tuple(sorted(x)) in near for x in links)
    assert roots(signed, links) == roots(signed, pairs)


def test_thresholds_cover_the_budget():
    for budget in (1, 2, 4, 6):
        work = [[0.0] + [10.0 * (i + 1) * k for k in range(1, budget + 1)] for i in range(3)]
        cost, ts = simhash.allocate(work, budget)
        assert sum(t + 1 for t in ts) == budget
        assert cost == sum(w[t + 1] for w, t in zip(work, ts))
    assert simhash.allocate([[0, 1, 100], [0, 50, 60]], 2) == (51, [0, 0])


def test_simhash_groups(spark):
    rows = [(5, "a b c d"), (2, "A B c D"), (None, "a b c d"), (9, None), (8, ""), (7, " \n"), (1, "something else here now"), (1, "something else here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("id", "fp", "a", "component", "node")})
    out = [(r["id"], r["component"]) for r in simhash.simhash_groups(df).collect()]
    assert sorted(out, key=str) == sorted([(5, 2), (2, 2), (None, 2), (9, 7), (8, 7), (7, 7), (1, 1), (1, 1)], key=str)
    assert simhash.simhash_groups(df.limit(0)).count() == 0


# ---------------------------------------------------------------- suffixes

def slow_repeats(texts, length=suffixes.LENGTH):
    seen = defaultdict(int)
    raw = [(t or "").encode() for t in texts]
    for x in raw:
        for i in range(len(x) - length + 1):
            seen[x[i:i + length]] += 1
    out = []
    for x in raw:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        left = bytes(c for c, g in zip(x, gone) if not g)
        out.append((len(x), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def repeated_texts(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(300)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    passage, line = say(90), say(12)
    texts = [None, "", "short", "a" * 199, "b" * 200, "b" * 199 + "c", "d" * 450, "xyz" * 150, "é" * 150, say(800)]
    for k in range(60):
        t = say(rng.randint(1, 120))
        if k % 3 == 0:
            t = t + " " + line + " " + say(30)
        if k % 4 == 0:
            t = t + passage + say(rng.randint(0, 20))
        if k % 5 == 0:
            t = passage[rng.randint(0, 250):rng.randint(300, 500)] + t
        texts.append(t)
    texts += [texts[20], texts[20], texts[9][:1500], texts[9][700:2600] + "!", texts[9][300:] + say(3) + texts[9][:900]]
    near = texts[9].split(" ")
    for k in range(12):  # near copies
        copy = list(near)
        for _ in range(3):
            copy[rng.randrange(len(copy))] = "edit"
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("seed,block_rows", [(1, 4096), (2, 3)])
def test_repeats_against_brute_force(spark, seed, block_rows):
    texts = repeated_texts(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in suffixes.remove_repeats(df, digests=True, block_rows=block_rows).collect()}
    assert got == dict(enumerate(slow_repeats(texts)))


def test_sorting_in_groups_finds_the_same(monkeypatch):
    import pyarrow as pa

    rng = random.Random(8)
    rows = []
    for key in range(60):
        core = bytes(rng.choices(b"abc", k=210))
        for doc in range(rng.randint(1, 6)):
            d, n = rng.randint(0, 60), rng.randint(1, 25)
            body = core + bytes(rng.choices(b"ab", k=30))
            rows.append((key, doc, 0, 1000 * doc, n, d, body[:n + 199]))
    batch = pa.RecordBatch.from_pydict({k: pa.array(v, t) for k, v, t in zip(
        ("key", "id", "rk", "i", "n", "d", "body"), zip(*rows), [pa.int64()] * 6 + [pa.binary()])})

    def found(size):
        monkeypatch.setattr(suffixes, "GROUP_BYTES", size)
        return sorted(tuple(r.values()) for x in suffixes._sort(iter([batch.slice(0, 50), batch.slice(50)])) for r in x.to_pylist())

    one = found(1 << 30)
    assert one and found(1) == one and found(3000) == one


def test_long_texts_are_cut_into_pieces_without_loss(monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 1000)
    import pyarrow as pa

    rng = random.Random(5)
    text = "".join(rng.choices("abcd ", k=7000))
    seen = set()
    for a, ends, rows, offs in suffixes._pieces(pa.array(["x" * 50, text, "y" * 300])):
        r = suffixes.runs_of(a, ends)
        k = np.searchsorted(ends, r["s"], "right") if r else []
        for j, s, n in zip(k, r.get("s", ()), r.get("n", ())):
            begin = int(ends[j - 1]) if j else 0
            seen |= {(int(rows[j]), int(offs[j]) + int(s) - begin + d) for d in range(n)}
    assert seen == {(1, i) for i in range(7000 - 199)} | {(2, i) for i in range(101)}


def test_repeats_edge_rows(spark):
    long = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(700))
    rows = [(1, long, "p"), (1, "other " + long[:150], "q"), (None, long, "r"), (2, None, "s"), (2, None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, rk string").withColumns({c: F.lit(1) for c in ("id", "row", "spans", "h1")})
    out = suffixes.remove_repeats(df, carry=True).collect()
    assert sorted((str(r["id"]), r["n_bytes"], r["n_removed"], r["kept"], r["row"]["rk"]) for r in out) == sorted(
        [("1", 700, 700, "", "p"), ("1", 156, 0, "other " + long[:150], "q"), ("None", 700, 700, "", "r"), ("2", 0, 0, "", "s"), ("2", 0, 0, "", "s")])
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


# ---------------------------------------------------------------- embeddings

def test_metric_join_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(metric_join, "PER_PIVOT", 60)
    monkeypatch.setattr(metric_join, "HOMES", 25)
    monkeypatch.setattr(metric_join, "GUESTS", 40)
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(12, 8))
    x = np.concatenate([c + 0.25 * rng.normal(size=(30, 8)) for c in centers] + [rng.normal(size=(40, 8)), centers[:1].repeat(70, 0) * 3])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    ids = rng.permutation(len(x)).tolist()
    low = roots(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(linked)) if i < j])
    bad = [(1001, None), (1002, [0.0] * 8), (1003, [1.0, None] + [0.0] * 6), (1004, [float("nan")] * 8), (1005, [float("inf")] * 8), (1006, [])]
    df = spark.createDataFrame([*zip(ids, x.tolist()), *bad], "vec_id long, embedding array<double>").withColumns({c: F.lit(0) for c in ("id", "v", "cell", "label")})
    out = {r["id"]: (r["n_links"], r["component"], r["kept"]) for r in metric_join.near_duplicates(df).collect()}
    expected = {i: (int(n), low[i], low[i] == i) for i, n in zip(ids, linked.sum(axis=1))} | {i: (0, i, True) for i, _ in bad}
    assert out == expected
    assert metric_join.near_duplicates(df.limit(0)).count() == 0
    assert metric_join.near_duplicates(df.filter("vec_id > 1000")).count() == len(bad)


def most_on_disk(spark, of: Path, run):
    """What run() returns, and the most bytes that its shuffle files and the tables in a folder took meanwhile."""
    local, sizes, done = [Path(str(d)) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()], [], threading.Event()

    def size(f: Path) -> int:
        try:
            return f.stat().st_size
        except OSError:  # it may go meanwhile
            return 0

    def watch():
        while not done.is_set():
            sizes.append(sum(size(f) for d in local for f in d.glob("*/shuffle_*.data")) + sum(size(f) for f in of.glob("*/*.parquet")))
            done.wait(0.1)

    thread = threading.Thread(target=watch)
    thread.start()
    try:
        return run(), max(sizes) - sizes[0]
    finally:
        done.set()
        thread.join()


def test_metric_join_writes_no_vector_for_every_cell(spark, monkeypatch, tmp_path):
    """Vectors without clusters are near every cell; what is written and shuffled stays in proportion to them."""
    for name, value in (("PER_PIVOT", 60), ("HOMES", 100), ("GUESTS", 128)):
        monkeypatch.setattr(metric_join, name, value)
    monkeypatch.setattr(metric_join, "BLOCK_BYTES", 300 * 64 * 4, raising=False)  # large cells in several blocks
    kept = []
    monkeypatch.setattr(shared, "scratch_path", lambda spark, name: kept.append(name) or str(tmp_path / f"{name}{len(kept)}"))
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 64))
    x[:600] = x[0] + 0.2 * x[:600]  # one group, most of its vectors beyond each block
    x[700:900:2] = x[701:900:2] + 0.1 * x[700:900:2]  # pairs
    x = x.astype(np.float32)
    x[1000:1200] = x[1000]  # equal vectors, in several partitions
    x[1000:1200, 5] = 0.0
    x[1000:1100, 5] = -0.0
    x[1500:1520, 40:] = 0
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    cos = u @ u.T
    assert (np.abs(cos - 0.9) > 1e-9).all()
    linked = cos >= 0.9
    np.fill_diagonal(linked, False)
    ids = rng.permutation(len(x)).tolist()
    low = roots(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(linked)) if i < j])
    vectors = [v[:40] if 1500 <= i < 1520 else v for i, v in enumerate(x.tolist())]  # shorter ones are as if zeros followed
    rows = [*zip(ids, vectors)]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "vec_id long, embedding array<float>")
    out, most = most_on_disk(spark, tmp_path, lambda: metric_join.near_duplicates(df).collect())
    assert {r["id"]: (r["n_links"], r["component"], r["kept"]) for r in out} == {i: (int(n), low[i], low[i] == i) for i, n in zip(ids, linked.sum(axis=1))}
    assert most < 10 * x.nbytes, most / x.nbytes


def test_metric_join_null_and_repeated_ids(spark):
    near = lambda a: [float(np.cos(a)), float(np.sin(a))]
    rows = [(7, near(0.0)), (7, near(0.1)), (9, near(0.2)), (None, near(0.3)), (None, near(0.3)),  # one group, two vectors of id 7
            (None, near(2.0)), (None, near(2.1)),  # a group without an id
            (7, near(-2.0)), (3, near(-2.1)),  # id 7 again, in another group
            (None, near(3.5)), (None, None)]
    out = metric_join.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    expected = [(7, 4, 7, True), (7, 4, 7, True), (9, 4, 7, False), (None, 4, 7, False), (None, 4, 7, False),
                (None, 1, None, True), (None, 1, None, True), (7, 1, 3, False), (3, 1, 3, True), (None, 0, None, True), (None, 0, None, True)]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, expected))
