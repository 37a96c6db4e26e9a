"""The prefix trie against a brute-force version."""

import base64
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from textsieve.llm import trie


def brute(seqs):
    """Nodes of {conv_id: [(role, text), ...]} as tuples in the output's order of columns."""
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[c] for c in below) if below else 1
        saved[p] = sum(saved[c] for c in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rebuilt(rows):
    convs = {}
    for c, n, r, t in rows:
        if c is not None:
            convs.setdefault(c, []).append((n is not None, n or 0, r or "", t or ""))
    convs = {c: [(r, t) for _, _, r, t in sorted(s)] for c, s in convs.items()}
    out = {}
    for c, s in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + s[h:]
    return out


def nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def paths_of(spark, seqs, parts):
    rows = [(c, i, r, t) for c, s in seqs.items() for i, (r, t) in enumerate(s)]
    turns = trie.turn_lists(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    known = spark.createDataFrame([(c,) for c in seqs], "conv_id long").join(turns, "conv_id", "left")
    empty = F.array().cast("array<struct<digest:string,size:int>>")
    return known.repartition(parts).select("conv_id", *trie.as_paths(F.coalesce("turns", empty)))


def random_seqs(seed, n, depth, texts):
    rng = random.Random(seed)
    return {i: [(rng.choice(["user", "a"]), rng.choice(texts)) for _ in range(rng.randrange(depth))] for i in rng.sample(range(-n, 10 * n), n)}


@pytest.mark.parametrize("seed, fan, block_rows", [(1, 64, 4096), (2, 2, 3), (3, 3, 1), (4, 2, 7)])
def test_equals_brute_force_over_many_blocks_and_levels(spark, seed, fan, block_rows):
    seqs = random_seqs(seed, 130, 7, ["", "x", "é"])
    seqs |= {5000 + i: [("user", "x"), ("a", "é"), ("user", "x")] for i in range(60)}  # a group of copies
    seqs |= {6000: [("user", "x")] * 300, 6001: [("user", "x")] * 299 + [("user", "y")]}  # long shared paths
    assert nodes(trie.prefix_trie(paths_of(spark, seqs, 5), fan, block_rows)) == brute(seqs)


def test_contraction_in_one_process():
    rng = random.Random(9)
    for _ in range(300):
        seqs = random_seqs(rng.random(), rng.randrange(1, 25), rng.randrange(1, 6), ["", "é"])
        paths = {}
        for c, s in seqs.items():
            p = "".join(f"{'0' if r == 'a' else '1'}{len(t.encode())}".ljust(trie.WIDTH) for r, t in s)
            paths.setdefault(p, ([len(t.encode()) for _, t in s], []))[1].append(c)
        level = [trie.Path(p, sizes, {len(sizes): trie.Hung(len(m), min(m), sha=hashlib.sha256(",".join(map(str, sorted(m))).encode()).hexdigest())})
                 for p, (sizes, m) in sorted(paths.items())]
        rows, named = [], False
        while True:
            size = rng.randrange(2, 6)
            cuts = [level[a:a + size] for a in range(0, len(level), size)]
            if len(cuts) == 1:
                rows += trie.contract(cuts[0], True, named)[0]
                break
            level = []
            for cut in cuts:
                done, left = trie.contract(cut, False, named)
                rows += done
                level += left
            named = True
            if len(level) == 2 * len(cuts) and size == 2:  # nothing got smaller: finish
                rows += trie.contract(level, True, True)[0]
                break
        known = {r[8]: r[0] for r in rows if r[8]}
        got = sorted((tuple([*r[:2], known[r[9]] if r[9] else r[2], *r[3:8]]) for r in rows), key=repr)
        assert got == brute(seqs)


def test_rebuilt_conversations_with_nulls_ties_and_extra_columns(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, -7, *range(23)]), rng.choice([None, 0, 1, 2, 3]), rng.choice([None, "user", "assistant"]), rng.choice([None, "", "a", "b" * 3000])) for _ in range(160)]
    rows += [(100, i, "user", "hello") for i in range(12)] + [(104, 0, "user", "only")] * 3  # 104 keeps no turn of its own if h >= 3
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    # ties of role and number go by the text's digest
    order = lambda r: hashlib.sha256(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).digest()[:18]
    want = {}
    for c in {r[0] for r in rows} - {None}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", base64.b64encode(order(r))))
        want[c] = [(r[2] or "", r[3] or "") for r in mine]
    seqs = {}
    for c, s in want.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        seqs[c] = want.get(base, [])[:h] + s[h:]
    turns = trie.rebuild(trie.turn_lists(df.withColumns({c: F.lit(0) for c in ("path", "turns", "a b", "digest")})))
    assert nodes(trie.prefix_trie(turns.select("conv_id", *trie.as_paths(F.col("turns"))))) == brute(seqs)


def test_query_on_the_small_table_and_empty_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(trie.op12_trie(spark, "/root/testdata/sf0.001")) == brute(rebuilt(rows))
    none = trie.prefix_trie(paths_of(spark, {1: [("user", "x")]}, 1).limit(0))
    assert none.count() == 0 and none.columns == trie.NODE_COLUMNS
