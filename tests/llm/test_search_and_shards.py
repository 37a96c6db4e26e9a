"""Nearest neighbours, URL filter, sharding and mixing."""

import random
import re
import tempfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from textsieve.llm import mixing, sharding, urls, vptree


# ---------------------------------------------------------------- nearest neighbours

def exact_nearest(ids, x, queries, k):
    out = {}
    for a in queries:
        q = x[ids.index(a)]
        scores = [(-float((q * v).sum()), i) for i, v in zip(ids, x) if i != a]
        out[a] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_factor_one_is_exact_with_any_norms_and_ties(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, size=(300, 6)).astype(float) * rng.choice([1, 2, 5], size=(300, 1))
    x[np.abs(x).sum(axis=1) == 0] = 1
    x[40:70] = x[40]  # ties
    ids = rng.permutation(1000)[:300].tolist()
    bad = [(2000, None), (2020, [0.0] * 6), (2040, [float("nan")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame([*zip(ids, x.tolist()), *bad], "vec_id long, embedding array<double>")
    df = df.unionByName(df.limit(5)).withColumns({c: F.lit(0) for c in ("id", "v", "query", "score")})
    out = {}
    for r in vptree.nearest(df, F.col("id") % 20 == 0, k=20, factor=1.0, shard_rows=70, query_rows=7).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    expected = exact_nearest(ids, x, [i for i in ids if i % 20 == 0], 20)
    assert set(out) == set(expected)
    for q, rows in expected.items():
        got = sorted(out[q])
        assert [g[0] for g in got] == list(range(1, 21))
        assert [(g[1], g[2]) for g in got] == rows


def test_recall_and_scored_pairs_over_many_shards(spark):
    """Vectors in clusters, over eight shards: what is found, and how much of all pairs it took."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(40, 16))[rng.integers(0, 40, 3000)] * 4 + rng.normal(size=(3000, 16)) * 0.4
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    df = spark.createDataFrame(list(zip(range(3000), x.tolist())), "vec_id long, embedding array<double>")
    want = exact_nearest(list(range(3000)), x, range(0, 3000, 20), 20)
    q, ids = x[::20], np.arange(3000)
    norm = float(np.sqrt((x * x).sum(axis=1).max())) * (1 + 1e-12)
    chosen = vptree.calibrated_factor((ids, x), (ids[::20], q), norm, 20)
    least = vptree.kth_score(q, ids[::20], x, ids, 20)
    for factor in (1.0, None):
        got = {}
        for r in vptree.nearest(df, F.col("id") % 20 == 0, factor=factor, shard_rows=375).collect():
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
        recall = sum(len(got[a] & {i for i, _ in rows}) for a, rows in want.items()) / (20 * len(want))
        assert recall == 1.0 if factor else recall >= 0.95
    scored = [sum(vptree.Search(q, ids[::20], vptree.lifted_tree(x[s::8], norm), x[s::8], ids[s::8], norm, 20, f, least).seen for s in range(8)) / (len(q) * 3000)
              for f in (chosen, 1.0)]
    print("factor", chosen, "pairs scored", scored)
    assert 0.1 <= chosen < 1 and scored[0] < 0.5 and scored[0] <= scored[1], scored


def test_recall_of_the_production_factor(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in vptree.nearest(df, F.col("id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    at = {v: i for i, v in enumerate(ids)}
    hits = n = 0
    for q in (i for i in ids if i % 20 == 0):
        s = x @ x[at[q]]
        s[at[q]] = -np.inf
        hits, n = hits + len(got[q] & {ids[j] for j in np.argsort(-s, kind="stable")[:20]}), n + 20
    assert hits / n >= 0.95


def test_few_candidates_and_empty(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.5, 0.0])], "vec_id long, embedding array<float>")
    out = vptree.nearest(df, F.col("id") % 20 == 0).collect()
    assert [tuple(r) for r in out] == [(20, 1, 1, 0.5)]
    assert vptree.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


# ---------------------------------------------------------------- URLs

ODD_URLS = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.NET/en/x", "http://example.net/enx", "https://a.example.com/de/?q",
            "http://notexample.com/de/", "http://x.org/fr/", "http://org/fr/1", "http://net/", "http://net", "a://b.net/?://c.org/fr/", "http://é.net/ü",
            "http://x.org/fr\n/", "x" * 3000, "http://EXAMPLE.com/de/#"]


def judged(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "page_id long, url string")
    extra = df.withColumns({c: F.lit(0) for c in ("id", "u", "g", "host", "bin", "score")})
    return df, {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.filter_urls(extra).collect()}


def test_url_rules(spark):
    _, out = judged(spark, ODD_URLS)
    by = dict(zip(ODD_URLS, (out[i] for i in range(len(ODD_URLS)))))
    assert by[None][:3] == by[""][:3] == by["no scheme"][:3] == ("", "", None)
    assert by["HTTP://WWW.Example.NET/en/x"] == ("www.example.net", "/en/x", "example.net/en/", "allow")
    assert by["http://example.net/enx"] == ("example.net", "/enx", "net/", "block")
    assert by["https://a.example.com/de/?q"] == ("a.example.com", "/de/", "example.com/de/", "block")
    assert by["http://notexample.com/de/"][2] is None
    assert by["http://x.org/fr/"][2:] == ("org/fr/", "allow") and by["http://org/fr/1"][2:] == ("org/fr/", "allow")
    assert by["http://net/"][2:] == ("net/", "block") and by["http://net"][2] is None
    assert by["a://b.net/?://c.org/fr/"][:3] == ("b.net", "/", "net/")
    assert {v[3] for v in out.values()} <= {"allow", "block"}


def test_url_filter_equals_its_sql(spark):
    rng = random.Random(4)
    hosts = ["a.example.net", "b.example.com", "c.example.org", "shop.test", "example.net"]
    values = ODD_URLS + [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.choice(['cheap', 'news'])}{rng.randint(0, 30)}" for _ in range(400)]
    df, out = judged(spark, values)
    path = f"{tempfile.mkdtemp(prefix='textsieve-test-')}/pages.parquet"
    df.toPandas().to_parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path}')")
    assert {r[0]: r[1:] for r in con.sql(urls.OP1_SQL).fetchall()} == out


def test_url_models_tell_the_classes_apart(spark):
    """URLs that no rule decides follow the kind that they resemble."""
    values = [f"http://x{i}.net/casino/{i % 17}" for i in range(300)] + [f"http://x{i}.org/fr/recettes/{i % 19}" for i in range(300)]
    values += [f"http://y{i}.test/casino/{i % 17}" for i in range(50)] + [f"http://y{i}.test/fr/recettes/{i % 19}" for i in range(50)]
    _, out = judged(spark, values)
    assert sum(out[i][3] == "block" for i in range(600, 650)) >= 48 and sum(out[i][3] == "allow" for i in range(650, 700)) >= 48


def test_url_filter_of_nothing(spark):
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


# ---------------------------------------------------------------- sharding

@pytest.mark.parametrize("seed", range(4))
def test_transfers_move_the_fewest_bytes(seed):
    rng = random.Random(seed)
    old = {k: rng.randint(0, 1000) for k in range(rng.randint(1, 9))}
    capacity = sharding.equal_capacities(sum(old.values()), rng.randint(1, 12))
    flow = sharding.transfers(old, capacity)
    for k, size in old.items():
        assert sum(v for (a, _), v in flow.items() if a == k) == size
    for j, c in enumerate(capacity):
        assert sum(v for (_, b), v in flow.items() if b == j) <= c
    # what a shard cannot hold must go, and no more
    fewest = sum(max(0, size - (capacity[k] if k < len(capacity) else 0)) for k, size in old.items())
    assert sum(v for (a, b), v in flow.items() if a != b) == fewest


def test_transfers_need_room():
    with pytest.raises(ValueError):
        sharding.transfers({0: 10}, [4, 5])


def test_reshard_rows_and_files(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([None, "", "x" * rng.randint(1, 60), "é" * 20]), rng.choice([0, 0, 0, 1, 2, None])) for i in range(900)]
    rows += [(None, "no id", 1), (3, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(rows, "doc_id long, text string, old int").withColumns({c: F.lit(0) for c in ("id", "size", "shard", "block", "slot")})
    out, flow = sharding.reshard(df, F.col("old"), 5)
    got = out.collect()
    assert len(got) == len(rows)
    size = {}
    for j in range(5):
        mine = [r for r in got if r["shard"] == j]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        size[j] = sum(r["size"] for r in mine)
    assert max(size.values()) - min(size.values()) <= 2 * (60 + 16)
    moved = sum(r["size"] for r in got if r["old_shard"] != r["shard"])
    assert abs(moved - sum(v for (a, b), v in flow.items() if a != b)) <= 76 * len(flow)
    unique = df.filter("doc_id is not null").dropDuplicates(["doc_id"])
    out, flow = sharding.reshard(unique, F.col("old"), 5)
    root = tempfile.mkdtemp(prefix="textsieve-test-") + "/shards"
    written = sharding.rewrite_affected(unique, out, flow, root)
    back = {(r["doc_id"], r["shard"]) for r in spark.read.parquet(root).select("doc_id", "shard").collect()}
    assert back == {(r["id"], r["shard"]) for r in out.collect() if r["shard"] in written}
    empty, flow = sharding.reshard(df.limit(0), F.col("old"), 5)
    assert empty.count() == 0 and not flow


def test_shards_that_fit_stay(spark):
    df = spark.createDataFrame([(i, "t" * 4, i % 4) for i in range(400)], "doc_id long, text string, old int")
    out, flow = sharding.reshard(df, F.col("old"), 4)
    assert sharding.affected_shards(flow) == [] and out.filter("old_shard <> shard").count() == 0


def test_shard_files_hold_every_row_once_with_its_slot(spark):
    """Null ids, repeated ids and repeated rows, in shards that change and one (4) that does not."""
    rng = random.Random(7)
    rows = [(rng.choice([None, *range(150)]), "x" * rng.randint(0, 60), rng.choice([0, 0, 0, 1, 2]), i) for i in range(600)]
    rows += [*rows[:20], *[(5, "same", 1, k) for k in range(9)], *[(9000 + i, "y" * 184, 4, i) for i in range(40)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, old int, n int").withColumns({c: F.lit(0) for c in ("id", "size", "Slot", "block", "row")})
    total = sum(len(r[1]) + 16 for r in rows)
    rest = total - 40 * 200
    out, flow = sharding.reshard(df, F.col("old"), 5, capacity=[*sharding.equal_capacities(rest, 4), 40 * 200])
    root = tempfile.mkdtemp(prefix="textsieve-test-") + "/shards"
    written = sharding.rewrite_affected(df, out, flow, root)
    assert written == [0, 1, 2, 3]
    back = spark.read.parquet(root).collect()
    assert sorted((str(r["doc_id"]), r["text"], r["old"], r["n"]) for r in back) == sorted((str(a), t, o, n) for a, t, o, n in rows if o != 4)
    planned = sorted((r["shard"], r["slot"], str(r["id"]), r["size"], r["old_shard"]) for r in out.collect() if r["shard"] in written)
    assert sorted((r["shard"], r["slot"], str(r["doc_id"]), len(r["text"]) + 16, r["old"]) for r in back) == planned


def test_blocks_and_writing_tasks_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_BYTES", 500)
    monkeypatch.setattr(sharding, "BLOCKS", 4)
    df = spark.createDataFrame([(i, "t" * 84, i % 3 % 2) for i in range(900)], "doc_id long, text string, old int")
    out, flow = sharding.reshard(df, F.col("old"), 4)
    sizes = {r["shard"]: r["s"] for r in out.groupBy("shard").agg(F.sum("size").alias("s")).collect()}
    assert flow.starts.count() > 100 and max(sizes.values()) - min(sizes.values()) <= 200
    root = tempfile.mkdtemp(prefix="textsieve-test-") + "/shards"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sharding.rewrite_affected(df, out, flow, root, write_bytes=1000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(root)
    rows = files.groupBy(F.input_file_name()).count().agg(F.max("count"), F.count("*")).first()
    assert files.count() == out.filter(F.col("shard").isin(sharding.affected_shards(flow))).count() and rows[0] <= 120 and rows[1] > 40


def test_sharding_query_returns_what_its_files_hold(spark, monkeypatch):
    roots = []
    monkeypatch.setattr(sharding, "scratch_path", lambda *a: roots.append(tempfile.mkdtemp(prefix="textsieve-test-") + "/shards") or roots[-1])
    sf = "/root/testdata/sf0.001"
    got = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.op9_sharding(spark, sf).collect()}
    files = spark.read.parquet(roots[0])
    back = {(r["doc_id"], r["shard"], r["slot"]) for r in files.collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert back <= got and len(got) == docs.count() and len(back) > 0
    assert files.drop("shard", "slot").exceptAll(docs).count() == 0
    assert {r[0] for r in back}.isdisjoint(r[0] for r in got - back)


# ---------------------------------------------------------------- mixing

def test_raking_meets_the_marginals():
    tokens = np.array([400.0, 300, 200, 100, 800, 200])
    codes = [np.array([0, 0, 1, 1, 2, 2]), np.array([0, 1, 0, 1, 0, 1])]
    targets = [np.array([0.3, 0.2, 0.5]), np.array([0.6, 0.4])]
    w = mixing.rake(tokens, codes, targets, 600)
    assert np.allclose(np.bincount(codes[0], w), [180, 120, 300], rtol=1e-6)
    assert np.allclose(np.bincount(codes[1], w), [360, 240], rtol=1e-6)
    assert (w <= tokens).all()


def test_word_count(spark):
    values = [None, "", " ", "a", " a  b\n\tc ", "\x0bx\x0c", "é ü"]
    rows = mixing.counted(spark.createDataFrame(list(enumerate(values)), "i int, text string")).collect()
    assert {r["i"]: r["n_tokens"] for r in rows} == {i: len((v or "").encode().split()) for i, v in enumerate(values)}
    assert {r["i"]: r["n_lines"] for r in rows} == {i: (v or "").count("\n") + 1 for i, v in enumerate(values)}


def test_mix_samples_to_targets(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), rng.choice(["a", "a", "a", "b", None]), rng.choice(["en", "de"])) for i in range(6000)]
    rows += [(9001, None, "a", "en"), (None, "x y", "b", None), (5, rows[5][1], rows[5][2], rows[5][3])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumns({c: F.lit(0) for c in ("id", "s", "kept", "draw", "n_tokens")})
    out = mixing.mix(df, topic=F.lit("t"), targets={"source": {"a": 0.4, "b": 0.4, "(none)": 0.2}, "lang": {"en": 0.7, "de": 0.3, "(none)": 0.0}}, keep=0.4, carry=True).collect()
    assert len(out) == len(rows)
    expected = {}
    for r in out:
        assert r["kept"] == (r["draw"] < r["probability"]) and 0 <= r["probability"] <= 1
        expected[r["source"]] = expected.get(r["source"], 0) + r["probability"] * r["n_tokens"]
    total = sum(expected.values())
    assert np.allclose([expected["a"] / total, expected["b"] / total], 0.4, atol=1e-3)
    kept = sum(r["n_tokens"] for r in out if r["kept"])
    assert abs(kept / total - 1) < 0.05
    assert len({(r["draw"], r["kept"]) for r in out if r["id"] == 5}) == 1
    again = {(r["id"], r["kept"]) for r in mixing.mix(df.repartition(7), topic=F.lit("t"), keep=0.4).collect()}
    assert again == {(r["id"], r["kept"]) for r in mixing.mix(df, topic=F.lit("t"), keep=0.4).collect()}
    assert mixing.mix(df.limit(0)).count() == 0


def test_what_full_values_cannot_take_goes_to_the_others():
    got = mixing.capped(np.array([5.0, 3, 1, 1, 0]), np.array([10.0, 100, 100, 5, 50]), 100)
    assert np.allclose(got, [10, 63.75, 21.25, 5, 0])
    assert np.allclose(mixing.capped(np.array([1.0, 1]), np.array([10.0, 20]), 500), [10, 20])
    rng = np.random.default_rng(2)
    for _ in range(200):
        shares, have = rng.integers(0, 5, 6).astype(float), rng.integers(0, 40, 6).astype(float)
        total = rng.uniform(0, have[shares > 0].sum())
        got = mixing.capped(shares, have, total)
        assert np.all(got <= have + 1e-9) and np.all(got[shares == 0] == 0)
        if shares.sum():
            assert np.isclose(got.sum(), total)
            open_ = (got < have - 1e-9) & (shares > 0)
            assert np.allclose(got[open_] / shares[open_], (got[open_] / shares[open_])[:1])


def test_query_meets_what_the_cells_can_give_and_reports_the_rest(spark):
    """The whole query against raking by brute force, and its report."""
    sf = "/root/testdata/sf0.001"
    out = mixing.op10_mixing(spark, sf).cache()
    rows = out.collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    cells = {}
    for r in rows:
        assert r["n_tokens"] == len([w for w in re.split("[ \t\n\v\f\r]+", docs[r["doc_id"]]["text"] or "") if w])
        c = cells.setdefault((r["source"], r["lang"], r["topic"]), [0, r["probability"]])
        c[0] += r["n_tokens"]
        assert r["kept"] == (r["draw"] < r["probability"]) and c[1] == r["probability"]
    have = {k: t for k, (t, _) in cells.items()}
    total, w = 0.8 * sum(have.values()), {k: 0.8 * t for k, t in have.items()}
    of = [{v: sum(t for k, t in have.items() if k[d] == v) for v in {k[d] for k in have}} for d in range(3)]
    goals = []
    for values in of:
        names = sorted(values)
        g = mixing.capped(np.array([values[n] ** 0.7 for n in names]), np.array([float(values[n]) for n in names]), total)
        goals.append(dict(zip(names, g)))
    for _ in range(2000):
        for d in range(3):
            for v, g in goals[d].items():
                got = sum(x for k, x in w.items() if k[d] == v)
                for k in w:
                    if k[d] == v and got > 0:
                        w[k] = min(have[k], w[k] * g / got)
    assert all(abs(w[k] - p * t) <= 1e-3 * max(t, 1) for k, (t, p) in cells.items() if t)
    rep = {(r["dimension"], r["value"]): r for r in mixing.report(out.withColumnRenamed("doc_id", "id")).collect()}
    for d, name in enumerate(mixing.DIMENSIONS):
        assert np.isclose(sum(r["asked"] for (n, _), r in rep.items() if n == name), total)
        for v in of[d]:
            r = rep[name, v]
            assert r["available"] == of[d][v] and r["kept"] <= r["available"] and r["expected"] <= r["available"] * (1 + 1e-9)
            assert np.isclose(r["expected"], sum(x for k, x in w.items() if k[d] == v), rtol=1e-3, atol=1)
    print({k: (round(r["asked"]), r["available"], round(r["expected"])) for k, r in rep.items()})


def test_every_category_is_raked_by_itself(spark):
    """1,200 sources and 60 languages: tails have the goals of their members, and an asked-for value of the tail its own."""
    rows = [(i, "w " * (100 if i < 1200 else 1), f"s{i % 1200}", "en") for i in range(3600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = mixing.mix(df, topic=F.lit("t"), keep=0.5).select("source", "probability").distinct().collect()
    assert len(out) == 1200 and max(r["probability"] for r in out) - min(r["probability"] for r in out) < 1e-9
    rows = [(i, "w " * (10 if i % 60 < 50 else 5), "s", f"l{i % 60:02}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    tokens = {}
    for r in mixing.mix(df, topic=F.lit("t"), targets={"lang": {"l00": 0.5, "l59": 0.5}}, keep=0.01).collect():
        tokens[r["lang"]] = tokens.get(r["lang"], 0) + r["probability"] * r["n_tokens"]
    assert len(tokens) == 60 and tokens["l59"] > 0 and np.isclose(tokens["l59"], tokens["l00"])
    assert np.isclose(sum(tokens.values()), tokens["l00"] + tokens["l59"])


@pytest.mark.parametrize("targets", [None, {"source": {"a": 0.4, "b": 0.6}, "topic": {"none such": 1.0}}])
def test_tables_rake_as_the_driver_does(spark, monkeypatch, targets):
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randint(0, 80)), rng.choice(["a", "a", "a", "b", None]), rng.choice(["en", "de"])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    few = {r["id"]: r["probability"] for r in mixing.mix(df, targets=targets, keep=0.1).collect()}
    monkeypatch.setattr(mixing, "DRIVER_CELLS", 0)
    many = {r["id"]: r["probability"] for r in mixing.mix(df, targets=targets, keep=0.1).collect()}
    assert set(few) == set(many) == set(range(400)) and all(np.isclose(few[i], many[i], atol=1e-7) for i in few)


def test_documents_without_an_id_have_draws_of_their_own(spark):
    rows = [(None, f"{i} w", "s", "en") for i in range(2000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), keep=0.5).collect()
    assert len({r["draw"] for r in out}) == 2000 and abs(sum(r["kept"] for r in out) - 1000) < 120


def test_other_vectors_of_one_id_are_candidates(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 5.0]), (1, [0.0, 5.0]), (3, [0.5, 0.5]), (20, [0.0, 1.0]), (20, [1.0, 0.0]), (7, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["rank"], r["vec_id"], r["score"]) for r in vptree.nearest(df, F.col("id") % 20 == 0, k=9, shard_rows=2).orderBy("rank").collect()]
    assert got == [(1, 1, 5.0), (2, 1, 1.0), (3, 3, 0.5), (4, 7, 0.0)]
