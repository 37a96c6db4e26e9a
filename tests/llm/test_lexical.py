"""Ranked lexical search against a brute-force version."""

import math
import random
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textsieve.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    words = [(i, terms_of(t)) for i, t in docs]
    n = sum(1 for _, w in words if w)
    total = sum(len(w) for _, w in words)
    df = {}
    for _, w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = {}
    for item, terms in items.items():
        scored = []
        for i, w in words:
            if not w:
                continue
            m = 100 - 50 + (50 * len(w) * n) // total
            s = 0
            for t in terms:
                if t in w:
                    tf = w.count(t)
                    s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 20 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out[item] = [(x[3], -x[0]) for x in sorted(scored)[:k]]
    return {i: r for i, r in out.items() if r}


def ranked(df):
    out = {}
    for r in df.orderBy("item_id", "rank").collect():
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    assert all([x[0] for x in rows] == list(range(1, len(rows) + 1)) for rows in out.values())
    return {i: [x[1:] for x in rows] for i, rows in out.items()}


WORDS = ["apple", "Apple", "app", "le", "été", "ÉTÉ", "naïve", "42", "x", "తెలుగు", "a_b", "don't", "İ", "\x00z", "\x7fq", "apple42"]


def corpus(seed, n):
    rng = random.Random(seed)
    docs = [(rng.randrange(n), rng.choice([" ", ",", "\n", "\t"]).join(rng.choices(WORDS, k=rng.randrange(0, 30)))) for _ in range(n)]
    return docs + [(None, "apple apple x"), (7, None), (8, ""), (9, "  ,,"), (9, "apple"), (9, "apple"), (10, "le " * 50_000)]


def test_equals_brute_force_with_ties_nulls_and_repeats(spark):
    docs = corpus(1, 120)
    items = [(1, "apple été 42"), (2, "APPLE x X x"), (3, None), (4, ",,"), (5, "unseen"), (6, "le app తెలుగు"), (6, "İ naïve"), (None, "apple")]
    want = {}
    for i, t in items:
        if i is not None:
            want.setdefault(i, set()).update(terms_of(t))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumns({c: F.lit(0) for c in ("id", "term", "a b", "score")})
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(0))
    assert ranked(lexical.search(d, q, k=9)) == brute(docs, want, 9)


def test_groups_of_items_give_the_same_rows(spark):
    docs = corpus(2, 60)
    items = [(i, f"{a} {b}") for i, (a, b) in enumerate(zip(WORDS, WORDS[::-1]))]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    few = ranked(lexical.search(d, q, k=5, term_bytes=40))
    assert few == ranked(lexical.search(d, q, k=5)) == brute(docs, {i: set(terms_of(t)) for i, t in items}, 5)


def test_bounded_memory_paths_change_nothing(monkeypatch):
    docs = [(i, t) for i, t in corpus(3, 50)]
    items = {1: {"apple", "x"}, 2: {"x", "été", "42"}, 3: {"le"}}
    m = lexical.Matcher([(i, sorted(t)) for i, t in items.items()])
    assert m.counts(lexical.guarded("Xx x-APPLE apples")) == {m.terms.index("x"): 1, m.terms.index("apple"): 1}
    words = [terms_of(t) for _, t in docs]
    n, total = sum(map(bool, words)), sum(map(len, words))
    w = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in x for x in words) + 1))) for t in m.terms])

    def run():
        batches = [pa.RecordBatch.from_pydict({"id": pa.array([i for i, _ in docs[a:a + 7]], pa.int64()), "text": [t for _, t in docs[a:a + 7]]})
                   for a in range(0, len(docs), 7)]
        rows = [r for b in lexical._score(SimpleNamespace(value=m), SimpleNamespace(value=(n, total, w)), 4)(iter(batches)) for r in b.to_pylist()]
        return {i: [(r["doc_id"], r["score"]) for r in rows if r["item_id"] == i] for i in items}

    whole = run()
    for name in ("HITS", "PRODUCTS", "SCORES"):
        monkeypatch.setattr(lexical, name, 2)
    assert run() == whole == brute(docs, items, 4)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "apple")], "doc_id long, text string"), spark.createDataFrame([(1, "apple")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs.limit(0), items).columns == ["item_id", "rank", "doc_id", "score"]
