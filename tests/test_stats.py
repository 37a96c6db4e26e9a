import math
from collections import Counter

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from textsieve.operators import ngrams as NG
from textsieve.operators import stats as S


def frame(spark, values, name="v"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


def np_hist(values, bins):
    counts, edges = np.histogram(np.asarray(values, dtype=float), bins=bins)
    return [int(c) for c in counts], edges


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=60),
       st.integers(min_value=1, max_value=25))
def test_histogram_matches_numpy(spark, values, bins):
    got = sorted(S.histogram(frame(spark, values), "v", bins).collect())
    counts, edges = np_hist(values, bins)
    assert [r["n"] for r in got] == counts
    assert sum(r["n"] for r in got) == len(values)
    assert np.allclose([r["bin_lo"] for r in got], edges[:-1]) and got[-1]["bin_hi"] == edges[-1]


def test_histogram_all_equal_values(spark):
    got = sorted(S.histogram(frame(spark, [2.0] * 7), "v", 4).collect())
    counts, edges = np_hist([2.0] * 7, 4)
    assert [r["n"] for r in got] == counts and got[0]["bin_lo"] == edges[0]


def test_integer_word_counts_50_bins(spark):
    rng = np.random.default_rng(3)
    vals = list(rng.integers(1, 5000, size=500))
    got = sorted(S.histogram(frame(spark, vals), "v", 50).collect())
    assert [r["n"] for r in got] == np_hist(vals, 50)[0]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=80))
def test_exact_quantiles_match_numpy(spark, values):
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r["p"]: r["value"] for r in S.exact_quantiles(frame(spark, values), ["v"], probs, buckets=8).collect()}
    exp = np.percentile(np.asarray(values, dtype=float), [p * 100 for p in probs])
    assert np.allclose([got[p] for p in probs], exp)


def test_quantile_buckets_are_refined(spark):
    values = np.random.default_rng(5).normal(size=4000).round(3)
    vc = S.value_counts(frame(spark, values), ["v"])
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r["p"]: r["value"] for r in S.quantiles_from_counts(vc, probs, buckets=5, most=20).collect()}
    assert np.allclose([got[p] for p in probs], np.quantile(values, probs))


def test_profile_matches_pandas_describe(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"a": rng.integers(0, 100, 300).astype(float), "b": rng.random(300)})
    sdf = spark.createDataFrame(pdf)
    rows = S.profile(sdf, ["a", "b"], digits=None).collect()
    assert [r["stat"] for r in rows] == S.DESCRIBE_STATS
    got = {r["stat"]: (r["a"], r["b"]) for r in rows}
    desc = pdf.describe()
    for stat in S.DESCRIBE_STATS:
        assert np.allclose(got[stat], (desc.loc[stat, "a"], desc.loc[stat, "b"]), rtol=1e-12), stat


def test_auto_bins_match_numpy(spark):
    rng = np.random.default_rng(1)
    for vals in (rng.random(400), rng.normal(size=50), np.r_[np.zeros(30), rng.random(10)]):
        nb = S.auto_bin_count(frame(spark, vals), "v")
        assert nb == len(np.histogram_bin_edges(vals, bins="auto")) - 1
        got = sorted(S.auto_histogram(frame(spark, vals), "v").collect())
        assert [r["n"] for r in got] == list(np.histogram(vals, bins="auto")[0])


def test_kde_matches_gaussian_formula(spark):
    rng = np.random.default_rng(2)
    vals = np.round(rng.random(120), 2)
    got = sorted(S.gaussian_kde(frame(spark, vals), "v", grid=50, digits=None).collect())
    bw = vals.std(ddof=1) * len(vals) ** (-0.2)
    grid = np.linspace(vals.min(), vals.max(), 50)
    dens = np.exp(-0.5 * ((grid[:, None] - vals[None, :]) / bw) ** 2).sum(1) / (len(vals) * bw * math.sqrt(2 * math.pi))
    assert np.allclose([r["x"] for r in got], grid)
    assert np.allclose([r["density"] for r in got], dens, rtol=1e-10)


def test_kde_of_large_values_and_of_values_without_variance(spark):
    got = S.gaussian_kde(frame(spark, [1e9, 2e9, 4e9]), "v", grid=5).collect()
    assert len(got) == 5 and all(r["density"] > 0 for r in got)
    for values in ([], [3.0], [2.0] * 9):
        assert S.gaussian_kde(frame(spark, values) if values else frame(spark, [1]).limit(0), "v").count() == 0


def test_profile_and_histogram_of_nothing(spark):
    empty = frame(spark, [1.0]).limit(0)
    rows = {r["stat"]: r["v"] for r in S.profile(empty, ["v"]).collect()}
    assert rows == {s: (0.0 if s == "count" else None) for s in S.DESCRIBE_STATS}
    bins = sorted(tuple(r) for r in S.histogram(empty, "v", 2).collect())
    assert bins == [(1, 0.0, 0.5, 0), (2, 0.5, 1.0, 0)]


def test_top_ngrams_ties_by_phrase(spark):
    # single-letter words are not tokens ((?u)\b\w\w+\b semantics)
    df = spark.createDataFrame([("bb cc aa bb cc",), ("aa bb xx yy z",)], "t string")
    got = [(r["ngram"], r["freq"]) for r in NG.top_ngrams(df, "t", 2, 3).collect()]
    assert got == [("aa bb", 2), ("bb cc", 2), ("bb xx", 1)]


def test_formatted_mean(spark):
    assert S.formatted_mean(frame(spark, [0.125, 0.5]), "v").first()[0] == "0.31"


def py_top_first_seen(texts, k):
    import re as _re

    freq = {}
    for t in texts:  # dict insertion order = first appearance
        w = _re.findall(r"(?u)\b\w\w+\b", t.lower())
        for a, b in zip(w, w[1:]):
            freq[a + " " + b] = freq.get(a + " " + b, 0) + 1
    return sorted(freq.items(), key=lambda x: x[1], reverse=True)[:k]


def test_top_ngrams_first_seen_matches_vectorizer_order(spark):
    texts = ["zz yy xx ww", "aa bb zz yy", "cc dd aa bb", "xx ww cc dd", "qq rr", "rr qq"]
    df = spark.createDataFrame(list(enumerate(texts)), "d long, t string")
    for k in (1, 3, 5, 8):
        got = [(r["ngram"], r["freq"]) for r in NG.top_ngrams_first_seen(df, "t", "d", 2, k).collect()]
        assert got == py_top_first_seen(texts, k), k


def test_radix_selection_over_every_kind_of_double(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=400), -np.exp(rng.uniform(-300, 300, 200)), np.exp(rng.uniform(-300, 300, 200)), [0.0, -0.0, 5e-324, -5e-324, np.inf, -np.inf], np.repeat(1.5, 300)])
    vc = S.value_counts(frame(spark, values.tolist()), ["v"])
    ordered = np.sort(values + 0.0)
    want = list(range(0, len(values), 37)) + [len(values) - 1]
    for bits, most in ((16, 4096), (16, 1), (9, 1)):
        got = S.order_statistics(vc, {"v": want}, S._buckets(vc, 0, bits, None), bits, most)
        assert [got["v", k] for k in want] == ordered[want].tolist()



def bigram_texts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(4)


def test_bounded_ngrams_are_proven_or_counted_in_full(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(["aa bb cc"] * 30 + list(rng.choice(words, 30))) for _ in range(40)] + ["", None]
    df = bigram_texts(spark, texts)
    want = [tuple(r) for r in NG.top_ngrams(df, "text", 2, 3).collect()]
    counts, proven = NG.heavy_ngrams(df, "text", 2, 3)
    assert proven and [tuple(r) for r in NG.top_ngrams_bounded(df, "text", 2, 3).collect()] == want
    assert counts.count() <= 16 * 3
    # summaries too small to prove anything; frequencies all alike, more n-grams than tracked, and fewer
    alike = bigram_texts(spark, [f"a{i} b{i} c{i}" for i in range(300)])
    for frame_, k, tracked, sure in ((df, 3, 16, False), (df, 200, 1000, False), (alike, 15, 400, False), (alike, 15, 100_000, True)):
        counts, proven = NG.heavy_ngrams(frame_, "text", 2, k, tracked=tracked)
        assert proven == sure
        assert [tuple(r) for r in NG.top_ngrams_bounded(frame_, "text", 2, k, tracked=tracked).collect()] == [tuple(r) for r in NG.top_ngrams(frame_, "text", 2, k).collect()]
    assert NG.top_ngrams_bounded(df.limit(0), "text").count() == 0


def test_ngrams_tokenize_each_text_once(spark):
    df = bigram_texts(spark, ["aa bb cc"])
    for tokenizer in ("compat", "unicode", "exact"):
        plan = NG.ngram_counts(df, "text", 2, tokenizer)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("regexp_extract_all") == 1


def test_top_ngrams_count_only_what_can_be_among_them(spark):
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(300)]
    share = 1 / np.arange(1, 301)
    rows = [list(rng.choice(words, 60, p=share / share.sum())) for _ in range(80)]
    all_counts = Counter(f"{a} {b}" for r in rows for a, b in zip(r, r[1:], strict=False))
    df = bigram_texts(spark, [" ".join(r) for r in rows])
    for k, tracked in ((15, NG.TRACKED), (40, 3000), (5, 300), (15, 100)):
        want = sorted(all_counts.items(), key=lambda x: (-x[1], x[0]))[:k]
        for top in (NG.top_ngrams, NG.top_ngrams_bounded):
            assert [tuple(r) for r in top(df, "text", 2, k, "unicode", tracked).collect()] == want
    plan = NG.top_ngrams(df, "text", 2, 15, "unicode")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("LeftSemi")  # the join is below the exchange: candidates alone are dealt
