"""Invariants from the test strategy: ratios in range, idempotent cleaning,
anti + semi partition the catalog, keep-first is idempotent."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import one_col
from textsieve.functions import text as T
from textsieve.operators import sets as S

ALPHABET = st.sampled_from(list("ab AB_.,!?1") + ["\u0c05", "\u0c2e", "\u0c4d", "\u00a0", "\n", "\u2003"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=25), min_size=1, max_size=10)


@settings(max_examples=12, deadline=None)
@given(TEXTS)
def test_ratio_in_unit_interval_and_strip_idempotent(spark, texts):
    df = one_col(spark, texts).select(
        T.script_ratio("t").alias("r"), T.uniqueness_ratio(T.tokens("t")).alias("u"),
        T.strip_foreign("t").alias("s1"), T.strip_foreign(T.strip_foreign("t")).alias("s2"))
    for r in df.collect():
        assert 0.0 <= r["r"] <= 1.0 and 0.0 <= r["u"] <= 1.0
        assert r["s1"] == r["s2"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=8), min_size=1, max_size=12),
       st.lists(st.text(alphabet=ALPHABET, max_size=8), max_size=8))
def test_anti_and_semi_partition_catalog(spark, catalog, done):
    cat = one_col(spark, catalog, "song_name")
    dn = spark.createDataFrame([(d,) for d in done] or [("\x00never",)], "song_name string")
    anti = S.pending(cat, dn, "song_name", "song_name")
    key = T.normalize_key(F.col("song_name"))
    semi = cat.withColumn("_k", key).join(dn.select(key.alias("_k")).distinct(), "_k", "left_semi")
    ids = sorted([r["i"] for r in anti.collect()] + [r["i"] for r in semi.collect()])
    assert ids == list(range(len(catalog)))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=6), min_size=1, max_size=15))
def test_keep_first_idempotent(spark, names):
    df = one_col(spark, names, "song_name")
    once = S.keep_first(df, "song_name", "i")
    twice = S.keep_first(once, "song_name", "i")
    assert sorted(once.collect()) == sorted(twice.collect())
    kept = {r["song_name"].lower() for r in once.collect()}
    assert kept == {n.lower() for n in names if n.lower()}
