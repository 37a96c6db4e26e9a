import __spark_entry__ as E
from textsieve.plans.oracle_sql import oracle_queries
from textsieve.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "final_text" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_queries())
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_every_query_has_rows(spark):
    # few rows at the smallest scale: no shelf may have a candidate that qualifies
    larger = {"first_candidate", "page_lyrics", "page_lyrics_rounds", "lang_filter", "catalog_fallback"}
    for name, fn in QUERIES.items():
        assert fn(spark, SF.replace("0.001", "0.01") if name in larger else SF).count() > 0, name
