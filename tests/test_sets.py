from pyspark.sql import functions as F

from textsieve.operators import candidates as C
from textsieve.operators import sets as S


def test_pending_normalized_anti_join(spark):
    cat = spark.createDataFrame(
        [(1, "Ee Velalo"), (2, "ee velalo"), (3, "Tears, Blood (Telugu)"), (4, None), (5, "Other")],
        "id long, song_name string")
    done = spark.createDataFrame([("EE_VELALO ",), ("Tears_Blood_Telugu",), (None,)], "song_name string")
    compat = sorted(r["id"] for r in S.pending(cat, done, "song_name", "song_name").collect())
    assert compat == [3, 5]  # duplicates both removed, null keys equal, punctuation never matches
    by_slug = sorted(r["id"] for r in S.pending(cat, done, "song_name", "song_name", key="slug").collect())
    # under slug keys the trailing space of "EE_VELALO " becomes '_' (a trailing
    # space after normalization), so only the punctuated title now matches
    assert by_slug == [1, 2, 5]


def test_semi_and_anti_lower(spark):
    scraped = spark.createDataFrame([("Yatra",), ("SVSC",), ("Other",), ("Yatra",)], "movie_name string")
    sheet = spark.createDataFrame([("yatra", 1), ("svsc", 2), ("SVSC", 3), ("rudraveena", 4)], "movie string, k int")
    matched = S.semi_lower(scraped, "movie_name", sheet, "movie")
    assert sorted(r["value"] for r in matched.collect()) == ["SVSC", "Yatra"]
    rest = S.anti_lower(sheet, "movie", matched)
    assert sorted(r["k"] for r in rest.collect()) == [3, 4]


def test_keep_first_keeps_first_casing(spark):
    df = spark.createDataFrame([(3, "Song", "c"), (1, "SONG", "a"), (2, "", "b"), (4, "other", "d"), (5, None, "e")],
                               "seq int, song_name string, x string")
    out = sorted((r["song_name"], r["x"]) for r in S.keep_first(df, "song_name", "seq").collect())
    assert out == [("SONG", "a"), ("other", "d")]


def test_fallback_union_both_branches(spark):
    prim = spark.createDataFrame([("A", 0)], "song_name string, seq int")
    fb = spark.createDataFrame([("A", 1), ("B", 2), ("B", 3), ("", 4), ("b", 5)], "song_name string, seq int")
    rows = S.fallback_union(prim, S.fallback_rows(prim, fb, "song_name", "seq"), min_rows=50)
    assert sorted((r[0], r[1]) for r in rows.collect()) == [("A", 0), ("B", 2), ("b", 5)]
    none_added = S.fallback_union(prim, S.fallback_rows(prim, fb, "song_name", "seq"), min_rows=1)
    assert none_added.count() == 1


def test_first_within_top(spark):
    cands = spark.createDataFrame(
        [(1, r, u) for r, u in [(1, "a.com"), (2, "b.com"), (3, "x.lyr"), (4, "y.lyr")]]
        + [(2, r, "z.other") for r in range(1, 4)]
        + [(3, r, "a.com") for r in range(1, 8)] + [(3, 8, "late.lyr")],
        "song long, rank int, url string")
    q = F.contains("url", F.lit(".lyr"))
    out = {r["song"]: r["url"] for r in C.first_within_top(cands, "song", "rank", q, 7, ["url"]).collect()}
    assert out == {1: "x.lyr"}
    out3 = {r["song"]: r["url"] for r in C.first_within_top(cands, "song", "rank", q, 2, ["url"]).collect()}
    assert out3 == {}


def test_search_helpers(spark):
    df = spark.createDataFrame([("Ee Velalo", "Gulabi"), (None, "M~*")], "s string, m string")
    rows = df.select(C.search_query("s", "m"), C.quote_plus(C.search_query("s", "m", "{song} {movie}")),
                     C.search_payload(C.search_query("s", "m"))).collect()
    from urllib.parse import quote_plus
    assert rows[0][0] == "site:lyricstape.com Ee Velalo Gulabi lyrics"
    assert rows[0][1] == quote_plus("Ee Velalo Gulabi")
    assert rows[1][1] == quote_plus(" M~*")
    assert rows[0][2] == '{"q":"site:lyricstape.com Ee Velalo Gulabi lyrics","gl":"in","hl":"en","num":3}'


def test_result_links(spark):
    js = ['{"organic":[{"link":"https://lyricstape.com/a"},{"link":"https://x.com"},{"title":"t"}]}', '{}', None]
    df = spark.createDataFrame([(j,) for j in js], "j string")
    out = [r[0] for r in df.select(C.result_links("j")).collect()]
    assert out == [["https://lyricstape.com/a"], [], []]


def test_derived_audio_path(spark):
    df = spark.createDataFrame([("O Papa Lali", "Solo / Lullaby")], "s string, c string")
    assert df.select(C.derived_audio_path("c", "s", "raw")).first()[0] == "raw/Solo_-_Lullaby/O_Papa_Lali.wav"


def test_keep_first_keeps_one_of_repeated_rows(spark):
    rows = [(1, "A", {"k": 1}), (1, "A", {"k": 1}), (1, "a", {"k": 2}), (2, "B", None), (None, "c", None), (None, "C", None), (None, "C", None)]
    df = spark.createDataFrame(rows, "seq int, name string, `m.x y` map<string,int>")
    out = S.keep_first(df, "name", "seq")
    assert out.columns == df.columns
    got = sorted((r["name"].lower(), r["seq"]) for r in out.collect())
    assert got == [("a", 1), ("b", 2), ("c", None)]
    again = sorted(map(repr, S.keep_first(df.repartition(3), "name", "seq").collect()))
    assert again == sorted(map(repr, out.collect()))


def test_one_per_key_moves_no_texts_for_the_choice(spark):
    df = spark.createDataFrame([(1, "k", "t" * 50), (2, "k", "u"), (2, "k", "u")], "seq int, name string, text string")
    out = S.one_per_key(df, S.key_digest(F.col("name")), F.col("seq"), last=True)
    assert [tuple(r) for r in out.collect()] == [(2, "k", "u")]
    p = out._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in p.splitlines() if ("Exchange" in x or "Sort [" in x or "SortAggregate" in x) and "text" in x]
