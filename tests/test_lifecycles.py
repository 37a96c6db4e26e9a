import os

from pyspark.sql import functions as F

from textsieve import patterns as P
from textsieve.operators import candidates as C
from textsieve.plans import lifecycles as L

TE_WORDS = ["అమ్మ", "నాన్న", "ప్రేమ", "పాట", "మనసు", "వెన్నెల", "చిలుక", "గాలి", "నది", "కల"]


def test_clean_and_publish(spark, tmpdir_path):
    good = " ".join(TE_WORDS * 4) + " ఖడ్గం, Hello!"
    rows = [("s1", good), ("s2", "short అమ్మ"), ("s3", "english only " * 20), ("s4", None)]
    docs = spark.createDataFrame(rows, "song_name string, lyrics string")
    rep = L.clean_and_publish(spark, docs, tmpdir_path, csv_path=os.path.join(tmpdir_path, "clean_csv"),
                              rename=P.PUBLISHED_NAMES_TELUGU)
    clean = rep["clean"].collect()
    assert [r["song_name"] for r in clean] == ["s1"]
    assert "Hello" not in clean[0]["final_text"] and clean[0]["final_text"].endswith(", !")
    rec = rep["reconciliation"].first()
    assert (rec["rows_before"], rec["rows_after"], rec["rows_dropped"]) == (4, 1, 3)
    prof = {r["stat"]: r["word_count"] for r in rep["profile"].collect()}
    assert prof["count"] == 4 and prof["min"] == 1.0  # NULL lyrics count as the 1-word text 'None'
    assert rep["top_ngrams"].count() > 0 and rep["richness_kde"].count() == 0  # one value has no curve
    csv = spark.read.option("header", "true").option("multiLine", "true").csv(os.path.join(tmpdir_path, "clean_csv"))
    assert csv.columns == ["song_name", "word_count", "telugu_ratio", "uniqueness_ratio", "final_lyrics",
                           "richness", "complexity", "sanskrit_score"] and csv.count() == 1


def test_pages_to_lyrics_v1_and_v2(spark):
    te = " ".join(TE_WORDS * 2)
    catalog = spark.createDataFrame([(1, "Song A", "Movie"), (2, "Song B", "Movie"), (3, "Song C", "Movie")],
                                    "song_id long, song_name string, movie string")
    cands = spark.createDataFrame(
        [(1, 1, "https://other.com/a"), (1, 2, "https://lyricstape.com/empty"), (1, 3, "https://lyricstape.com/ok"),
         (2, 1, "https://other.com/b")],
        "song_id long, rank int, url string")
    pages = spark.createDataFrame(
        [("https://lyricstape.com/empty", "<div>nothing</div>"),
         ("https://lyricstape.com/ok", f"<nav>{te}</nav><article><p>{te}</p><p>Share this</p></article>")],
        "url string, html string")
    v1 = {r["song_id"]: (r["outcome"], r["lyrics"]) for r in L.pages_to_lyrics(catalog, cands, pages).collect()}
    assert v1[1] == ("found", te) and v1[2][0] == "missing" and v1[3][0] == "missing"
    v2 = {r["song_id"]: r["outcome"] for r in L.pages_to_lyrics(catalog, cands, pages, version="v2").collect()}
    assert v2 == {1: "Page loaded, but no Telugu text found", 2: "Lyricstape not found in top 7 results",
                  3: "No search results found"}
    unfetched = pages.where("url not like '%empty'")
    v2 = {r["song_id"]: r["outcome"] for r in L.pages_to_lyrics(catalog, cands, unfetched, version="v2").collect()}
    assert v2[1] == P.REASON_NOT_LOADED
    statuses = pages.withColumn("status", F.when(F.col("url").endswith("ok"), 500).otherwise(200))
    v1 = {r["song_id"]: r["outcome"] for r in L.pages_to_lyrics(catalog, cands, statuses, status_col="status").collect()}
    assert v1[1] == "missing"


def test_catalog_from_html_with_fallback(spark):
    rows = spark.createDataFrame(
        [(1, '<a href="/song/1">Ee Velalo</a><a href="/album/2">Gulabi</a><a href="/artist/3">Sunitha</a>'),
         (2, '<a href="/song/4">ee velalo</a>'), (3, '<span>no song</span>')], "seq long, html string")
    page = spark.createDataFrame(
        [(1, "[Ninne Ninne](/song/9) x [S. P. B] y [Album Z] [Ee Velalo](/song/1) [a] [b]")],
        "seq long, html string")
    out = sorted(tuple(r) for r in L.catalog_from_html(rows, page).collect())
    assert out == [("Ee Velalo", "Gulabi", "Sunitha"), ("Ninne Ninne", "Album Z", "S. P. B")]


def test_sheet_songs_and_pending(spark):
    sheet = spark.createDataFrame(
        [("SVSC", "Poet", "Title\nMusic: x\n\nline1"), ("yatra", "Poet", "Y\n\nl"), ("other", "Else", "Z\n\nq"),
         ("rudraveena", "Poet", "R\n\nr")],
        "movie string, lyricist string, telugu_lyrics string")
    scraped = spark.createDataFrame([("Yatra", "a", "x")], "movie_name string, song_name string, lyrics string")
    got = sorted(tuple(r) for r in L.sheet_songs(sheet, scraped, "Poet", ["SVSC", "yatra", "rudraveena"]).collect())
    assert got == [("SVSC", "Title", "line1"), ("rudraveena", "R", "r")]
    cat = spark.createDataFrame([("Title",), ("R",), ("New Song",)], "song_name string")
    pend = [r[0] for r in L.pending_songs(cat, spark.createDataFrame(got, scraped.schema)).collect()]
    assert pend == ["New Song"]


def test_catalog_from_html_alternative_selector(spark):
    empty = spark.createDataFrame([], "seq long, html string")
    alt = spark.createDataFrame([(1, '<a href="/song/7">Alt Song</a><a href="/album/8">Alt Album</a>')],
                                "seq long, html string")
    rows = sorted(tuple(r) for r in L.catalog_from_html(empty, alt_rows_html=alt).collect())
    assert rows == [("Alt Song", "Alt Album", "")]
    prim = spark.createDataFrame([(1, '<a href="/song/1">Main</a>')], "seq long, html string")
    rows = sorted(tuple(r) for r in L.catalog_from_html(prim, alt_rows_html=alt).collect())
    assert rows == [("Main", "", "")]


def _tree(base, files):
    for (movie, song), body in files.items():
        os.makedirs(os.path.join(base, movie), exist_ok=True)
        with open(os.path.join(base, movie, song + ".txt"), "w", encoding="utf-8") as f:
            f.write(body)


def test_ingest_trees_idempotent(spark, tmpdir_path):
    tree = os.path.join(tmpdir_path, "v1")
    _tree(tree, {("Movie_A", "Song_1"): "Song: x\nMovie: y\nSource: s\nURL: u\n\nintro...\n  అమ్మ నాన్న",
                 ("Movie_A", "Song_2"): "no marker here  "})
    table = os.path.join(tmpdir_path, "songs")
    L.ingest_text_tree(spark, tree, table)
    L.ingest_text_tree(spark, tree, table, only_new=True)
    assert spark.read.parquet(table).count() == 2
    got = {r["song_name"]: r["lyrics"] for r in spark.read.parquet(table).collect()}
    assert got == {"Song_1": "అమ్మ నాన్న", "Song_2": "no marker here"}
    scraped = os.path.join(tmpdir_path, "v2")
    _tree(scraped, {("Movie_B", "x"): "song:\nPata\ntelugu\nఅమ్మ\nనాన్న\nEnglish line"})
    L.ingest_scraped_tree(spark, scraped, table, only_new=True)
    L.ingest_scraped_tree(spark, scraped, table)
    assert spark.read.parquet(table).count() == 4  # a plain append adds what it is given
    row = [r for r in spark.read.parquet(table).collect() if r["movie_name"] == "Movie_B"][0]
    assert (row["song_name"], row["lyrics"]) == ("Pata", "అమ్మ\nనాన్న")


def test_write_lyrics_files_and_requests(spark, tmpdir_path):
    res = spark.createDataFrame(
        [(1, "Song A", "Movie X", "found", "https://lyricstape.com/a", "అమ్మ"),
         (2, "Song B", "Movie X", "missing", None, None)],
        "song_id long, song_name string, movie string, outcome string, url string, lyrics string")
    base = os.path.join(tmpdir_path, "files")
    L.write_lyrics_files(res, base)
    back = spark.read.text(base, wholetext=True).collect()
    assert len(back) == 1 and back[0]["value"].startswith("Song: Song A\nMovie: Movie X\nSource: lyricstape.com\n")
    second = os.path.join(tmpdir_path, "files2")
    L.write_lyrics_files(res, second, "v2")
    assert [r["value"] for r in spark.read.text(second, wholetext=True).collect()] == [
        "Song: Song A\nMovie: Movie X\nSource: Lyricstape (DDG-DeepScan)\n\nఅమ్మ\n"]
    req = L.search_requests(res.select("song_name", F.col("movie").alias("movie_album"))).first()
    assert req["query"] == "site:lyricstape.com Song A Movie X lyrics"
    assert req["search_url"] == "https://duckduckgo.com/?q=lyricstape.com+Song+A+Movie+X+lyrics&t=h_&ia=web"


def test_one_row_per_song_when_a_page_landed_twice(spark):
    te = " ".join(TE_WORDS * 2)
    catalog = spark.createDataFrame([(1, "Song A", "Movie")], "song_id long, song_name string, movie string")
    cands = spark.createDataFrame([(1, 1, "https://lyricstape.com/a")], "song_id long, rank int, url string")
    pages = spark.createDataFrame([("https://lyricstape.com/a", "<div>nothing</div>"), ("https://lyricstape.com/a", f"<p>{te}</p>"), ("https://lyricstape.com/a", f"<p>{te}</p>")],
                                  "url string, html string")
    for kind in ({"version": "v1"}, {"version": "v2"}, {"version": "v1", "by_rounds": True}):
        assert [(r["outcome"], r["lyrics"]) for r in L.pages_to_lyrics(catalog, cands, pages, **kind).collect()] == [("found", te)], kind


def test_rounds_parse_fewer_pages_for_the_same_rows(spark):
    te = " ".join(TE_WORDS * 2)
    cands = spark.createDataFrame([(s, r, f"https://lyricstape.com/{s}/{r}") for s in range(30) for r in range(1, 5)], "song_id long, rank int, url string")
    catalog = cands.select("song_id").distinct()
    # a third of the songs have a text on their first page, a third on the third, the others none in the top three
    pages = cands.select("url", F.when(((F.col("song_id") % 3 == 0) & (F.col("rank") == 1)) | ((F.col("song_id") % 3 == 1) & (F.col("rank") >= 3)), f"<p>{te}</p>")
                         .otherwise("<p>no</p>").alias("html"))
    whole = sorted(map(repr, L.pages_to_lyrics(catalog, cands, pages).collect()))
    assert sorted(map(repr, L.pages_to_lyrics(catalog, cands, pages, by_rounds=True).collect())) == whole
    ranked = C.top_candidates(cands, "song_id", "rank", 3)
    solved, parsed = L.first_usable_by_rounds(ranked, pages, 3)
    assert parsed == [30, 20, 20] and solved.count() == 20  # instead of 90 pages
