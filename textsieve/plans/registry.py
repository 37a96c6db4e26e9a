"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads whole test tables (see TESTDATA.md) and runs one operator
or lifecycle of the library over them.  The test corpora are Latin-script,
so the script parameter is ``LATIN`` where the production default is Telugu.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve import patterns as P
from textsieve.functions import html as H
from textsieve.functions import structure as STR
from textsieve.functions import text as TX
from textsieve.operators import blocks as B
from textsieve.operators import candidates as C
from textsieve.operators import ngrams as NG
from textsieve.operators import quality as Q
from textsieve.operators import sets as SETS
from textsieve.operators import stats as S
from textsieve.plans import lifecycles as L
from textsieve.plans.oracle_sql import DENSITY_CHARS, SCRIPT
from textsieve.session import scratch_path
from textsieve.sources import catalog_tables as CT
from textsieve.sources import files as IO
from textsieve.sources import trees as TR
from textsieve.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


#: session setting: partitions to deal a text table to (for tables of a few large row groups); unset adds nothing
SPREAD = "textsieve.spread"


def table(spark: SparkSession, sf_dir: str, name: str, columns=None, cpu_bound: bool = False) -> DataFrame:
    spread = int(spark.conf.get(SPREAD, "0")) if cpu_bound else 0
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", columns, spread or None)


def documents(spark: SparkSession, sf_dir: str, columns=("doc_id", "text")) -> DataFrame:
    """The document corpus."""
    return table(spark, sf_dir, "documents", list(columns), cpu_bound=True)


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.with_quality_metrics(documents(spark, sf_dir), "text", SCRIPT)


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.clean_corpus(documents(spark, sf_dir), "doc_id", "text", SCRIPT, DENSITY_CHARS)


def q_quality_metrics(spark, sf):
    return scored_documents(spark, sf).select("doc_id", *Q.METRIC_COLUMNS)


def q_quality_gate(spark, sf):
    return Q.quality_gate(scored_documents(spark, sf)).select("doc_id", *Q.METRIC_COLUMNS)


def q_strip_script(spark, sf):
    return Q.quality_gate(scored_documents(spark, sf)).select(
        "doc_id", TX.strip_foreign("text", SCRIPT).alias("final_text")
    )


def q_clean_corpus(spark, sf):
    return clean_documents(spark, sf)


def q_gate_reconciliation(spark, sf):
    return Q.gate_reconciliation(scored_documents(spark, sf))


def q_profile(spark, sf):
    return S.profile(scored_documents(spark, sf), Q.METRIC_COLUMNS, digits=9)


def q_mean_richness(spark, sf):
    return S.formatted_mean(clean_documents(spark, sf), "richness", "mean_richness")


def q_top_bigrams(spark, sf):
    return NG.top_ngrams(clean_documents(spark, sf), "final_text", P.NGRAM_N, P.NGRAM_TOP_K)


def q_top_bigrams_bounded(spark, sf):
    return NG.top_ngrams_bounded(clean_documents(spark, sf), "final_text", P.NGRAM_N, P.NGRAM_TOP_K)


def q_top_bigrams_exact(spark, sf):
    return NG.top_ngrams_bounded(clean_documents(spark, sf), "final_text", P.NGRAM_N, P.NGRAM_TOP_K, tokenizer="exact")


def q_slug_exact(spark, sf):
    """Slugs of whole texts by the exact word characters."""
    return documents(spark, sf).select("doc_id", F.md5(TX.slug("text", exact=True).cast("binary")).alias("slug_md5"))


def q_top_bigrams_unicode(spark, sf):
    return NG.top_ngrams(clean_documents(spark, sf), "final_text", P.NGRAM_N, P.NGRAM_TOP_K, tokenizer="unicode")


def q_top_bigrams_first_seen(spark, sf):
    return NG.top_ngrams_first_seen(clean_documents(spark, sf), "final_text", "doc_id", P.NGRAM_N, P.NGRAM_TOP_K)


def q_histogram_words(spark, sf):
    return S.histogram(scored_documents(spark, sf), "word_count", P.HIST_BINS_WORDS)


def q_histogram_script(spark, sf):
    return S.histogram(scored_documents(spark, sf), "script_ratio", P.HIST_BINS_SCRIPT)


def q_histogram_unique(spark, sf):
    return S.histogram(scored_documents(spark, sf), "uniqueness_ratio", P.HIST_BINS_UNIQUE)


def q_histogram_richness_auto(spark, sf):
    return S.auto_histogram(clean_documents(spark, sf), "richness")


def q_kde_richness(spark, sf):
    return S.gaussian_kde(clean_documents(spark, sf), "richness", P.KDE_GRID, digits=6)


def q_top_complex(spark, sf):
    return NG.top_by(clean_documents(spark, sf), "complexity", ["doc_id", "complexity"], P.TOP_COMPLEX, "doc_id")


QUERIES: dict[str, Query] = {
    "quality_metrics": q_quality_metrics,
    "quality_gate": q_quality_gate,
    "strip_script": q_strip_script,
    "clean_corpus": q_clean_corpus,
    "gate_reconciliation": q_gate_reconciliation,
    "profile": q_profile,
    "mean_richness": q_mean_richness,
    "top_bigrams": q_top_bigrams,
    "top_bigrams_bounded": q_top_bigrams_bounded,
    "top_bigrams_exact": q_top_bigrams_exact,
    "slug_exact": q_slug_exact,
    "top_bigrams_unicode": q_top_bigrams_unicode,
    "top_bigrams_first_seen": q_top_bigrams_first_seen,
    "histogram_words": q_histogram_words,
    "histogram_script": q_histogram_script,
    "histogram_unique": q_histogram_unique,
    "histogram_richness_auto": q_histogram_richness_auto,
    "kde_richness": q_kde_richness,
    "top_complex": q_top_complex,
}


# --- set logic -------------------------------------------------------------

# Candidate pages on this domain stand in for the lyrics site.
CANDIDATE_DOMAIN = "example.net"


def titled_documents(spark, sf, extra=()):
    """Documents with their first line as title (the song-name stand-in)."""
    d = table(spark, sf, "documents", ["doc_id", "text", "lang", "source", *extra], cpu_bound=True)
    return d.withColumn("title", F.substring_index("text", "\n", 1))


def processed_names(spark, sf):
    """File-name form (slug) of the titles of already-processed (labelled) docs."""
    docs = titled_documents(spark, sf).join(table(spark, sf, "labels", ["doc_id"]), "doc_id", "left_semi")
    return docs.select(TX.slug("title").alias("song_name"))


def q_pending_by_name(spark, sf):
    """The compat key only matches names without punctuation, so the catalog's have none."""
    cat = titled_documents(spark, sf).select("doc_id", F.translate("title", ".,|", "").alias("title"))
    return SETS.pending(cat, processed_names(spark, sf), "title", "song_name", key="compat")


def q_pending_by_slug(spark, sf):
    cat = titled_documents(spark, sf).select("doc_id", "title")
    return SETS.pending(cat, processed_names(spark, sf), "title", "song_name", key="slug")


def _part_words(spark, sf):
    return table(spark, sf, "part", ["p_partkey", "p_name", "p_type"]).withColumn(
        "first_word", F.split_part("p_name", F.lit(" "), F.lit(1))
    )


def q_semi_lower(spark, sf):
    part = _part_words(spark, sf)
    return SETS.semi_lower(part, "p_type", part, "first_word")


def q_anti_lower(spark, sf):
    part = _part_words(spark, sf)
    matched = SETS.semi_lower(part, "p_type", part, "first_word")
    return SETS.anti_lower(part, "first_word", matched).select("p_partkey", "first_word")


def q_dedupe_keep_first(spark, sf):
    d = table(spark, sf, "documents", ["doc_id", "lang", "source", "text"])
    return SETS.keep_first(d, "text", "doc_id", unique_order=True).select("doc_id", "lang", "source")


def q_union_all(spark, sf):
    d = table(spark, sf, "documents", ["doc_id", "text"]).select(
        F.col("doc_id").alias("id"), F.lit("documents").alias("origin"), "text")
    b = table(spark, sf, "benchmark", ["item_id", "text"]).select(
        F.col("item_id").alias("id"), F.lit("benchmark").alias("origin"), "text")
    return SETS.union_all(d, b)


def q_catalog_fallback(spark, sf):
    """Primary catalog (benchmark items) plus, when it has fewer than 50 rows,
    fallback rows (titles of toxic-labelled documents) not already present;
    then keep-first by lower-case name."""
    prim = table(spark, sf, "benchmark", ["item_id", "text"]).select(
        F.substring_index("text", "\n", 1).alias("song_name"), F.lit("benchmark").alias("origin"),
        F.col("item_id").alias("seq"), F.lit(0).alias("part"))
    toxic = table(spark, sf, "labels", ["doc_id", "toxic"]).where("toxic = 1")
    fb = titled_documents(spark, sf).join(toxic, "doc_id", "left_semi").select(
        F.col("title").alias("song_name"), F.lit("documents").alias("origin"),
        F.col("doc_id").alias("seq"), F.lit(1).alias("part"))
    fb = SETS.fallback_rows(prim, fb, "song_name", "seq")
    both = SETS.fallback_union(prim, fb, P.FALLBACK_MIN_ROWS).withColumn("_ord", F.struct("part", "seq"))
    return SETS.keep_first(both, "song_name", "_ord").select("song_name", "origin", "seq")


def q_lang_filter(spark, sf):
    d = table(spark, sf, "documents", ["doc_id", "lang", "source"])
    return d.filter(F.col("lang") == "fr").filter(F.col("source").isin("src1", "src2", "src3")).select(
        "doc_id", "source")


def q_distinct_sources(spark, sf):
    return SETS.distinct_values(table(spark, sf, "documents", ["source"]), "source")


# --- document structure ------------------------------------------------------

def q_after_marker(spark, sf):
    d = titled_documents(spark, sf)
    body = F.concat(F.lit("Song: "), "title", F.lit("\nMovie: "), "source", F.lit("\nSource: "), "lang",
                    F.lit("\nURL: u\n\n"), F.when(F.col("lang") == "en", "...\n").otherwise(""), "text")
    return d.select("doc_id", STR.after_marker(body).alias("lyrics"))


def q_clean_lines_v1(spark, sf):
    return documents(spark, sf).select("doc_id", STR.clean_lines_v1("text", SCRIPT).alias("lyrics"))


def q_clean_lines_v2(spark, sf):
    return documents(spark, sf).select("doc_id", STR.clean_lines_v2("text").alias("lyrics"))


def q_slug(spark, sf):
    return titled_documents(spark, sf).select("doc_id", TX.slug("title").alias("slug"))


def q_parse_song(spark, sf):
    d = titled_documents(spark, sf)
    body = F.concat("title", F.lit("\nLyricist: "), "source", F.lit("\n"),
                    F.when(F.col("lang") != "de", "\n").otherwise(""), "text")
    return d.select("doc_id", STR.parse_song(body).alias("s")).select("doc_id", "s.song_name", "s.lyrics")


def q_extract_song(spark, sf):
    d = titled_documents(spark, sf)
    body = F.concat(F.lit("song:\n"), "title", F.lit("\n"), F.when(F.col("lang") != "fr", "telugu\n").otherwise(""),
                    "text", F.lit("\n---\nEnd: x"))
    return d.select("doc_id", STR.extract_song(body, SCRIPT).alias("s")).select("doc_id", "s.song_name", "s.lyrics")


# --- pages, links, requests ----------------------------------------------------

def q_anchor_texts(spark, sf):
    p = table(spark, sf, "pages", ["page_id", "html"])
    out = p.select("page_id", H.anchor_text("html", "/").alias("first_link"),
                   H.anchor_texts("html", "/").alias("all_links"))
    return out.where(TX.non_empty("first_link"))


def q_json_field(spark, sf):
    e = table(spark, sf, "events", ["event_id", "props"])
    return e.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


def q_search_request(spark, sf):
    d = titled_documents(spark, sf)
    q1 = C.search_query("title", "source", P.QUERY_TEMPLATE_V1)
    q2 = C.search_query("title", "source", P.QUERY_TEMPLATE_V2)
    url = F.replace(F.lit(P.SEARCH_URL_V2), F.lit("{q}"), C.quote_plus(q2))
    return d.select(
        "doc_id", q1.alias("query"), url.alias("search_url"),
        C.search_payload(q1).alias("payload"),
        C.search_query("title", "source", P.QUERY_TEMPLATE_AUDIO).alias("audio_query"),
    )


def q_derived_path(spark, sf):
    p = table(spark, sf, "part", ["p_partkey", "p_name", "p_brand", "p_type"])
    cat = F.concat("p_brand", F.lit(" / "), "p_type")
    return p.select(
        "p_partkey",
        F.replace(F.replace(cat, F.lit(" "), F.lit("_")), F.lit("/"), F.lit("-")).alias("category_folder"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".wav")).alias("file_name"),
        C.derived_audio_path(cat, "p_name", "audio").alias("path"),
    )


# Candidates of a search: the pages of so many neighbouring documents (some have more than the top 7).
SHELF = 40


def candidate_pages(spark, sf):
    """Search candidates per shelf of documents: pages whose URL path names a
    document of it, ranked by page_id.  Pages whose path names none are nobody's
    candidates.  The page's number makes URLs unique."""
    p = table(spark, sf, "pages", ["page_id", "url", "html"], cpu_bound=True)
    did = F.regexp_extract("url", "/[a-z]{2}/([0-9]+)", 1)
    return p.where(did != "").select(
        F.floor(did.try_cast("long") / SHELF).alias("song_id"), F.col("page_id").alias("rank"),
        F.concat("url", F.lit("#"), "page_id").alias("url"), "html")


def shelves(spark, sf):
    return table(spark, sf, "documents", ["doc_id"]).select(F.floor(F.col("doc_id") / SHELF).alias("song_id")).distinct()


def q_first_candidate(spark, sf):
    """The first page of a mobile host, if it is among a shelf's first seven."""
    c = candidate_pages(spark, sf).select("song_id", "rank", "url")
    return C.first_within_top(c, "song_id", "rank", F.contains("url", F.lit("//m.")), P.V2_MAX_RESULTS, payload=["url"])


def q_best_block(spark, sf):
    p = table(spark, sf, "pages", ["page_id", "html"], cpu_bound=True)
    return B.extract_main_text(p, "html", "v1", SCRIPT).select("page_id", "score", "main_text")


def q_page_lyrics(spark, sf):
    """V1 lifecycle: first candidate of the top three on the domain whose page
    loaded (here: pages of https URLs) and has a main text, per shelf."""
    c = candidate_pages(spark, sf)
    pages = c.select("url", "html", F.when(F.startswith("url", F.lit("https")), 200).otherwise(404).alias("status"))
    res = L.pages_to_lyrics(shelves(spark, sf), c.select("song_id", "rank", "url"), pages, CANDIDATE_DOMAIN, "v1", SCRIPT, "status")
    return res.where("outcome = 'found'").select("song_id", "rank", "url", "lyrics")


# Letters beyond ASCII: many English pages have too few of them, so "no text" occurs.
ACCENTED = P.Script("accented", ((0xC0, 0xFF),))


def q_outcome_counts(spark, sf):
    """V2 lifecycle outcomes counted; pages of plain http URLs were never loaded."""
    c = candidate_pages(spark, sf)
    pages = c.where(F.startswith("url", F.lit("https"))).select("url", "html")
    res = L.pages_to_lyrics(shelves(spark, sf), c.select("song_id", "rank", "url"), pages, CANDIDATE_DOMAIN, "v2", ACCENTED)
    return L.outcome_counts(res)


def q_result_links(spark, sf):
    """Links of search responses: per shelf one JSON document with its pages' URLs in order."""
    c = candidate_pages(spark, sf).select("song_id", "rank", "url")
    found = F.transform(F.array_sort(F.collect_list(F.struct("rank", "url"))), lambda x: F.struct(x["url"].alias("link")))
    response = c.groupBy("song_id").agg(F.to_json(F.struct(found.alias("organic"))).alias("response"))
    links = C.result_links("response", CANDIDATE_DOMAIN, P.V2_MAX_RESULTS)
    return response.select("song_id", F.posexplode(links).alias("pos", "link"))


def q_catalog_from_html(spark, sf):
    """Song catalog from rendered rows: each page's first four navigation words
    are a row's song, album and two singers."""
    p = table(spark, sf, "pages", ["page_id", "html"])
    w = F.regexp_extract_all("html", F.lit('<li><a href="/[^"]+">([^<]+)</a></li>'), 1)

    def link(kind, i):
        return F.concat(F.lit(f'<a href="/{kind}/'), F.col("page_id"), F.lit('">'), F.get("w", F.lit(i)), F.lit("</a>"))

    rows = p.select("page_id", w.alias("w")).where(F.size("w") >= 4).select(
        F.col("page_id").alias("seq"), F.concat(link("song", 0), link("album", 1), link("artist", 2), link("artist", 3)).alias("html"))
    return L.catalog_from_html(rows)


# --- files and tables ---------------------------------------------------------------

def q_csv_roundtrip(spark, sf):
    """Documents written as CSV and read by header name into another column order."""
    d = table(spark, sf, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    path = scratch_path(spark, "csv")
    IO.write_csv(d, path)
    back = IO.read_csv(spark, path, "source string, n_chars long, doc_id long, text string, lang string")
    return back.select("doc_id", "lang", "source", "n_chars", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))


def q_text_tree_roundtrip(spark, sf):
    """Benchmark items written as one text file each and read back."""
    b = table(spark, sf, "benchmark", ["item_id", "text"]).select(
        "item_id", F.concat(F.lit("Item, "), "item_id").alias("song"), F.concat(F.lit("Shelf "), F.col("item_id") % 7).alias("movie"), "text")
    path = scratch_path(spark, "text-tree")
    body = IO.lyrics_file_body("song", "movie", F.lit("benchmark"), None, F.concat(F.lit("..."), "text"))
    IO.write_text_tree(b, path, "movie", "song", body, "item_id")
    back = IO.read_slug_tree(spark, path)
    return back.select("movie_slug", "song_slug", F.md5(STR.after_marker("content").cast("binary")).alias("lyrics_md5"))


def q_append_new(spark, sf):
    """Labelled documents, then all documents, then all again, appended by (source, title)."""
    d = titled_documents(spark, sf).select("doc_id", "source", "title")
    path = scratch_path(spark, "appended")
    for batch in (d.join(table(spark, sf, "labels", ["doc_id"]), "doc_id", "left_semi"), d, d):
        IO.append_new(spark, batch, path, ["source", "title"], order_col="doc_id")
    return spark.read.parquet(path).select("doc_id", "source", "title")


def q_table_append(spark, sf):
    """``append_new`` on a bucketed table by name: created from the labelled documents, then all documents appended twice."""
    d = titled_documents(spark, sf).select("doc_id", "source", "title")
    path = scratch_path(spark, "database")
    db = "db_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{path}'")
    name, keys = f"{db}.songs", ["source", "title"]
    labelled = d.join(table(spark, sf, "labels", ["doc_id"]), "doc_id", "left_semi")
    CT.replace_table(d.limit(0), name, keys, 16)
    CT.replace_table(SETS.one_per_key(labelled, SETS.key_digest(F.col("source"), F.col("title")), F.col("doc_id")), name, keys, 16)
    for _ in range(2):
        CT.append_new_to(d, name, keys, order_col="doc_id")
    return CT.read_named(spark, name, ["doc_id", "source", "title"])


def q_attach_report(spark, sf):
    """Audio files exist for small parts only; how many catalog rows find theirs."""
    p = table(spark, sf, "part", ["p_name", "p_type", "p_size"])
    files = p.where("p_size < 25").select(C.derived_audio_path("p_type", "p_name", "audio").alias("path")).distinct()
    files = files.withColumn("content", F.col("path").cast("binary"))
    return IO.upload_report(IO.attach_audio(p, files, "audio", "p_name", "p_type"))


# Folder and file names that only an exact writer and reader keep: '%', '+', spaces and another script.
ODD_MOVIE, ODD_SONG = " +%41 పాట", "100% "


def song_files(spark, sf):
    """All documents as song files: (doc_id, movie, song, text); several documents may share a name."""
    return titled_documents(spark, sf).select(
        "doc_id", F.concat("source", F.lit(ODD_MOVIE)).alias("movie"), F.concat(F.lit(ODD_SONG), F.left("title", F.lit(40))).alias("song"), "text", "lang")


def q_song_tree_ingest(spark, sf):
    """All documents written as ``<movie>/<song>.txt`` (the last of one name stays), scanned, cut at the marker and appended to a table."""
    d, path = song_files(spark, sf), scratch_path(spark, "song-tree")
    body = IO.lyrics_file_body("song", "movie", F.lit("documents"), F.lit("u"), F.concat(F.lit("..."), F.coalesce("text", F.lit(""))))
    TR.write_named_files(d, path, IO.song_file_path(F.col("movie"), F.col("song")), body, "doc_id")
    out = scratch_path(spark, "songs")
    L.ingest_text_tree(spark, path, out)
    return spark.read.parquet(out).select("movie_name", "song_name", F.md5(F.col("lyrics").cast("binary")).alias("lyrics_md5"))


def q_scraped_tree_ingest(spark, sf):
    """All documents as scraped pages in one file each; the song's name comes from the body."""
    d, path = titled_documents(spark, sf), scratch_path(spark, "scraped-tree")
    body = F.concat(F.lit("song:\n"), "title", F.lit("\n"), F.when(F.col("lang") != "fr", "telugu\n").otherwise(""), "text", F.lit("\n---\nEnd: x"))
    TR.write_named_files(d, path, IO.song_file_path(F.col("source"), F.col("doc_id").cast("string")), body, "doc_id")
    out = scratch_path(spark, "scraped")
    L.ingest_scraped_tree(spark, path, out, SCRIPT)
    return spark.read.parquet(out).select("movie_name", "song_name", F.md5(F.col("lyrics").cast("binary")).alias("lyrics_md5"))


def q_csv_row_index(spark, sf):
    """Documents with training flags, written with a row index (by language, then id) in a given field order, read back with it."""
    d = IO.with_training_flags(table(spark, sf, "documents", ["doc_id", "lang", "source"]))
    path = scratch_path(spark, "csv-index")
    IO.write_csv(d, path, columns=["source", "doc_id", *P.TRAINING_FLAGS, "lang"], index_order=["lang", F.desc("doc_id")])
    schema = "_c0 long, doc_id long, lang string, source string, " + ", ".join(f"{c} string" for c in P.TRAINING_FLAGS)
    return IO.read_csv(spark, path, schema, index_col="row_id").withColumnsRenamed({c: c.lower() for c in P.TRAINING_FLAGS})


def audio_tree(spark, sf):
    """Files of the small parts, named by category and song: (base, catalog)."""
    p = table(spark, sf, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    path = scratch_path(spark, "audio")
    body = F.repeat(F.concat("p_brand", F.lit("|"), "p_name", F.lit("\n")), F.col("p_size"))
    TR.write_named_files(p.where("p_size < 25"), path, C.derived_audio_path("p_type", "p_name"), body, "p_partkey")
    return path, p


def q_attach_files(spark, sf):
    """Every part with the audio file that exists for it: listed first, read where a part names it."""
    base, p = audio_tree(spark, sf)
    out = IO.attach_files(p.select("p_partkey", "p_type", "p_name"), base, C.derived_audio_path("p_type", "p_name"))
    return out.select("p_partkey", "outcome", "length", F.md5("content").alias("content_md5"))


def q_upload_files(spark, sf):
    """Outcomes of appending the parts with their files to a table, and the rows that the table holds."""
    base, p = audio_tree(spark, sf)
    path = scratch_path(spark, "uploaded")
    report = IO.upload_files(p.select("p_partkey", "p_type", "p_name"), base, C.derived_audio_path("p_type", "p_name"), path)
    held = spark.read.parquet(path).agg(F.struct(F.count("content").alias("n"), F.sum(F.octet_length("content")).alias("bytes"))).scalar()
    in_table = F.when(F.col("outcome") == P.OUTCOME_UPLOADED, held)
    return report.withColumn("held", in_table).select("outcome", "n", F.col("held.n").alias("held"), F.col("held.bytes").alias("bytes"))


def q_page_lyrics_rounds(spark, sf):
    """``page_lyrics`` by rounds: the next candidate's page is parsed only for shelves without a text so far."""
    c = candidate_pages(spark, sf)
    pages = c.select("url", "html", F.when(F.startswith("url", F.lit("https")), 200).otherwise(404).alias("status"))
    res = L.pages_to_lyrics(shelves(spark, sf), c.select("song_id", "rank", "url"), pages, CANDIDATE_DOMAIN, "v1", SCRIPT, "status", by_rounds=True)
    return res.where("outcome = 'found'").select("song_id", "rank", "url", "lyrics")


def q_catalog_markdown(spark, sf):
    """Few rendered rows (the nations), so song links in the pages' markdown are added: each page's first words by threes."""
    rows = table(spark, sf, "nation", ["n_nationkey", "n_name"]).select(
        F.col("n_nationkey").alias("seq"), F.concat(F.lit('<a href="/song/1">'), "n_name", F.lit('</a><a href="/album/1">Atlas</a>')).alias("html"))
    w = F.regexp_extract_all("html", F.lit('<li><a href="/[^"]+">([^<]+)</a></li>'), 1)
    links = F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.concat(
        F.lit("* ["), F.get("w", i), F.lit(" "), F.get("w", i + 1), F.lit("](/song/"), i.cast("string"), F.lit(") by ["), F.get("w", i + 1), F.lit("] on ["),
        F.get("w", i + 2), F.lit("]\n")))
    pages = table(spark, sf, "pages", ["page_id", "html"]).select("page_id", w.alias("w")).where(F.size("w") >= 3)
    return L.catalog_from_html(rows, pages.select(F.col("page_id").alias("seq"), F.array_join(links, "").alias("html")))


def q_semi_titles(spark, sf):
    """Distinct titles of labelled documents that, in lower case, are among the upper- or lower-case titles of all."""
    d = titled_documents(spark, sf)
    left = d.join(table(spark, sf, "labels", ["doc_id"]), "doc_id", "left_semi")
    right = d.select(F.when(F.col("lang") == "en", F.lower("title")).otherwise(F.upper("title")).alias("name"))
    return SETS.semi_lower(left, "title", right, "name")


QUERIES.update({
    "table_append": q_table_append,
    "song_tree_ingest": q_song_tree_ingest,
    "scraped_tree_ingest": q_scraped_tree_ingest,
    "csv_row_index": q_csv_row_index,
    "attach_files": q_attach_files,
    "upload_files": q_upload_files,
    "page_lyrics_rounds": q_page_lyrics_rounds,
    "catalog_markdown": q_catalog_markdown,
    "semi_titles": q_semi_titles,
    "pending_by_name": q_pending_by_name,
    "pending_by_slug": q_pending_by_slug,
    "semi_lower": q_semi_lower,
    "anti_lower": q_anti_lower,
    "dedupe_keep_first": q_dedupe_keep_first,
    "union_all": q_union_all,
    "catalog_fallback": q_catalog_fallback,
    "lang_filter": q_lang_filter,
    "distinct_sources": q_distinct_sources,
    "after_marker": q_after_marker,
    "clean_lines_v1": q_clean_lines_v1,
    "clean_lines_v2": q_clean_lines_v2,
    "slug": q_slug,
    "parse_song": q_parse_song,
    "extract_song": q_extract_song,
    "anchor_texts": q_anchor_texts,
    "json_field": q_json_field,
    "search_request": q_search_request,
    "derived_path": q_derived_path,
    "first_candidate": q_first_candidate,
    "best_block": q_best_block,
    "page_lyrics": q_page_lyrics,
    "outcome_counts": q_outcome_counts,
    "result_links": q_result_links,
    "catalog_from_html": q_catalog_from_html,
    "csv_roundtrip": q_csv_roundtrip,
    "text_tree_roundtrip": q_text_tree_roundtrip,
    "append_new": q_append_new,
    "attach_report": q_attach_report,
})
