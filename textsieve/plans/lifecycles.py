"""End-to-end plans composed from the operators.

A. ``clean_and_publish``: scan -> metrics -> reports -> gate -> clean -> features
   -> publish, with the feature reports read back from the published table.
B. ``pages_to_lyrics``: ranked search candidates + fetched pages -> first
   usable page per song -> outcomes -> one text file per song.
C. ``ingest_*``: text trees and sheets -> parsed songs -> appends (on request
   idempotent); ``pending_songs`` finds catalog songs not yet extracted.

Metrics reused by several reports are written without the text (Parquet under
the shared checkpoint directory), and the published table is read back for
the feature reports, so no report re-runs the text pipeline, and executor
loss only recomputes from those tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve import patterns as P
from textsieve.functions import html as H
from textsieve.functions import structure as ST
from textsieve.functions import text as TX
from textsieve.operators import blocks as B
from textsieve.operators import candidates as C
from textsieve.operators import ngrams as NG
from textsieve.operators import quality as Q
from textsieve.operators import sets as SETS
from textsieve.operators import stats as S
from textsieve.session import write_scratch
from textsieve.sources import files as IO
from textsieve.sources import trees as TR


def clean_and_publish(spark: SparkSession, docs: DataFrame, out_dir: str, id_col: str = "song_name",
                      text_col: str = "lyrics", script: P.Script = P.TELUGU,
                      density_chars: str = P.TELUGU_DENSITY_CHARS, csv_path: str | None = None,
                      rename: dict | None = None) -> dict[str, DataFrame]:
    """Lifecycle A.  Returns the published table and every report; with
    ``csv_path`` the published table is also exported as CSV.  ``rename`` maps
    library column names to published names (e.g.
    ``patterns.PUBLISHED_NAMES_TELUGU``); reports keep the library names."""
    metrics = Q.with_quality_metrics(docs.select(id_col, text_col), text_col, script)
    scored = write_scratch(metrics.select(id_col, *Q.METRIC_COLUMNS), "metrics")
    reports = {
        "profile": S.profile(scored, Q.METRIC_COLUMNS),
        "hist_word_count": S.histogram(scored, "word_count", P.HIST_BINS_WORDS),
        "hist_script_ratio": S.histogram(scored, "script_ratio", P.HIST_BINS_SCRIPT),
        "hist_uniqueness_ratio": S.histogram(scored, "uniqueness_ratio", P.HIST_BINS_UNIQUE),
        "reconciliation": Q.gate_reconciliation(scored),
    }
    published = Q.clean_corpus(docs, id_col, text_col, script, density_chars)
    path = f"{out_dir.rstrip('/')}/clean"
    IO.write_table(published.withColumnsRenamed(rename or {}), path)
    table = spark.read.parquet(path).withColumnsRenamed({v: k for k, v in (rename or {}).items()})
    if csv_path:
        IO.write_csv(spark.read.parquet(path), csv_path)
    reports.update({
        "mean_richness": S.formatted_mean(table, "richness", "mean_richness"),
        "richness_hist": S.auto_histogram(table, "richness"),
        "richness_kde": S.gaussian_kde(table, "richness"),
        "top_complex": NG.top_by(table, "complexity", [id_col, "complexity"], P.TOP_COMPLEX, id_col),
        "top_ngrams": NG.top_ngrams_bounded(table, "final_text", P.NGRAM_N, P.NGRAM_TOP_K),
    })
    reports["clean"] = table
    return reports


def pages_to_lyrics(catalog: DataFrame, candidates: DataFrame, pages: DataFrame, domain: str = P.SEARCH_DOMAIN,
                    version: str = "v1", script: P.Script = P.TELUGU, status_col: str | None = None, by_rounds: bool = False) -> DataFrame:
    """Lifecycle B for ``catalog(song_id, song_name, movie)``,
    ``candidates(song_id, rank, url)`` and ``pages(url, html[, status])``.

    v1: the first candidate among the top 3 whose URL contains ``domain``
    and whose page yields text.  v2: the first candidate in the top 7 whose
    URL contains ``domain``, then that page only.  Returns one row per song
    with ``outcome`` and (when found) ``lyrics`` and ``url``.  Of several pages
    with one URL that with a text counts, then the least text.

    ``by_rounds`` (v1) parses only what it must: the pages of rank 1, then for the
    songs still without a text those of rank 2, and so on; each round's result
    is a written table.
    """
    n = P.V1_SEARCH_RESULTS if version == "v1" else P.V2_MAX_RESULTS
    # rank and domain are cut first, so only pages that can win reach the parser
    top = C.top_candidates(candidates.select("song_id", "rank", "url"), "song_id", "rank", n)
    top = top.where(F.contains("url", F.lit(domain))).drop("_rank")
    if version != "v1":
        top = C.first_of_group(top, "song_id", "rank")
    pg = pages if status_col is None else pages.where(F.col(status_col) == 200)
    wanted = pg.select("url", "html").join(top.select(F.col("url").alias("_u")), F.col("url") == F.col("_u"), "left_semi")
    extracted = B.extract_main_text(wanted, "html", version, script).select(
        F.col("url").alias("_u"), "main_text", F.lit(True).alias("_loaded"))
    if version == "v1" and by_rounds:
        ranked = C.top_candidates(candidates.select("song_id", "rank", "url"), "song_id", "rank", n).where(F.contains("url", F.lit(domain)))
        usable, _ = first_usable_by_rounds(ranked, pg, n, script)
        out = catalog.join(usable, "song_id", "left")
        outcome = F.when(F.col("main_text").isNull(), F.lit("missing")).otherwise(F.lit("found"))
    elif version == "v1":
        usable = top.join(extracted.where(B.found("main_text")), F.col("url") == F.col("_u")).drop("_u", "_loaded")
        out = catalog.join(C.first_of_group(usable, "song_id", _best_page()), "song_id", "left")
        outcome = F.when(F.col("main_text").isNull(), F.lit("missing")).otherwise(F.lit("found"))
    else:
        chosen = C.first_of_group(top.join(extracted, F.col("url") == F.col("_u"), "left").drop("_u"), "song_id", _best_page())
        has = candidates.groupBy("song_id").agg(F.lit(True).alias("_has"))
        out = catalog.join(has, "song_id", "left").join(chosen, "song_id", "left")
        outcome = (
            F.when(F.col("_has").isNull(), F.lit(P.REASON_NO_RESULTS))
            .when(F.col("url").isNull(), F.lit(P.REASON_NOT_IN_TOP.format(n=P.V2_MAX_RESULTS)))
            .when(F.col("_loaded").isNull(), F.lit(P.REASON_NOT_LOADED))
            .when(~B.found("main_text"), F.lit(P.REASON_NO_SCRIPT))
            .otherwise(F.lit("found"))
        )
    return out.withColumn("outcome", outcome).drop("_has", "_loaded").withColumnRenamed("main_text", "lyrics")


def _best_page():
    """Order of the pages of one song: by candidate, one with a text first, then the least text."""
    return F.struct(F.col("rank"), F.coalesce(~B.found("main_text"), F.lit(True)).alias("none"), F.col("main_text"))


def first_usable_by_rounds(ranked: DataFrame, pages: DataFrame, n: int, script: P.Script = P.TELUGU) -> tuple[DataFrame, list[int]]:
    """(song_id, rank, url, main_text) of each song's first candidate with a text, and the number of pages parsed per round.

    ``ranked`` is (song_id, rank, url, _rank); round i parses the pages of the
    i-th candidates of songs that no earlier round has solved.
    """
    todo = write_scratch(ranked, "candidates")
    solved, parsed = None, []
    for i in range(1, n + 1):
        mine = todo.where(F.col("_rank") == i).drop("_rank")
        if solved is not None:
            mine = mine.join(solved.select("song_id"), "song_id", "left_anti")
        wanted = pages.select(F.col("url").alias("_u"), "html").join(mine.select("url").distinct(), F.col("_u") == F.col("url"), "left_semi")
        texts = write_scratch(B.extract_main_text(wanted, "html", "v1", script).select("_u", "main_text"), f"round{i}")
        parsed.append(texts.count())
        usable = mine.join(texts.where(B.found("main_text")), F.col("url") == F.col("_u")).drop("_u")
        usable = write_scratch(C.first_of_group(usable, "song_id", _best_page()), f"solved{i}")
        solved = usable if solved is None else solved.unionByName(usable)
    return solved, parsed


def outcome_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def write_lyrics_files(results: DataFrame, base: str, version: str = "v1", source: str | None = None, song_col: str = "song_name",
                       movie_col: str = "movie", order_col: str = "song_id", per_song: bool = True, exact: bool = False) -> None:
    """One file per found song; the second version's header has no URL line and another source.

    With ``exact`` the files are ``<movie>/<song>.txt`` (slugs) and hold just the body."""
    found = results.where(F.col("outcome") == "found")
    source = source or (P.SOURCE_V1 if version == "v1" else P.SOURCE_V2)
    url = F.col("url") if version == "v1" else None
    body = IO.lyrics_file_body(F.col(song_col), F.col(movie_col), F.lit(source), url, F.col("lyrics"))
    if exact:
        path = IO.song_file_path(IO.folder_slug(movie_col), IO.folder_slug(song_col))
        TR.write_named_files(found, base, path, body, order_col)
    else:
        IO.write_text_tree(found, base, movie_col, song_col, body, order_col, per_song=per_song)


def _append(spark: SparkSession, rows: DataFrame, table_path: str, only_new: bool) -> None:
    if only_new:
        IO.append_new(spark, rows, table_path, ["movie_name", "song_name"])
    else:
        IO.append_rows(rows, table_path)


def ingest_text_tree(spark: SparkSession, base: str, table_path: str, only_new: bool = False) -> None:
    """Text tree with a ``...`` marker before the lyrics -> (movie_name, song_name, lyrics), appended.

    With ``only_new`` a (movie, song) that the table has is not added again."""
    tree = TR.read_text_files(spark, base)
    _append(spark, tree.select("movie_name", "song_name", ST.after_marker("content").alias("lyrics")), table_path, only_new)


def ingest_scraped_tree(spark: SparkSession, base: str, table_path: str, script: P.Script = P.TELUGU, only_new: bool = False) -> None:
    """Scraped page bodies -> song name from the body (``song:`` line) + script lyrics, appended."""
    tree = TR.read_text_files(spark, base)
    parsed = tree.select("movie_name", ST.extract_song("content", script).alias("s"))
    _append(spark, parsed.select("movie_name", "s.song_name", "s.lyrics"), table_path, only_new)


def sheet_songs(sheet: DataFrame, scraped: DataFrame, lyricist: str, movies) -> DataFrame:
    """Sheet rows by ``lyricist`` for movies not already scraped (case-insensitive,
    one-sided), restricted to ``movies``, parsed into (movie_name, song_name, lyrics)."""
    mine = sheet.where(F.col("lyricist") == lyricist)
    overlap = SETS.semi_lower(scraped, "movie_name", mine, "movie")
    new = SETS.anti_lower(mine, "movie", overlap)
    chosen = new.where(F.col("movie").isin(list(movies)))
    parsed = chosen.select(F.col("movie").alias("movie_name"), ST.parse_song("telugu_lyrics").alias("s"))
    return parsed.select("movie_name", "s.song_name", "s.lyrics")


def pending_songs(catalog: DataFrame, extracted: DataFrame, key: str = "compat") -> DataFrame:
    """Catalog songs whose normalized name is not among the extracted names."""
    return SETS.pending(catalog, extracted, "song_name", "song_name", key)


def search_requests(catalog: DataFrame, song_col: str = "song_name", movie_col: str = "movie_album") -> DataFrame:
    """Per catalog row: v1 query + JSON payload, v2 query URL."""
    q1 = C.search_query(song_col, movie_col, P.QUERY_TEMPLATE_V1)
    q2 = C.search_query(song_col, movie_col, P.QUERY_TEMPLATE_V2)
    return catalog.select(
        "*", q1.alias("query"), C.search_payload(q1).alias("payload"),
        F.replace(F.lit(P.SEARCH_URL_V2), F.lit("{q}"), C.quote_plus(q2)).alias("search_url"),
    )


def catalog_from_html(rows_html: DataFrame, page_html: DataFrame | None = None, html_col: str = "html",
                      order_col: str = "seq", alt_rows_html: DataFrame | None = None) -> DataFrame:
    """Song catalog from rendered song-row snippets (``/song/``, ``/album/``,
    ``/artist/`` anchors).  ``alt_rows_html`` (a second selector's elements) is
    used only when ``rows_html`` has no rows at all; when fewer than 50 songs
    come out, markdown-style links ``[song](/song/x) .. [singers] .. [album]``
    from the page are added; finally keep-first by lower-case name."""
    if alt_rows_html is not None:
        rows_html = SETS.fallback_union(rows_html.select(order_col, html_col),
                                        alt_rows_html.select(order_col, html_col), min_rows=1)
    prim = rows_html.select(
        H.anchor_text(html_col, "/song/").alias("song_name"),
        H.anchor_text(html_col, "/album/").alias("movie_album"),
        H.anchor_texts(html_col, "/artist/").alias("singers"),
        F.col(order_col).alias("seq"), F.lit(0).alias("part"),
    ).where(TX.non_empty("song_name"))
    if page_html is None:
        both = prim
    else:
        pat = P.MARKDOWN_SONG
        m = page_html.select(F.col(order_col).alias("page_seq"),
                             F.posexplode(F.regexp_extract_all(html_col, F.lit(pat), 0)).alias("pos", "m"))
        fb = m.select(
            TX.py_strip(F.regexp_extract("m", pat, 1)).alias("song_name"),
            TX.py_strip(F.regexp_extract("m", pat, 4)).alias("movie_album"),
            TX.py_strip(F.regexp_extract("m", pat, 3)).alias("singers"),
            F.struct("page_seq", "pos").alias("seq"), F.lit(1).alias("part"),
        )
        prim_s = prim.withColumn("seq", F.struct(F.col("seq").cast("long").alias("page_seq"),
                                                 F.lit(0).alias("pos")))
        fb = SETS.fallback_rows(prim_s, fb, "song_name", "seq")
        both = SETS.fallback_union(prim_s, fb, P.FALLBACK_MIN_ROWS)
    ordered = both.withColumn("_ord", F.struct("part", "seq"))
    return SETS.keep_first(ordered, "song_name", "_ord").select("song_name", "movie_album", "singers")
