"""DuckDB spellings of the registered queries (the correctness oracle).

Patterns are produced by ``textsieve.patterns`` in RE2 syntax, so the Spark
and DuckDB sides use the same character classes.  All test corpora are
Latin-script, so the script is ``LATIN``.
"""

from __future__ import annotations

from textsieve import patterns as P

SCRIPT = P.LATIN
DENSITY_CHARS = "àâäçéèêëîïôöùûüÿñß"

WS = P.WS.re2
TOK = P.TOKEN.re2
SCR = SCRIPT.any_char.re2
KEEP = SCRIPT.keep_only().re2
DENS = P.density_class(DENSITY_CHARS).re2
NGRAM = P.NGRAM_TOKEN["compat"].re2
NGRAM_UNI = P.NGRAM_TOKEN["unicode"].re2
LB = P.LINE_BREAK.re2


def ratio(num: str, den: str) -> str:
    return f"coalesce(({num})::DOUBLE / nullif({den}, 0), 0.0)"


def nonws_len(expr: str) -> str:
    return f"length(regexp_replace({expr}, '{WS}', '', 'g'))"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '\\A{WS}+|{WS}+\\z', '', 'g')"


def lstrip(expr: str) -> str:
    return f"regexp_replace({expr}, '\\A{WS}+', '')"


SCORED = f"""
scored_tok AS (
  SELECT doc_id, coalesce(text, 'None') AS t,
         regexp_extract_all(coalesce(text, 'None'), '{TOK}') AS w
  FROM documents),
scored AS (
  SELECT doc_id, t, len(w)::INTEGER AS word_count,
         {ratio(f"len(regexp_extract_all(t, '{SCR}'))", nonws_len("t"))} AS script_ratio,
         {ratio("len(list_distinct(w))", "len(w)")} AS uniqueness_ratio
  FROM scored_tok)"""

GATED = f"""
gated AS (
  SELECT *, regexp_replace(t, '{KEEP}', '', 'g') AS final_text
  FROM scored
  WHERE word_count >= {P.MIN_WORD_COUNT} AND script_ratio >= {P.MIN_SCRIPT_RATIO}
    AND uniqueness_ratio >= {P.MIN_UNIQUE_RATIO}),
gated_tok AS (SELECT *, regexp_extract_all(final_text, '{TOK}') AS w2 FROM gated),
clean AS (
  SELECT doc_id, word_count, script_ratio, uniqueness_ratio, final_text,
         CASE WHEN len(w2) < {P.RICHNESS_MIN_TOKENS} THEN 0.0
              ELSE len(list_distinct(w2))::DOUBLE / len(w2) END AS richness,
         {ratio("list_sum(list_transform(w2, lambda x: length(x)))", "len(w2)")} AS complexity,
         {ratio(f"len(regexp_extract_all(final_text, '{DENS}'))", nonws_len("final_text"))} AS density
  FROM gated_tok)"""


def histogram_sql(source: str, col: str, bins: str, nb_cte: str = "") -> str:
    """numpy.histogram over ``col`` of CTE ``source``; ``bins`` is a SQL
    expression over CTE ``rng`` columns (lo, hi) and ``nb_cte`` may define it."""
    return f"""
hv AS (SELECT {col}::DOUBLE AS v FROM {source} WHERE {col} IS NOT NULL),
rng0 AS (SELECT min(v) AS mn, max(v) AS mx, count(*) AS cnt FROM hv),
rng AS (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
               CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi, mn, mx, cnt FROM rng0){nb_cte},
par AS (SELECT lo, hi, ({bins})::BIGINT AS nb, (hi - lo) / ({bins}) AS step FROM rng),
i0 AS (SELECT v, lo, hi, nb, step, floor(((v - lo) / (hi - lo)) * nb) AS idx FROM hv, par),
i1 AS (SELECT v, lo, hi, nb, step, CASE WHEN idx = nb THEN nb - 1 ELSE idx END AS idx FROM i0),
i2 AS (SELECT v, lo, hi, nb, step,
              CASE WHEN v < (CASE WHEN idx = nb THEN hi ELSE idx * step + lo END) THEN idx - 1 ELSE idx END AS idx
       FROM i1),
i3 AS (SELECT CASE WHEN v >= (CASE WHEN idx + 1 = nb THEN hi ELSE (idx + 1) * step + lo END) AND idx <> nb - 1
                   THEN idx + 1 ELSE idx END AS idx FROM i2),
cnts AS (SELECT (idx + 1)::BIGINT AS bin, count(*) AS n FROM i3 GROUP BY 1),
scaffold AS (SELECT unnest(generate_series(1, nb)) AS bin, lo, hi, nb, step FROM par)
SELECT s.bin::BIGINT AS bin, (s.bin - 1) * s.step + s.lo AS bin_lo,
       CASE WHEN s.bin = s.nb THEN s.hi ELSE s.bin * s.step + s.lo END AS bin_hi,
       coalesce(c.n, 0)::BIGINT AS n
FROM scaffold s LEFT JOIN cnts c ON s.bin = c.bin"""


AUTO_NB = """,
iq AS (SELECT quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM hv),
auto AS (
  SELECT lo, hi, CASE WHEN w > 0 THEN ceil((hi - lo) / w) ELSE 1 END AS nb
  FROM (SELECT lo, hi,
               least(greatest(2.0 * iqr * pow(cnt, -1.0 / 3.0), (mx - mn) / sqrt(cnt) / 2),
                     (mx - mn) / (log2(cnt) + 1.0)) AS w
        FROM rng, iq))"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["quality_metrics"] = f"WITH {SCORED} SELECT doc_id, word_count, script_ratio, uniqueness_ratio FROM scored"
    q["quality_gate"] = (
        f"WITH {SCORED}, {GATED} SELECT doc_id, word_count, script_ratio, uniqueness_ratio FROM gated"
    )
    q["strip_script"] = f"WITH {SCORED}, {GATED} SELECT doc_id, final_text FROM gated"
    q["clean_corpus"] = f"WITH {SCORED}, {GATED} SELECT * FROM clean"
    q["gate_reconciliation"] = f"""WITH {SCORED}
SELECT count(*) AS rows_before,
       count(*) FILTER (WHERE word_count >= {P.MIN_WORD_COUNT} AND script_ratio >= {P.MIN_SCRIPT_RATIO}
                        AND uniqueness_ratio >= {P.MIN_UNIQUE_RATIO}) AS rows_after,
       count(*) - count(*) FILTER (WHERE word_count >= {P.MIN_WORD_COUNT} AND script_ratio >= {P.MIN_SCRIPT_RATIO}
                        AND uniqueness_ratio >= {P.MIN_UNIQUE_RATIO}) AS rows_dropped
FROM scored"""
    q["profile"] = f"""WITH {SCORED},
l AS (SELECT 'word_count' AS name, word_count::DOUBLE AS v FROM scored
      UNION ALL SELECT 'script_ratio', script_ratio FROM scored
      UNION ALL SELECT 'uniqueness_ratio', uniqueness_ratio FROM scored),
st AS (SELECT name, count(v)::DOUBLE AS s_count, avg(v) AS s_mean, stddev_samp(v) AS s_std, min(v) AS s_min,
              quantile_cont(v, 0.25) AS s_25, quantile_cont(v, 0.5) AS s_50, quantile_cont(v, 0.75) AS s_75,
              max(v) AS s_max
       FROM l GROUP BY name),
u AS (UNPIVOT st ON s_count, s_mean, s_std, s_min, s_25, s_50, s_75, s_max INTO NAME stat VALUE value)
SELECT CASE stat WHEN 's_count' THEN 'count' WHEN 's_mean' THEN 'mean' WHEN 's_std' THEN 'std'
                 WHEN 's_min' THEN 'min' WHEN 's_25' THEN '25%' WHEN 's_50' THEN '50%' WHEN 's_75' THEN '75%'
                 ELSE 'max' END AS stat,
       round(max(value) FILTER (WHERE name = 'word_count'), 9) AS word_count,
       round(max(value) FILTER (WHERE name = 'script_ratio'), 9) AS script_ratio,
       round(max(value) FILTER (WHERE name = 'uniqueness_ratio'), 9) AS uniqueness_ratio
FROM u GROUP BY stat"""
    q["mean_richness"] = f"WITH {SCORED}, {GATED} SELECT printf('%.2f', avg(richness)) AS mean_richness FROM clean"
    q["top_bigrams"] = f"""WITH {SCORED}, {GATED},
tk AS (SELECT regexp_extract_all(lower(final_text), '{NGRAM}') AS w FROM clean),
bg AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS ngram FROM tk)
SELECT ngram, count(*) AS freq FROM bg GROUP BY ngram ORDER BY freq DESC, ngram ASC LIMIT {P.NGRAM_TOP_K}"""
    q["top_bigrams_bounded"] = q["top_bigrams"]
    q["top_bigrams_exact"] = q["top_bigrams"].replace(f"'{NGRAM}'", f"'{P.ngram_token('exact').re2}'")
    q["slug_exact"] = f"SELECT doc_id, md5(regexp_replace(replace(text, ' ', '_'), '{P.slug_drop(True).re2}', '', 'g')) AS slug_md5 FROM documents"
    q["top_bigrams_unicode"] = q["top_bigrams"].replace(f"'{NGRAM}'", f"'{NGRAM_UNI}'")
    q["top_bigrams_first_seen"] = f"""WITH {SCORED}, {GATED},
tk AS (SELECT doc_id, regexp_extract_all(lower(final_text), '{NGRAM}') AS w FROM clean),
b0 AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM tk),
bg AS (SELECT doc_id, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS ngram FROM b0),
agg AS (SELECT ngram, count(*) AS freq, min(doc_id) AS d0 FROM bg GROUP BY ngram),
fp AS (SELECT bg.ngram, min(bg.pos) AS p0 FROM bg JOIN agg ON bg.ngram = agg.ngram AND bg.doc_id = agg.d0
       GROUP BY bg.ngram)
SELECT agg.ngram, agg.freq FROM agg JOIN fp ON agg.ngram = fp.ngram
ORDER BY agg.freq DESC, agg.d0, fp.p0 LIMIT {P.NGRAM_TOP_K}"""
    q["histogram_words"] = f"WITH {SCORED}, " + histogram_sql("scored", "word_count", str(P.HIST_BINS_WORDS))
    q["histogram_script"] = f"WITH {SCORED}, " + histogram_sql("scored", "script_ratio", str(P.HIST_BINS_SCRIPT))
    q["histogram_unique"] = f"WITH {SCORED}, " + histogram_sql("scored", "uniqueness_ratio", str(P.HIST_BINS_UNIQUE))
    q["histogram_richness_auto"] = (
        f"WITH {SCORED}, {GATED}, "
        + histogram_sql("clean", "richness", "(SELECT nb FROM auto)", AUTO_NB)
    )
    q["kde_richness"] = f"""WITH {SCORED}, {GATED},
st AS (SELECT count(richness) AS n, min(richness) AS lo, max(richness) AS hi,
              stddev_samp(richness) * pow(count(richness)::DOUBLE, -0.2) AS bw FROM clean),
pts AS (SELECT j, CASE WHEN j = {P.KDE_GRID - 1} THEN hi ELSE j * ((hi - lo) / {P.KDE_GRID - 1}) + lo END AS x,
               n, bw FROM st, range(0, {P.KDE_GRID}) t(j))
SELECT (j + 1)::BIGINT AS point, round(x, 6) AS x,
       round(sum(exp(-0.5 * pow((x - richness) / bw, 2))) / (n * bw * sqrt(2 * pi())), 6) AS density
FROM pts, clean GROUP BY j, x, n, bw"""
    q["top_complex"] = (
        f"WITH {SCORED}, {GATED} SELECT doc_id, complexity FROM clean "
        f"ORDER BY complexity DESC, doc_id ASC LIMIT {P.TOP_COMPLEX}"
    )
    q.update(set_and_structure_queries())
    return q


TITLED = "titled AS (SELECT doc_id, text, lang, source, split_part(text, chr(10), 1) AS title FROM documents)"
SLUG_RE = "[^\\p{L}\\p{N}_\\-]"


def slug(expr: str) -> str:
    return f"regexp_replace(replace({expr}, ' ', '_'), '{SLUG_RE}', '', 'g')"


def norm_key(expr: str) -> str:
    return f"replace({strip(f'lower(coalesce({expr}, {chr(39)}nan{chr(39)}))')}, '_', ' ')"


def contains_any(expr: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({expr}), '{w}')" for w in words) + ")"


def splitlines(expr: str) -> str:
    """Python str.splitlines(): no pieces for '', no trailing empty piece."""
    return (f"CASE WHEN {expr} = '' THEN []::VARCHAR[] "
            f"WHEN regexp_matches({expr}, '(?:{LB})\\z') THEN string_split_regex({expr}, '{LB}')[:-2] "
            f"ELSE string_split_regex({expr}, '{LB}') END")


def clean_lines(expr: str, words, script: bool) -> str:
    cond = f"l <> '' AND NOT {contains_any('l', words)}"
    if script:
        cond += f" AND regexp_matches(l, '{SCR}')"
    return (f"CASE WHEN {expr} IS NULL OR {expr} = '' THEN '' ELSE array_to_string(list_filter("
            f"list_transform(string_split({expr}, chr(10)), lambda l: {strip('l')}), lambda l: {cond}), chr(10)) END")


def set_and_structure_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    done = f"""done AS (SELECT {slug('title')} AS song_name FROM titled WHERE doc_id IN (SELECT doc_id FROM labels))"""
    q["pending_by_name"] = f"""WITH {TITLED}, {done},
dk AS (SELECT DISTINCT {norm_key('song_name')} AS k FROM done)
SELECT doc_id, title FROM (SELECT doc_id, translate(title, '.,|', '') AS title FROM titled) t
WHERE NOT EXISTS (SELECT 1 FROM dk WHERE dk.k = {norm_key('t.title')})"""
    q["pending_by_slug"] = f"""WITH {TITLED}, {done},
dk AS (SELECT DISTINCT {norm_key(slug('song_name'))} AS k FROM done)
SELECT doc_id, title FROM titled t
WHERE NOT EXISTS (SELECT 1 FROM dk WHERE dk.k = {norm_key(slug('t.title'))})"""
    semi = ("matched AS (SELECT DISTINCT p_type AS value FROM part "
            "WHERE lower(p_type) IN (SELECT split_part(p_name, ' ', 1) FROM part))")
    q["semi_lower"] = f"WITH {semi} SELECT value FROM matched"
    q["anti_lower"] = f"""WITH {semi}
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word FROM part
WHERE NOT EXISTS (SELECT 1 FROM matched WHERE lower(matched.value) = split_part(part.p_name, ' ', 1))"""
    q["dedupe_keep_first"] = """SELECT doc_id, lang, source FROM (
  SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lower(text) ORDER BY doc_id) AS rn
  FROM documents WHERE text IS NOT NULL AND lower(text) <> '') WHERE rn = 1"""
    q["union_all"] = """SELECT doc_id AS id, 'documents' AS origin, text FROM documents
UNION ALL SELECT item_id AS id, 'benchmark' AS origin, text FROM benchmark"""
    q["catalog_fallback"] = f"""WITH {TITLED},
prim AS (SELECT split_part(text, chr(10), 1) AS song_name, 'benchmark' AS origin, item_id AS seq, 0 AS part
         FROM benchmark),
fb0 AS (SELECT title AS song_name, 'documents' AS origin, doc_id AS seq, 1 AS part FROM titled
        WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)),
fb1 AS (SELECT * FROM fb0 WHERE song_name IS NOT NULL AND song_name <> ''
        AND NOT EXISTS (SELECT 1 FROM prim WHERE prim.song_name = fb0.song_name)),
fb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY song_name ORDER BY seq) AS rn FROM fb1) WHERE rn = 1),
u AS (SELECT song_name, origin, seq, part FROM prim
      UNION ALL SELECT song_name, origin, seq, part FROM fb WHERE (SELECT count(*) FROM prim) < {P.FALLBACK_MIN_ROWS}),
d AS (SELECT *, row_number() OVER (PARTITION BY lower(song_name) ORDER BY part, seq) AS rn FROM u
      WHERE song_name IS NOT NULL AND lower(song_name) <> '')
SELECT song_name, origin, seq FROM d WHERE rn = 1"""
    q["lang_filter"] = "SELECT doc_id, source FROM documents WHERE lang = 'fr' AND source IN ('src1', 'src2', 'src3')"
    q["distinct_sources"] = "SELECT DISTINCT source FROM documents"
    body_v1 = ("'Song: ' || title || chr(10) || 'Movie: ' || source || chr(10) || 'Source: ' || lang || chr(10) || "
               "'URL: u' || chr(10) || chr(10) || CASE WHEN lang = 'en' THEN '...' || chr(10) ELSE '' END || text")
    q["after_marker"] = f"""WITH {TITLED}, b AS (SELECT doc_id, {body_v1} AS body FROM titled)
SELECT doc_id, CASE WHEN contains(body, '...') THEN {lstrip("regexp_extract(body, '(?s)^.*[.][.][.](.*)$', 1)")}
                    ELSE {strip('body')} END AS lyrics FROM b"""
    q["clean_lines_v1"] = f"SELECT doc_id, {clean_lines('text', P.STOP_WORDS_V1, True)} AS lyrics FROM documents"
    q["clean_lines_v2"] = f"SELECT doc_id, {clean_lines('text', P.STOP_WORDS_V2, False)} AS lyrics FROM documents"
    q["slug"] = f"WITH {TITLED} SELECT doc_id, {slug('title')} AS slug FROM titled"
    body_p2 = ("title || chr(10) || 'Lyricist: ' || source || chr(10) || "
               "CASE WHEN lang <> 'de' THEN chr(10) ELSE '' END || text")
    q["parse_song"] = f"""WITH {TITLED},
l AS (SELECT doc_id, {splitlines(strip(body_p2))} AS lines FROM titled),
n AS (SELECT doc_id, lines, list_filter(generate_series(1, len(lines)),
        lambda i: {strip('lines[i]')} <> '' AND NOT contains({strip('lines[i]')}, ':'))[1] AS np FROM l),
k AS (SELECT doc_id, lines, np, list_filter(generate_series(1, len(lines)),
        lambda i: i > np AND {strip('lines[i]')} = '')[1] AS bp FROM n)
SELECT doc_id, {strip('lines[np]')} AS song_name,
       CASE WHEN bp IS NULL THEN '' ELSE {strip("array_to_string(lines[bp + 1:], chr(10))")} END AS lyrics
FROM k"""
    body_p3 = ("'song:' || chr(10) || title || chr(10) || CASE WHEN lang <> 'fr' THEN 'telugu' || chr(10) ELSE '' END "
               "|| text || chr(10) || '---' || chr(10) || 'End: x'")
    tag = "(lower(lines[i]) = 'song:' AND i < n)"
    hdr = "(lower(lines[i]) = 'telugu')"
    scr = f"regexp_matches(lines[i], '{SCR}')"
    lab = f"(contains(lines[i], ':') AND len(regexp_extract_all(lines[i], '{TOK}')) <= 3)"
    plain = f"(NOT {tag} AND NOT {hdr})"
    q["extract_song"] = f"""WITH {TITLED},
l AS (SELECT doc_id, list_filter(list_transform({splitlines(body_p3)}, lambda x: {strip('x')}),
                                 lambda x: x <> '') AS lines FROM titled),
a AS (SELECT doc_id, lines, len(lines) AS n, generate_series(1, len(lines)) AS idx FROM l),
b AS (SELECT *, list_filter(idx, lambda i: {hdr})[1] AS armed FROM a),
c AS (SELECT *, list_filter(idx, lambda i: i > armed AND {plain} AND {scr})[1] AS st FROM b),
d AS (SELECT *, coalesce(list_filter(idx, lambda i: i >= st AND {plain} AND (NOT {scr} OR {lab}))[1], n + 1) AS sp
      FROM c),
e AS (SELECT *, list_filter(idx, lambda i: {tag} AND i < sp)[-1] AS tp FROM d)
SELECT doc_id, lines[tp + 1] AS song_name,
       coalesce(array_to_string(list_transform(list_filter(idx, lambda i: i >= st AND i < sp AND {plain}),
                                               lambda i: lines[i]), chr(10)), '') AS lyrics
FROM e"""
    anchor = 'href="/[^"]+">([^<]+)</a>'
    q["anchor_texts"] = f"""SELECT * FROM (
  SELECT page_id, {strip(f"regexp_extract(html, '{anchor}', 1)")} AS first_link,
         array_to_string(regexp_extract_all(html, '{anchor}', 1), ', ') AS all_links FROM pages)
WHERE first_link IS NOT NULL AND first_link <> ''"""
    q["json_field"] = "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events"

    def qtext(tpl):
        tpl = tpl.replace("{domain}", P.SEARCH_DOMAIN)
        parts = []
        for piece in __import__("re").split(r"(\{song\}|\{movie\})", tpl):
            if piece == "{song}":
                parts.append("coalesce(title, '')")
            elif piece == "{movie}":
                parts.append("coalesce(source, '')")
            elif piece:
                parts.append("'" + piece + "'")
        return " || ".join(parts)

    url_pre, url_post = P.SEARCH_URL_V2.split("{q}")
    q["search_request"] = f"""WITH {TITLED}
SELECT doc_id, {qtext(P.QUERY_TEMPLATE_V1)} AS query,
       '{url_pre}' || replace(url_encode({qtext(P.QUERY_TEMPLATE_V2)}), '%20', '+') || '{url_post}' AS search_url,
       json_object('q', {qtext(P.QUERY_TEMPLATE_V1)}, 'gl', '{P.SEARCH_GL}', 'hl', '{P.SEARCH_HL}',
                   'num', {P.V1_SEARCH_RESULTS})::VARCHAR AS payload,
       {qtext(P.QUERY_TEMPLATE_AUDIO)} AS audio_query
FROM titled"""
    q["derived_path"] = """SELECT p_partkey,
       replace(replace(p_brand || ' / ' || p_type, ' ', '_'), '/', '-') AS category_folder,
       replace(p_name, ' ', '_') || '.wav' AS file_name,
       'audio/' || replace(replace(p_brand || ' / ' || p_type, ' ', '_'), '/', '-') || '/'
         || replace(p_name, ' ', '_') || '.wav' AS path
FROM part"""
    q.update(page_queries())
    q["csv_roundtrip"] = "SELECT doc_id, lang, source, n_chars, md5(coalesce(text, '')) AS text_md5 FROM documents"
    q["text_tree_roundtrip"] = f"""SELECT 'Shelf_' || (item_id % 7) AS movie_slug, 'Item_' || item_id AS song_slug,
       md5({lstrip('text')}) AS lyrics_md5 FROM benchmark"""
    q["append_new"] = f"""WITH {TITLED}
SELECT coalesce(min(doc_id) FILTER (doc_id IN (SELECT doc_id FROM labels)), min(doc_id)) AS doc_id, source, title
FROM titled GROUP BY source, title"""
    q["table_append"] = q["append_new"]
    # '...' begins the text, but a later one in it cuts again
    q["song_tree_ingest"] = f"""WITH {TITLED},
f AS (SELECT source || ' +%41 పాట' AS movie_name, '100% ' || replace(title[1:40], '/', '_') AS song_name, max(doc_id) AS doc_id
      FROM titled GROUP BY ALL),
t AS (SELECT movie_name, song_name, '...' || replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t
      FROM f JOIN titled USING (doc_id))
SELECT movie_name, song_name, md5({lstrip("list_last(string_split(t, '...'))")}) AS lyrics_md5 FROM t"""
    q["scraped_tree_ingest"] = f"WITH songs AS ({q['extract_song']}) SELECT source AS movie_name, song_name, md5(lyrics) AS lyrics_md5 FROM songs JOIN documents USING (doc_id)"
    q["csv_row_index"] = """SELECT row_number() OVER (ORDER BY lang NULLS FIRST, doc_id DESC) - 1 AS row_id, doc_id, lang, source,
       'No' AS downloaded, 'No' AS vocals_extracted, 'No' AS dereverbed, NULL::VARCHAR AS notes FROM documents"""
    audio = """c AS (SELECT *, replace(replace(p_type, ' ', '_'), '/', '-') || '/' || replace(p_name, ' ', '_') AS path FROM part),
f AS (SELECT path, arg_max(repeat(p_brand || '|' || p_name || chr(10), p_size), p_partkey) AS body FROM c WHERE p_size < 25 GROUP BY path)"""
    q["attach_files"] = f"""WITH {audio}
SELECT p_partkey, CASE WHEN body IS NULL THEN 'missing' ELSE 'uploaded' END AS outcome, length(body)::BIGINT AS length, md5(body) AS content_md5
FROM c LEFT JOIN f USING (path)"""
    q["upload_files"] = f"""WITH {audio}
SELECT CASE WHEN body IS NULL THEN 'missing' ELSE 'uploaded' END AS outcome, count(*) AS n,
       CASE WHEN count(body) > 0 THEN count(body) END AS held, sum(length(body))::BIGINT AS bytes
FROM c LEFT JOIN f USING (path) GROUP BY 1"""
    q["semi_titles"] = f"""WITH {TITLED},
r AS (SELECT CASE WHEN lang = 'en' THEN lower(title) ELSE upper(title) END AS name FROM titled)
SELECT DISTINCT title AS value FROM titled WHERE doc_id IN (SELECT doc_id FROM labels) AND lower(title) IN (SELECT name FROM r)"""
    q["attach_report"] = """WITH c AS (SELECT replace(replace(p_type, ' ', '_'), '/', '-') || '/' || replace(p_name, ' ', '_') AS path, p_size FROM part)
SELECT CASE WHEN path IN (SELECT path FROM c WHERE p_size < 25) THEN 'uploaded' ELSE 'missing' END AS status, count(*) AS n
FROM c GROUP BY 1"""
    return q


# Pages have two blocks that are not inside another one: the advertisement and the article.
BLOCKS = """
page AS (SELECT page_id, url, html, [regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1),
                                     regexp_extract(html, '(?s)<article>(.*?)</article>', 1)] AS inner_html FROM pages),
nodes AS (SELECT page_id, url, list_transform(inner_html, lambda h: array_to_string(list_filter(
            string_split_regex(h, '<[^>]*>'), lambda x: x <> ''), chr(10))) AS raw FROM page),
blk AS (SELECT page_id, url, list_transform(raw, lambda t: replace(replace(replace(replace(replace(t,
            '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&middot;', '·'), '&amp;', '&')) AS t FROM nodes)"""


def best_text(script: str, cleaner) -> str:
    """CTE ``best`` (page_id, url, score, main_text): the block with more letters of the script, the first one if equal."""
    return f"""{BLOCKS},
scored_blk AS (SELECT page_id, url, t, len(regexp_extract_all(t[1], '{script}')) AS s1, len(regexp_extract_all(t[2], '{script}')) AS s2 FROM blk),
picked AS (SELECT page_id, url, greatest(s1, s2)::INTEGER AS score, CASE WHEN s1 >= s2 THEN t[1] ELSE t[2] END AS txt FROM scored_blk),
best AS (SELECT page_id, url, score, CASE WHEN score >= {P.MIN_SCRIPT_CHARS} THEN {cleaner('txt')} END AS main_text FROM picked)"""


def page_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    number = "regexp_extract(url, '/[a-z]{2}/([0-9]+)', 1)"
    cand = f"""cand AS (
  SELECT floor(TRY_CAST({number} AS BIGINT) / 40)::BIGINT AS song_id, page_id AS rank, url || '#' || page_id AS url
  FROM pages WHERE {number} <> ''),
ranked AS (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY rank) AS nth FROM cand)"""
    v1 = best_text(SCR, lambda t: clean_lines(t, P.STOP_WORDS_V1, True))
    accented = best_text(P.char_class([(0xC0, 0xFF)]).re2, lambda t: clean_lines(t, P.STOP_WORDS_V2, False))
    q["first_candidate"] = f"""WITH {cand}
SELECT song_id, min(rank) AS rank, arg_min(url, rank) AS url FROM ranked
WHERE nth <= {P.V2_MAX_RESULTS} AND contains(url, '//m.') GROUP BY song_id"""
    q["result_links"] = f"""WITH {cand}
SELECT song_id, (row_number() OVER (PARTITION BY song_id ORDER BY rank) - 1)::INTEGER AS pos, url AS link FROM ranked
WHERE nth <= {P.V2_MAX_RESULTS} AND contains(url, 'example.net')"""
    q["best_block"] = f"WITH {v1} SELECT page_id, score, main_text FROM best"
    q["page_lyrics"] = f"""WITH {cand}, {v1},
ok AS (SELECT song_id, rank, ranked.url, main_text FROM ranked JOIN best ON best.page_id = ranked.rank
       WHERE nth <= {P.V1_SEARCH_RESULTS} AND contains(ranked.url, 'example.net') AND ranked.url LIKE 'https%' AND main_text <> '')
SELECT song_id, min(rank) AS rank, arg_min(url, rank) AS url, arg_min(main_text, rank) AS lyrics FROM ok GROUP BY song_id"""
    q["outcome_counts"] = f"""WITH {cand}, {accented},
want AS (SELECT song_id, min(rank) AS rank FROM ranked WHERE nth <= {P.V2_MAX_RESULTS} AND contains(url, 'example.net') GROUP BY song_id),
shelf AS (SELECT DISTINCT floor(doc_id / 40)::BIGINT AS song_id FROM documents),
res AS (
  SELECT CASE WHEN song_id NOT IN (SELECT song_id FROM cand) THEN '{P.REASON_NO_RESULTS}'
              WHEN w.rank IS NULL THEN '{P.REASON_NOT_IN_TOP.format(n=P.V2_MAX_RESULTS)}'
              WHEN b.url NOT LIKE 'https%' THEN '{P.REASON_NOT_LOADED}'
              WHEN coalesce(b.main_text, '') = '' THEN '{P.REASON_NO_SCRIPT}' ELSE 'found' END AS outcome
  FROM shelf LEFT JOIN want w USING (song_id) LEFT JOIN best b ON b.page_id = w.rank)
SELECT outcome, count(*) AS n FROM res GROUP BY outcome"""
    q["page_lyrics_rounds"] = q["page_lyrics"]
    item = '<li><a href="/[^"]+">([^<]+)</a></li>'
    q["catalog_markdown"] = f"""WITH n AS (SELECT page_id, regexp_extract_all(html, '{item}', 1) AS w FROM pages),
l AS (SELECT page_id, i, {strip("w[i] || ' ' || w[i + 1]")} AS song_name, {strip('w[i + 2]')} AS movie_album, {strip('w[i + 1]')} AS singers
      FROM n, unnest(range(1, len(w) - 1)) AS u(i) WHERE len(w) >= 3),
a AS (SELECT 0 AS part, n_nationkey AS seq, 0 AS pos, {strip('n_name')} AS song_name, 'Atlas' AS movie_album, '' AS singers FROM nation
      UNION ALL SELECT 1, page_id, i, song_name, movie_album, singers FROM l WHERE song_name <> '' AND song_name NOT IN (SELECT {strip('n_name')} FROM nation)),
f AS (SELECT *, row_number() OVER (PARTITION BY lower(song_name) ORDER BY part, seq, pos) AS rn FROM a)
SELECT song_name, movie_album, singers FROM f WHERE rn = 1"""
    q["catalog_from_html"] = f"""WITH n AS (SELECT page_id, regexp_extract_all(html, '{item}', 1) AS w FROM pages),
c AS (SELECT page_id, {strip('w[1]')} AS song_name, {strip('w[2]')} AS movie_album, w[3] || ', ' || w[4] AS singers FROM n WHERE len(w) >= 4),
f AS (SELECT *, row_number() OVER (PARTITION BY lower(song_name) ORDER BY page_id) AS rn FROM c WHERE song_name <> '')
SELECT song_name, movie_album, singers FROM f WHERE rn = 1"""
    return q
