"""Search-candidate selection: first qualifying candidate within the top N.

A group's candidates are ranked by an order column and cut to the first N.
Spark keeps at most N rows of a group in each task before it shuffles them, so a
group that holds a third of all candidates arrives as N rows per task.
Expensive payloads (page texts) are joined to what the cut leaves.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textsieve import patterns as P
from textsieve.functions import text as T


def top_candidates(cands: DataFrame, group_col: str, order_col: str | Column, n: int, rank_col: str = "_rank") -> DataFrame:
    """The first ``n`` candidates of each group, with their rank from 1."""
    w = Window.partitionBy(group_col).orderBy(order_col)
    return cands.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def first_within_top(cands: DataFrame, group_col: str, order_col: str, qualifies: Column, n: int,
                     payload=()) -> DataFrame:
    """(group, order, *payload) of the first candidate of the top ``n`` that qualifies."""
    top = top_candidates(cands, group_col, order_col, n).where(qualifies)
    return first_of_group(top, group_col, order_col).select(group_col, order_col, *payload)


def first_of_group(cands: DataFrame, group_col: str, order_col: str | Column) -> DataFrame:
    """The first row of each group."""
    return top_candidates(cands, group_col, order_col, 1).drop("_rank")


def search_query(song, movie, template: str = P.QUERY_TEMPLATE_V1, domain: str = P.SEARCH_DOMAIN) -> Column:
    """Query text from a template with {song}, {movie}, {domain}; NULL parts become ''."""
    fill = {"{song}": F.coalesce(T._c(song), F.lit("")), "{movie}": F.coalesce(T._c(movie), F.lit(""))}
    pieces = re.split(r"(\{song\}|\{movie\})", template.replace("{domain}", domain))
    return F.concat(*[fill.get(p, F.lit(p)) for p in pieces if p])


def quote_plus(col) -> Column:
    """Form-encode like Python's ``quote_plus`` (space -> '+', '~' kept, '*' encoded)."""
    enc = F.url_encode(T._c(col))
    return F.replace(F.replace(enc, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def search_payload(query: Column, num: int = P.V1_SEARCH_RESULTS, gl: str = P.SEARCH_GL,
                   hl: str = P.SEARCH_HL) -> Column:
    """JSON request body {"q", "gl", "hl", "num"}."""
    return F.to_json(F.struct(query.alias("q"), F.lit(gl).alias("gl"), F.lit(hl).alias("hl"), F.lit(num).alias("num")))


def result_links(json_col, domain: str = P.SEARCH_DOMAIN, top: int | None = None) -> Column:
    """Links from a search response {"organic": [{"link": ...}, ...]} that
    contain ``domain``, in result order; a missing key gives []."""
    parsed = F.from_json(T._c(json_col), "organic array<struct<link:string>>")
    links = F.transform(F.coalesce(parsed["organic"], F.array().cast("array<struct<link:string>>")),
                        lambda x: x["link"])
    if top is not None:
        links = F.slice(links, 1, top)
    return F.filter(links, lambda u: u.isNotNull() & F.contains(u, F.lit(domain)))


def derived_audio_path(category, song, base: str = "") -> Column:
    """``<base>/<category: ' '->'_', '/'->'-'>/<song: ' '->'_'>.wav``."""
    folder = F.replace(F.replace(T._c(category), F.lit(" "), F.lit("_")), F.lit("/"), F.lit("-"))
    file_name = F.concat(F.replace(T._c(song), F.lit(" "), F.lit("_")), F.lit(".wav"))
    return F.concat_ws("/", *([F.lit(base)] if base else []), folder, file_name)
