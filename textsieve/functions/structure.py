"""Row -> parsed fields, written with higher-order array functions.

Every parser here works on the line array of one text and computes start /
stop indices with ``filter`` + ``try_element_at`` instead of a per-line fold,
so the cost is linear in the number of lines and stays inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textsieve import patterns as P
from textsieve.functions.text import _c, contains_any, has_script, is_label, py_lstrip, py_strip


def _empty_strings() -> Column:
    return F.array().cast("array<string>")


def split_lines(col) -> Column:
    """Python ``str.splitlines()``: Unicode line breaks, no trailing empty line."""
    c = _c(col)
    parts = F.split(c, P.LINE_BREAK.java, -1)
    ends_with_break = c.rlike(f"(?:{P.LINE_BREAK.java})\\z")
    return (
        F.when(c == "", _empty_strings())
        .when(ends_with_break, F.slice(parts, F.lit(1), F.size(parts) - 1))
        .otherwise(parts)
    )


def split_newline(col) -> Column:
    """Python ``str.split('\\n')`` (keeps a trailing empty piece)."""
    return F.split(_c(col), "\n", -1)


def after_marker(col, marker: str = "...") -> Column:
    """Text after the last ``marker`` with leading whitespace removed;
    without a marker the whole text, stripped."""
    c = _c(col)
    return F.when(F.contains(c, F.lit(marker)), py_lstrip(F.substring_index(c, marker, -1))).otherwise(py_strip(c))


def clean_lines(col, stop_words, script: P.Script | None = None) -> Column:
    """Split on '\\n', strip lines, drop empty lines and lines containing a stop
    word (lower-cased substring); with ``script`` keep only lines that contain
    it.  Re-joined with '\\n'.  NULL or empty input gives ''."""
    c = _c(col)
    lines = F.transform(split_newline(c), lambda l: py_strip(l))

    def keep(l):
        cond = (l != "") & ~contains_any(l, stop_words)
        if script is not None:
            cond = cond & has_script(l, script)
        return cond

    return F.when(c.isNull() | (c == ""), F.lit("")).otherwise(F.array_join(F.filter(lines, keep), "\n"))


def clean_lines_v1(col, script: P.Script = P.TELUGU) -> Column:
    return clean_lines(col, P.STOP_WORDS_V1, script)


def clean_lines_v2(col) -> Column:
    return clean_lines(col, P.STOP_WORDS_V2, None)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element ``transform``).

    Without it an index computed by one higher-order function and used inside
    another one's lambda is re-evaluated for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _first(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(1))


def parse_song(col) -> Column:
    """struct<song_name, lyrics>: the name is the first non-empty line without
    ':'; the lyrics are everything after the first blank line that follows the
    name, stripped ('' without such a blank line; NULL name without a name)."""

    def with_lines(lines):
        recs = F.transform(lines, lambda l, i: F.struct(py_strip(l).alias("s"), (i + 1).alias("p")))

        def with_recs(rs):
            name = _first(F.filter(rs, lambda r: (r["s"] != "") & ~F.contains(r["s"], F.lit(":"))))

            def with_name(nm):
                blank = _first(F.filter(rs, lambda r: (r["p"] > nm["p"]) & (r["s"] == "")))
                body = py_strip(F.array_join(F.slice(lines, blank["p"] + 1, F.size(lines)), "\n"))
                return F.struct(
                    nm["s"].alias("song_name"),
                    F.when(blank.isNull(), F.lit("")).otherwise(body).alias("lyrics"),
                )

            return let(name, with_name)

        return let(recs, with_recs)

    return let(split_lines(py_strip(_c(col))), with_lines)


def extract_song(col, script: P.Script = P.TELUGU, header: str = "telugu", name_tag: str = "song:") -> Column:
    """struct<song_name, lyrics> from a scraped page body.

    Over the stripped non-empty lines: a ``name_tag`` line that is not the last
    line names the song with the next line (the last one before the stop
    wins); a ``header`` line arms collection; once armed, the first line with
    script starts collecting; collection stops at the first line without
    script or that is a label.  Name-tag and header lines never start or stop
    collection.  Collected lines are joined with '\\n'.
    """

    def plain(r):
        return ~r["tag"] & ~r["hdr"]

    def with_lines(lines):
        n = F.size(lines)
        recs = F.transform(
            lines,
            lambda l, i: F.struct(
                l.alias("l"),
                (i + 1).alias("p"),
                ((F.lower(l) == name_tag) & (i + 1 < n)).alias("tag"),
                (F.lower(l) == header).alias("hdr"),
                has_script(l, script).alias("scr"),
                is_label(l).alias("lab"),
            ),
        )

        def with_recs(rs):
            armed = _first(F.filter(rs, lambda r: r["hdr"]))["p"]

            def with_armed(a):
                start = _first(F.filter(rs, lambda r: (r["p"] > a) & plain(r) & r["scr"]))["p"]

                def with_start(st):
                    stop = F.coalesce(
                        _first(F.filter(rs, lambda r: (r["p"] >= st) & plain(r) & (~r["scr"] | r["lab"])))["p"],
                        n + 1,
                    )

                    def with_stop(sp):
                        body = F.array_join(
                            F.transform(F.filter(rs, lambda r: (r["p"] >= st) & (r["p"] < sp) & plain(r)),
                                        lambda r: r["l"]),
                            "\n",
                        )
                        tag_pos = F.try_element_at(F.filter(rs, lambda r: r["tag"] & (r["p"] < sp)), F.lit(-1))["p"]
                        return F.struct(
                            F.try_element_at(lines, tag_pos + 1).alias("song_name"),
                            F.coalesce(body, F.lit("")).alias("lyrics"),
                        )

                    return let(stop, with_stop)

                return let(start, with_start)

            return let(armed, with_armed)

        return let(recs, with_recs)

    lines = F.filter(F.transform(split_lines(_c(col)), lambda l: py_strip(l)), lambda l: l != "")
    return let(lines, with_lines)
