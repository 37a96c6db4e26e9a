"""Scalar text functions: Column in, Column out, all JVM-side expressions.

Whitespace follows Python semantics (29 Unicode characters, see
``patterns.WS``), not Java's ASCII ``\\s``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textsieve import patterns as P


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def with_columns_once(df, columns: dict):
    """Add ``columns`` through a one-row ``inline`` generator.

    A later filter on these columns cannot be pushed below a generator, so
    Catalyst cannot copy their (expensive) expressions into the filter and
    evaluate them twice per row."""
    return df.select(*[F.col(c) for c in df.columns],
                     F.inline(F.array(F.struct(*[e.alias(n) for n, e in columns.items()]))))


def py_strip(col) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace
    (``trim`` with the whitespace set; several times cheaper than a regex)."""
    return F.trim(_c(col), F.lit(P.WS_CHARS))


def py_lstrip(col) -> Column:
    return F.ltrim(_c(col), F.lit(P.WS_CHARS))


def tokens(col) -> Column:
    """Python ``str.split()``: runs of non-whitespace, never empty strings.

    Every whitespace character becomes a space (``translate``), a split at single
    spaces needs no regex, and the empty pieces are removed without a lambda.
    """
    spaced = F.translate(_c(col), P.WS_CHARS, " " * len(P.WS_CHARS))
    return F.array_remove(F.split(spaced, " ", -1), "")


def token_chars(tok: Column) -> Column:
    """Total code points over the tokens = non-whitespace length of the text."""
    return F.length(F.array_join(tok, "")).cast("long")


def non_ws_length(col) -> Column:
    """Number of code points that are not whitespace."""
    return F.length(F.regexp_replace(_c(col), P.WS.java, ""))


def count_chars(col, chars: str) -> Column:
    """Occurrences of characters from the set ``chars``: the length lost when
    they are deleted with ``translate`` (about 3x cheaper than a regex count)."""
    c = _c(col)
    return F.length(c) - F.length(F.translate(c, chars, ""))


def delete_except(col, keep: str) -> Column:
    """Delete every character not in the set ``keep``.

    The first ``translate`` deletes the kept characters, leaving exactly the
    foreign characters present in this value; the second deletes those.  Two
    linear passes instead of a negated-class regex replace."""
    c = _c(col)
    return F.call_function("translate", c, F.translate(c, keep, ""), F.lit(""))


def _ratio(num: Column, den: Column) -> Column:
    """num / den as double, 0.0 when den is 0 or null."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def word_count(tok: Column) -> Column:
    return F.size(tok)


def script_ratio(col, script: P.Script = P.TELUGU, tok: Column | None = None) -> Column:
    """Script characters over non-whitespace characters; 0 when empty.

    ``tok`` (the token array of the same text) lets the denominator reuse it."""
    c = _c(col)
    den = token_chars(tok) if tok is not None else non_ws_length(c)
    return _ratio(count_chars(c, script.chars), den)


def uniqueness_ratio(tok: Column) -> Column:
    """Distinct tokens over tokens; 0 when there are none."""
    return _ratio(F.size(F.array_distinct(tok)), F.size(tok))


def has_script(col, script: P.Script = P.TELUGU) -> Column:
    return _c(col).rlike(script.any_char.java)


def count_script(col, script: P.Script = P.TELUGU) -> Column:
    return count_chars(col, script.chars)


def strip_foreign(col, script: P.Script = P.TELUGU, keep: str = P.KEPT_PUNCTUATION) -> Column:
    """Delete every character that is not script, whitespace or ``keep``.

    Whitespace is not collapsed.
    """
    return delete_except(col, script.chars + P.WS_CHARS + keep)


def richness(tok: Column, min_tokens: int = P.RICHNESS_MIN_TOKENS) -> Column:
    """Uniqueness ratio, but 0 when fewer than ``min_tokens`` tokens."""
    return F.when(F.size(tok) < min_tokens, F.lit(0.0)).otherwise(uniqueness_ratio(tok))


def mean_token_length(tok: Column, chars: Column | None = None) -> Column:
    """Mean token length in code points; 0 when there are no tokens."""
    return _ratio(token_chars(tok) if chars is None else chars, F.size(tok))


def char_density(col, chars: str = P.TELUGU_DENSITY_CHARS, non_ws: Column | None = None) -> Column:
    """Characters from the set ``chars`` over non-whitespace characters."""
    c = _c(col)
    return _ratio(count_chars(c, "".join(sorted(set(chars)))), non_ws_length(c) if non_ws is None else non_ws)


def ngram_tokens(col, mode: str = "compat") -> Column:
    """Lower-case, then runs of >= 2 word characters (see patterns.NGRAM_TOKEN)."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(P.ngram_token(mode).java), 0)


def ngrams(tok: Column, n: int = 2) -> Column:
    """Space-joined word n-grams of a token array, in order."""
    cnt = F.greatest(F.size(tok) - (n - 1), F.lit(0))
    if n == 1:
        return tok
    parts = [F.slice(tok, k + 1, cnt) for k in range(n)]
    out = parts[0]
    for p in parts[1:]:
        out = F.zip_with(out, p, lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def normalize_key(col, null_as: str | None = "nan") -> Column:
    """Catalog key: lower-case, strip, then '_' -> ' ' (strip happens first).

    ``null_as`` reproduces the string-cast null of the original key so that
    null names compare equal; pass None to keep SQL NULL.
    """
    c = _c(col)
    if null_as is not None:
        c = F.coalesce(c, F.lit(null_as))
    return F.replace(py_strip(F.lower(c)), F.lit("_"), F.lit(" "))


def slug(col, exact: bool = False) -> Column:
    """File-name slug: spaces to '_', then drop all but letters, digits, '_', '-' (``exact``: as one Unicode version has them)."""
    return F.regexp_replace(F.replace(_c(col), F.lit(" "), F.lit("_")), P.slug_drop(exact).java, "")


def contains_any(col, words) -> Column:
    """Lower-cased value contains any of ``words`` as a plain substring."""
    low = F.lower(_c(col))
    cond = F.lit(False)
    for w in words:
        cond = cond | F.contains(low, F.lit(w))
    return cond


def is_label(col) -> Column:
    """A short metadata line: contains ':' and has at most 3 words."""
    c = _c(col)
    return F.contains(c, F.lit(":")) & (F.size(tokens(c)) <= 3)


def non_empty(col) -> Column:
    c = _c(col)
    return c.isNotNull() & (c != "")
