"""Character classes, thresholds and word lists shared by every operator.

Each pattern exists in two spellings: Java regex (what Spark evaluates) and
RE2 (what DuckDB evaluates in the oracle SQL).  Both spellings are produced
from the same code-point ranges so they cannot drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

# --- fixed values (must equal the studied pipeline for identical results) ---
#
# Python's str.isspace() set: U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0,
# U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
WHITESPACE_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
    (0x3000, 0x3000),
]
# str.splitlines() boundaries (\r\n is matched first as one break).
LINE_BREAK_RANGES = [
    (0x0A, 0x0D), (0x1C, 0x1E), (0x85, 0x85), (0x2028, 0x2029),
]
# Telugu block, the default script.
TELUGU_RANGES = [(0x0C00, 0x0C7F)]
# Latin letters incl. Latin-1 supplement; used for the Latin test corpora.
LATIN_RANGES = [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xFF)]
# Punctuation kept by the script-stripping cleaner besides script + whitespace.
KEPT_PUNCTUATION = ".,?!"
# Aspirated / Sanskrit-derived letters whose density is measured (the literal
# contains KA + VIRAMA + SSA, so KA and VIRAMA count on their own as well).
TELUGU_DENSITY_CHARS = "ఖఘఛఝఠఢథధఫభశషక్ష"

# Quality gate (all inclusive, >=).
MIN_WORD_COUNT = 30
MIN_SCRIPT_RATIO = 0.6
MIN_UNIQUE_RATIO = 0.2
# Richness is 0 below this many tokens.
RICHNESS_MIN_TOKENS = 10
# Best HTML block must hold at least this many script characters.
MIN_SCRIPT_CHARS = 30
# Corpus n-gram report.
NGRAM_N = 2
NGRAM_TOP_K = 15
# Histogram bin counts for word count, script ratio, uniqueness ratio.
HIST_BINS_WORDS = 50
HIST_BINS_SCRIPT = 20
HIST_BINS_UNIQUE = 20
# KDE evaluation grid size.
KDE_GRID = 200
# Top-k most complex documents.
TOP_COMPLEX = 5
# Search candidates looked at: v1 asks for 3 results, v2 checks the first 7.
V1_SEARCH_RESULTS = 3
V2_MAX_RESULTS = 7
# Conditional fallback: fallback rows are added when primary has fewer rows.
FALLBACK_MIN_ROWS = 50

# Line stop-lists (plain, lower-case substrings).
STOP_WORDS_V1 = ["home", "movie", "review", "rating", "whatsapp", "share", "tweet", "pin it"]
STOP_WORDS_V2 = ["share", "comment", "whatsapp", "search", "home", "click here", "advertisement"]
# HTML tags removed with their content, and candidate block tags.
NOISE_TAGS_V1 = ["script", "style", "header", "footer", "nav", "aside", "iframe"]
BLOCK_TAGS_V1 = ["div", "article", "p"]
NOISE_TAGS_V2 = ["script", "style", "nav", "header", "footer", "form", "noscript"]
BLOCK_TAGS_V2 = ["div", "article", "p", "span"]

# Search query / payload templates.
SEARCH_DOMAIN = "lyricstape.com"
QUERY_TEMPLATE_V1 = "site:{domain} {song} {movie} lyrics"
QUERY_TEMPLATE_V2 = "{domain} {song} {movie} lyrics"
QUERY_TEMPLATE_AUDIO = "{song} {movie} telugu song high quality audio"
SEARCH_URL_V2 = "https://duckduckgo.com/?q={q}&t=h_&ia=web"
SEARCH_GL = "in"
SEARCH_HL = "en"

# Outcomes of a file upload.
OUTCOME_UPLOADED = "uploaded"
OUTCOME_MISSING = "missing"
OUTCOME_FAILED = "failed"
# Outcome reasons of the page-selection step.
REASON_NO_RESULTS = "No search results found"
REASON_NOT_IN_TOP = "Lyricstape not found in top {n} results"
REASON_NO_SCRIPT = "Page loaded, but no Telugu text found"
REASON_NOT_LOADED = "Error: page not loaded"

# Anchors of a rendered song row, and song links in markdown form (song, id, singers, album).
ANCHOR = 'href="{prefix}[^"]+">([^<]+)</a>'
MARKDOWN_SONG = r"\[([^\]]+)\]\(/song/([^)]+)\)[^\[]*\[([^\]]+)\][^\[]*\[([^\]]+)\]"

# Source lines of the two versions of lyrics files.
SOURCE_V1 = "lyricstape.com"
SOURCE_V2 = "Lyricstape (DDG-DeepScan)"

# Column names of the published clean table in the original pipeline
# (library name -> original name).
PUBLISHED_NAMES_TELUGU = {"script_ratio": "telugu_ratio", "final_text": "final_lyrics", "density": "sanskrit_score"}
# Constant columns of the training catalog.
TRAINING_FLAGS = {"Downloaded": "No", "Vocals_Extracted": "No", "DeReverbed": "No", "Notes": ""}
# --- end of fixed values ---


def _java_cp(cp: int) -> str:
    return f"\\x{{{cp:X}}}"


def _re2_cp(cp: int) -> str:
    return f"\\x{{{cp:X}}}"


def _class_body(ranges, spell) -> str:
    parts = []
    for lo, hi in ranges:
        parts.append(spell(lo) if lo == hi else f"{spell(lo)}-{spell(hi)}")
    return "".join(parts)


def _escape_chars(chars: str, spell) -> str:
    return "".join(spell(ord(c)) for c in sorted(set(chars)))


@dataclass(frozen=True)
class Pattern:
    """A regex in both dialects."""

    java: str
    re2: str


def char_class(ranges, extra: str = "", negate: bool = False) -> Pattern:
    """Character class from code-point ranges plus literal extra characters."""
    neg = "^" if negate else ""
    java = f"[{neg}{_class_body(ranges, _java_cp)}{_escape_chars(extra, _java_cp)}]"
    re2 = f"[{neg}{_class_body(ranges, _re2_cp)}{_escape_chars(extra, _re2_cp)}]"
    return Pattern(java, re2)


@lru_cache(maxsize=1)
def word_ranges() -> tuple[tuple[int, int], ...]:
    """Code-point ranges of the word characters of Python's regular expressions (``\\w``): letters and digits of any kind and '_'.

    They follow from the Unicode version of the Python that plans the query
    (``unicodedata.unidata_version``); the ranges travel in the pattern, so no
    other version (Java's, DuckDB's) takes part.
    """
    out, low = [], None
    for c in range(0x110001):
        word = c < 0x110000 and (chr(c).isalnum() or c == 0x5F)
        if word and low is None:
            low = c
        elif not word and low is not None:
            out.append((low, c - 1))
            low = None
    return tuple(out)


#: ranges tested one after the other
RANGE_GROUP = 4


def _java_halves(ranges) -> str:
    """Body of a Java class for sorted ranges: halved, each half behind one test of its span, down to a few ranges."""
    if len(ranges) <= RANGE_GROUP:
        return _class_body(ranges, _java_cp)
    halves = ranges[:len(ranges) // 2], ranges[len(ranges) // 2:]
    return "".join(f"[{_class_body([(h[0][0], h[-1][1])], _java_cp)}&&[{_java_halves(h)}]]" for h in halves)


@lru_cache(maxsize=8)
def word_class(extra: str = "", negate: bool = False) -> Pattern:
    """The exact word characters as a class.

    A Java class tests its ranges one after the other, so those from U+0100 on
    are found by halving.  Characters below it are spelled one by one, which
    Java looks up in a bitmap; as a class of their own they are tested first.
    """
    low = [(c, c) for lo, hi in word_ranges() for c in range(lo, min(hi, 0xFF) + 1)]
    high = [(max(lo, 0x100), hi) for lo, hi in word_ranges() if hi > 0xFF]
    java = f"[[{_class_body(low, _java_cp)}{_escape_chars(extra, _java_cp)}][\\x{{100}}-\\x{{10FFFF}}&&[{_java_halves(high)}]]]"
    return Pattern(f"[^{java}]" if negate else java, char_class(word_ranges(), extra, negate).re2)


WS = char_class(WHITESPACE_RANGES)
NOT_WS = char_class(WHITESPACE_RANGES, negate=True)
# One whitespace-separated token (Python str.split()).
TOKEN = Pattern(NOT_WS.java + "+", NOT_WS.re2 + "+")
LINE_BREAK = Pattern(
    "\\r\\n|" + char_class(LINE_BREAK_RANGES).java,
    "\\r\\n|" + char_class(LINE_BREAK_RANGES).re2,
)
# n-gram tokenizers: "compat" mirrors (?u)\b\w\w+\b; "unicode" keeps combining
# marks so Indic words are not shredded.
NGRAM_TOKEN = {
    "compat": Pattern("[\\p{L}\\p{N}_]{2,}", "[\\p{L}\\p{N}_]{2,}"),
    "unicode": Pattern("[\\p{L}\\p{M}\\p{N}_]{2,}", "[\\p{L}\\p{M}\\p{N}_]{2,}"),
}


def ngram_token(mode: str) -> Pattern:
    """The n-gram tokenizer of a mode; "exact" is "compat" with the exact word characters."""
    if mode == "exact":
        return Pattern(word_class().java + "{2,}", word_class().re2 + "{2,}")
    return NGRAM_TOKEN[mode]


def slug_drop(exact: bool = False) -> Pattern:
    """What a slug drops after spaces became underscores; ``exact`` by the exact word characters."""
    return word_class("-", negate=True) if exact else SLUG_DROP


# Slug: characters kept after spaces became underscores.
SLUG_DROP = Pattern("[^\\p{L}\\p{N}_\\-]", "[^\\p{L}\\p{N}_\\-]")


@dataclass(frozen=True)
class Script:
    """A writing system given as code-point ranges."""

    name: str
    ranges: tuple

    @property
    def any_char(self) -> Pattern:
        return char_class(self.ranges)

    @property
    def chars(self) -> str:
        """Every code point of the script as a string (surrogates excluded)."""
        return code_points(self.ranges)

    def keep_only(self, extra: str = KEPT_PUNCTUATION) -> Pattern:
        """Class of characters that are neither script, whitespace nor extra."""
        return char_class(list(self.ranges) + WHITESPACE_RANGES, extra=extra, negate=True)


def code_points(ranges) -> str:
    return "".join(chr(c) for lo, hi in ranges for c in range(lo, hi + 1) if not 0xD800 <= c <= 0xDFFF)


WS_CHARS = code_points(WHITESPACE_RANGES)

TELUGU = Script("telugu", tuple(TELUGU_RANGES))
LATIN = Script("latin", tuple(LATIN_RANGES))


def density_class(chars: str) -> Pattern:
    """Class matching any character of ``chars`` (a set, order irrelevant)."""
    return char_class([], extra=chars)

