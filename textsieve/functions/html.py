"""HTML -> candidate text blocks (the only Python on the page path).

The helper walks the tag stream with the standard-library ``HTMLParser`` and
returns, per page, the text of every *outermost* candidate block (e.g. ``div``,
``article``, ``p``) with noise subtrees (``script``, ``nav``, ...) removed and
text nodes joined by '\\n'.  Only outermost blocks are needed: a block's text
contains its descendants' text, so an ancestor scores at least as high as any
descendant and precedes it in document order, hence wins every tie.

Tree rules follow a lenient parser: unclosed tags nest (an unclosed ``<p>``
contains the next one), an end tag closes the most recent open tag of that
name and everything opened after it, and an end tag with no open match is
ignored.  Scoring, argmax, thresholds and cleaning are Spark expressions (see
``operators.blocks``).
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsieve import patterns as P
from textsieve.functions.text import py_strip

# Elements that never have content (closed as soon as they open).
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr basefont bgsound command "
    "frame image isindex keygen menuitem nextid spacer".split()
)


# Elements whose text is not part of an enclosing element's text.
SILENT_TAGS = frozenset(["script", "style", "template", "rt", "rp"])


class _BlockParser(HTMLParser):
    def __init__(self, noise, blocks):
        super().__init__(convert_charrefs=True)
        self.noise_tags = noise
        self.block_tags = blocks
        self.stack: list[tuple[str, str]] = []  # (tag, role) role in {"noise", "block", ""}
        self.noise_depth = 0
        self.in_block = False
        self.out: list[list[str]] = []
        self.data: list[str] = []

    def flush(self):
        """A text node ends at a tag, a comment or a declaration; the tokenizer may deliver it in pieces."""
        if self.data:
            if self.in_block and self.noise_depth == 0:
                self.out[-1].append("".join(self.data))
            self.data = []

    def handle_starttag(self, tag, attrs):
        self.flush()
        if tag in VOID_TAGS:
            return
        role = ""
        if tag in self.noise_tags:
            role = "noise"
            self.noise_depth += 1
        elif tag in self.block_tags and not self.in_block and self.noise_depth == 0:
            role = "block"
            self.in_block = True
            self.out.append([])
        self.stack.append((tag, role))

    def handle_startendtag(self, tag, attrs):
        self.flush()

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def close(self):
        super().close()
        self.flush()

    def handle_endtag(self, tag):
        self.flush()
        for pos in range(len(self.stack) - 1, -1, -1):
            if self.stack[pos][0] == tag:
                for _, role in self.stack[pos:]:
                    if role == "noise":
                        self.noise_depth -= 1
                    elif role == "block":
                        self.in_block = False
                del self.stack[pos:]
                return

    def handle_data(self, data):
        self.data.append(data)


def outermost_blocks(html: str | None, noise_tags, block_tags) -> list[str] | None:
    """Texts of the outermost candidate blocks of ``html`` in document order."""
    if html is None:
        return None
    p = _BlockParser(frozenset(noise_tags) | SILENT_TAGS, frozenset(block_tags))
    p.feed(html)
    p.close()
    return ["\n".join(parts) for parts in p.out]


def html_blocks(col, noise_tags, block_tags) -> Column:
    """array<string> column of outermost block texts (Arrow-batched UDF)."""
    noise, blocks = tuple(noise_tags), tuple(block_tags)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _blocks(s: pd.Series) -> pd.Series:
        return s.map(lambda h: outermost_blocks(h, noise, blocks))

    return _blocks(F.col(col) if isinstance(col, str) else col)


def anchor_text(col, path_prefix: str) -> Column:
    """Text of the first ``<a href="<prefix>...">text</a>``, stripped; '' if none."""
    pat = P.ANCHOR.replace("{prefix}", _quote(path_prefix))
    return py_strip(F.regexp_extract(F.col(col) if isinstance(col, str) else col, pat, 1))


def anchor_texts(col, path_prefix: str, sep: str = ", ") -> Column:
    """All such anchor texts (unstripped) joined by ``sep``; '' if none."""
    pat = P.ANCHOR.replace("{prefix}", _quote(path_prefix))
    return F.array_join(F.regexp_extract_all(F.col(col) if isinstance(col, str) else col, F.lit(pat), 1), sep)


def _quote(s: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in s)
