"""Main-text extraction from HTML pages and per-song outcomes.

Per page: the UDF returns the outermost candidate blocks; Catalyst scores
each block by script characters, keeps the first block with the strictly
highest positive score (``aggregate`` fold, so ties keep the earlier block and
a zero score never wins), applies the minimum-score threshold and the line
cleaner.  All of it is per row: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsieve import patterns as P
from textsieve.functions import html as H
from textsieve.functions import structure as ST
from textsieve.functions import text as T

VERSIONS = {
    "v1": (P.NOISE_TAGS_V1, P.BLOCK_TAGS_V1),
    "v2": (P.NOISE_TAGS_V2, P.BLOCK_TAGS_V2),
}


def best_block(blocks: Column, script: P.Script = P.TELUGU) -> Column:
    """struct<score, text> of the first block with the highest positive score."""
    scored = F.transform(blocks, lambda b: F.struct(T.count_script(b, script).alias("score"), b.alias("text")))
    init = F.struct(F.lit(0).alias("score"), F.lit(None).cast("string").alias("text"))
    return F.aggregate(scored, init, lambda acc, x: F.when(x["score"] > acc["score"], x).otherwise(acc))


def extract_main_text(df: DataFrame, html_col: str = "html", version: str = "v1", script: P.Script = P.TELUGU,
                      min_chars: int = P.MIN_SCRIPT_CHARS) -> DataFrame:
    """Adds ``score`` and ``main_text`` (cleaned best block, NULL when the best
    block has fewer than ``min_chars`` script characters)."""
    noise, tags = VERSIONS[version]
    cleaner = (lambda c: ST.clean_lines_v1(c, script)) if version == "v1" else ST.clean_lines_v2
    best = F.col("_best")
    with_best = df.withColumn("_best", best_block(H.html_blocks(html_col, noise, tags), script))
    # Emitted through a generator so a filter on main_text cannot copy the
    # UDF call below this point (the HTML helper runs once per page).
    return T.with_columns_once(with_best, {
        "score": best["score"],
        "main_text": F.when(best["score"] >= min_chars, cleaner(best["text"])),
    }).drop("_best")


def found(col="main_text") -> Column:
    """Extraction succeeded: non-empty cleaned text."""
    return T.non_empty(col)
