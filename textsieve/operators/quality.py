"""Quality metrics, the quality gate and lexical features (the cleaning pass).

All per-row work is built-in expressions; nothing here shuffles.  The token
array is projected once and reused by every metric.

The metrics are emitted through a one-row ``inline`` generator.  Without it
Catalyst pushes the gate filter below the metric projection and inlines the
metric expressions into the filter, tokenizing every text twice; a filter on
generator output cannot be pushed below the generator, so each text is
tokenized once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsieve import patterns as P
from textsieve.functions import text as T

METRIC_COLUMNS = ["word_count", "script_ratio", "uniqueness_ratio"]
FEATURE_COLUMNS = ["final_text", "richness", "complexity", "density"]


def metric_text(col, null_text: str | None = "None") -> Column:
    """The text the metrics read.  ``null_text`` reproduces a string-cast
    null (a 1-word row); None keeps NULL."""
    c = T._c(col)
    return F.coalesce(c, F.lit(null_text)) if null_text is not None else c


def with_quality_metrics(df: DataFrame, text_col: str = "text", script: P.Script = P.TELUGU,
                         null_text: str | None = "None") -> DataFrame:
    """Adds word_count, script_ratio, uniqueness_ratio."""
    txt = metric_text(text_col, null_text)
    tok = F.col("_tok")
    metrics = {
        "word_count": T.word_count(tok),
        "script_ratio": T.script_ratio(txt, script, tok),
        "uniqueness_ratio": T.uniqueness_ratio(tok),
    }
    return T.with_columns_once(df.withColumn("_tok", T.tokens(txt)), metrics).drop("_tok")


def gate_condition(min_words: int = P.MIN_WORD_COUNT, min_script: float = P.MIN_SCRIPT_RATIO,
                   min_unique: float = P.MIN_UNIQUE_RATIO) -> Column:
    return (
        (F.col("word_count") >= min_words)
        & (F.col("script_ratio") >= min_script)
        & (F.col("uniqueness_ratio") >= min_unique)
    )


def quality_gate(df: DataFrame, min_words: int = P.MIN_WORD_COUNT, min_script: float = P.MIN_SCRIPT_RATIO,
                 min_unique: float = P.MIN_UNIQUE_RATIO) -> DataFrame:
    """Keep rows passing all three thresholds (inclusive).  Needs the metrics."""
    return df.filter(gate_condition(min_words, min_script, min_unique))


def with_lexical_features(df: DataFrame, text_col: str = "text", script: P.Script = P.TELUGU,
                          density_chars: str = P.TELUGU_DENSITY_CHARS, null_text: str | None = "None",
                          min_tokens: int = P.RICHNESS_MIN_TOKENS) -> DataFrame:
    """Adds final_text (script-only text), richness, complexity, density."""
    final = T.strip_foreign(metric_text(text_col, null_text), script)
    tok, chars = F.col("_tok2"), F.col("_chars2")
    return (
        df.withColumn("final_text", final)
        .withColumn("_tok2", T.tokens(F.col("final_text")))
        .withColumn("_chars2", T.token_chars(tok))
        .withColumns({
            "richness": T.richness(tok, min_tokens),
            "complexity": T.mean_token_length(tok, chars),
            "density": T.char_density(F.col("final_text"), density_chars, chars),
        })
        .drop("_tok2", "_chars2")
    )


def clean_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", script: P.Script = P.TELUGU,
                 density_chars: str = P.TELUGU_DENSITY_CHARS, min_words: int = P.MIN_WORD_COUNT,
                 min_script: float = P.MIN_SCRIPT_RATIO, min_unique: float = P.MIN_UNIQUE_RATIO) -> DataFrame:
    """Scan -> metrics -> gate -> strip foreign script -> features -> publishable columns."""
    scored = with_quality_metrics(df.select(id_col, text_col), text_col, script)
    kept = quality_gate(scored, min_words, min_script, min_unique)
    feats = with_lexical_features(kept, text_col, script, density_chars)
    return feats.select(id_col, *METRIC_COLUMNS, *FEATURE_COLUMNS)


def gate_reconciliation(scored: DataFrame, min_words: int = P.MIN_WORD_COUNT, min_script: float = P.MIN_SCRIPT_RATIO,
                        min_unique: float = P.MIN_UNIQUE_RATIO) -> DataFrame:
    """One pass: rows before, rows kept, rows dropped."""
    return scored.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(gate_condition(min_words, min_script, min_unique)).alias("rows_after"),
    ).withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))
