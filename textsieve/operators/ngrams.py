"""Corpus-wide top-k word n-grams.

Counting all n-grams shuffles every distinct one, which on a large corpus is
most of it, and sorts and spills in each task.  ``heavy_ngrams`` does not: a
mergeable heavy-hitter summary of bounded size per task names candidates with
bounds, and its error bound proves that no other n-gram can be as frequent.
The candidates alone are counted: token array -> n-gram array -> explode ->
broadcast semi join -> partial hash aggregate -> final aggregate ->
TakeOrderedAndProject.  Where the summary proves nothing, all are counted.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsieve import patterns as P
from textsieve.functions import text as T
from textsieve.session import write_scratch

#: n-grams that a task's summary tracks, and its error: at most SUMMARY_ERROR / TRACKED of all n-grams
TRACKED, SUMMARY_ERROR = 100_000, 3.5
#: tasks that merge the tasks' summaries before one merges theirs
MERGERS = 32


def _words(df: DataFrame, text_col: str, tokenizer: str, *keep: Column) -> DataFrame:
    """The n-gram tokens of each row as a column of their own.

    A generator evaluates its input without looking for common parts, and
    ``ngrams`` names its tokens several times: the tokenizer would run for each.
    """
    return df.select(*keep, T.ngram_tokens(text_col, tokenizer).alias("words"))


def _gram_rows(words: DataFrame, n: int, *keep: Column) -> DataFrame:
    return words.select(*keep, F.explode(T.ngrams(F.col("words"), n)).alias("ngram"))


def ngram_counts(df: DataFrame, text_col: str, n: int = P.NGRAM_N, tokenizer: str = "compat") -> DataFrame:
    """(ngram, freq) over the whole corpus."""
    return _gram_rows(_words(df, text_col, tokenizer), n).groupBy("ngram").agg(F.count(F.lit(1)).alias("freq"))


def heavy_ngrams(df: DataFrame, text_col: str, n: int = P.NGRAM_N, top_k: int = P.NGRAM_TOP_K, tokenizer: str = "compat",
                 order_col: str | None = None, tracked: int = TRACKED) -> tuple[DataFrame, bool]:
    """(ngram, freq) of at least all n-grams as frequent as the ``top_k``-th, exact; and whether the summary proved it.

    With ``order_col`` also ``first``, the least value of it among the rows that hold the n-gram.

    Texts are tokenized once; the summary is taken when called, from the written
    tokens, and the counts are a query over them.  The summary tracks
    ``tracked`` n-grams with an error of at most e = 3.5 * N / tracked for N
    n-grams, merged in two levels.  It returns those whose frequency is surely above its error, each
    with an upper bound less than e too high, so the k-th frequency is at least
    the k-th bound less e, and an n-gram that it does not return has at most 2e.
    Where the former is above the latter, the n-grams whose bound reaches it are
    all that can be as frequent as the k-th.  The candidates, at most ``tracked``
    strings, pass the driver; their count shuffles one row per candidate and task.
    """
    keep, of = ([F.col("order")], [F.min("order").alias("first")]) if order_col else ([], [])
    words = write_scratch(_words(df, text_col, tokenizer, *([F.col(order_col).alias("order")] if order_col else [])), "words")
    grams = _gram_rows(words, n, *keep)
    count = [F.count(F.lit(1)).alias("freq"), *of]
    parts = grams.groupBy((F.spark_partition_id() % MERGERS).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(ngram, {tracked})").alias("state"), F.count(F.lit(1)).alias("n"))
    summary = parts.groupBy(F.lit(True)).agg(F.expr(f"approx_top_k_combine(state, {tracked})").alias("state"), F.sum("n").alias("n"))
    summary = summary.select(F.expr(f"approx_top_k_estimate(state, {tracked})").alias("top"), "n").first()  # no row without n-grams
    bounds = [(r["item"], r["count"]) for r in summary["top"]] if summary else []  # most frequent first
    error = SUMMARY_ERROR * summary["n"] / tracked if summary else 0
    least = bounds[top_k - 1][1] - error if len(bounds) >= top_k else 0
    if least <= 2 * error:
        return grams.groupBy("ngram").agg(*count), False
    names = df.sparkSession.createDataFrame(pa.table({"candidate": pa.array([g for g, b in bounds if b >= least], pa.string())}))
    found = grams.join(F.broadcast(names), F.col("ngram") == F.col("candidate"), "left_semi")
    return found.groupBy("ngram").agg(*count), True


def top_ngrams(df: DataFrame, text_col: str, n: int = P.NGRAM_N, top_k: int = P.NGRAM_TOP_K,
               tokenizer: str = "compat", tracked: int = TRACKED) -> DataFrame:
    """The ``top_k`` most frequent n-grams; ties broken by n-gram ascending.

    The shuffle does not grow with the number of distinct n-grams (see ``heavy_ngrams``, which runs when called)."""
    counts, _ = heavy_ngrams(df, text_col, n, top_k, tokenizer, tracked=tracked)
    return counts.orderBy(F.desc("freq"), F.asc("ngram")).limit(top_k)


def top_ngrams_bounded(df: DataFrame, text_col: str, n: int = P.NGRAM_N, top_k: int = P.NGRAM_TOP_K, tokenizer: str = "compat",
                       tracked: int = TRACKED) -> DataFrame:
    """``top_ngrams``, counted when called and kept, for a result that is read more than once."""
    return write_scratch(top_ngrams(df, text_col, n, top_k, tokenizer, tracked), "top-ngrams").orderBy(F.desc("freq"), F.asc("ngram"))


def top_by(df: DataFrame, order_col: str, cols, k: int, tie_col: str) -> DataFrame:
    """Top ``k`` rows by ``order_col`` descending (tie: ``tie_col`` ascending)."""
    return df.orderBy(F.desc(order_col), F.asc(tie_col)).select(*cols).limit(k)


def top_ngrams_first_seen(df: DataFrame, text_col: str, order_col: str, n: int = P.NGRAM_N,
                          top_k: int = P.NGRAM_TOP_K, tokenizer: str = "compat") -> DataFrame:
    """Top-k n-grams with ties ordered by first appearance: documents in
    ``order_col`` order, then position in the document (the vocabulary order
    of a count vectorizer fitted on the corpus in that order).

    Exact and bounded: (1) frequency and first document of the n-grams that can
    be among them (``heavy_ngrams``); (2) the k-th (frequency, first document) key
    (at most k rows reach the driver); (3) candidates ranked at or before that
    key - at most k plus the n-grams of one document; (4) first positions read
    only from the <= k+1 documents the candidates first appear in.
    """
    def grams_of(frame):
        return frame.select(
            F.col(order_col).alias("_d"),
            F.posexplode(T.ngrams(T.ngram_tokens(text_col, tokenizer), n)).alias("_p", "ngram"),
        )

    counts, _ = heavy_ngrams(df, text_col, n, top_k, tokenizer, order_col)
    counts = write_scratch(counts, "ngram-counts").withColumnRenamed("first", "_d0")
    head = counts.orderBy(F.desc("freq"), F.asc("_d0")).limit(top_k).collect()
    if not head:
        return counts.select("ngram", "freq").limit(0)
    f_k, d_k = head[-1]["freq"], head[-1]["_d0"]
    cands = counts.where((F.col("freq") > f_k) | ((F.col("freq") == f_k) & (F.col("_d0") <= d_k)))
    docs = [r["_d0"] for r in cands.select("_d0").distinct().collect()]  # <= k + 1 values
    first_pos = (
        grams_of(df.where(F.col(order_col).isin(docs)))
        .join(cands.select("ngram", "_d0"), "ngram")
        .where(F.col("_d") == F.col("_d0"))
        .groupBy("ngram")
        .agg(F.min("_p").alias("_p0"))
    )
    return (
        cands.join(first_pos, "ngram")
        .orderBy(F.desc("freq"), F.asc("_d0"), F.asc("_p0"))
        .select("ngram", "freq")
        .limit(top_k)
    )
