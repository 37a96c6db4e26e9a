"""The document pipeline: toxicity, SimHash near-duplicates, repeated passages, mixing, tokens.

Each stage works on all that its predecessor kept.  All but the last return
the columns of ``documents``; each stage's result is written as Parquet and
read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textsieve.llm import bpe, mixing, simhash, suffixes, toxicity
from textsieve.llm.shared import Scratch, column, table, whole_row

#: score from which on a document is rejected as toxic
TOXIC = 0.7


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold; labels are learned as in the operator's query.

    Null and empty texts hold no passage and stay (unless most labelled texts
    are toxic), repeated rows get one score, so all or none stay; a null id is
    never labelled; an empty table stays empty; other columns pass unseen.
    """
    model = toxicity.fit_documents(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, carry=True).filter(F.col("score") < TOXIC).select("row.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest id (of several texts with it the least by hash), once.

    Null and empty texts are one group with the texts without words; documents
    without an id stay; of rows that repeat an id and its text one stays, the
    least by a hash of the other columns; an empty table stays empty; other
    columns pass unseen.
    """
    groups = simhash.simhash_groups(docs, traced=True).filter("id = component")
    first = groups.groupBy("root").agg(F.min("id").alias("first"), F.min("digest").alias("least")).drop("root")
    rows = docs.select(column("doc_id").cast("long").alias("id"), simhash.text_digest("text").alias("digest"), whole_row(docs).alias("row"))
    kept = rows.join(first, (F.col("id") == F.col("first")) & (F.col("digest") == F.col("least")), "left_semi")
    # rows that repeat an id and its text are one document (the join has dealt the rows by both already)
    same = Window.partitionBy("id", "digest").orderBy(F.xxhash64(F.to_json("row")))
    kept = kept.withColumn("nth", F.row_number().over(same)).filter("nth = 1")
    return kept.select("row.*").unionByName(docs.filter(column("doc_id").isNull()))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages that also occur elsewhere; n_chars follows the text.

    Null and empty texts stay as they are; repeated rows are copies of each
    other and lose what they share; null ids are ids like any other; an empty
    table stays empty; other columns pass unseen.
    """
    out = suffixes.remove_repeats(docs, carry=True)
    changed = F.col("n_removed") > 0
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    own = {c: F.col("row").getField(c) for c in docs.columns}
    return out.select(*[(F.when(changed, new[c].cast(docs.schema[c].dataType)).otherwise(x) if c in new else x).alias(c) for c, x in own.items()])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample of documents that meets the target marginals of source, language and topic.

    Null categories are a category; texts without words, null ones too, stay
    where their cell keeps all; repeated rows share one draw; documents without
    an id draw by their text; an empty table stays empty; other columns pass unseen.
    """
    return mixing.mix(docs, carry=True).filter("kept").select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of the text that they decode to.

    Null and empty texts have no ids; repeated rows and null ids stay; an empty
    table gives no rows; other columns are left behind.
    """
    return bpe.encode(docs, ids=True, digests=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", keep_clean),
    ("simhash_near_duplicates", keep_one_of_each_group),
    ("suffix_array_dedup", cut_repeated_passages),
    ("mixing", mix_sources),
    ("bpe_tokens", tokenize),
]

#: scores, fingerprints, suffix matches, raking and merges are beyond SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is a written table."""
    docs, scratch, last = table(spark, sf_dir, "documents"), Scratch(spark), None
    for name, stage in STAGES[:-1]:
        docs = scratch.put(name, stage(spark, docs, sf_dir))
        if last:
            scratch.drop(last)
        last = name
    return STAGES[-1][1](spark, docs, sf_dir)
