"""Operators on data where one key holds a third of all rows."""

from pyspark.sql import functions as F

from textsieve.operators import candidates as C
from textsieve.operators import ngrams as NG
from textsieve.operators import sets as S

N = 30000


def skewed(spark):
    # a third of the rows share group 0 / name "hot"; the rest are spread
    return spark.range(N).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("grp"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("n"), (F.col("id") % 997).cast("string")))
        .alias("name"),
    )


def test_keep_first_hot_key(spark):
    out = {r["name"].lower(): r["seq"] for r in S.keep_first(skewed(spark), "name", "seq").collect()}
    assert out["hot"] == 0 and len(out) == 998
    assert out["n5"] == min(i for i in range(N) if i % 3 and i % 997 == 5)


def test_first_within_top_hot_group(spark):
    cands = skewed(spark).withColumn("url", F.when(F.col("seq") == 27, F.lit("x.lyr")).otherwise(F.lit("y.com")))
    q = F.col("url") == "x.lyr"
    # seq 27 is the 10th member of group 0 (0, 3, ..., 27): inside top 10, outside top 9
    assert [r["seq"] for r in C.first_within_top(cands, "grp", "seq", q, 10).collect()] == [27]
    assert C.first_within_top(cands, "grp", "seq", q, 9).count() == 0


def split_plan(spark, build):
    """The executed plan with broadcasts off and low skew thresholds."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = build()
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_left_key_is_split(spark, tmpdir_path):
    skewed(spark).repartition(12).write.parquet(tmpdir_path + "/left")
    spark.range(500).selectExpr("concat('N', id) AS song_name", "concat('n', id) AS value").write.parquet(tmpdir_path + "/right")

    def left():
        return spark.read.parquet(tmpdir_path + "/left")

    def right():
        return spark.read.parquet(tmpdir_path + "/right")

    joins = {
        "pending": lambda: S.pending(left(), right(), "name", "song_name"),
        "anti_lower": lambda: S.anti_lower(left(), "name", right()),
        "fallback_rows": lambda: S.fallback_rows(right().withColumnRenamed("song_name", "name"), left(), "name", "seq"),
    }
    for name, build in joins.items():
        assert "skew=true" in split_plan(spark, build), name


def test_pending_and_ngrams_hot_key(spark):
    df = skewed(spark)
    done = spark.createDataFrame([("hot",), ("N7",)], "song_name string")
    left = S.pending(df, done, "name", "song_name")
    assert left.count() == N - N // 3 - sum(1 for i in range(N) if i % 3 and i % 997 == 7)
    text = df.select(F.when(F.col("grp") == 0, F.lit("aa bb")).otherwise(F.lit("cc dd")).alias("t"))
    top = [(r["ngram"], r["freq"]) for r in NG.top_ngrams(text, "t", 2, 2).collect()]
    assert top == [("cc dd", N - N // 3), ("aa bb", N // 3)]
