"""Tables by name: appends that leave the table where it is, and replacement that cannot lose it."""

import uuid

import pytest
from pyspark.sql import functions as F

from textsieve.sources import catalog_tables as CT


@pytest.fixture()
def db(spark, tmpdir_path):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmpdir_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(spark, name):
    return sorted(map(tuple, CT.read_named(spark, name).collect()), key=repr)


SCHEMA = "movie string, song string, text string"


def test_append_is_idempotent_and_null_keys_are_equal(spark, db):
    name = f"{db}.songs"
    CT.replace_table(spark.createDataFrame([("m", "a", "1"), (None, "n", "2")], SCHEMA), name, ["movie", "song"], 4)
    batch = spark.createDataFrame([("m", "a", "x"), (None, "n", "x"), ("m", "b", "z"), ("m", "b", "y"), ("m", "b", "y"), (None, None, "q")], SCHEMA)
    assert CT.append_new_to(batch.select("text", "song", "movie"), name, ["movie", "song"], "text") == 2
    assert CT.append_new_to(batch, name, ["movie", "song"], "text") == 0
    assert CT.append_new_to(batch.limit(0), name, ["movie", "song"]) == 0
    assert rows(spark, name) == sorted([("m", "a", "1"), (None, "n", "2"), ("m", "b", "y"), (None, None, "q")], key=repr)
    assert CT.read_named(spark, name, ["song"]).columns == ["song"]
    with pytest.raises(ValueError):
        spark.range(1).write.saveAsTable(f"{db}.plain")
        CT.append_new_to(spark.range(1), f"{db}.plain", ["id"])


def test_the_table_side_of_an_append_is_not_shuffled(spark, db):
    name = f"{db}.big"
    CT.replace_table(spark.range(2000).select(F.col("id").alias("k"), F.lit("x").alias("text")), name, ["k"], 8)
    CT.append_new_to(spark.range(1990, 2100).select(F.col("id").alias("k"), F.lit("y").alias("text")), name, ["k"])
    df = CT.new_rows(spark.range(2050, 2200).select(F.col("id").alias("k"), F.lit("z").alias("text")), name, ["k"])
    assert df.count() == 100
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("Initial Plan")].splitlines() if "Initial Plan" in plan else plan.splitlines()
    at = next(i for i, x in enumerate(final) if "Scan parquet" in x and ".big" in x)
    assert "Bucketed: true" in final[at]
    # up from the scan to the join there is a sort at most
    depth = lambda x: len(x) - len(x.lstrip(" :+-*"))
    above = [x for i, x in enumerate(final[:at]) if all(depth(y) > depth(x) for y in final[i + 1:at + 1])]
    upper = [x for x in above if "SortMergeJoin" in x]
    below_join = above[above.index(upper[-1]) + 1:]
    assert upper and not [x for x in below_join if "Exchange" in x]


def test_a_failed_replacement_leaves_the_old_table(spark, db):
    name = f"{db}.songs"
    CT.replace_table(spark.createDataFrame([("m", "a", "1")], SCHEMA), name, ["movie", "song"], 2)
    bad = spark.range(100).select(F.lit("m").alias("movie"), F.col("id").cast("string").alias("song"), F.when(F.col("id") == 99, F.raise_error(F.lit("boom")).cast("string")).alias("text"))
    with pytest.raises(Exception, match="boom"):
        CT.replace_table(bad, name, ["movie", "song"], 2)
    assert rows(spark, name) == [("m", "a", "1")]
    assert [t.name for t in spark.catalog.listTables(db)] == ["songs"]
    CT.replace_table(spark.createDataFrame([("m", "b", "2")], SCHEMA), name, ["movie", "song"], 3)
    assert rows(spark, name) == [("m", "b", "2")] and CT.buckets_of(spark, name) == 3
    assert [t.name for t in spark.catalog.listTables(db)] == ["songs"]
