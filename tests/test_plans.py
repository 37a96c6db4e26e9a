"""Plan-shape guards for the performance properties the operators rely on."""

from textsieve.plans import registry as R

SF = "/root/testdata/sf0.001"


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_flagship_prunes_columns_and_tokenizes_once(spark):
    df = R.QUERIES["clean_corpus"](spark, SF)
    text = formatted(df)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    p = plan(df)
    # one split for the raw text, one for the cleaned text: the gate filter did
    # not copy the tokenizer below the metrics
    assert p.count("split(") == 2, p  # by single spaces, no regex
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_html_helper_once_per_page(spark):
    assert plan(R.QUERIES["best_block"](spark, SF)).count("ArrowEvalPython") == 1


def test_ngram_counts_pre_aggregate_before_shuffle(spark):
    p = plan(R.QUERIES["top_bigrams"](spark, SF))
    assert "partial_count" in p and "TakeOrderedAndProject" in p


def test_keep_first_neither_sorts_nor_shuffles_texts(spark):
    p = plan(R.QUERIES["dedupe_keep_first"](spark, SF))
    assert "partial_min" in p and "Window" not in p and "SortAggregate" not in p
    assert "text" not in "".join(x for x in p.splitlines() if "Exchange" in x)


def test_candidates_are_cut_before_the_shuffle(spark):
    df = R.QUERIES["first_candidate"](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    limits = [i for i, x in enumerate(lines) if "WindowGroupLimit" in x]
    shuffle = next(i for i, x in enumerate(lines) if "Exchange" in x and "hashpartitioning" in x)
    assert limits and max(limits) > shuffle  # one below the exchange, in the map tasks


def test_only_pages_that_can_win_are_parsed(spark):
    p = plan(R.QUERIES["page_lyrics"](spark, SF))
    helper, below = p.index("ArrowEvalPython"), p[p.index("ArrowEvalPython"):]
    assert "LeftSemi" in below and "WindowGroupLimit" in below and "Contains(url" in below, helper


def test_no_cross_joins_anywhere(spark):
    for name, fn in R.QUERIES.items():
        p = plan(fn(spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
