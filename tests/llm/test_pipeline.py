"""The registered queries of this subpackage, and the pipeline against a brute-force version of its stages."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from test_dedup import roots, slow_fingerprint, slow_repeats
from textsieve.llm import mixing, toxicity
from textsieve.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_the_operators_and_the_pipeline_are_registered():
    names = E.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert [s for s, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_duplicates", "suffix_array_dedup", "mixing", "bpe_tokens"]


@pytest.mark.parametrize("name", ["op2_suffixes", "op3_simhash"])
def test_whole_table_queries_against_brute_force(spark, name):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES[name](spark, SF).collect()
    if name == "op2_suffixes":
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
        assert got == dict(zip((i for i, _ in docs), slow_repeats([t for _, t in docs])))
    else:
        fps = {i: slow_fingerprint(t) for i, t in docs}
        near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
        low = roots(fps, near)
        assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{x:016x}", low[i]) for i, x in fps.items()}


def windows(text):
    raw = text.encode()
    return [raw[i:i + 200] for i in range(len(raw) - 199)]


def test_pipeline_against_brute_force(spark):
    read = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit_documents(read, spark.read.parquet(f"{SF}/labels.parquet"))
    docs = [r.asDict() for r in read.orderBy("doc_id").collect()]
    docs = [d for d in docs if model.probability(model.evidence(toxicity.words_of(d["text"]))) < corpus_pipeline.TOXIC]
    fps = {d["doc_id"]: slow_fingerprint(d["text"]) for d in docs}
    low = roots(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3])
    docs = [d for d in docs if low[d["doc_id"]] == d["doc_id"]]
    seen = Counter(w for d in docs for w in windows(d["text"]))
    for d in docs:
        raw = d["text"].encode()
        gone = {k for i, w in enumerate(windows(d["text"])) if seen[w] > 1 for k in range(i, i + 200)}
        if gone:
            d["text"] = bytes(c for i, c in enumerate(raw) if i not in gone).decode("utf-8", "ignore")
    frame = spark.createDataFrame([(d["doc_id"], d["text"], d["source"], d["lang"]) for d in docs], "doc_id long, text string, source string, lang string")
    kept = {r["id"] for r in mixing.mix(frame).collect() if r["kept"]}
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {d["doc_id"]: hashlib.sha256(np.array(lib.encode(d["text"], add_special_tokens=False).ids, "<u4").tobytes()).hexdigest() for d in docs if d["doc_id"] in kept}
    got = {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == expected


def test_stages_keep_columns_and_handle_odd_rows(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "x", "en", "src0", 1), (0, None, None, "src1", 0), (7777, "", "en", None, 0)], base.schema)
    rows = base.limit(40).unionByName(odd).unionByName(base.limit(2))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, SF)
        assert out.columns == base.columns, name
        assert stage(spark, rows.limit(0), SF).count() == 0, name
        n = out.count()
        assert 0 < n <= rows.count(), name
        if name in ("simhash_near_duplicates", "suffix_array_dedup"):
            assert out.filter(F.col("doc_id").isNull()).count() == 2
    assert corpus_pipeline.STAGES[-1][1](spark, rows, SF).count() == rows.count()


def test_other_texts_of_a_repeated_id_stay(spark):
    rng = random.Random(3)
    a, b, c = (" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(60)) for _ in range(3))
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (1, a, "en", "s", 1), (2, a, "en", "s", 1), (3, b, "en", "s", 1), (4, c, "en", "s", 1), (None, c, "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    out = corpus_pipeline.keep_one_of_each_group(spark, spark.createDataFrame(rows, schema), SF).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in out) == sorted([("1", a), ("1", b), ("4", c), ("None", c)])


def test_stages_keep_any_other_columns(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    names = ["_digest", "_nth", "my col", "a.b", "row", "kept", "n_removed", "id", "digest", "score", "topic", "probability", "tick`ed"]
    rows = base.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in names],
                       F.create_map(F.lit("k"), F.col("doc_id")).alias("a map"), F.struct(F.col("lang").alias("x y"), F.col("doc_id").alias("z.w")).alias("st.ruct"))
    rows = rows.unionByName(rows.limit(1)).unionByName(rows.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(9999).cast("long")))
    want = {r["doc_id"]: r for r in rows.filter("text is not null").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, SF)
        assert out.columns == rows.columns and [f.dataType for f in out.schema] == [f.dataType for f in rows.schema], name
        got = out.collect()
        assert got, name
        for r in got:
            if r["text"] is not None:
                assert [r[c] for c in rows.columns if c not in ("text", "n_chars")] == [want[r["doc_id"]][c] for c in rows.columns if c not in ("text", "n_chars")], name
        if name == "simhash_near_duplicates":
            assert sum(r["doc_id"] == 9999 for r in got) == 1
    assert corpus_pipeline.STAGES[-1][1](spark, rows, SF).count() == rows.count()
