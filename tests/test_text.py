import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from conftest import evaluate
from textsieve import patterns as P
from textsieve.functions import text as T

WS_CHARS = [chr(c) for lo, hi in P.WHITESPACE_RANGES for c in range(lo, hi + 1)]
SAMPLES = [
    "", " ", "a b", "  lead and trail  ", "a b c", "x\vy\x85z w", "line1\r\nline2\n",
    "అమ్మ నాన్న అమ్మ", "ప్రేమ నీ కోసం", "tab\tsep\x1cfs", "　ideo　",
]


def test_whitespace_class_is_python_isspace():
    assert sorted(WS_CHARS) == sorted(chr(c) for c in range(0x3001) if chr(c).isspace())


def test_tokens_match_str_split(spark):
    got = evaluate(spark, SAMPLES, T.tokens("t"))
    assert got == [s.split() for s in SAMPLES]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(WS_CHARS + list("abఅమ్.")), max_size=30), min_size=1, max_size=8))
def test_tokens_property(spark, texts):
    assert evaluate(spark, texts, T.tokens("t")) == [s.split() for s in texts]


def test_strip_and_lstrip(spark):
    assert evaluate(spark, SAMPLES, T.py_strip("t")) == [s.strip() for s in SAMPLES]
    assert evaluate(spark, SAMPLES, T.py_lstrip("t")) == [s.lstrip() for s in SAMPLES]


def test_script_ratio_and_uniqueness(spark):
    cases = [  # text, script ratio, distinct share of tokens
        ("", 0.0, 0.0), (" ", 0.0, 0.0), ("a b", 0.0, 1.0), ("a\tb\x85a\u3000a", 0.0, 0.5), ("అమ్మ నాన్న అమ్మ", 1.0, 2 / 3),
        ("అఆ ab", 0.5, 1.0), ("క x x x", 0.25, 0.5), ("ప్రేమ.", 5 / 6, 1.0),
    ]
    texts = [c[0] for c in cases]
    assert evaluate(spark, texts, T.script_ratio("t")) == [c[1] for c in cases]
    assert evaluate(spark, texts, T.script_ratio("t", P.TELUGU, T.tokens("t"))) == [c[1] for c in cases]
    assert evaluate(spark, texts, T.uniqueness_ratio(T.tokens("t"))) == [c[2] for c in cases]


def test_richness_cutoff_at_ten_tokens(spark):
    nine = " ".join(f"w{i}" for i in range(9))
    ten = " ".join(f"w{i}" for i in range(10))
    assert evaluate(spark, [nine, ten], T.richness(T.tokens("t"))) == [0.0, 1.0]


def test_mean_token_length_counts_code_points(spark):
    vals = ["అమ్మ ab", "", "abc"]
    assert evaluate(spark, vals, T.mean_token_length(T.tokens("t"))) == [3.0, 0.0, 3.0]


def test_density_counts_ka_and_virama():
    cls = P.density_class(P.TELUGU_DENSITY_CHARS).java
    assert len(set(P.TELUGU_DENSITY_CHARS)) == 14
    assert "\\x{C15}" in cls and "\\x{C4D}" in cls


def test_density_value(spark):
    txt = "క్ష ఖ అ"  # KA, VIRAMA, SSA, KHA count; A does not
    assert evaluate(spark, [txt], T.char_density("t")) == [4 / 5]


def test_strip_foreign_keeps_script_space_punct(spark):
    src = "Hello అమ్మ, 123 నాన్న!\nok?"
    exp = re.sub(r"[^ఀ-౿\s\.\,\?\!]", "", src)
    assert evaluate(spark, [src], T.strip_foreign("t")) == [exp]


def test_slug_drops_vowel_signs_and_punctuation(spark):
    vals = ["Tears, Blood And Breach (Telugu)", "ప్రేమ", "a-b_c d"]
    exp = [re.sub(r"[^\w\-_]", "", v.replace(" ", "_")) for v in vals]
    assert evaluate(spark, vals, T.slug("t")) == exp


def test_normalize_key_strips_before_underscores(spark):
    assert evaluate(spark, ["_Foo_", " A_b ", None], T.normalize_key("t")) == [" foo ", "a b", "nan"]


def test_ngram_tokenizer_modes(spark):
    vals = ["ప్రేమ నీ కోసం", "The cat, the HAT a"]
    compat = evaluate(spark, vals, T.ngram_tokens("t"))
    assert compat[1] == re.findall(r"(?u)\b\w\w+\b", vals[1].lower())
    assert compat[0] == re.findall(r"(?u)\b\w\w+\b", vals[0])  # vowel signs split words: no tokens
    uni = evaluate(spark, vals, T.ngram_tokens("t", "unicode"))
    assert uni[0] == ["ప్రేమ", "నీ", "కోసం"]


def test_ngrams(spark):
    out = evaluate(spark, ["a b c", "a", ""], T.ngrams(T.tokens("t"), 2))
    assert out == [["a b", "b c"], [], []]
    assert evaluate(spark, ["a b c d"], T.ngrams(T.tokens("t"), 3)) == [["a b c", "b c d"]]


def test_is_label_and_contains_any(spark):
    assert evaluate(spark, ["Singer: x", "a: b c d", "no colon"], T.is_label("t")) == [True, False, False]
    assert evaluate(spark, ["Homeland", "fine"], T.contains_any("t", ["home"])) == [True, False]


def test_exact_word_characters_over_all_code_points(spark):


    points = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    word = re.compile(r"\w")
    want = {c for c in points if word.match(chr(c))}
    blocks = [points[a:a + 4096] for a in range(0, len(points), 4096)]
    df = spark.createDataFrame([("".join(map(chr, b)),) for b in blocks], "t string")
    one = P.word_class()
    got = df.select(F.regexp_extract_all("t", F.lit(one.java), 0).alias("w"), F.regexp_replace("t", P.word_class(negate=True).java, "").alias("kept"),
                    T.slug("t", exact=True).alias("slug")).collect()
    assert {ord(c) for r in got for c in r["w"]} == want
    assert {ord(c) for r in got for c in r["kept"]} == want
    assert {ord(c) for r in got for c in r["slug"]} == want | {ord("-")}
    con = duckdb.connect()
    for b in blocks[::8]:
        found = con.execute(f"SELECT regexp_extract_all(?, '{one.re2}')", ["".join(map(chr, b))]).fetchone()[0]
        assert {ord(c) for c in found} == want & set(b)
    assert P.ngram_token("exact").java.endswith("{2,}") and P.slug_drop() is P.SLUG_DROP
