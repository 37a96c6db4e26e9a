from pyspark.sql import functions as F

from textsieve import patterns as P
from textsieve.functions.html import anchor_text, anchor_texts, outermost_blocks
from textsieve.operators import blocks as B

V1 = (P.NOISE_TAGS_V1, P.BLOCK_TAGS_V1)
TE = "అమ్మ నాన్న ప్రేమ "  # 14 script code points


def test_outermost_blocks_noise_removed_and_nesting():
    html = ("<html><head><script>var t='</p>';</script></head><body><nav><div>menu</div></nav>"
            "<div>A<p>B<b>C</b></p><script>x</script></div><article><p>one<p>two</article>tail<p>last")
    assert outermost_blocks(html, *V1) == ["A\nB\nC", "one\ntwo", "last"]


def test_unmatched_end_tag_ignored_and_void_tags():
    html = "<div>a</span>b<br>c<img src=x>d</div>"
    assert outermost_blocks(html, *V1) == ["a\nb\nc\nd"]


def test_entities_and_comments():
    assert outermost_blocks("<p>a &amp; b<!-- c --></p>", *V1) == ["a & b"]


def test_best_block_ties_first_and_threshold(spark):
    pages = [
        (1, f"<div>{TE * 2}</div><div>{TE * 2}</div>"),       # tie: first wins, 28 chars < 30
        (2, f"<p>{TE * 3}</p><p>{TE}</p>"),                  # 42 chars, found
        (3, "<div>plain latin only</div>"),                    # zero never wins
        (4, f"<div>Home {TE * 3}\n{TE * 3}\nshare</div>"),     # stop-listed lines removed
    ]
    df = spark.createDataFrame(pages, "page_id long, html string")
    out = {r["page_id"]: (r["score"], r["main_text"])
           for r in B.extract_main_text(df, "html", "v1").collect()}
    assert out[1] == (28, None)
    assert out[2] == (42, (TE * 3).strip())
    assert out[3] == (0, None)
    assert out[4][1] == (TE * 3).strip()


def test_best_block_struct_strict_greater(spark):
    df = spark.createDataFrame([(["x", "అ", "అ", "అఅ", "అఅ"],)], "b array<string>")
    r = df.select(B.best_block(F.col("b"))).first()[0]
    assert (r["score"], r["text"]) == (2, "అఅ")


def test_anchor_extraction(spark):
    html = ('<a href="/song/x">  Song A </a><a href="/album/y">Album</a>'
            '<a href="/artist/1">S1</a><a href="/artist/2">S2</a>')
    df = spark.createDataFrame([(html,), ("<p>none</p>",)], "h string")
    rows = df.select(anchor_text("h", "/song/"), anchor_text("h", "/album/"), anchor_texts("h", "/artist/")).collect()
    assert tuple(rows[0]) == ("Song A", "Album", "S1, S2")
    assert tuple(rows[1]) == ("", "", "")


def test_v2_blocks_and_cleaner(spark):
    te = TE * 3
    html = (f"<form><div>{te}{te}</div></form><header>{te}</header>"
            f"<span>{te}\nSearch here\nకల</span><div>{TE}</div>")
    assert outermost_blocks(html, P.NOISE_TAGS_V2, P.BLOCK_TAGS_V2) == [f"{te}\nSearch here\nకల", TE]
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    r = B.extract_main_text(df, "html", "v2").first()
    # v2 keeps lines without script (no script filter) but drops stop-listed ones
    assert r["score"] == 44 and r["main_text"] == f"{te.strip()}\nకల"
