"""Main blocks of hand-written pages, with the expected text."""

from textsieve import patterns as P
from textsieve.functions.html import outermost_blocks
from textsieve.operators import blocks as B

TE = "అమ్మ నాన్న ప్రేమ"  # 14 script code points
V1, V2 = (P.NOISE_TAGS_V1, P.BLOCK_TAGS_V1), (P.NOISE_TAGS_V2, P.BLOCK_TAGS_V2)


def test_a_stray_less_than_does_not_break_a_line():
    assert outermost_blocks("<div>aaa 5 < 6 bbb</div>", *V1) == ["aaa 5 < 6 bbb"]
    assert outermost_blocks("<p>a &lt; b &amp; c &#8364; d</p>", *V1) == ["a < b & c € d"]


def test_comments_and_tags_end_a_text_node():
    assert outermost_blocks("<div>a<!-- x -->b<br>c<i></i>d</div>", *V1) == ["a\nb\nc\nd"]


def test_text_of_templates_and_ruby_notes_is_left_out():
    html = "<div>a<template>t<b>u</b></template><ruby>k<rp>(</rp><rt>r</rt><rp>)</rp></ruby>z</div>"
    assert outermost_blocks(html, *V1) == ["a\nk\nz"]


PAGES = [
    # the article beats the shorter advertisement; a stop-listed line and a line without script go
    (1, f"<div>{TE}</div><article><h1>Song</h1><p>{TE}<br>{TE}</p><p>Share {TE}</p></article>", 42, f"{TE}\n{TE}", f"Song\n{TE}\n{TE}"),
    # nothing reaches the minimum
    (2, f"<div>{TE}</div><p>{TE}</p>", 14, None, None),
    # navigation is noise, unclosed paragraphs nest
    (3, f"<nav><p>{TE}{TE}{TE}{TE}</p></nav><div><p>{TE}<p>{TE}<p>{TE}</div>", 42, f"{TE}\n{TE}\n{TE}", f"{TE}\n{TE}\n{TE}"),
    # equal scores: the first block
    (4, f"<div>x {TE} {TE} {TE}</div><div>y {TE} {TE} {TE}</div>", 42, f"x {TE} {TE} {TE}", f"x {TE} {TE} {TE}"),
    # broken end tags close what they match and nothing else
    (5, f"<div></b>{TE}</i>{TE}</span>{TE}</div></div>tail", 42, f"{TE}\n{TE}\n{TE}", f"{TE}\n{TE}\n{TE}"),
    # spans count in the second version only
    (6, f"<span>{TE} {TE} {TE}</span>", None, None, f"{TE} {TE} {TE}"),
    (7, "", None, None, None),
    (8, None, None, None, None),
]


def test_main_text_of_both_versions(spark):
    df = spark.createDataFrame([(p[0], p[1]) for p in PAGES], "page_id long, html string")
    v1 = {r["page_id"]: (r["score"], r["main_text"]) for r in B.extract_main_text(df, "html", "v1").collect()}
    v2 = {r["page_id"]: r["main_text"] for r in B.extract_main_text(df, "html", "v2").collect()}
    for page, _, score, first, second in PAGES:
        assert v1[page][1] == first and v2[page] == second, page
        assert score is None or v1[page][0] == score, page
