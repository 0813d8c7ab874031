"""What counts as a template of a host, and what never does."""

import pytest

from tintero.llm import html


def texts(spark, rows, **how):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in html.extract_text(frame, **how).collect()}


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_articles_keep_what_recurs_in_them(spark, limit):
    table = "<table><tr><th>Sold<td>Yes</table><ul><li>Contents</ul><div><blockquote>A passage that many quote</blockquote></div>"
    rows = [(i, "http://a.example/p", f"<div><article><p>Story {i} is longer than what it quotes</p>{table}</article></div><div>Imprint of the site</div>") for i in range(30)]
    got = texts(spark, rows, limit=limit)
    assert all(got[i] == f"Story {i} is longer than what it quotes\nSold\nYes\nContents\nA passage that many quote" for i in range(30))


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_templates_are_in_a_share_of_the_pages(spark, limit):
    quoted = "<p>A sentence that some pages quote</p>"
    rows = [(i, "http://b.example/p", f"<div>Menu of the site</div><p>Page {i} has words of its own here</p>{quoted if i < 12 else ''}") for i in range(150)]
    got = texts(spark, rows, limit=limit)
    assert got[0] == "Page 0 has words of its own here\nA sentence that some pages quote"
    assert all(got[i] == f"Page {i} has words of its own here" for i in range(12, 150))


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_templates_longer_than_the_texts(spark, limit):
    legal = "<div>" + "This long legal notice is longer than anything else on the page. " * 5 + "</div>"
    rows = [(i, "http://c.example/p", f"<div>Home News Contact</div><p>Note {i}</p>{legal}") for i in range(30)]
    rows += [(100 + i, "http://d.example/p", f"<div>Home</div><div>One text, copied often</div>{legal}") for i in range(30)]
    got = texts(spark, rows, limit=limit)
    assert all(got[i] == f"Note {i}" for i in range(30))
    assert all("One text, copied often" in got[100 + i] for i in range(30))
