"""Templates inside articles, counted over different articles of a host."""

from __future__ import annotations

from adpulse.llm import pages


def test_lines_that_recur_in_different_articles_go(spark):
    page = "<main><article><h1>Title {0}</h1><p>Own text {0}</p>{1}<ul><li>Item {0}</li><li>Subscribe now</li></ul></article></main>"
    notice = "<p>All rights reserved</p><h2>Advert</h2>"
    rows = [(i, "http://a.org/x", page.format(i, notice)) for i in range(12)]
    # copies of one article have one vote, also if what surrounds them or is dropped inside differs
    rows += [(100 + i, "http://b.org/x", f"<main><p>Day {i}</p><article><p>Same article</p><div class=ad>Ad {i}</div></article></main>") for i in range(12)]
    # too few articles
    rows += [(200 + i, "http://c.org/x", page.format(i, notice)) for i in range(4)]
    # cells and parts of lines are no templates
    rows += [(300 + i, "http://d.org/x", f"<article><table><tr><td>Name {i}</td><td>Yes</td></tr></table><p>On {i} <b>Note</b></p></article>") for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    few = pages.MARKED
    pages.MARKED = 0  # too many pages hold templates for their numbers to be broadcast
    try:
        shuffled = {r.page_id: r.text for r in pages.main_text(df).collect()}
    finally:
        pages.MARKED = few
    assert shuffled == {r.page_id: r.text for r in pages.main_text(df).collect()}
    got = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert all(got[i] == f"Title {i}\nOwn text {i}\nItem {i}" for i in range(12))
    assert all(got[100 + i] == f"Day {i}\nSame article" for i in range(12))
    assert all(got[200 + i] == f"Title {i}\nOwn text {i}\nAll rights reserved\nAdvert\nItem {i}\nSubscribe now" for i in range(4))
    assert all(got[300 + i] == f"Name {i}\nYes\nOn {i} Note" for i in range(12))
