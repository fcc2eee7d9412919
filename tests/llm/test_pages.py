from __future__ import annotations

from windrow.llm import pages, queries


def test_article_without_the_rest():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
      <header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies</div>
      <div class=ad>Buy</div><article><header><h1>Big &amp; small</h1></header><p>One<br>two <b>th</b>ree&nbsp;x</p>
      <aside>More</aside><form><input>Send</form><script>var t="</p><p>no";</script><p>last &lt;p&gt;
      <section id="comments"><p>Nice!</p></section></article><div class="sidebar">S</div><footer>&copy;</footer>"""
    assert pages.main_text(page) == "Big & small One two three x last <p>"


def test_broken_markup():
    assert pages.main_text('<div class="ad">x<article><p>a<p>b <b>c<p>d &am') == "a b c d &am"
    assert pages.main_text("<article><p>a</p><p cla") == "a"
    assert pages.main_text("<article>a<!-- b") == "a"
    assert pages.main_text("<article>1 < 2 <!-- x -->and 3</article> tail") == "1 < 2 and 3"
    assert [pages.main_text(x) for x in (None, "", "<html>", "<article></article>", "<script>x")] == [""] * 5
    assert pages.main_text("plain text") == "plain text"
    assert pages.main_text("<article>" + "<p>w" * 20_000) == " ".join(["w"] * 20_000)


def plain_page(i):
    return (
        f"<html><body><div><span>Welcome to our site</span></div><ul><li><a href=1>Red {i}</a><li><a href=2>Blue</a></ul>"
        f"<table><tr><td>Story number {i} told in full <i>he</i>re</td></tr></table><div><p>All rights reserved by us</p></div></body></html>"
    )


def test_template_of_a_host_without_articles(spark):
    rows = [(i, f"http://H.example/{i}", plain_page(i), "x") for i in range(12)] + [(99, "http://other.example", "<p>alone</p>", "y")]
    rows += [(100, None, None, "z"), (101, "http://h.example/dup", plain_page(3), None), (101, "http://h.example/dup", plain_page(3), None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string")
    got = {r["page_id"]: r["main_text"] for r in pages.extract(frame).collect()}
    assert {i: got[i] for i in range(12)} == {i: f"Story number {i} told in full here" for i in range(12)}
    assert (got[99], got[100], got[101]) == ("alone", "", "Story number 3 told in full here")
    assert pages.extract(frame).count() == len(rows)
    assert pages.extract(frame.where("false")).count() == 0


def test_occurrence_vectors_equal_brute_force(spark):
    rows = [("h", i, plain_page(i % 3)) for i in range(7)]
    frame = spark.createDataFrame(rows, "host string, key long, html string").repartition(3)
    got = {r["token"]: r["n_pages"] for r in pages.occurrences(frame).collect()}
    want = {}
    for _, _, page in rows:
        for t in set(pages.page_tokens(page)):
            want[t] = want.get(t, 0) + 1
    assert got == want
    (template,) = [r["template"] for r in pages.templates(frame).collect()]
    fixed = [t for t, n in want.items() if n == 7]
    assert set(template) <= set(fixed) and len(template) > 10


def test_query(spark, tmp_path):
    rows = [(1, "http://a/b", "<article>é😀 &lt;</article>"), (2, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(map(tuple, queries.op5_pages(spark, str(tmp_path)).collect())) == [(1, "http://a/b", "é😀 <", 4), (2, None, "", 0)]


def test_clashing_names_and_copies(spark):
    rows = [(i, f"http://h.example/{i % 6}", plain_page(i % 6), "x", "y", "z") for i in range(12)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, _host string, host string, template string")
    got = pages.extract(frame)
    assert got.columns == [*frame.columns, "main_text"]
    got = {r["page_id"]: r for r in got.collect()}
    # Every page is there twice, with the same url: its tokens still have occurrence vectors of their own.
    assert all(got[i]["main_text"] == f"Story number {i % 6} told in full here" for i in range(12))
    assert {(r["_host"], r["host"], r["template"]) for r in got.values()} == {("x", "y", "z")}
    alone = spark.createDataFrame([("h", 1, "<p>a</p>"), ("h", 1, "<p>a</p>"), ("h", 2, "<i>b</i>"), ("h", 2, "<i>b</i>")], "host string, key long, html string")
    assert pages.occurrences(alone).select("vector").distinct().count() == 2


def article_page(i):
    return (
        f"<html><body><article><h1>Story {i}</h1><div><p>Please subscribe to our letter</p></div><p>Told {i} in full"
        f"<p>{'and so on ' * (i % 5)}<p>the end {i}</article></body></html>"
    )


def test_template_of_articles(spark):
    """A text that stands on a host's pages without a telling name, inside the article."""
    rows = [(i, f"http://h.example/{i}", article_page(i)) for i in range(1, 11)] + [(50, "http://few.example", article_page(50))]
    rows += [(100 + i, f"http://copies.example/{i}", article_page(7)) for i in range(6)]
    # Pages of a small host that share a passage.
    quoted = "<p>One two three four</p>"
    rows += [(200 + i, f"http://small.example/{i}", f"<article><p>Page {i}</p>{quoted if i < 2 else ''}</article>") for i in range(4)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["main_text"] for r in pages.extract(frame).collect()}
    assert [got[200 + i] for i in range(4)] == ["Page 0 One two three four", "Page 1 One two three four", "Page 2", "Page 3"]
    middle = {i: "".join(["and so on "] * (i % 5)) for i in got}
    assert {i: got[i] for i in range(1, 11)} == {i: f"Story {i} Told {i} in full {middle[i]}the end {i}" for i in range(1, 11)}
    # Neither a single page nor copies of one page tell what a host's template is.
    letter = "Please subscribe to our letter"
    assert got[50] == f"Story 50 {letter} Told 50 in full the end 50"
    assert all(got[100 + i] == f"Story 7 {letter} Told 7 in full and so on and so on the end 7" for i in range(6))
