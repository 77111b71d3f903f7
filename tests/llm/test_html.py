import html
import re

from pyspark.sql import functions as F

from tallyframe.llm import html_extract, wrappers

SF = "/root/testdata/sf0.01"


def plain(page):
    """The article of a test page, by its known layout."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", "", x)).split())
              for x in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("text", F.lit("clash"))
    got = {r.page_id: r for r in html_extract.extract(pages).collect()}
    given = pages.collect()
    assert len(got) == len(given)
    for r in given:
        assert got[r.page_id].text == plain(r.html) and got[r.page_id].n_chars == len(plain(r.html))


LAYOUT = """<html><head><title>t</title><style>p{{}}</style></head><body>
<div class="site-header">Brand</div><div id="nav-12"><a href=x>Home</a></div>
<div class=content><h1>{title}</h1><p class="lead">Fixed lead</p>{body}<form>Name <input> send</form></div>
<aside>Side</aside><div class="comments"><p>nice post</p></div><script>var a="<p>no</p>";</script>
<div class="cookie-notice">We use cookies</div></body></html>"""


def test_other_layouts_and_edges(spark):
    rows = [(i, f"http://host.example/{i}", LAYOUT.format(
        title=f"Title &lt;{i}&gt;", body="".join(f"<p>Para {i} {k} caf&eacute;&nbsp; end" for k in range(i + 1))))
        for i in range(12)]
    rows += [(100, "http://solo/", "<p>Only <b>one</b><br>page</p>"), (101, None, None), (102, "", ""),
             (103, "nonsense", "no tags at all &amp; more"), (104, "http://x/", "<p>a<!-- <p>c</p> --><p>b <"),
             (105, "http://x/", "<a '<b \"<div>" * 2000 + "end"), (105, "http://y/", "<li>1<li>2"),
             (106, "http://long/", "<div>" * 3000 + "deep" + "</div>" * 10), (107, "http://big/", "<p>word " * 60_000)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    for i in range(12):
        assert text[i] == "\n".join([f"Title <{i}>", *[f"Para {i} {k} café end" for k in range(i + 1)]])
    assert text[100] == "Only one page" and text[101] == text[102] == ""
    assert text[103] == "no tags at all & more" and text[104].startswith("a\nb")
    assert text[106] == "deep" and text[107].count("word") == 60_000
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert html_extract.extract(empty).count() == 0


def test_copies_on_a_host_are_not_a_template(spark):
    rows = [(i, "http://copies/", "<article><h1>Same</h1><p>Short text</p></article>") for i in range(20)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r.text for r in got.collect()} == {"Same\nShort text"}


def test_alignment_makes_slots_options_and_repeats():
    one = wrappers.shape(wrappers.Page("<ul><li>a<li>b</ul><p>x</p>").tree)
    two = wrappers.shape(wrappers.Page("<ul><li>a</ul><hr><p>y</p>").tree)
    ul, hr, p = wrappers.merge(one, two)[3]
    assert ul[3] == [["li", 0, 1, [["#", 0, 0, None]]]]
    assert hr[:3] == ["hr", 1, 0] and p[3] == [["#", 0, 0, None]]
    pairs = wrappers.shape(wrappers.Page("<dl><dt>a<dd>b<dt>c<dd>d</dl>").tree)[3][0]
    assert [x[:3] for x in pairs[3]] == [["dt", 0, 1], ["dd", 0, 1]]


def test_groups_are_merged_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "GROUP", 3)
    rows = [(i, "http://h/", f"<article><h1>{i}</h1><p>t{i}</p>{'<hr>' * (i % 3)}</article>") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    inferred = html_extract.infer(html_extract.shapes(pages)).collect()
    assert [(r.host, r.n, r.region) for r in inferred] == [("h", 30, "/article")]
    assert {r.page_id: r.text for r in html_extract.extract(pages).collect()} == {i: f"{i}\nt{i}" for i in range(30)}
