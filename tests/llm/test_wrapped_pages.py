"""Pages whose layout has no tag or class that tells the article: the aligned wrapper decides."""

import pytest

from tallyframe.llm import html_extract, wrappers


def bare_page(i, host):
    """A page of divs alone, and its article."""
    menu = "".join(f"<div>{x}</div>" for k, x in enumerate(["Home", "World", "Sport", "Money"]) if k != i % 4 or k == 0)
    article = [f"Story {i} of {host}", f"Opening words of story {i} " + f"told{i} " * 12,
               *[f"Paragraph {k} of story {i} " + f"word{i}x{k} " * 9 for k in range(i % 3 + 1)]]
    promo = "<div><div>Read our weekly letter</div></div>" if i % 2 else ""
    body = "".join(f"<p>{x}</p>" for x in article[1:])
    html = (f"<html><body><div><div>{host} daily</div><div>{menu}</div></div>"
            f"<div><h2>{article[0]}</h2>{body}</div>{promo}"
            f"<div><span>Printed by {host} press, all rights reserved</span><p>Page number {i}</p></div></body></html>")
    return html, "\n".join(" ".join(x.split()) for x in article)


def extracted(spark, rows):
    got = html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    return {r.page_id: r.text for r in got.collect()}


@pytest.mark.parametrize("group", [200, 3])
def test_wrappers_find_the_article_without_any_name(spark, monkeypatch, group):
    monkeypatch.setattr(html_extract, "GROUP", group)
    rows, truth = [], {}
    for h in ("alpha", "beta"):
        for i in range(12):
            html, text = bare_page(i, h)
            rows.append((len(rows), f"http://{h}.example/{i}", html))
            truth[len(truth)] = text
    got = extracted(spark, rows)
    changed = sum(got[k] != wrappers.Page(html).article() for k, _, html in rows)
    assert got == truth and changed == len(rows)


def test_joined_plans_give_the_same(spark):
    rows = [(i, "http://gamma.example/", bare_page(i, "gamma")[0]) for i in range(10)]
    small = extracted(spark, rows)
    spark.conf.set("spark.tallyframe.broadcastBytes", "0")
    try:
        assert extracted(spark, rows) == small
    finally:
        spark.conf.unset("spark.tallyframe.broadcastBytes")


def test_copies_stay_whole_and_single_pages_keep_all(spark):
    copy = bare_page(1, "copies")[0].replace("Page number 1", "Page number {}")
    rows = [(i, "http://copies.example/", copy.format(i)) for i in range(6)]
    rows += [(100, "http://one.example/", bare_page(2, "one")[0])]
    got = extracted(spark, rows)
    assert all("Opening words of story 1" in got[i] and "Story 1 of copies" in got[i] for i in range(6))
    assert got[100] == wrappers.Page(rows[-1][2]).article()


def test_class_parts_say_nothing_inside_an_article():
    for name in ("navy", "ad-hoc", "search-results", "related-work", "alert-level", "notices", "promontory",
                 "share-price", "widget-a"):
        assert wrappers.Page(f"<article><p>One</p><div class='{name}'><p>Two</p></div></article>").article() == "One\nTwo"
    for name in ("navy", "promontory"):
        assert wrappers.Page(f"<p>One</p><div class='{name}'><p>Two</p></div>").article() == "One\nTwo"
    for name in ("ad", "comments", "sidebar wide"):
        assert wrappers.Page(f"<article><p>One</p><div class='{name}'><p>Two</p></div></article>").article() == "One"


def test_a_page_is_read_by_its_wrapper():
    pages = [wrappers.Page(x) for x in ("<ul><li>a<li>b</ul><p>x</p>", "<ul><li>a</ul><hr><div>m</div><p>y</p>")]
    wrapper = wrappers.merge(*[wrappers.shape(p.tree) for p in pages])
    numbers = wrappers.number(wrapper)
    read = [wrappers.read_page(wrapper, p.numbered(), numbers) for p in pages]
    assert [[blocks for _, blocks in one] for one in read] == [[[0, 1], [2]], [[0], [1], [2]]]
    # the same slots of list and paragraph on both pages, brute force over the leaves of the wrapper
    leaves = []

    def walk(node):
        if node[0] == "#":
            leaves.append(numbers[id(node)])
        else:
            [walk(x) for x in node[3]]

    walk(wrapper)
    assert [s for s, _ in read[1]] == leaves and [s for s, _ in read[0]] == [leaves[0], leaves[2]]
