"""Extraction of pages whose layouts lose text easily."""

from tallyframe.llm import html_extract, wrappers


def extracted(spark, pages, host="h"):
    rows = [(i, f"http://{host}/{i}", page) for i, page in enumerate(pages)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    return [r.text for r in got.orderBy("page_id").collect()]


def test_long_texts_are_aligned(spark):
    long = "This story first appeared in the print edition of the Daily Example."
    copy = f"<article><h1>Same</h1><p class=by>By Ann</p><p>{long}</p><ul><li>one<li>two</ul></article>"
    assert extracted(spark, [copy] * 6) == [f"Same\nBy Ann\n{long}\none\ntwo"] * 6
    near = [copy.replace(long, long * 3).replace("By Ann", f"By Ann, {i} min ago") for i in range(6)]
    assert all(long * 3 in text for text in extracted(spark, near))
    made = [f"<article><h1>T{i}</h1><p>Words of {i}</p><p>More of {i}</p><div>{long}</div></article>" for i in range(2)]
    assert extracted(spark, made) == [f"T{i}\nWords of {i}\nMore of {i}" for i in range(2)]


def test_no_part_of_an_article_is_left_out(spark):
    beside = [f"<body><h1>Title {i}</h1><div class=content><p>Words {i} " + "w " * 99 + "</p></div></body>" for i in range(3)]
    assert all(f"Title {i}\nWords {i}" in text for i, text in enumerate(extracted(spark, beside)))
    parts = [f"<body><div class=part-a><p>{'a' * 90}{i}</p></div><div class=part-b><p>{'b' * 50}{i}</p></div></body>"
             for i in range(3)]
    other = "<body><div class=content><p>Teaser</p></div><div class=story><p>The article</p></div></body>"
    assert extracted(spark, [*parts, *beside, other]) == [
        *[f"{'a' * 90}{i}\n{'b' * 50}{i}" for i in range(3)],
        *[f"Title {i}\nWords {i} " + " ".join("w" * 99) for i in range(3)], "Teaser\nThe article"]
    mains = [f"<body><p>Side<article class=one><p>First {i}</article><article class=two><p>Second {i} longer</article></body>"
             for i in range(2)]
    assert extracted(spark, mains) == [f"First {i}\nSecond {i} longer" for i in range(2)]


def test_no_tag_or_class_takes_the_whole_page():
    cases = {
        "<body><svg viewBox='0 0 1 1'/><p>Words</p><svg><path/><text>no</text></svg><p>More</p></body>": "Words\nMore",
        "<p>One</p><iframe src=x><p>Two</p><select><p>Three</p>": "One\nTwo\nThree",
        "<p>One</p><script>var a = '<p>no</p>'": "One", "<p>One</p><textarea><p>no</p>": "One",
        "<p>One</p><object data=x><param name=a value=b><p>Fallback</p></object><p>Two</p>": "One\nFallback\nTwo",
        "<body class='single has-sidebar sidebar'><p>Words</p></body>": "Words",
        "<html class=nav id=search><article class='post comments'><p>Words</p></article></html>": "Words",
        "<body><div class=widget><p>Words</p><nav>no</nav></div></body>": "Words",
        "<body><p>Words</p><div class=widget><p>no</p></div></body>": "Words",
    }
    for page, text in cases.items():
        assert wrappers.Page(page).article() == text, page
    assert wrappers.Page("<svg>" * 20_000 + "<p>end</p>").article() == "end"
