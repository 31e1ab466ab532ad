"""Main text of pages with the usual furniture around the article."""

import pytest

from eventide.llm import html_text as H

P1 = "The first paragraph of the article is long enough to be decided on its own, and it has the words that text has."
P2 = "Short one."
P3 = "Another paragraph that is in the article and that says more of what the page has to say about it, at some length."
WANT = f"Title of it\n\n{P1}\n\n{P2}\n\n{P3}"
ARTICLE = f"<h1>Title of it</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p>"

PAGES = {
    "article": f"<html><head><title>x</title><script>var a='<p>no</p>'</script></head><body><nav><a href=/>Home of the site and of all</a></nav><article>{ARTICLE}</article><footer>&copy; of the site</footer></body></html>",
    "main": f"<body><header><h2>The site of the day</h2></header><main>{ARTICLE}<aside>{P1}</aside></main><div id=comments><p>{P1}</p></div>",
    "no container": f"<body><div class='menu'><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div><div>{ARTICLE}</div><div class=sidebar><p>{P3}</p></div><div class='cookie-notice'>We use cookies and that is what it is for you and us all in the end.</div></body>",
    "unclosed": f"<body><article><h1>Title of it</h1><p>{P1}<p>{P2}<p>{P3}",
    "inside": f"<article><header><h1>Title of it</h1></header><p>{P1}</p><form><p>{P1}</p><input></form><p>{P2}</p><div class='ad'>{P1}</div><p>{P3}</p><section class='comments'><article><p>{P1}</p></article></section></article>",
    "layout": f"<body class='no-sidebar'><div class='page has-sidebar'><article>{ARTICLE}</article></div><div style='display: none'>{P1}</div><p hidden>{P1}</p></body>",
    "case": f"<BODY><ARTICLE>{ARTICLE.upper().replace('</H1>', '</h1>')}</ARTICLE>",
}


@pytest.mark.parametrize("name", PAGES)
def test_furniture(name):
    want = WANT.upper() if name == "case" else WANT
    assert H.extract_text(PAGES[name]) == want


def test_teasers_are_not_the_article():
    """The main text in a div beside teaser cards that are articles; a title that is a link."""
    cards = "".join(f"<article><h3><a href=/{i}>Read this other story of ours</a></h3><p>Short teaser {i}.</p></article>" for i in range(4))
    got = H.extract_text(f"<body><div>{ARTICLE}</div><div class=cards>{cards}</div></body>")
    assert got.startswith(WANT)
    linked = ARTICLE.replace("Title of it", "<a href=/x>Title of it and of all</a>")
    for page in (f"<article>{linked}</article>", f"<body><div>{linked}</div></body>"):
        assert H.extract_text(page) == WANT.replace("Title of it", "Title of it and of all")


def test_references_and_space():
    assert H.extract_text("<article><p>a &amp; b&nbsp;c &lt;i&gt; &#233;&#x1F600;\n\t d<br>e <b>f</b>g</p></article>") == "a & b c <i> é😀 d e fg"


def test_odd_pages():
    assert H.extract_text("") == H.extract_text("   ") == H.extract_text("<html><body></body></html>") == ""
    assert H.extract_text("<article><p>unfinished <b>one") == "unfinished one"
    assert H.extract_text("<article><p>x < y</p></article></div></p>") == "x < y"
    assert H.extract_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"
    assert H.extract_text("<article><!-- no --><p>yes</p><script>no</article>") == "yes"
    big = "<article>" + "".join(f"<p>{P1} {i}</p>" for i in range(3000)) + "</article>"
    assert H.extract_text(big).count("\n\n") == 2999


def test_passes():
    blocks = [("x", 0, False, False, False, 0)] * 5
    assert H.second_pass(blocks, [1, 0, 0, 0, -1]) == [1, 1, -1, -1, -1]
    inside = [("x", 0, False, True, False, 1)] * 5
    assert H.second_pass(inside, [1, 0, 0, 0, -1]) == [1, 1, 1, -1, -1]
    assert H.second_pass(inside, [0] * 5) == [1] * 5 and H.second_pass(blocks, [0] * 5) == [-1] * 5
    assert H.first_pass((P1, 0, False, False, False, 0), False) == 1
    assert H.first_pass((P1, 80, False, False, False, 0), False) == -1
    assert H.first_pass(("kurz", 0, False, False, False, 0), False) == 0


def test_frames(spark):
    df = spark.createDataFrame([(1, "u", PAGES["main"], "x"), (2, None, None, "x"), (1, "u", PAGES["main"], "x")], "page_id long, url string, html string, n_chars string").coalesce(1)
    got = H.extract(df).collect()
    assert [r["text"] for r in got] == [WANT, "", WANT] and got[0]["n_chars"] == "x"
    assert H.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("junk", ["<![foo[bar]]>", "<![", "<![if x]>", "<!doctype [<!entity x>", "<!>", "<!-", "<?x", "</", "<a b='", "&#xZZ;", "<![CDATA[x]]>"])
def test_malformed_declarations(junk):
    page = f"<article>{ARTICLE}</article>"
    H.extract_text(junk)
    H.extract_text(page[:40] + junk + page[40:])
    assert H.extract_text(page + junk) == WANT


def test_random_markup_never_fails():
    import random

    rng = random.Random(1)
    bits = ["<p>", "</p>", "<b>", "</b>", "<div class='ad'>", "</div>", "<![x", "]]>", "<!--", "-->", "<article>", "</article>", "<li>", "<a href=x>",
            "</a>", "<h1>", "</h2>", "text of it ", "&amp", "<table>", "<script>", "</script>", "\x00", "<", ">", "'", "<form>", "</ul>", "é"]
    for _ in range(500):
        H.extract_text("".join(rng.choice(bits) for _ in range(rng.randrange(60))))


def test_unclosed_tags_cost_linear_time():
    import time

    def took(n):
        begin = time.process_time()
        H.extract_text("<p><i>" + "<b>" * n + "</i>" * n + "<h2>x</h2>" * n)
        return time.process_time() - begin
    took(1000)
    assert took(16_000) < 16 * max(took(4000), 0.01)


@pytest.mark.parametrize("page", [f"<form>{ARTICLE}</form>"] + [f"<div class='{c}'>{ARTICLE}</div>" for c in (
    "post tags-x", "social-sciences", "content search", "related-art")] + [f"<div class='page widget-area'><article>{ARTICLE}</article></div>"])
def test_names_that_also_name_topics(page):
    assert H.extract_text(f"<body><nav><a href=/>Home of the site</a></nav>{page}</body>") == WANT


def test_unknown_language_and_furniture_alone():
    text = "Pierwszy akapit artykułu jest wystarczająco długi, żeby można było o nim zdecydować osobno, bez pomocy słów."
    page = f"<body><nav><a href=x>Strona główna serwisu</a></nav><div><h1>Tytuł</h1><p>{text}</p></div><div class=comments><p>{text}</p></div></body>"
    assert H.extract_text(page) == f"Tytuł\n\n{text}"
    assert H.extract_text(f"<body><nav><a href=x>Home of it</a></nav><div class=comments><p>{P1}</p></div><footer>{P3}</footer></body>") == ""
