"""URL filter: parsing, rules and the template tree against plain code."""

import re

from eventide.llm import urltree
from eventide.llm.queries import URL_RULES

URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/de/1?x#y", "https://a.example.net/en/5", "https://example.net/en", "http://x.net",
        "http://net/", "http://a.org/fr/9#q", "http://borg/fr/9", "http://a.org?fr/", "http://É.org/fr/", "a://b://c.net/d", "http://h.example.com/de/x/y/z/1/2/3",
        "http://u@h.net:80/p"]


def plain(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None, None
    rest = url[at + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for verdict, h, p in URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, *(best or (None, None))


def test_rules(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string, host string")
    got = urltree.judge(df, URL_RULES).collect()
    assert len(got) == len(URLS) + 3
    for r in got:
        host, path, rule, verdict = plain((URLS + URLS[:3])[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict is None or r["verdict"] == verdict
        assert r["verdict"] in ("allow", "block")


def test_templates_learn_from_labels(spark):
    """One host: /bad/* mostly bad, /good/* good, many slugs under /blog; another host has no labels."""
    rows, labels = [], []
    def add(url, bad=None):
        rows.append((len(rows), url))
        if bad is not None:
            labels.append((len(rows) - 1, bad))
    for i in range(40):
        add(f"http://h.x/bad/{i}", 1)
        add(f"http://h.x/good/{i}.html", 0)
        add(f"http://h.x/blog/slug{chr(97 + i % 26)}{'xyz'[i % 3]}", 1 if i < 30 else None)
        add(f"http://other.x/bad/{i}")
    add("http://h.x/bad/4711")
    add("http://h.x/good/4711.html")
    df = spark.createDataFrame(rows, "page_id long, url string")
    lab = spark.createDataFrame(labels + labels[:5] + [(None, 1), (3, None)], "id long, bad int")
    got = {r["page_id"]: r for r in urltree.judge(df, [], lab).collect()}
    byurl = {u: got[i] for i, u in rows}
    assert byurl["http://h.x/bad/4711"]["verdict"] == "block" and byurl["http://h.x/bad/4711"]["template"] == "/bad/<n>"
    assert byurl["http://h.x/good/4711.html"]["verdict"] == "allow"
    assert {byurl[u]["template"] for _, u in rows if "/blog/" in u} == {"/blog/*"}
    assert {byurl[u]["verdict"] for _, u in rows if "/blog/" in u} == {"block"}
    assert {byurl[u]["verdict"] for _, u in rows if "other.x" in u} == {"allow"}


def test_similar_branches_share_their_evidence(spark):
    """Branches with few labels each are rejected together; one that differs is not."""
    rows = [(i * 10 + j, f"http://h.x/s{'abcdef'[i]}/p") for i in range(6) for j in range(3)]
    labels = [(r[0], 1) for r in rows if "/sf/" not in r[1]] + [(r[0], 0) for r in rows if "/sf/" in r[1]] * 1
    df = spark.createDataFrame([(i, u.replace("/p", "")) for i, u in rows], "page_id long, url string")
    got = {r["path"]: r["verdict"] for r in urltree.judge(df, [], spark.createDataFrame(labels, "id long, bad int")).collect()}
    assert got == {**{f"/s{c}": "block" for c in "abcde"}, "/sf": "allow"}


def test_a_rule_on_one_section_says_nothing_of_others(spark):
    """20 sections and 10 one-off typos below one host; then many small sections, too."""
    for sections, pages in ((20, 10), (60, 12)):
        names = ["de"] + [f"s{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(sections - 1)]
        urls = [f"http://example.com/{n}/p{chr(97 + j)}" for n in names for j in range(pages)]
        urls += [f"http://example.com/typo{c}/x" for c in "abcdefghij"]
        df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
        got = {r["path"]: r["verdict"] for r in urltree.judge(df, URL_RULES).collect()}
        assert len(got) == len(urls) and {v for p, v in got.items() if p.startswith("/de/")} == {"block"}
        assert {v for p, v in got.items() if not p.startswith("/de/")} == {"allow"}


def test_empty(spark):
    assert urltree.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES).collect() == []
