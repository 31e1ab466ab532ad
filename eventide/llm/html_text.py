"""Main text of web pages by two-pass block rules.

A page becomes blocks (runs of text between block tags).  The first pass decides
by place, link density, length and stop-word density: a block is main text,
boilerplate or undecided.  The second pass gives undecided blocks the label of
their nearest decided neighbours.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from eventide.llm.common import arrow_batches

#: Characters from which a block is long; shares of linked characters and of stop words.
SHORT, LINKS, STOP_GOOD, STOP_SOME = 70, 0.33, 0.25, 0.12

# Stop words of the supported languages.
STOP = frozenset("""
a an and are as at be but by for from has have he in is it its not of on or she that the their they this to was were which with you
au aux avec ce ces dans de des du elle en est et il la le les leur mais ne par pas pour que qui sur un une vous
als auf aus bei das dem den der des die ein eine einer er es für ich im in ist mit nicht sich sie und von zu
al como con de del el en es esta la las lo los más no para pero por que se su un una y
""".split())
# Tags that begin a block, tags without text of their own, tags never read.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("""audio button canvas datalist footer form head iframe input map math nav noframes noscript object aside menu dialog
script select style svg template textarea title video""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id or role that mark boilerplate.
MARKED = re.compile(r"""(?ix)(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side-?bar|
footer|site-?header|page-?header|masthead|topbar|toolbar|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|
login|search|share|sharing|social|related|recommend\w*|comments?|commentlist|disqus|respond|replies|reply|discussion|pagination|pager|widget\w*|
complementary|contentinfo|navigation|banner|search|disclaimer|copyright|toc|tags|skip-?link)(?:$|[\s_-])""")
#: Words among them that name topics and layouts as often (fixed values).
_WEAK = ("search|", "share|", "sharing|", "social|", "related|", "recommend\\w*|", "widget\\w*|", "toc|", "tags|")
SURELY_MARKED = re.compile(reduce(lambda p, w: p.replace(w, ""), _WEAK, MARKED.pattern))
CONTENT = frozenset(["article", "main"])
#: Share of stop words below which a page's language is none of the known ones.
UNKNOWN = 0.05
_LAYOUT = re.compile(r"(?i)\b(?:no|has|with|without|hide|show)[-_][\w-]+")


class Blocks(HTMLParser):
    """Blocks of a page: [text, linked characters, heading, in content, boilerplate, region]."""

    def __init__(self, marked: re.Pattern = MARKED):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple] = []
        self.open: list[tuple[str, bool, bool] | None] = []  # tag, boilerplate, content; None: ended out of order
        self.where: dict[str, list[int]] = defaultdict(list)  # places of the open elements by tag
        self.block_at: list[int] = []
        self.text: list[str] = []
        self.linked, self.links, self.heading, self.region = 0, 0, False, 0
        self.marked, self.skip = marked, SKIP if marked is MARKED else SKIP - {"form"}

    def state(self):
        return self.open[-1][1:] if self.open else (False, False)

    def push(self, tag, bad, content):
        self.where[tag].append(len(self.open))
        if tag in BLOCK:
            self.block_at.append(len(self.open))
        self.open.append((tag, bad, content))

    def cut(self, at):
        """End all elements from place ``at`` on."""
        while len(self.open) > at or (self.open and self.open[-1] is None):
            entry = self.open.pop()
            if entry:
                self.where[entry[0]].pop()
                if entry[0] in BLOCK:
                    self.block_at.pop()

    def parse_marked_section(self, i, report=1):
        """Any ``<![`` that is no known section is a comment up to the next ``>``."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self._comment(i)

    def parse_html_declaration(self, i):
        try:
            return super().parse_html_declaration(i)
        except AssertionError:
            return self._comment(i)

    def _comment(self, i):
        end = self.rawdata.find(">", i + 2)
        return end + 1 if end >= 0 else len(self.rawdata)

    def close_block(self):
        text = " ".join("".join(self.text).split())
        if text:
            bad, content = self.state()
            self.blocks.append((text, self.linked, self.heading, content, bad, self.region))
        self.text, self.linked, self.heading = [], 0, False

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append(" ")
        if tag in BLOCK or tag in SKIP:
            self.close_block()
        if tag in VOID:
            return
        if tag == "p" or tag in HEADINGS:  # a paragraph ends where the next begins
            self.end("p")
        if tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
            self.end(tag, stop=("ul", "ol", "dl", "table", "select", "menu"))
        bad, content = self.state()
        values = {k: v or "" for k, v in attrs}
        inside = content and tag == "header"  # a header of the article: its headings stay
        hint = " ".join(values.get(k, "") for k in ("class", "id", "role"))
        hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "")
        starts = tag in CONTENT or values.get("role") in CONTENT or values.get("itemprop") == "articleBody"
        if tag in self.skip or hidden or (tag == "header" and not inside) or (tag not in ("html", "body") and not starts and self.marked.search(_LAYOUT.sub("", hint))):
            bad = True
        if starts and not bad:
            if not content:
                self.region += 1
            content = True
        self.push(tag, bad, content)
        if tag in HEADINGS:
            self.heading = True
        if tag == "a":
            self.links += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("script", "style", "svg", "iframe"):
            self.handle_endtag(tag)

    def end(self, tag, stop=()):
        """End the innermost ``tag`` and what is open in it, unless a ``stop`` (for p: a block) is in between."""
        if not self.where[tag]:
            return
        at = self.where[tag][-1]
        inner = [self.where[s][-1] for s in stop if self.where[s]] + (self.block_at[-1:] if tag == "p" else [])
        if any(i > at for i in inner):
            return
        self.close_block()
        self.links = max(0, self.links - (len(self.where["a"]) - bisect_left(self.where["a"], at)))
        was = self.state()[1]
        self.cut(at)
        if was and not self.state()[1]:
            self.region += 1

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        if tag in BLOCK or tag in SKIP:
            self.close_block()
        if not self.where[tag]:
            return
        if tag in BLOCK or tag in SKIP:
            self.end(tag)
        elif not self.block_at or self.block_at[-1] < self.where[tag][-1]:  # an inline end tag never closes a block
            self.links = max(0, self.links - (tag == "a"))
            self.open[self.where[tag].pop()] = None
            self.cut(len(self.open))

    def handle_data(self, data):
        if self.state()[0]:
            return
        self.text.append(data)
        if self.links:
            self.linked += len("".join(data.split()))


def parse(html: str, marked: re.Pattern = MARKED) -> list[tuple]:
    p = Blocks(marked)
    p.feed(html)
    p.close()
    p.close_block()
    return p.blocks


def first_pass(block: tuple, has_content: bool) -> int:
    """1 main text, -1 boilerplate, 0 undecided.  ``has_content``: the main text stands in regions
    of content, so that blocks outside them are boilerplate."""
    text, linked, heading, content, bad, _ = block
    if bad or (has_content and not content):
        return -1
    words = text.lower().split()
    stops = sum(w.strip(".,;:!?()\"'«»") in STOP for w in words) / len(words)
    if heading:  # a title may be a permalink: its neighbours decide
        return 0
    if linked > LINKS * len("".join(words)):
        return 0 if content and len(words) <= 3 else -1
    if len(text) >= SHORT and stops >= STOP_SOME:
        return 1
    if not content and text.startswith(("©", "Copyright")):
        return -1
    if len(text) >= SHORT and not content:
        return 0 if stops >= STOP_SOME / 2 else -1
    return 1 if content and stops >= STOP_GOOD else 0


def second_pass(blocks: list[tuple], labels: list[int]) -> list[int]:
    """Undecided blocks take the label of the decided neighbours of their region: the
    nearest on either side; if those differ, the nearer one, and main text for headings
    before main text and at equal distance inside the article.  Without a decided
    neighbour, blocks inside an article are main text, others boilerplate."""
    n = len(blocks)
    before, after = [None] * n, [None] * n
    for out, steps in ((before, range(n)), (after, range(n - 1, -1, -1))):
        last, region = None, None
        for i in steps:
            if blocks[i][5] != region:
                last, region = None, blocks[i][5]
            out[i] = last
            if labels[i]:
                last = i
    out = list(labels)
    for i in range(n):
        if labels[i]:
            continue
        heading, content = blocks[i][2], blocks[i][3]
        b, a = before[i], after[i]
        near = [(abs(i - j), labels[j]) for j in (b, a) if j is not None]
        if not near:
            out[i] = 1 if content else -1
        elif heading and a is not None and labels[a] == 1:
            out[i] = 1
        else:
            least = min(d for d, _ in near)
            close = {label for d, label in near if d == least}
            out[i] = (1 if content else -1) if len(close) > 1 else close.pop()
    return out


def _share(blocks: list[tuple]) -> float:
    words = [w for b in blocks for w in b[0].lower().split()]
    return sum(w.strip(".,;:!?()\"'«»") in STOP for w in words) / max(1, len(words))


def extract_text(html: str) -> str:
    """Main text: the blocks of the article in page order, two line feeds between.

    If nothing is found, class names that may as well name a topic, and forms, no longer count
    against a block; and if the page is in none of the known languages, length and links
    decide without stop words."""
    blocks = [b for b in parse(html) if not b[4]]
    text = _main_text(blocks)
    if not text:
        weak = [b for b in parse(html, SURELY_MARKED) if not b[4]]
        text = _main_text(weak) if len(weak) > len(blocks) else ""
        if not text and weak and _share(weak) < UNKNOWN:
            labels = [0 if b[2] else 1 if len(b[0]) >= SHORT and b[1] <= LINKS * len(b[0]) else -1 for b in weak]
            if 1 in labels:
                text = "\n\n".join(b[0] for b, label in zip(weak, second_pass(weak, labels)) if label > 0)
    return text


def _main_text(blocks: list[tuple]) -> str:
    labels = [first_pass(b, False) for b in blocks]
    if any(b[3] for b in blocks):
        # Place is evidence where the regions of content hold most of the main text (or all there is).
        within, outside = (sum(len(b[0]) for b, label in zip(blocks, labels) if label > 0 and b[3] == side) for side in (True, False))
        if within >= outside:
            labels = [first_pass(b, True) for b in blocks]
        else:  # teasers: the regions say nothing
            blocks = [(*b[:3], False, *b[4:]) for b in blocks]
            labels = [first_pass(b, False) for b in blocks]
    labels = second_pass(blocks, labels)
    return "\n\n".join(b[0] for b, label in zip(blocks, labels) if label > 0)


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``, the main text of the whole html (empty if none; null html is
    empty).  Pages are read alone (no shuffle), broken markup as far as it goes; repeated rows
    and other columns stay as they are."""
    arrow_batches(pages.sparkSession)

    def run(batch: pd.Series) -> pd.Series:
        return pd.Series([extract_text(h or "") for h in batch], dtype=object)

    return pages.withColumn(out, F.pandas_udf(run, "string")(F.col(html_col)))
