"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams its events; each block of text is a
line with the number of tags that came with it. The ratios of text to tags
are smoothed with a Gaussian, lines over a threshold (the spread of the
page's ratios) seed the content, and the regions that hold a seed are kept
whole, so that a short paragraph between long ones stays. All regions take
part, in articles and outside; the lists and tables of an article belong to
its section around them.

An article element is a weight, not a verdict. If the articles with a seed
hold at least as much text as the seeds outside, what lies outside goes and
a line inside is a seed also if its own ratio, without its neighbours', is
over 1 / ARTICLE of the threshold; otherwise the ratios alone decide, so a
story card marked as an article does not replace the page's text.

What the markup itself calls a menu, a notice or the like (by element, role,
class or id) never counts as content. A class or id is believed only if the
element lies in an article, or holds neither an article element nor nearly
all of the page's text: a wrapper may well be called "with-sidebar".
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import only, small_batches

SIGMA = 1.0  # of the Gaussian, in lines
ARTICLE = 2.0  # weight of a line's own ratio in an article that is believed
DOUBTED = 0.2  # weight of a seed outside whose element is named like a notice
WRAPPER = 0.8  # share of the page's text beyond which a name is not believed
# Elements by what they mean for the text.
SKIP = frozenset("script style noscript template title head textarea select option button datalist svg math iframe object canvas audio video".split())
BOILER = frozenset("nav footer aside form menu dialog".split())
MAIN = frozenset(("article", "main"))
SECTION = MAIN | frozenset(("div", "section"))  # regions of their own in an article
REGION = frozenset("html body div section article main aside nav header footer form menu dialog ul ol dl table tr td th fieldset details blockquote center".split())
BREAK = REGION | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre br hr figure figcaption address caption thead tbody tfoot summary legend option title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar status form".split())
NAMES = frozenset(
    """ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb
    breadcrumbs sidebar footer header masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert popup modal toast overlay
    newsletter subscribe subscription signup login search share sharing social related recommended comment comments disqus replies respond
    discussion widget pagination pager copyright disclaimer""".split()
)
_cut_off = re.compile(r"<[a-zA-Z/!?]")
_word = re.compile(r"[a-z]+")
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")
_hidden = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class _Lines(HTMLParser):
    """Collects (text, tags, region, doubt, article) per line. ``doubt`` is
    the innermost ancestor whose class or id speaks against the line (those
    further out are found from it, so nothing is copied per line),
    ``article`` is the region of the outermost article (0 outside). The work
    is linear in the page, however deep it nests: an end tag looks up
    whether its element is open at all."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, int]] = []
        self.stack: list[tuple[str, bool, int, bool]] = []  # element, out (surely no content), region, doubted
        self.out = 0
        self.inline: list[str] = []
        self.tags = 0
        self.regions = 0
        self.doubt = 0  # innermost open doubted element; 0 is none
        self.above: dict[int, int] = {}  # the doubted element around each
        self.open: dict[str, int] = {}  # elements on the stack, by name
        self.mains: set[int] = set()  # doubted elements with an article inside
        self.inside: set[int] = set()  # doubted elements inside an article
        self.articles: list[int] = []  # regions of open article elements
        self.found = False  # an article
        self.sections: list[int] = []  # regions of open sections in an article, its own first

    def flush(self):
        if self.inline:
            text = " ".join("".join(self.inline).split())
            self.inline.clear()
            if text:
                region = self.sections[-1] if self.sections else self.stack[-1][2] if self.stack else 0
                self.lines.append((text, self.tags, region, self.doubt, self.articles[0] if self.articles else 0))
                self.tags = 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BREAK:
            self.flush()
        if tag in VOID:
            return
        region, out, doubt = tag in REGION, tag in SKIP or tag in BOILER, False
        if tag == "header":
            out = not self.articles  # an article's own header holds its title
        if attrs and not out:
            for k, v in attrs:
                if k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and v and _hidden.search(v.lower()):
                    out = True
                elif k == "role" and v:
                    out = out or v.strip().lower() in ROLES
                elif (k == "class" or k == "id") and v and tag not in ("html", "body"):
                    doubt = doubt or not NAMES.isdisjoint(_word.findall(_camel.sub(" ", v).lower()))
        if tag == "body" or tag in MAIN:
            while self.stack and self.stack[-1][0] in ("head", "title"):  # never closed
                self._pop()
        if tag in MAIN and not (out or doubt or self.out or self.found):  # comments may be articles too
            d = self.doubt
            while d:
                self.mains.add(d)
                d = self.above[d]
        if region or out or doubt:
            if doubt and not region and not out:
                self.flush()
            self.regions += 1
            self.stack.append((tag, out, self.regions, doubt))
            self.open[tag] = self.open.get(tag, 0) + 1
            self.out += out
            if doubt:
                self.above[self.regions] = self.doubt
                self.doubt = self.regions
                if self.articles:
                    self.inside.add(self.regions)
            if tag in MAIN and not self.out and not doubt:
                self.articles.append(self.regions)
                self.found = True
            if self.articles and tag in SECTION:
                self.sections.append(self.regions)

    def _pop(self):
        tag, out, region, doubt = self.stack.pop()
        self.open[tag] -= 1
        self.out -= out
        if doubt:
            self.doubt = self.above[region]
        if self.articles and self.articles[-1] == region:
            self.articles.pop()
        if self.sections and self.sections[-1] == region:
            self.sections.pop()
        return tag

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BREAK:
            self.flush()
        if not self.open.get(tag):
            return
        self.flush()
        while self._pop() != tag:
            pass

    def handle_data(self, data):
        if not self.out:
            self.inline.append(data)


def smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing; at the ends the kernel is cut and renormalised."""
    radius = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-radius, radius + 1)]
    out = []
    for i in range(len(values)):
        lo, hi = max(0, i - radius), min(len(values), i + radius + 1)
        weights = kernel[lo - i + radius : hi - i + radius]
        out.append(sum(w * v for w, v in zip(weights, values[lo:hi])) / sum(weights))
    return out


def _complete(html: str) -> str:
    """The page without a tag that its end cuts off, and with comments that
    never end as text. The parser would look for the end of each of them
    again, up to the page's end."""
    end = html.rfind("-->") + 3 if "-->" in html else 0
    if html.find("<!--", end) >= 0:
        html = html[:end] + html[end:].replace("<!--", "&lt;!--")
    last = html.rfind(">") + 1
    m = _cut_off.search(html, last)
    return html[: m.start()] if m else html


def main_text(html: str | None) -> str:
    """The page's main text: blocks in page order, joined by one space."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(_complete(html))
    parser.close()
    parser.flush()
    lines = parser.lines
    if not lines:
        return ""
    total = sum(len(x[0]) for x in lines)
    held = dict.fromkeys(parser.above, 0)
    for text, _, _, doubt, _ in lines:
        if doubt:
            held[doubt] += len(text)
    for d in sorted(held, reverse=True):  # an inner element has the greater number
        if parser.above[d]:
            held[parser.above[d]] += held[d]
    wrong = {0: False}
    for d in sorted(held):
        wrong[d] = wrong[parser.above[d]] or d not in parser.mains and (d in parser.inside or held[d] <= WRAPPER * total)
    own = [x for x in lines if not wrong[x[3]]]
    if not own:
        return ""
    bare = [len(x[0]) / max(1, x[1]) for x in own]
    ratios = smooth(bare)
    mean = sum(ratios) / len(ratios)
    spread = math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    threshold = min(spread, max(ratios))
    seeds = [x for x, r in zip(own, ratios) if r >= threshold]
    articles = {x[4] for x in seeds if x[4]}
    inside = sum(len(x[0]) for x in own if x[4] in articles)
    outside = sum(len(x[0]) * (DOUBTED if x[3] else 1.0) for x in seeds if not x[4])
    if articles and inside >= outside:
        seeds = [x for x, r, b in zip(own, ratios, bare) if x[4] and (r >= threshold or ARTICLE * b >= threshold)]
    content = {x[2] for x in seeds}
    return " ".join(x[0] for x in own if x[2] in content)


def extract(spark: SparkSession, pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``; page_id and url
    keep their types and values, nulls and repeats included.

    A null or empty html, and one without any text outside the parts that
    never count, gives the empty text. Whole pages are parsed; broken markup
    never fails. Other columns are ignored, an empty table gives no rows.
    """
    small_batches(spark)

    def run(batches):
        for b in batches:
            texts = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    own = only(pages, page_id=page_id, url=url, html=html)
    kinds = dict(own.dtypes)
    return own.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
