"""Main text of web pages: the maximum-scoring contiguous region of words and tags.

A page becomes a sequence of words and tags, each with its place: within the
page's mark (``article``, else ``main``), beside it, or on a page without one.
Words and tags score by weights learnt from labelled pages (``fit``): the log
odds of standing in the main text, for each kind and place.  A word scores at
most 1, a tag never more than a little below nought.  One linear scan finds the
contiguous region of greatest sum; the first of equal ones counts.  A mark's
border ends a region.

Within a mark, and on pages without one, words of elements that are no article
text by kind (menus, page headers and footers, asides, forms, scripts, adverts,
notices, reader comments) aren't words of the sequence; beside a mark all words
are, and it is their weights that keep them out.  An article that is a comment or the like, by its own
class or by an element around it, is no mark, nor one outside ``main``.

Text: character references decoded, white space inside a block as one blank,
blocks trimmed and joined by a newline in page order.  A null or empty page,
or one without a word, gives an empty text.  Each page is judged by itself;
repeated rows, null ids and null urls stay; unclosed and stray tags are
tolerated.  Time grows in proportion to a page's length, whatever it holds.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, small_batches

OPENING = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[a-zA-Z][a-zA-Z0-9:-]*+)")
QUOTE = re.compile(r"[>\"']")
#: Kinds of elements.
RAW = frozenset("script style noscript template iframe svg math textarea xmp object".split())
SKIP = frozenset("head title nav footer aside form menu dialog select button input label fieldset figure".split()) - {"figure"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Class, id and role words of elements that are no article text.
NOISE = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notices?|alert|newsletter|subscribe|subscription|signup|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|site-header|page-header|topbar|comments?|commentlist|disqus|respond|replies|related|recommended|share|sharing|social|popup|modal|overlay|login|search|widget|pagination|pager|toolbar|complementary|contentinfo|skip-link|paywall)(?:$|[\s_-])", re.I)
#: Whole class, id and role words by which an article itself is a comment, a promotion and the like.
OWN_NOISE = re.compile(r"(?:(?:user|reader|guest|post|blog|article|single)[_-])?(?:ads?|adverts?|advertisements?|sponsor(?:ed)?|promo(?:tion)?s?|cookies?|newsletter|comments?|commentlist|disqus|respond|reply|replies|related|recommended|popup|widget|sidebar)(?:[_-](?:body|item|content|inner|box|card|list|entry|text|wrap|wrapper|block|\d+))*", re.I)
OWN_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true)|display\s*:\s*none", re.I)
#: Most that a word scores or costs; what a tag that no labelled page has costs, and the least and the most that any costs.
WORD_SCORE, OTHER_TAG, LEAST_TAG, MOST_TAG = 1.0, -1.0, -0.02, -1.5
#: Stand around the main text of a labelled page.
FIRST, LAST = "\ue000", "\ue001"

#: Labelled pages of pages without a mark: [[ and ]] stand around the main text.  ``labelled_sample`` adds pages with one.
LABELLED = [
    "<body><div><a>Home</a><a>News</a><a>About</a></div><div>[[<h1>The river in spring</h1><p>Water rises early this year and the banks are wet.</p><p>Nobody had <b>seen</b> such a flood before, they said.</p>]]</div><div><ul><li><a>Next</a></li><li><a>Older</a></li></ul></div></body>",
    "<body><table><tr><td><a>Start</a></td><td><a>Shop</a></td></tr></table>[[<h2>A note on bread</h2><p>Flour, water and salt are all that it takes.</p><ul><li>Knead for ten minutes.</li><li>Let it rest for a night.</li></ul><p>Bake it hot and <i>long</i>.</p>]]<div><span>Call us</span><span>Mon to Fri</span></div></body>",
    "<body><ul><li><a>One</a></li><li><a>Two</a></li><li><a>Three</a></li></ul><div><section>[[<p>The council met on Tuesday to talk about the bridge.<br>It will be closed until autumn.</p><blockquote>We regret it, the mayor said.</blockquote><p>Buses go by the old road.</p>]]</section></div><div><a>Top</a> <a>Imprint</a></div></body>",
    "<body><div><img><a>Logo</a></div><div><span>12 May</span></div><div>[[<p>Old maps show a mill where the school is now.</p><p>It burnt down in a dry summer, and a <a>chronicle</a> tells of the fire at some length.</p><h3>What remains</h3><p>A wall, a well and a name.</p>]]</div><div><a>A</a> | <a>B</a> | <a>C</a></div></body>",
]


def _noise(tag: str, attrs: str) -> bool:
    if not attrs:
        return False
    if HIDDEN.search(attrs):
        return True
    return tag not in ("html", "body", "article", "main") and any(NOISE.search(m[0] or m[1] or m[2]) for m in NAMED.findall(attrs))


def _own_noise(attrs: str) -> bool:
    return bool(attrs) and (bool(HIDDEN.search(attrs)) or any(OWN_NOISE.fullmatch(w) for m in OWN_NAMED.findall(attrs) for w in (m[0] or m[1] or m[2]).split()))


class _Page:
    """A page's tags, each found once."""

    def __init__(self, page: str):
        self.page = page
        self.dead: set[int] = set()  # quotes from which no tag ends
        self.quiet = len(page) + 1  # from here on no ">" or quote stands
        self.open: dict[str, bool] = {}

    def _end(self, at: int) -> int:
        """Where the tag ends whose attributes begin at ``at``; -1 if it doesn't outside of quotes."""
        seen = []
        while at < self.quiet:
            m = QUOTE.search(self.page, at)
            if not m:
                self.quiet = at
                break
            if m[0] == ">":
                return m.start()
            if m.start() in self.dead:
                break
            seen.append(m.start())
            at = self.page.find(m[0], m.start() + 1) + 1
            if not at:
                break
        self.dead.update(seen)
        return -1

    def tags(self) -> Iterator[tuple[str, str, bool, str]]:
        """(text before, name, whether it closes, attributes); comments and the like have no name, raw elements are left out."""
        page, at, from_ = self.page, 0, 0
        last = page.rfind(">")
        while m := OPENING.search(page, at):
            mark = m[0]
            if mark in ("<!--", "<![CDATA["):
                close = "-->" if mark == "<!--" else "]]>"
                stop = page.find(close, m.end())
                end, name = len(page) if stop < 0 else stop + len(close), ""
            else:
                if m.end() > last:  # no tag ends any more
                    break
                name = "" if mark[1] in "!?" else mark.lstrip("</").lower()
                stop = self._end(m.end()) if name else -1
                stop = page.find(">", m.end()) if stop < 0 else stop
                end = stop + 1
            attrs = page[m.end() : stop] if name else ""
            yield page[from_ : m.start()], name, mark[1] == "/", attrs
            at = from_ = end
            if name in RAW and mark[1] != "/" and not attrs.rstrip().endswith("/"):
                got = re.compile(f"</{name}", re.I).search(page, at)
                stop = page.find(">", got.start()) if got else -1
                at = from_ = stop + 1 if stop >= 0 else len(page)
        yield page[from_:], "", False, ""

    def closed(self, name: str) -> bool:
        if name not in self.open:
            count = lambda x: len(re.findall(x, self.page, re.I))
            self.open[name] = count(rf"<{re.escape(name)}[\s>/]") > count(f"</{re.escape(name)}")
        return not self.open[name]


def sequence(page: str) -> list[tuple[str, str, str]]:
    """(kind, value, place) of a page: kind ``#`` for words and ``#a`` for a link's, ``|`` where a region may not cross, else a tag's name with value ``/`` if it ends an element.

    Words of elements that are no article text are left out within the mark, and
    on pages without one; their tags stay.  The mark is ``article``, but ``main`` where no article that counts lies in
    it; else ``main``; else there is none.  Places: in, off (the mark), none.
    """
    has_main = re.search(r"<main[\s>/]", page, re.I) is not None
    worded = lambda items: any(kind[0] == "#" and value.strip() and place != "off" for kind, value, place in items)
    first = None
    if re.search(r"<article[\s>/]", page, re.I):
        first, in_main = _scan(page, "article")
        if worded(first) and (in_main or not has_main):
            return first
    if has_main and worded(main := _scan(page, "main")[0]):
        return main
    if first is not None and worded(first):
        return first
    whole = _scan(page, None)[0]
    return whole if first is None or worded(whole) else _scan(page, "article", True)[0]


def _scan(page: str, mark: str | None, every: bool = False) -> tuple[list[tuple[str, str, str]], bool]:
    """The sequence for one mark, and whether words in it lie in ``main``; with ``every`` all marked elements count."""
    out: list[tuple[str, str, str]] = []
    held = _Page(page)
    skip: list[str] = []
    depth: Counter[str] = Counter()  # of the names in skip
    inside, mains, links, in_main = 0, 0, 0, False

    def push(name: str) -> None:
        skip.append(name)
        depth[name] += 1

    for text, name, close, attrs in held.tags():
        place = "none" if not mark else "in" if inside else "off"
        if text and (not skip or place == "off"):  # beside the mark the scan alone decides
            out.append(("#a" if links else "#", text, place))
            in_main |= place == "in" and mains > 0 and bool(text.strip())
        if not name or name in RAW:
            continue
        if name == "main":
            mains = max(0, mains + (-1 if close else 1))
        if name == "a":
            links = 0 if close else 1
        if name == mark and not (close and depth[name]):
            # an element left unclosed before the mark doesn't hide it
            hidden = not close and not every and bool(skip) and (inside or held.closed(skip[0]))
            noise = not close and not every and (_own_noise(attrs) or inside and _noise("div", attrs))
            if hidden or noise:
                out.append((name, "", place))
                push(name)
                continue
            skip.clear()
            depth.clear()
            links = 0
            inside = max(0, inside - 1) if close else inside + 1
            if inside == (0 if close else 1):
                out.append(("|", "", ""))
            continue
        if name in ("body", "html"):
            skip.clear()
            depth.clear()
        out.append((name, "/" if close else "", place))
        if name in VOID or attrs.endswith("/") and name not in BLOCK:
            continue
        if close:
            if depth[name]:  # unclosed elements within it end too
                while (last := skip.pop()) != name:
                    depth[last] -= 1
                depth[name] -= 1
        elif skip:
            if name in SKIP or name in ("div", "section", "ul", "ol", "table", "header", "article", "main", "span", "p", "li"):
                if name not in ("p", "li", "span") or skip[0] == name:
                    push(name)
        elif name in SKIP or name == "header" and not inside or _noise(name, attrs) or name == "article" and _own_noise(attrs):
            push(name)
    return out, in_main


def labelled_sample(pages: DataFrame, sample_pages: int = 200, most_chars: int = 200_000) -> list[str]:
    """Labelled pages from the pages that mark their article: ``sample_pages`` at most, those whose hashes are smallest, none beyond ``most_chars``.

    The sample is bounded, so the driver holds at most their product; who has
    pages labelled by hand gives those to ``extract`` instead.
    """
    html = as_text("html")
    marked = pages.where(html.rlike("(?i)<article[\\s>]") & html.rlike("(?i)</article>") & (F.length(html) <= most_chars)).select(html.alias("html"))
    rows = marked.orderBy(F.xxhash64("html"), "html").limit(sample_pages).collect()
    return [x for x in (labelled(r["html"]) for r in rows) if x]


def labelled(page: str) -> str | None:
    """A page with one article, ``FIRST`` and ``LAST`` within its marks."""
    begin, end = re.search(r"<article(?:\s[^>\"']*)?>", page, re.I), list(re.finditer(r"</article", page, re.I))
    if not begin or len(end) != 1 or end[0].start() < begin.end() or FIRST in page or LAST in page or _own_noise(begin[0]):
        return None
    return f"{page[: begin.end()]}{FIRST}{page[begin.end() : end[0].start()]}{LAST}{page[end[0].start() :]}"


def fit(pages: list[str]) -> dict[tuple[str, str], float]:
    """Each kind's weight by place: the log odds of standing in the main text, between the bounds above.

    A page with a mark counts twice, the second time with its mark taken for
    a plain element, so that pages without one have weights too.
    """
    inside: Counter[tuple[str, str]] = Counter()
    outside: Counter[tuple[str, str]] = Counter()
    for page in pages:
        page = page.replace("[[", FIRST).replace("]]", LAST)
        plain = re.sub(r"(</?)(?:article|main)\b", r"\1div", page, flags=re.I)
        for version in {page, plain}:
            main = False
            for kind, value, place in sequence(version):
                if kind[0] != "#":
                    (inside if main else outside)[kind, place] += kind != "|" and value != "/"
                    continue
                for part in re.split(f"([{FIRST}{LAST}])", value):
                    if part in (FIRST, LAST):
                        main = part == FIRST
                    else:
                        (inside if main else outside)[kind, place] += len(part.split())
    out = {}
    for key in {*inside, *outside}:
        odds = math.log((inside[key] + 0.5) / (outside[key] + 0.5))
        out[key] = max(-WORD_SCORE, min(WORD_SCORE, odds)) if key[0][0] == "#" else max(MOST_TAG, min(LEAST_TAG, odds))
    return out


def best_region(items: list[tuple[str, str, str]], weights: dict[tuple[str, str], float]) -> tuple[int, int]:
    """[first, last) of the contiguous items of greatest sum; a border ends a region.

    A kind that no labelled page has at a place: in a mark words score most and
    tags cost least, beside it words cost most; on other pages words score most.
    """
    best, span, total, first = 0.0, (0, 0), 0.0, 0
    for i, (kind, value, place) in enumerate(items):
        if kind == "|":
            total, first = 0.0, i + 1
            continue
        if kind[0] == "#":
            total += weights.get((kind, place), -WORD_SCORE if place == "off" else WORD_SCORE) * len(value.split())
        else:
            total += weights.get((kind, place), LEAST_TAG if place == "in" else OTHER_TAG)
        if total <= 0:
            total, first = 0.0, i + 1
        elif total > best:
            best, span = total, (first, i + 1)
    return span


def main_text(page: str | None, weights: dict[tuple[str, str], float]) -> str:
    if not page:
        return ""
    items = sequence(page)
    first, last = best_region(items, weights)
    return shown(items[first:last])


def shown(items: list[tuple[str, str, str]]) -> str:
    """The text of a region."""
    blocks, part = [], []

    def close() -> None:
        text = " ".join(_html.unescape("".join(part)).split())
        if text:
            blocks.append(text)
        part.clear()

    for kind, value, _ in items:
        if kind[0] == "#":
            part.append(value)
        elif kind in BLOCK:
            close()
        elif kind == "br":
            part.append(" ")
    close()
    return "\n".join(blocks)


def extract(pages: DataFrame, labelled_pages: list[str] | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars.  ``labelled_pages``: as ``LABELLED``; where none are given, those and ``labelled_sample``."""
    weights = fit(labelled_pages or LABELLED + labelled_sample(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [main_text(x, weights) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    small_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), as_text("url").alias("url"), as_text("html").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
