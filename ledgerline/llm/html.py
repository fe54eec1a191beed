"""Main-text extraction with a tree-structured graphical model over the DOM.

Every element that forms blocks and every run of text between them is a node with a hidden label, content or not. A
node's features (tag, words of its class, id and role; for text its length, link share and punctuation) depend on its
label, and a node's label depends on its parent's through a potential for its kind. Sum-product messages upward and
then downward give each text run its exact marginal; runs with a marginal of one half or more are the main text.

The potentials are smoothed counts over labelled pages: hand-labelled page patterns below, and a bounded sample of the
given pages that name their article by an ``article`` element.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import staged

SAMPLE_PAGES = 300  # pages of the table that are learned from, at most
SAMPLE_CHARS = 100_000  # code points of such a page, at most
SMOOTH = 0.05

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPLIT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")

# Fixed values of the HTML language.
UNSEEN = set("annotation annotation-xml script style template noscript svg iframe object canvas audio video select option button textarea datalist head title".split())
RAW = set("script style template noscript iframe textarea title svg".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter output picture progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
INLINE |= set("math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dt dd".split())
PARTS = set("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd td th tr table tbody thead blockquote pre figure figcaption".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
P_SCOPE = ("td", "th", "caption")  # a block inside one of these doesn't close a p around it
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}

#: Words that name parts of any page: where a name ends in such words, the word before them says what the element holds.
PART_WORDS = frozenset(
    "area article bar block body bottom box button card center column container count desktop element facebook first form group head "
    "heading holder icon image inner instagram item label last leaderboard left linkedin link list logo main media mobile module more new outer "
    "page panel part pinterest post primary product reading rectangle right row secondary section signup skyscraper slot spot story storie tab text this "
    "thread title toggle tool top topic twitter unit up us video whatsapp widget wrap wrapper youtube zone".split()
)


class Page:
    """Nodes of a page in document order: ``parent[i] < i``; a node with text is a leaf."""

    __slots__ = ("features", "kind", "parent", "text")

    def __init__(self, source: str) -> None:
        self.parent, self.kind = [-1], ["#root"]
        self.features: list[list[str]] = [[]]
        self.text: list[str | None] = [None]
        stack: list[tuple[str, int]] = [("#root", 0)]  # open elements that form blocks
        places: defaultdict[str, list[int]] = defaultdict(list)  # where in the stack each name is open
        lists: defaultdict[int, list[int]] = defaultdict(lambda: [0] * 4)  # texts, words, characters and linked ones of a list
        endless: set[str] = set()  # names without a closing tag in the rest of the page
        run: list[str] = []
        link = linked = 0
        at, size = 0, len(source)

        def flush() -> None:
            nonlocal linked
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                at_list = nearest(("ul", "ol"))
                if places["li"] and nearest(("li",)) > at_list > 0:  # items are alike: their list is measured once
                    self._add(stack[-1][1], "#text", [], text)
                    sums = lists[stack[at_list][1]]
                    for i, n in enumerate((1, text.count(" ") + 1, len(text), min(linked, len(text)))):
                        sums[i] += n
                else:
                    self._add(stack[-1][1], "#text", self._measures(text, linked), text)
            linked = 0

        def nearest(names: Iterable[str]) -> int:
            return max((places[n][-1] for n in names if places[n]), default=0)

        def cut(height: int) -> None:
            while len(stack) > height:
                places[stack.pop()[0]].pop()

        while at < size:
            token = _TOKEN.search(source, at)
            end = token.start() if token else size
            if end > at:
                run.append(source[at:end])
                if link:
                    linked += end - at
            if not token:
                break
            at = token.end()
            close, tag = token[1], token[2] or token[4]
            if close:
                close = close.lower()
                if close == "a":
                    link = 0
                elif close in INLINE:
                    pass
                elif places[close]:
                    flush()
                    cut(places[close][-1])
                elif close == "p":
                    flush()
                continue
            if not tag:
                continue
            tag = tag.lower()
            if tag in INLINE:
                if tag == "a":
                    link = 1
                elif tag == "br":
                    run.append(" ")
                continue
            if tag in RAW or tag in UNSEEN:
                if not (token[3] or token[5] or "").rstrip().endswith("/"):
                    if tag == "head":
                        stop = re.compile(r"</head\s*>|<body\b", re.I).search(source, at)
                        at = (stop.end() if stop[0][1] == "/" else stop.start()) if stop else at
                    elif tag not in endless or tag in RAW:
                        stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                        if not stop:
                            endless.add(tag)
                        at = stop.end() if stop else size if tag in RAW else at
                if tag not in INLINE:
                    run.append(" ")
                continue
            flush()
            link = 0
            if tag in CLOSES_P and nearest(("p",)) > nearest(P_SCOPE):
                cut(nearest(("p",)))
            if tag in CLOSED_BY and nearest(CLOSED_BY[tag]) > nearest(SCOPE[tag]):
                cut(nearest(CLOSED_BY[tag]))
            if tag in VOID or tag in ("html", "body"):
                continue
            places[tag].append(len(stack))
            stack.append((tag, self._add(stack[-1][1], tag, self._names(tag, token[3] or token[5] or ""), None)))
        flush()
        for i, (texts, words, chars, links) in lists.items():
            self.features[i] = [*self.features[i], f"items:{min((words // texts).bit_length(), 5)}", f"menu:{round(links / chars * 3)}"]

    def _add(self, parent: int, kind: str, features: list[str], text: str | None) -> int:
        self.parent.append(parent)
        self.kind.append(kind)
        self.features.append(features)
        self.text.append(text)
        return len(self.parent) - 1

    @staticmethod
    def _names(tag: str, attributes: str) -> list[str]:
        out = set() if tag == "li" else {f"tag:{tag}"}
        if attributes.strip():
            for name, value in _ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name in ("class", "id", "role", "itemprop", "aria-label"):
                    for single in [value] if name == "aria-label" else value.split():
                        words = _SPLIT.split(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", single).lower())
                        out |= {f"name:{w}" for w in _telling([w.removesuffix("s") for w in words if len(w) > 1])}
                elif name == "hidden" or name == "aria-hidden" and "true" in value or name == "style" and re.search(r"display\s*:\s*none", value):
                    out.add("name:hidden")
        return sorted(out)

    @staticmethod
    def _measures(text: str, linked: int) -> list[str]:
        words = text.count(" ") + 1
        share = min(1.0, linked / len(text))
        return [f"words:{min(words.bit_length(), 7)}", f"linked:{round(share * 3)}", f"ends:{text[-1] in '.!?…»”\"'}"]


def _telling(words: list[str]) -> list[str]:
    """The word of a name that says what its element holds: the last that isn't a part word, or else the first.

    ``share-price`` is a price and ``comment-on-war`` a war; ``share-buttons`` is a share, ``site-header`` a header.
    """
    at = len(words) - 1
    while at > 0 and words[at] in PART_WORDS:
        at -= 1
    return words[max(at, 0) : at + 1]


def _role(kind: str) -> str:
    """Which potential joins a node to its parent: text runs, parts of a text, and boxes around them."""
    return "text" if kind == "#text" else "part" if kind in PARTS else "box"


def _labels(page: Page, content: Counter) -> list[int]:
    """Labels of a page's nodes from the texts of its content runs: an element is content if it holds any of them."""
    y = [0] * len(page.parent)
    left = Counter(content)
    for i in range(len(page.parent) - 1, 0, -1):
        text = page.text[i]
        if text is not None and left[text] > 0:
            left[text] -= 1
            y[i] = 1
        y[page.parent[i]] |= y[i]
    return y


class Model:
    """Smoothed counts of the labelled pages as potentials."""

    def __init__(self, labelled: Iterable[tuple[Page, Counter]]) -> None:
        edges: Counter = Counter()
        features: tuple[Counter, Counter] = (Counter(), Counter())
        totals: tuple[Counter, Counter] = (Counter(), Counter())
        for page, content in labelled:
            y = _labels(page, content)
            for i in range(1, len(y)):
                edges[_role(page.kind[i]), y[page.parent[i]], y[i]] += 1
                totals[y[i]][page.kind[i] == "#text"] += 1
                features[y[i]].update(page.features[i])
        self.log_odds: dict[str, float] = {}
        for f in features[0] | features[1]:
            leaf = f.startswith(("words:", "linked:", "ends:"))
            n0, n1 = totals[0][leaf] + 8 * SMOOTH, totals[1][leaf] + 8 * SMOOTH
            self.log_odds[f] = math.log((features[1][f] + SMOOTH) / n1) - math.log((features[0][f] + SMOOTH) / n0)
        # edge[role][label of the parent][label of the node]
        self.edge = {}
        for role in ("text", "part", "box"):
            rows = []
            for p in (0, 1):
                n = [edges[role, p, c] + SMOOTH for c in (0, 1)]
                rows.append((n[0] / sum(n), n[1] / sum(n)))
            self.edge[role] = rows

    def marginals(self, page: Page) -> list[float]:
        """Probability that each node is content, by one upward and one downward pass of messages."""
        n = len(page.parent)
        belief = [sum(self.log_odds.get(f, 0.0) for f in fs) for fs in page.features]
        up = [0.0] * n
        for i in range(n - 1, 0, -1):
            (a00, a01), (a10, a11) = self.edge[_role(page.kind[i])]
            e = math.exp(max(-40.0, min(40.0, belief[i])))
            up[i] = math.log((a10 + a11 * e) / (a00 + a01 * e))
            belief[page.parent[i]] += up[i]
        for i in range(1, n):
            (a00, a01), (a10, a11) = self.edge[_role(page.kind[i])]
            e = math.exp(max(-40.0, min(40.0, belief[page.parent[i]] - up[i])))
            belief[i] += math.log((a01 + a11 * e) / (a00 + a10 * e))
        return [1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, b)))) for b in belief]

    def extract(self, source: str | None) -> str:
        """Content runs in page order, one per line."""
        page = Page(source or "")
        marginals = self.marginals(page)
        return "\n".join(t for t, p in zip(page.text, marginals, strict=True) if t is not None and p >= 0.5)


def labelled_patterns(pages: int = 600, seed: int = 3) -> Iterator[tuple[Page, Counter]]:
    """Hand-labelled page patterns: common ways to mark up an article and what stands around it."""
    r = random.Random(seed)
    syllables = "an be co du el fi ga ho in jo ka lu mi no or pa ri so ta ve".split()

    def words(n: int) -> str:
        return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(n))

    def sentence(n: int) -> str:
        return words(n).capitalize() + "."

    def links(n: int) -> str:
        return "<ul>" + "".join(f"<li><a href='/{i}'>{words(r.randint(1, 2))}</a></li>" for i in range(n)) + "</ul>"

    around = {
        "top": ["<header{}>{t}</header>", "<nav{}>{u}</nav>", "<div class='{}'>{u}</div>|menu|nav|navbar|header|top-bar|breadcrumb", "<div id='{}'>{t}</div>|header|masthead|site-header|banner|skip"],
        "side": ["<aside{}>{t}{u}</aside>", "<div class='{}'><h3>{h}</h3>{u}<p>{t}</p></div>|sidebar|widget|related|recommended|popular|promo|social|share|author-box|toc|tags", "<div class='{}'>{t}</div>|ad|ads|advert|advertisement|sponsored|sponsor|banner|promo"],
        "note": ["<p class='{}'>{t}</p>|ad|advert|advertisement|sponsored|copyright|newsletter|subscribe|share|notice|promo", "<ul class='{}'><li>{t}</li><li>{h}</li></ul>|share|tags|related|social|menu|breadcrumb|pagination", "<div class='{}'><p>{t}</p></div>|cookie|cookie-notice|consent|notice|alert|popup|modal|newsletter|subscribe|paywall|hidden", "<form{}><p>{t}</p><label>{h}</label></form>", "<div role='{}'><p>{t}</p></div>|alert|dialog|banner|complementary|search|navigation"],
        "talk": ["<section class='{}'><h3>{h}</h3><div class='{}'><p>{t}</p></div><div class='{}'><p>{l}</p></div></section>|comments|comment|reply|replies|discussion|responses", "<div id='{}'><h2>{h}</h2><ul><li><p>{t}</p></li><li><p>{l}</p></li></ul></div>|comments|disqus|reader-comments|comment-list"],
        "end": ["<footer{}>{t}</footer>", "<div class='{}'>{t}{u}</div>|footer|site-footer|copyright|legal|pagination|pager|bottom"],
    }

    def piece(where: str) -> str:
        pattern, *names = r.choice(around[where]).split("|")
        name = r.choice(names) if names else ""
        filled = pattern.replace("{t}", sentence(r.randint(1, 40))[: None if r.random() < 0.7 else -1]).replace("{l}", sentence(r.randint(2, 90))).replace("{h}", words(r.randint(1, 4))).replace("{u}", links(r.randint(2, 8)))
        return filled.replace("{}", name)

    for _ in range(pages):
        content: list[str] = []

        def paragraph(tag: str, n: int, keep: list[str] = content) -> str:
            text = sentence(n)
            if r.random() < {"p": 0.12, "pre": 0.5}.get(tag, 0.6):  # headings and items seldom end as sentences do
                text = text[:-1]
            keep.append(text)
            return f"<{tag}>{text}</{tag}>"

        body = []
        if r.random() < 0.8:
            body.append(paragraph("h1", r.randint(1, 10)))
        for _ in range(r.randint(1, 9)):
            x = r.random()
            if x < 0.72:
                body.append(paragraph("p", r.choice((1, 2, 5, 12, 30, 60, 120))))
            elif x < 0.82:
                body.append(paragraph(r.choice(("h2", "h3")), r.randint(1, 7)))
            elif x < 0.85:
                items = [words(r.randint(1, 6)) for _ in range(r.randint(2, 6))]
                content += items
                body.append("<ul>" + "".join(f"<li><a href='/{i}'>{t}</a></li>" for i, t in enumerate(items)) + "</ul>")
            elif x < 0.89:
                body.append("<ul>" + "".join(paragraph("li", r.choice((1, 3, 6, 12, 25, 50))) for _ in range(r.randint(2, 4))) + "</ul>")
            elif x < 0.92:
                body.append("<blockquote>" + paragraph("p", r.randint(6, 30)) + "</blockquote>")
            elif x < 0.95:
                body.append(paragraph("pre", r.randint(3, 12)))
            elif x < 0.97:
                body.append("<table><tr>" + paragraph("td", 3) + paragraph("td", 4) + "</tr></table>")
            else:
                body.append("<figure>" + paragraph("figcaption", 6) + "</figure>")
        inner = "".join(body)
        cut = r.randint(0, len(body))
        if r.random() < 0.35:
            inner = "".join(body[:cut]) + piece(r.choice(("side", "note"))) + "".join(body[cut:])
        if r.random() < 0.35:
            inner += piece("talk")
        open_, close = r.choice((("<article>", "</article>"), ("<article class='post'>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ("<div class='content'>", "</div>"), ("<div id='main-content'><div class='article-body'>", "</div></div>"), ("<div class='entry'>", "</div>"), ("<div class='post-text'>", "</div>"), ("<section class='story'>", "</section>"), ("<div>", "</div>"), ("<div role='main'>", "</div>")))
        page = piece("top") + (piece("note") if r.random() < 0.4 else "") + (piece("side") if r.random() < 0.4 else "")
        page += open_ + inner + close
        page += (piece("side") if r.random() < 0.4 else "") + (piece("talk") if r.random() < 0.25 else "") + (piece("end") if r.random() < 0.9 else "")
        if r.random() < 0.4:
            page = f"<div class='{r.choice(('page', 'wrapper', 'container', 'site'))}'>{page}</div>"
        yield Page(f"<html><body>{page}</body></html>"), Counter(content)


#: Names (as features hold them, without a final s) that set their element apart from the text around it, whatever else it is named.
APART = frozenset(f"name:{w}" for w in "ad advert advertisement sponsor sponsored promo banner comment reply replie discussion response disqu share social related recommended newsletter subscribe cookie consent notice alert popup modal paywall hidden copyright pagination breadcrumb sidebar widget".split())


def _set_apart(names: list[str], patterns: Model) -> bool:
    """Whether an element's names mark it as no content: one of ``APART``, or names that the patterns hold for none."""
    return not APART.isdisjoint(names) or sum(patterns.log_odds.get(f, 0.0) for f in names) < 0


def labelled_by_article(source: str, patterns: Model) -> tuple[Page, Counter] | None:
    """A page labelled by its only ``article`` element, less what names itself otherwise inside it.

    A name that ``patterns`` doesn't know is a wrapper like any other: what it holds is content.
    """
    page = Page(source)
    if page.kind.count("article") != 1:
        return None
    within = [False] * len(page.parent)
    content: Counter = Counter()
    outside = {"nav", "aside", "footer", "form", "header"}
    for i in range(1, len(within)):
        within[i] = page.kind[i] == "article" or within[page.parent[i]] and page.kind[i] not in outside
        if within[i] and page.kind[i] != "article" and _set_apart([f for f in page.features[i] if f.startswith("name:")], patterns):
            within[i] = False
        if within[i] and page.text[i] is not None:
            content[page.text[i]] += 1
    return page, content


def train(pages: DataFrame | None = None, sample_pages: int = SAMPLE_PAGES) -> Model:
    """Fit on the patterns and on at most ``sample_pages`` pages with one ``article`` element (smallest hash of page_id).

    Pages of more than ``SAMPLE_CHARS`` code points teach nothing; together the two bound what the driver holds.
    """
    labelled = list(labelled_patterns())
    if pages is not None:
        short = pages.filter(F.length("html") <= SAMPLE_CHARS)
        named = short.filter(F.contains(F.lower("html"), F.lit("<article"))).select("page_id").filter("page_id is not null")
        chosen = staged(named.distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages), "html-sample")
        rows = short.select("page_id", "html").join(chosen, "page_id").select("html").limit(sample_pages).collect()
        patterns = Model(labelled)
        labelled += [x for x in (labelled_by_article(source, patterns) for source in sorted(r.html for r in rows)) if x]
    return Model(labelled)


def extract(pages: DataFrame, model: Model, source: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of each page; empty for a null or empty page and for one without content.

    The text becomes the column ``name``, in place of an input column of that name.
    """
    shared = pages.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))  # bounded: one number per feature of the sample

    @F.arrow_udf("string")
    def main_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = cloudpickle.loads(shared.value)
        for sources in batches:
            yield pa.array([own.extract(s.as_py()) for s in sources], pa.string())

    return pages.withColumn(name, main_text(F.coalesce(F.col(source).cast("string"), F.lit(""))))
