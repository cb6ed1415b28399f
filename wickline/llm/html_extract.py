"""HTML extraction by the maximum-scoring subsequence of words and tags.

A page is read as a sequence of text runs and tags. A word scores by the log
odds of its open elements, class and id words to hold content, a tag scores
below zero by how common it is outside of content; both come from ``LABELLED``,
a small table of labelled pages. One linear scan finds the contiguous stretch
with the largest sum. Within it, runs of a negative score (an advert between two
paragraphs) are left out, so that only the article's own blocks remain.

Defined cases: a null or empty page, or one without a scoring word, has empty
text; unknown elements and attributes score nothing; an unclosed comment, script
or style reaches to the end of the page, an unfinished tag is dropped; stray end
tags are ignored; repeated rows and null ids or urls are answered each; an empty
table gives an empty result; further columns are not touched.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable, Container, Iterable, Iterator
from functools import cache

from pyspark.sql import DataFrame

from wickline.llm.common import per_text

#: The labelled pages. ``[[`` and ``]]`` stand around content.
LABELLED = (
    """<html><body><header class="site-header masthead" id="top"><a href="/">The Daily</a> <span class="tagline">news for all</span></header>
    <nav class="navbar main-nav menu" role="navigation"><ul class="nav"><li class="menu-item"><a>Home</a></li><li><a>World</a></li><li><a>Sport</a></li></ul></nav>
    <div class="breadcrumbs breadcrumb"><a>Home</a> / <a>World</a> / here</div>
    <div class="cookie-notice cookie-banner consent" id="cookies" role="dialog">We use cookies to improve this site <button class="btn">Accept all</button></div>
    <article class="post story"><h1>[[River town rebuilds its bridge]]</h1><p>[[After two years of work the old bridge over the river is open again and many came to see it.]]</p>
    <div class="advert ad-slot ads">Buy two and get one for free only today</div><p>[[The mayor said that the work had cost less than was planned, and thanked all who had helped.]]</p>
    <h2>[[What comes next]]</h2><p>[[A second bridge further down is to follow in the coming year.]]</p><ul><li>[[new lamps along the way]]</li><li>[[a path for bicycles]]</li></ul></article>
    <aside class="sidebar widget-area" id="sidebar" role="complementary"><div class="widget"><h3 class="widget-title">Most read</h3><ul><li><a>Ten tips for the garden</a></li><li><a>Why the train was late</a></li></ul></div></aside>
    <section class="comments comment-list" id="comments"><h3>Two comments</h3><div class="comment"><p>I was there and it was great.</p><a class="reply">Reply</a></div><div class="comment-body"><p>Far too dear if you ask me, they should not have done it at all.</p></div></section>
    <footer class="footer site-footer" role="contentinfo"><p>Copyright The Daily. All rights reserved.</p><a>Imprint</a> <a>Privacy</a></footer></body></html>""",
    """<body><div id="header" class="header top-bar topbar"><div class="logo">Kitchen notes</div><form class="search search-form" role="search"><label>Search</label><input><button>Go</button></form></div>
    <div id="menu" class="menu navigation"><a>Recipes</a> <a>About</a> <a>Contact us</a></div>
    <div id="content" class="content main-content entry"><h1 class="entry-title title">[[Bread without kneading]]</h1><div class="entry-content post-content article-body"><p>[[Mix flour, water and salt in the evening and let the dough rest until the <b>next</b> morning.]]</p>
    <p>[[Heat the oven with the pot inside, then bake for <a href="/t">forty minutes</a> and let it cool before you cut it.]]</p><blockquote><p>[[Good bread needs time more than work.]]</p></blockquote><p>[[Enjoy.]]</p></div>
    <div class="share social share-buttons social-links"><span>Share this</span> <a>Mail</a> <a>Print</a></div><div class="related related-posts recommended"><h3>You may also like</h3><a>Rolls with seeds</a> <a>Sweet buns</a></div>
    <div class="promo newsletter subscribe signup"><p>Get our letter each week in your inbox</p><form><input><button>Subscribe now</button></form></div></div>
    <div class="respond comment-respond" id="respond"><h3>Leave a reply</h3><form class="comment-form"><textarea>your words</textarea><button>Post comment</button></form></div>
    <div id="footer" class="footer bottom copyright legal"><p>Made with care by the kitchen team</p></div></body>""",
    """<body><div class="alert notice notification announcement" role="alert">Our service will be down on Sunday night for a short time</div><div class="modal popup overlay lightbox" hidden>Join our club and save ten percent on all you buy</div>
    <main role="main" class="main page"><section class="section"><h1>[[How bees find their way]]</h1><p>[[Bees remember the place of the sun and the look of the land around the hive.]]</p><figure><img><figcaption>[[A bee on a flower in May]]</figcaption></figure>
    <p>[[On cloudy days they use the pattern of <a href="/light">the light in the sky</a>.]]</p><pre><code>[[turn left at the oak]]</code></pre><table><tr><th>[[place]]</th><td>[[metres from the hive]]</td></tr></table><aside class="pullquote-ad sponsored sponsor">Sponsored by the honey shop in town</aside><p>[[That is how they come home.]]</p></section></main>
    <div class="sidebar side right-rail rail"><div class="trending popular">Popular now: <a>The price of wax</a></div><div class="banner advertisement sponsor">Honey at half price this week</div><div class="tags tag-cloud"><a>bees</a> <a>sun</a></div></div>
    <div id="disqus_thread" class="discussion replies reviews"><div class="reply"><p>My father kept bees and always said the same about them.</p></div></div>
    <div class="pagination pager"><a>Older</a> <a>Newer</a></div><div role="contentinfo" class="colophon"><ul><li><a>Terms</a></li><li><a>Jobs</a></li></ul></div></body>""",
    """<body><a class="skip-link skip">Skip to content</a><div role="banner" class="banner brand">Weather Watch</div><div class="dropdown toolbar"><ul><li>Login</li><li>Register</li></ul></div>
    <article><header><h1>[[Storm passes north of the coast]]</h1></header><section><h2>[[Morning]]</h2><p>[[The wind had fallen by the morning and the boats went out again.]]</p><div>[[No one was hurt, and the roads were clear by noon.]]</div></section>
    <section><p>[[More rain is due.]]</p><ol><li>[[Stay off the pier.]]</li></ol><p><em>[[Take care on the way home.]]</em></p></section><footer><p>Filed under weather</p></footer></article>
    <div class="comments-area user-comments"><article class="comment"><p>It was loud here all night and the fence is gone.</p></article><article class="comment"><p>Same here, and the shed too.</p></article></div>
    <div class="cta call-to-action promotion offer">Download the app today</div><noscript>Please turn on scripts</noscript><footer><small>Weather Watch and its partners</small></footer></body>""",
    """<body><table class="layout"><tr><td class="leftnav side-nav"><a>Start</a><br><a>Archive</a><br><a>Links</a></td><td><h1>[[On old maps]]</h1><p>[[Old maps tell as much of <a href="/m">their makers</a> as of the land.]]</p><p>[[Many coasts were drawn from tales alone.]]</p></td>
    <td class="adsense adbox ad"><div class="sponsored-links">Cheap frames for maps and prints</div></td></tr></table><div class="disclaimer">The views here are my own</div><div class="author-box bio byline">About the writer of this page</div><div class="gdpr privacy cookiebar">This site stores cookies</div></body>""",
    """<body><div class="wrapper container"><div class="row"><div class="post-body text article-text"><h2>[[A walk in the hills]]</h2><p>[[We set out early and saw no one until the pass.]]</p><p>[[From <a>there the path</a> goes down to a lake, where we ate and rested.]]</p><dl><dt>[[length]]</dt><dd>[[nine miles in all]]</dd></dl></div>
    <div class="feedback rating poll survey">Was this page of use to you? <button>Yes</button></div><div class="hidden sr-only" aria-hidden>for screen readers only</div><nav><a>Next walk</a></nav></div></div></body>""",
)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section select summary "
    "table tbody textarea tfoot thead title tr ul".split()
)
_CELL = frozenset(("td", "th"))
_PROSE = frozenset(("p", "blockquote", "dd", "figcaption", "em"))
#: Elements whose content is not markup. That of the first four is no text of the page either.
_RAW = ("script", "style", "iframe", "noembed", "title", "textarea", "xmp")
_SILENT = frozenset(("script", "style", "iframe", "noembed", "title", "template", "svg", "head"))
#: A start tag of the key ends an open element of these kinds.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LISTS = ("table", "ul", "ol", "dl", "select")
_SCOPE = frozenset(("table", "ul", "ol", "dl", "select", "button", "article", "section", "div", "td", "th"))
#: Features that the reading itself asks for.
_OWN = _SILENT | _PROSE | {"article", "!article"}

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|"""
    r"""<(?P<end>/?+)(?P<name>[A-Za-z][^\s/>]*+)""",
    re.DOTALL,
)
_STOP = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))|\b(hidden|aria-hidden)\b""", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in _RAW}
#: A word's score before its context, the bounds of that score, and those of one feature and one tag.
#: What is not content costs little, so that a short paragraph behind an advert still belongs to the region.
FIRST, WORD, FEATURE, TAG = 1.0, (-0.05, 4.0), (-5.0, 2.0), (-0.3, -0.02)


def _features(name: str, rest: str) -> list[str]:
    found = [name]
    if rest:
        for key, a, b, c, flag in _ATTRIBUTE.findall(rest):
            if flag:
                found.append(".hidden")
            else:
                # A role counts as the word it is; class and id are split into words.
                found += [f".{part.lower()}" for part in _PART.findall(a or b or c) if len(part) > 1]
        if _HIDDEN.search(rest):
            found.append(".hidden")
    return found


def _tag_ends(page: str) -> Callable[[int], int]:
    """A function from the end of a tag's name to the place of its ">", or the page's end.

    Quoted values of any length may hold ">"; if a quote is never closed, the
    first ">" counts. Quotes that lead to such a one are remembered, so each is
    followed once and a page takes linear time.
    """
    unclosed: set[int] = set()

    def end(at: int) -> int:
        here, passed = at, []
        while m := _STOP.search(page, here):
            place = m.start()
            if page[place] == ">":
                return place
            passed.append(place)
            close = -1 if place in unclosed else page.find(page[place], place + 1)
            if close < 0:
                unclosed.update(passed)
                first = page.find(">", at)
                return first if first >= 0 else len(page)
            here = close + 1
        return len(page)

    return end


class _Open:
    """The open elements, outermost first, and where in the stack those of each name are."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, list[str]]] = []
        self.places: dict[str, list[int]] = {}

    def push(self, name: str, features: list[str]) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, features))

    def pop(self) -> tuple[str, list[str]]:
        self.places[self.stack[-1][0]].pop()
        return self.stack.pop()

    def innermost(self, names: Iterable[str]) -> int:
        """The place of the innermost open element of these names, -1 if there is none."""
        return max((places[-1] for name in names if (places := self.places.get(name))), default=-1)


def events(page: str, known: Container[str] | None = None) -> Iterator[tuple[str, str, Counter, bool]]:
    """Runs and tags in order: (kind, text or tag name, open features, whether a block begins here).

    ``kind`` is "text", or "tag". The features are live: read them before the next event.
    With ``known``, no other features than these and the parser's own are told.
    """
    inside: Counter = Counter()
    opened = _Open()
    stack = opened.stack
    articles = bool(re.search(r"<article[\s>]", page, re.IGNORECASE))
    if articles:
        inside["!article"] += 1

    def pop() -> None:
        name, features = opened.pop()
        for feature in features:
            inside[feature] -= 1
            if not inside[feature]:
                del inside[feature]
        if name == "article" and articles and not inside.get("article"):
            inside["!article"] += 1

    at, size, tag_end = 0, len(page), _tag_ends(page)
    while at < size:
        mark = page.find("<", at)
        m = _MARKUP.match(page, mark) if mark >= 0 else None
        while mark >= 0 and m is None:  # a bare "<" is text
            mark = page.find("<", mark + 1)
            m = _MARKUP.match(page, mark) if mark >= 0 else None
        if mark < 0:
            mark = size
        if mark > at:
            yield "text", page[at:mark], inside, False
        if m is None:
            break
        at = m.end()
        if not m["name"]:
            continue
        name, stop = m["name"].lower(), tag_end(at)
        rest, at = page[at:stop], min(stop + 1, size)
        block = name in _BLOCK
        if m["end"]:
            depth = opened.innermost((name,))
            while 0 <= depth < len(stack):
                pop()
            yield "tag", name, inside, block
            continue
        if block and name not in ("button", "option", "label", "select", "textarea", "legend", "title"):
            paragraph = opened.innermost(("p",))  # a block ends an open paragraph
            if paragraph > opened.innermost(_SCOPE):
                while len(stack) > paragraph:
                    pop()
        if name in _ENDS:
            ended = opened.innermost(_ENDS[name])
            if ended > opened.innermost(_LISTS):
                while len(stack) > ended:
                    pop()
        if name == "body":
            while opened.places.get("head"):
                pop()
        yield "tag", name, inside, block
        if name in _VOID:
            continue
        own = list(dict.fromkeys(_features(name, rest)))
        if name == "a" and not _PROSE.isdisjoint(inside):
            own[0] = "p a"  # a link within a sentence is not a menu
        if known is not None:
            own = [f for f in own if f in known or f in _OWN]
        for feature in own:
            inside[feature] += 1
        if name == "article":
            inside.pop("!article", None)
        opened.push(name, own)
        if name in _RAW_END:
            ended = _RAW_END[name].search(page, at)
            stop = ended.start() if ended else size
            if stop > at and name not in _SILENT:
                yield "text", page[at:stop], inside, False
            at = stop


class Weights:
    """Log odds of features and tags, learned from pages with ``[[`` and ``]]`` around content."""

    def __init__(self, pages: tuple[str, ...] = LABELLED) -> None:
        inside, outside, totals = Counter(), Counter(), Counter()
        tags_in, tags_out = Counter(), Counter()
        for page in pages:
            marked = page.index("[["), page.rindex("]]")
            seen, content = 0, False
            for kind, text, features, _ in events(page):
                seen = page.find(text, seen) if kind == "text" else seen
                if kind == "tag":
                    (tags_in if marked[0] <= seen <= marked[1] else tags_out)[text] += 1
                    continue
                content = content or "[[" in text
                words = len(text.split())
                totals[content] += words
                for feature in features:
                    (inside if content else outside)[feature] += words
                content = content and text.rfind("]]") <= text.rfind("[[")
        self.features = {
            f: max(FEATURE[0], min(FEATURE[1], math.log((inside[f] + 0.5) / (totals[True] + 1)) - math.log((outside[f] + 0.5) / (totals[False] + 1))))
            for f in {*inside, *outside} - {"html", "body"}
        }
        total_in, total_out = sum(tags_in.values()), sum(tags_out.values())
        self.tags = {
            t: max(TAG[0], min(TAG[1], 0.1 * (math.log((tags_in[t] + 0.5) / (total_in + 1)) - math.log((tags_out[t] + 0.5) / (total_out + 1))) - 0.1))
            for t in {*tags_in, *tags_out}
        }

    def word(self, features: Counter) -> float:
        if _SILENT & features.keys():
            return WORD[0]
        get = self.features.get
        return max(WORD[0], min(WORD[1], FIRST + sum(get(f, 0.0) for f in features)))

    def tag(self, name: str) -> float:
        return self.tags.get(name, -0.1)


@cache
def trained() -> Weights:
    return Weights()


def scored_runs(page: str, weights: Weights) -> Iterator[tuple[float, str | None, bool]]:
    """Per event: its score, its text if it counts as content, and whether a block begins with it."""
    for kind, text, features, block in events(page, weights.features):
        if kind == "tag":
            yield weights.tag(text), " " if text == "br" or text in _CELL else None, block
        else:
            score = weights.word(features)
            yield score * len(text.split()), text if score > 0 else None, block


def best_region(scores: Iterable[float]) -> tuple[int, int]:
    """First and last (exclusive) place of the contiguous stretch with the largest sum, in one scan; none above 0: empty."""
    best = total = 0.0
    start, region = 0, (0, 0)
    for place, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, place
        total += score
        if total > best:
            best, region = total, (start, place + 1)
    return region


def main_text(page: str, weights: Weights) -> tuple[str, int, int]:
    """The article's blocks joined by line feeds, and the first and last event of the region."""
    runs = list(scored_runs(page, weights))
    region = best_region(score for score, _, _ in runs)
    blocks, current = [], []
    for _, piece, block in runs[region[0] : region[1]]:
        if block and current:
            blocks.append("".join(current))
            current = []
        if piece:
            current.append(piece)
    blocks.append("".join(current))
    clean = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b), *region


def extract(pages: DataFrame, labelled: tuple[str, ...] = LABELLED) -> DataFrame:
    """Per row: page_id, url, text, n_chars, and the region as numbers of its first and last event."""

    def make() -> Callable[[str], tuple]:
        weights = trained() if labelled is LABELLED or labelled == LABELLED else Weights(labelled)

        def extracted(page: str) -> tuple:
            text, first, last = main_text(page, weights)
            return text, len(text), first, last

        return extracted

    fields = "text string, n_chars long, first_event int, last_event int"
    return per_text(pages, ["page_id", "url"], make, fields, text="html")
