"""HTML extraction (operator 7): a linear-chain conditional random field over the leaf blocks of a page.

A page is read once into its leaf blocks: runs of text and inline markup between block-level tags, with the
elements around them. A block's features are its ancestors (tags, and words of their class and id), the
length, links and ending of its text, and its place on the page. Names say nothing where they are those of the
page (``html``, ``body``, ``main``) or of what holds its story (``_story``). The field has the labels "article" and
"other", weights for the features and for the steps between labels, and is decoded by Viterbi.

It is trained by gradient ascent on two kinds of pages, none of which is labelled by what it is shown by. At most TRAIN_PAGES pages of the
table (of at most TRAIN_BYTES and TRAIN_BLOCKS) are labelled by their own markup: blocks in an ``article`` or ``main`` element are article, but for
those in elements that name themselves menus, forms, adverts, comments and the like. They are learned as they are, without sectioning
tags and names, and without any markup at all, by their texts and neighbours alone. MADE pages are composed of parts that are known to be
article or other (``made_pages``) in layouts of all kinds - sectioning tags, names, opaque names, tables, bare sections - so that the field also
learns what the table's pages lack, and how far each sign can be trusted. All weights begin at 0 and are pulled towards it.

Plan: one scan with three columns, no shuffle; the weights are broadcast (under 100 numbers).

Cases: null and empty pages, and pages without an article, give an empty text. Broken markup is read as
browsers do: open elements end with their parents, unknown end tags are skipped, a tag that never closes is
text. Long pages are read whole. Rows with null or repeated ids are returned each; other columns aren't read.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES, TRAIN_BYTES, TRAIN_BLOCKS, MADE, ROUNDS = 100, 200_000, 2000, 500, 400
TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*+)([^>]*+)>|<[!?/][^>]*+>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
TITLE = re.compile(r"<title[^>]*>([^<]{0,2000})", re.I)
#: Elements whose content is not text of the page.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "textarea", "object", "canvas", "audio", "video", "title", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: What an opening tag ends, if it is open and nothing of the second set lies between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
SCOPE = {"table", "td", "th", "button", "object", "body", "html", "div", "section", "article", "main", "aside", "nav", "header", "footer", "form", "li", "blockquote", "figure"}

TAGS = "article main nav header footer aside form section ul ol table blockquote figure figcaption pre button fieldset dialog h1 h2 h3 h4 h5 h6 p div li td head".split()
SECTIONING = {"article", "main", "nav", "header", "footer", "aside", "section"}
NAMES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager tabs skip toc",
    "head": "header masthead banner branding logo topline",
    "foot": "footer foot copyright colophon legal",
    "side": "sidebar aside widget related recommended recommendations more popular trending teaser tags tagcloud",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay paywall disclaimer",
    "comment": "comment comments commentlist reply replies respond disqus discussion reader reviews",
    "form": "form login signin signup search subscribe subscription newsletter register contact",
    "share": "share sharing social follow print toolbox",
    "author": "meta byline author date published timestamp",
    "hidden": "hidden invisible screen-reader sr-only visually-hidden",
    "body": "article content post entry story text body main articlebody post-content entry-content page",
}
#: Parts of a name that tell what a page has or does: such names are matched as a whole only.
STATES = set("has no not with without is open opened closed enabled disabled fixed".split())
OUT = ("menu", "foot", "side", "advert", "notice", "comment", "form", "share", "hidden")
OUT_TAGS = {"nav", "aside", "footer", "form", "button", "dialog"}
WORD_NAMES = {w: k for k, words in NAMES.items() for w in words.split()}
LENGTHS = (2, 5, 12, 30, 80)
TEXTS = ["one", "links0", "links1", "links2", "stop", "phrase", "first", "last"] + [f"words{i}" for i in range(len(LENGTHS) + 1)]
#: What stands around a block: long texts next to it, within NEAR blocks, anywhere before and after, in the same holder and in the one around it; and whether the page's title has its text.
TEXTS += ["long", "long_before", "long_after", "near_before", "near_after", "all_before", "all_after", "links_before", "links_after", "titled", "with_long", "under_long"]
LONG, NEAR = 12, 3
#: Elements that hold blocks which belong together.
HOLDERS = {"article", "aside", "body", "center", "dd", "dialog", "div", "fieldset", "footer", "form", "header", "main", "nav", "section", "td", "th"}
FEATURES = [f"in_{t}" for t in TAGS] + [f"named_{n}" for n in NAMES] + ["header_in_article", *TEXTS]
AT = {f: i for i, f in enumerate(FEATURES)}
PHRASES = re.compile(r"©|copyright|all rights reserved|cookies?\b|sign in|log in|subscribe|newsletter|privacy policy|terms of|read more|click here|share this|advertisement|sponsored|leave a (?:comment|reply)", re.I)
#: Weights: of the features, then a bias, the first block's, and the steps other-article, article-other, article-article.
WEIGHTS = len(FEATURES) + 5


# --- pages to blocks ---------------------------------------------------------------------------------------


def _named(attributes: str) -> frozenset[str]:
    if "=" not in attributes and "hidden" not in attributes:
        return frozenset()
    found = set()
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            found.add("hidden")
        for word in value.split():
            parts = re.split(r"[-_]+", word)
            for w in (word, *([] if STATES.intersection(parts) else parts)):
                if w in WORD_NAMES:
                    found.add(WORD_NAMES[w])
        if name == "role":
            found |= {"navigation": {"menu"}, "banner": {"head"}, "contentinfo": {"foot"}, "complementary": {"side"}, "search": {"form"}, "main": {"body"}, "article": {"body"}}.get(value, set())
    return frozenset(found)


class Element:
    """An element: tag, names, its parent; then what its blocks first .. last hold. ``number`` .. ``until`` are those inside it."""

    __slots__ = ("tag", "names", "parent", "number", "until", "hidden", "tags", "first", "last", "chars", "linked", "prose", "title", "mask")

    def __init__(self, tag: str, attributes: str, parent: Element | None, number: int):
        self.tag, self.names, self.parent, self.number, self.until = tag, _named(attributes), parent, number, number
        self.hidden = "hidden" in self.names and bool(re.search(r"(?:^|\s)(?:hidden(?![\w-])|aria-hidden\s*=\s*[\"']?true)", re.sub(r"""=\s*(?!["']?true)("[^"]*"|'[^']*')""", "", attributes), re.I))
        self.first = self.last = -1
        self.chars = self.linked = self.prose = 0
        self.title = False
        #: Features of the tags and names around and of this element, once they are known.
        self.mask: int | None = None

    def clear(self) -> None:
        """Only names of a text, and the attribute hidden, are left."""
        self.names = self.names & {"body"} | (frozenset({"hidden"}) if self.hidden else frozenset())

    def holds(self, other: Element) -> bool:
        return self.number <= other.number <= self.until

    def path(self) -> list[Element]:
        """The elements around it, from the outermost on, and itself."""
        out, at = [], self
        while at is not None:
            out.append(at)
            at = at.parent
        return out[::-1]


Block = tuple[str, "Element | None", float]


def _story(found: list[Block]) -> None:
    """Clears the names of ``html``, ``body`` and the main element, and of elements that hold the page's story.

    An element with a name of menus, adverts, comments and the like holds the story if its text is prose and hardly
    any text of the page lies outside such elements and itself: for the largest article (or what is around it), if it is
    more than twice any other, less than its own text; for others, a fifth of it where the page's titles (h1) are
    inside, a twentieth where there are none, and none for comments without a title. The largest are decided first."""
    seen: dict[int, Element] = {}
    for k, (text, own, linked) in enumerate(found):
        at = own
        while at is not None and at.number not in seen:
            seen[at.number] = at
            at = at.parent
        if own is not None:
            own.first, own.last = (k if own.first < 0 else own.first), k
            own.chars += len(text)
            own.linked += linked * len(text)
            own.prose += len(text) if text.count(" ") >= 5 else 0
    elements = [seen[n] for n in sorted(seen)]
    if not any(e.names for e in elements):
        return
    title: dict[int, bool] = {}  # whether an element is, or is inside, a title
    for e in elements:
        title[e.number] = e.tag == "h1" or e.parent is not None and title[e.parent.number]
        e.title = title[e.number] and e.first >= 0
    for e in reversed(elements):  # inner ones come after outer ones
        if (up := e.parent) is not None:
            up.first = e.first if up.first < 0 or 0 <= e.first < up.first else up.first
            up.last = max(up.last, e.last)
            up.chars, up.linked, up.prose, up.title = up.chars + e.chars, up.linked + e.linked, up.prose + e.prose, up.title or e.title
    main = max((e for e in elements if e.tag == "main"), key=lambda e: e.chars, default=None)
    for e in elements:
        if e.tag in ("html", "body"):
            e.names = frozenset()
        elif main is not None and e.holds(main):
            e.clear()
    articles = [e for e in elements if e.tag == "article"]
    article = max(articles, key=lambda e: e.chars, default=None)
    if article is not None and any(2 * e.chars >= article.chars and not article.holds(e) and not e.holds(article) for e in articles):
        article = None
    bad = {*OUT, "head"}
    outer: dict[int, bool] = {}  # whether an element is, or is inside, one whose tag is none of a story
    for e in elements:
        outer[e.number] = e.tag in OUT_TAGS or e.parent is not None and outer[e.parent.number]
    least = sum(len(b[0]) for b in found) / 10
    named = sorted((e for e in elements if bad & e.names and e.chars >= least), key=lambda e: -e.chars)
    away = None
    for e in named:
        if outer[e.number]:
            continue
        if away is None:  # what lies in other such elements, as long as no name is cleared
            away = {}
            for x in elements:
                away[x.number] = x.tag in OUT_TAGS or bool(bad & x.names) or x.parent is not None and away[x.parent.number]
        rest = [(text, own) for k, (text, own, _) in enumerate(found) if not e.first <= k <= e.last and not (own is not None and away[own.number])]
        outside, titles = sum(len(text) for text, _ in rest), any(own is not None and title[own.number] for _, own in rest)
        held = article if article is not None and e.holds(article) else e
        if 2 * held.linked > held.chars or 2 * held.prose < held.chars:
            continue
        if held is article and not ("comment" in e.names and titles):
            sure = outside < held.chars
        elif e.title:
            sure = not titles and outside <= 0.2 * e.chars
        else:
            sure = not titles and outside <= (0 if "comment" in e.names else 0.05) * e.chars
        if sure:
            e.clear()
            away = None


def blocks(page: str) -> list[Block]:
    """(text, element, share of its characters in links) of each leaf block; the element is the innermost around its beginning."""
    out: list[Block] = []
    stack: list[Element] = []
    parts: list[str] = []
    linked, depth, number, begun, own = 0, 0, 0, False, None

    def flush() -> None:
        nonlocal linked, begun
        if parts:
            text = " ".join("".join(parts).split())
            if text and begun:
                out.append((text, own, min(1.0, linked / len(text))))
            parts.clear()
        linked, begun = 0, False

    def add(raw: str) -> None:
        nonlocal linked, begun, own
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if not begun and not text.isspace():
            begun, own = True, stack[-1] if stack else None
        if depth:
            linked += len(text.strip())

    def close(k: int) -> None:
        nonlocal depth
        while len(stack) > k:
            e = stack.pop()
            e.until = number
            if e.tag == "a":
                depth -= 1

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>"))
            continue
        tag, end, attributes = tag.lower(), m[1] or m[4], m[3] if m[2] else m[6]
        if tag in BLOCK:
            flush()
        if end:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if tag not in BLOCK and stack[k].tag in SCOPE:
                    break
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else n
            continue
        if tag in VOID:
            if tag in ("br", "wbr") and parts:
                parts.append(" " if tag == "br" else "")
            continue
        if tag in BLOCK:
            ended, within = ENDS.get(tag, ({"p"}, SCOPE))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in ended:
                    close(k)
                    break
                if stack[k].tag in within:
                    break
        if attributes.endswith("/") and tag not in BLOCK:
            continue
        number += 1
        stack.append(Element(tag, attributes, stack[-1] if stack else None, number))
        depth += tag == "a"
    flush()
    close(0)
    _story(out)
    return out


# --- features ------------------------------------------------------------------------------------------------


def around(own: Element | None) -> int:
    """The features (bits) of a block's element and those around it; each element's are made once."""
    todo, mask = [], 0
    while own is not None and own.mask is None:
        todo.append(own)
        own = own.parent
    if own is not None:
        mask = own.mask
    for e in reversed(todo):
        if e.tag == "header" and mask >> AT["in_article"] & 1:
            mask |= 1 << AT["header_in_article"]
        if (k := AT.get(f"in_{e.tag}")) is not None:
            mask |= 1 << k
        for n in e.names:
            mask |= 1 << AT[f"named_{n}"]
        e.mask = mask
    return mask


def bits(mask: int) -> np.ndarray:
    return np.array([mask >> k & 1 for k in range(len(FEATURES))], np.float64)


def _holder(own: Element | None) -> Element | None:
    while own is not None and own.tag not in HOLDERS:
        own = own.parent
    return own


def inside(found: list[Block], title: str) -> list[list[int]]:
    """Which features of its text, place and neighbours each block has."""
    n, out = len(found), []
    words = [text.count(" ") + 1 for text, _, _ in found]
    is_long = [w > LONG and linked <= 0.3 for w, (_, _, linked) in zip(words, found, strict=True)]
    longs = [k for k in range(n) if is_long[k]]
    first, last = (longs[0], longs[-1]) if longs else (n, -1)
    before, after = [-n] * n, [2 * n] * n  # the nearest long block on either side
    for k in range(1, n):
        before[k] = k - 1 if is_long[k - 1] else before[k - 1]
    for k in range(n - 2, -1, -1):
        after[k] = k + 1 if is_long[k + 1] else after[k + 1]
    holder = [_holder(own) for _, own, _ in found]
    outer = [_holder(h.parent) if h is not None else None for h in holder]
    held: dict[int, int] = {}  # long blocks right in a holder, and (below 0) in it or in one right in it
    for k in longs:
        for h, sign in ((holder[k], 1), (holder[k], -1), (outer[k], -1)):
            if h is not None:
                held[sign * h.number] = held.get(sign * h.number, 0) + 1
    for k, (text, _, linked) in enumerate(found):
        size = 0
        while size < len(LENGTHS) and words[k] > LENGTHS[size]:
            size += 1
        got = [AT[f"words{size}"], AT["links2" if linked > 0.7 else "links1" if linked > 0.2 else "links0"]]
        if words[k] == 1:
            got.append(AT["one"])
        if text[-1] in ".!?…»”\"":
            got.append(AT["stop"])
        if words[k] <= 40 and PHRASES.search(text):
            got.append(AT["phrase"])
        if 10 * k < n:
            got.append(AT["first"])
        if 10 * (n - 1 - k) < n:
            got.append(AT["last"])
        if is_long[k]:
            got.append(AT["long"])
        if before[k] >= k - 1:
            got.append(AT["long_before"])
        elif before[k] >= k - NEAR:
            got.append(AT["near_before"])
        if after[k] <= k + 1:
            got.append(AT["long_after"])
        elif after[k] <= k + NEAR:
            got.append(AT["near_after"])
        if k < first:
            got.append(AT["all_after"])
        if k > last:
            got.append(AT["all_before"])
        if k and found[k - 1][2] > 0.7:
            got.append(AT["links_before"])
        if k + 1 < n and found[k + 1][2] > 0.7:
            got.append(AT["links_after"])
        if (h := holder[k]) is not None and held.get(h.number, 0) > is_long[k]:
            got.append(AT["with_long"])
        elif (h := outer[k]) is not None and held.get(-h.number, 0) > is_long[k]:
            got.append(AT["under_long"])
        if title and 1 < words[k] <= 40 and (text in title or len(title) > 10 and title in text):
            got.append(AT["titled"])
        out.append(got)
    return out


def title_of(page: str) -> str:
    m = TITLE.search(page)
    return " ".join(html.unescape(m[1]).split()) if m else ""


def _mask(*features: str) -> int:
    return sum(1 << AT[f] for f in features)


STORY = _mask("in_article", "in_main")
ELSEWHERE = _mask(*(f"in_{t}" for t in sorted(OUT_TAGS)), *(f"named_{n}" for n in OUT))
SECTIONS = _mask("header_in_article", *(f"in_{t}" for t in sorted(SECTIONING)))
NAMED = _mask(*(f"named_{n}" for n in NAMES))
MARKUP = SECTIONS | NAMED | _mask(*(f"in_{t}" for t in TAGS))


def own_label(mask: int) -> bool:
    """What a page's own markup says of a block: it is in an article or main element and in nothing that is none of it."""
    return bool(mask & STORY) and not mask & ELSEWHERE


# --- the field ------------------------------------------------------------------------------------------------


def _sums(emit: np.ndarray, w: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """log Z, the marginals of "article", and the expected numbers of each step, by forward and backward sums over all pages at once."""
    pages, steps = emit.shape
    trans = np.array([[0.0, w[-3]], [w[-2], w[-1]]])
    score = np.stack([np.zeros_like(emit), emit], axis=2)
    score[:, 0, 1] += w[-4]
    alpha, beta = np.empty_like(score), np.zeros_like(score)
    alpha[:, 0] = score[:, 0]
    for t in range(1, steps):
        new = np.logaddexp(alpha[:, t - 1, 0, None] + trans[0], alpha[:, t - 1, 1, None] + trans[1]) + score[:, t]
        alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
    for t in range(steps - 2, -1, -1):
        ahead = beta[:, t + 1] + score[:, t + 1]
        new = np.logaddexp(ahead[:, 0, None] + trans[:, 0], ahead[:, 1, None] + trans[:, 1])
        beta[:, t] = np.where(mask[:, t + 1, None], new, beta[:, t + 1] * 0)
    z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    article = np.exp(np.minimum(0, alpha[:, :, 1] + beta[:, :, 1] - z[:, None])) * mask
    pair = np.zeros((2, 2))
    for i in (0, 1):
        for j in (0, 1):
            p = alpha[:, :-1, i] + trans[i, j] + score[:, 1:, j] + beta[:, 1:, j] - z[:, None]
            pair[i, j] = (np.exp(np.minimum(0, p)) * mask[:, 1:]).sum()
    return z, article, pair, article[:, 0]


def fit(pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = ROUNDS, pull: float = 0.002) -> np.ndarray:
    """Weights from (features, labels) of labelled pages, by gradient ascent (Adam) on the likelihood, pulled towards 0.

    Pages are filled up to the longest of their group; a group's longest is under twice its shortest."""
    pages = sorted(((x, y) for x, y in pages if len(y)), key=lambda p: len(p[1]))
    w = np.zeros(WEIGHTS)
    if not pages:
        return w
    groups, at = [], 0
    while at < len(pages):
        to = next((k for k in range(at, len(pages)) if len(pages[k][1]) >= 2 * len(pages[at][1])), len(pages))
        own, steps = pages[at:to], len(pages[to - 1][1])
        x, y, mask = np.zeros((len(own), steps, len(FEATURES) + 1), np.float32), np.zeros((len(own), steps)), np.zeros((len(own), steps), bool)
        for i, (f, labels) in enumerate(own):
            x[i, : len(labels), :-1], y[i, : len(labels)], mask[i, : len(labels)] = f, labels, True
            x[i, : len(labels), -1] = 1
        groups.append((x, y, mask))
        at = to
    true = np.zeros(len(w))
    for x, y, mask in groups:
        true[: len(FEATURES) + 1] += np.einsum("ptf,pt->f", x, y)
        true[-4] += y[:, 0].sum()
        both = mask[:, 1:]
        true[-3:] += ((1 - y[:, :-1]) * y[:, 1:] * both).sum(), (y[:, :-1] * (1 - y[:, 1:]) * both).sum(), (y[:, :-1] * y[:, 1:] * both).sum()
    m, v = np.zeros(len(w)), np.zeros(len(w))
    for k in range(1, rounds + 1):
        seen = np.zeros(len(w))
        for x, _, mask in groups:
            _, article, pair, first = _sums((x @ w[: len(FEATURES) + 1].astype(np.float32)).astype(np.float64), w, mask)
            seen += np.concatenate([np.einsum("ptf,pt->f", x, article.astype(np.float32)), [first.sum(), pair[0, 1], pair[1, 0], pair[1, 1]]])
        grad = (true - seen) / len(pages) - pull * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w + 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return w


class Extractor:
    """Decodes pages with given weights; remembers what the elements around a block add up to."""

    def __init__(self, weights: np.ndarray):
        self.w = weights
        self.own = weights.tolist()
        self.masks: dict[int, float] = {}

    def text(self, page: str | None) -> str:
        found = blocks(page) if page else []
        if not found:
            return ""
        bias, first, (enter, leave, stay) = self.own[-5], self.own[-4], self.own[-3:]
        if len(self.masks) > 100_000:
            self.masks = {}
        back: list[tuple[bool, bool]] = []
        other = article = 0.0
        features = inside(found, title_of(page))
        for k, (_, own, _) in enumerate(found):
            mask = around(own)
            base = self.masks.get(mask)
            if base is None:
                base = self.masks[mask] = float(bits(mask) @ self.w[: len(FEATURES)])
            emit = base + bias + sum(self.own[i] for i in features[k])
            if not k:
                other, article = 0.0, emit + first
                continue
            to_other, to_article = article + leave > other, article + stay > other + enter
            back.append((to_other, to_article))
            other, article = max(other, article + leave), max(other + enter, article + stay) + emit
        label = article > other
        keep = [label]
        for step in reversed(back):
            label = step[label]
            keep.append(label)
        return "\n".join(b[0] for b, y in zip(found, reversed(keep), strict=True) if y)


def train(pages: DataFrame) -> np.ndarray:
    """Weights from a bounded sample of the pages that label themselves."""
    marked = F.lower(F.col("html")).rlike("<(article|main)[\\s>]")
    rows = pages.select("page_id", F.col("html").cast("string").alias("html")).where(F.octet_length("html") <= TRAIN_BYTES).where(marked)
    # Each task sends its first ids only; the pages themselves are fetched for the TRAIN_PAGES that are chosen.
    chosen = rows.select(F.col("page_id").alias("_id")).where("_id is not null").orderBy(F.xxhash64("_id"), "_id").limit(TRAIN_PAGES)
    rows = rows.join(F.broadcast(chosen.distinct()), F.col("page_id") == F.col("_id")).dropDuplicates(["page_id"]).collect()
    rows.sort(key=lambda r: r["page_id"])
    return fit([own for r in rows for own in labelled(r["html"])] + made())


def known(page: str, labels: list[bool] | None = None, hide: tuple[int, ...] = (0,)) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, labels) of a page, once for each set of hidden features; labels by its own markup, if None are given."""
    found = blocks(page)
    if not 0 < len(found) <= TRAIN_BLOCKS:
        return []
    masks = [around(own) for _, own, _ in found]
    y = np.array([own_label(m) for m in masks] if labels is None else labels, float)
    texts, out = inside(found, title_of(page)), []
    for hidden in hide:
        x = np.stack([bits(m & ~hidden) for m in masks])
        for k, own in enumerate(texts):
            x[k, own] = 1
        out.append((x, y))
    return out


def labelled(page: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """A page that labels itself: as it is, without sectioning tags and names, and without markup; nothing of a page of very many blocks."""
    return known(page, None, (0, SECTIONS | NAMED, MARKUP))


def made(pages: int = MADE, seed: int = 1) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = random.Random(seed)
    return [own for _ in range(pages) for own in known(*made_page(rng))]


def made_page(rng: random.Random) -> tuple[str, list[bool]]:
    """A page of known parts, and which of its blocks are article.

    The parts stand in sectioning tags, in elements whose names say what they are, in elements whose names say nothing, in the cells of
    a table, or in bare sections. Prose that is no article (comments, adverts, teasers, notices) is in elements that say so.
    """
    syllables = "ba ce di fo gu ha je ki lo mu na pe ri so tu ve wi xa yo zu".split()
    name = lambda: "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=rng.randint(3, 7)))
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    few = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b))).capitalize()
    prose = lambda a, b: few(a, b) + rng.choice(".....!?")
    layout = rng.choice(("tags", "names", "opaque", "table", "sections"))
    words = {k: v.split() for k, v in NAMES.items()}

    def box(kind: str, inner: str) -> str:
        tags = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form", "body": "article", "main": "main"}
        kind_name = rng.choice(words["body" if kind == "main" else kind])
        if layout == "tags" and kind in tags:
            return f"<{tags[kind]}>{inner}</{tags[kind]}>"
        if layout in ("tags", "names") or kind in ("comment", "advert", "notice", "share"):
            tag = rng.choice(("div", "div", "p", "section", "ul")) if "<" not in inner else "div"
            return f'<{tag} {rng.choice(("class", "id"))}="{kind_name}">{inner}</{tag}>'
        if layout == "table":
            return f"<tr><td>{inner}</td></tr>" if rng.random() < 0.5 else f"<td>{inner}</td>"
        return f"<section>{inner}</section>" if layout == "sections" else f'<div class="{name()}">{inner}</div>'

    if rng.random() < 0.12:  # hardly more than one part
        layout, yes = "tags" if layout in ("opaque", "table") else layout, rng.random() < 0.75
        items = [f"<p>{prose(1, rng.choice((6, 12, 40)))}</p>" if yes else f"<div>{few(1, 5)}</div>" for _ in range(rng.choice((1, 1, 1, 2, 3)))]
        if yes and rng.random() < 0.3:
            items.insert(0, f"<h1>{few(1, 6)}</h1>")
        tag = rng.choice(("article", "main")) if yes else rng.choice(("nav", "footer", "aside", "form", "header"))
        return f"<html><body><{tag}>{''.join(items)}</{tag}></body></html>", [yes] * len(items)
    line = lambda text: rng.choice(("<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "<li>{}</li>")).format(text)
    parts: list[tuple[str, list[bool]]] = []  # markup, and a label a block

    def other(kind: str, items: list[str]) -> None:
        if len(items) == 1 and rng.random() < 0.6:  # the text alone, or its link
            items = [re.sub(r"</?(?:p|div|li)>", "", items[0])]
        parts.append((box(kind, "".join(items)), [False] * len(items)))

    links = rng.randint(2, 8)
    menu = [f"<li><a href=x>{few(1, 3)}</a></li>" for _ in range(links)]
    top, title = few(1, 4), few(3, 10)
    if rng.random() < 0.6:
        other("head", [rng.choice(("<div>{}</div>", "<h2>{}</h2>", "<h1>{}</h1>", "<p>{}</p>", "<p><a href=w>{}</a></p>")).format(top)])
    if rng.random() < 0.9:
        parts.append((box("menu", "<ul>" + "".join(menu) + "</ul>" if rng.random() < 0.7 else "".join(f"<div><a href=y>{few(1, 2)}</a></div>" for _ in range(links))), [False] * links))
    if rng.random() < 0.4:
        other("notice", [f"<p>{rng.choice(('We use cookies.', 'Sign in to go on.'))} {prose(3, 14)}</p>"])
    if rng.random() < 0.4:
        other("advert", [f"<div>{prose(3, 16)}</div>"])
    # Paragraphs by their tag, or each in a holder of its own; some stories are of short ones only, where the markup tells them.
    para = rng.choice(("<p>{}</p>", "<p>{}</p>", "<div>{}</div>", f'<div class="{name()}">{{}}</div>', f'<div class="{name()}"><p>{{}}</p></div>')) if layout != "tags" else "<p>{}</p>"
    short = rng.random() < 0.15 and layout in ("tags", "names")
    body, labels = [f"<{(h := rng.choice(('h1', 'h1', 'h2')))}>{title}</{h}>"], [True]
    for _ in range(rng.randint(1, 9)):
        kind = rng.random()
        if kind < 0.72:
            body.append(para.format(prose(1, 12) if short else prose(14, 70)))
        elif kind < 0.8:
            body.append(para.format(prose(1, 12)))
        elif kind < 0.86:
            body.append(f"<h2>{few(2, 6)}</h2>")
        elif kind < 0.92:
            body.append(f"<blockquote>{prose(10, 40)}</blockquote>")
        else:
            items = rng.randint(2, 4)
            body.append("<ul>" + "".join(f"<li>{few(3, 12)}</li>" for _ in range(items)) + "</ul>")
            labels += [True] * (items - 1)
        labels.append(True)
        if rng.random() < 0.06:
            kind = rng.choice(("advert", "share", "notice", *(["form", "side"] if layout in ("tags", "names") else [])))
            body.append(box(kind, rng.choice(("<p>{}</p>", "{}")).format(prose(2, 15) if rng.random() < 0.5 else few(2, 12))))
            labels.append(False)
        if rng.random() < (0.15 if layout == "tags" else 0.05) and layout != "opaque":
            body.append(f"<p>{rng.choice(('All rights reserved.', 'Read more ' + prose(2, 9), 'Privacy policy ' + prose(4, 12), prose(1, 1)))}</p>")
            labels.append(True)
    if rng.random() < 0.4:
        readers = rng.randint(1, 5)
        body.append(box("comment", "".join(f"<p>{prose(4, 40)}</p>" for _ in range(readers))))
        labels += [False] * readers
    story = "".join(body)
    wrapped = rng.random()
    parts.append((box("main", box("body", story)) if wrapped < 0.2 and layout == "tags" else box("body" if wrapped < 0.8 else "main", story), labels))
    if rng.random() < 0.6:
        other("side", [line(f"<a href=z>{few(2, 7)}</a>") if rng.random() < 0.7 else line(few(2, 8)) for _ in range(rng.choice((1, 1, 2, 4, 6)))])
    if rng.random() < 0.3:
        other("form", [f"<div>{rng.choice(('Subscribe to our newsletter', 'Log in', few(1, 3)))}<input></div>"])
    if rng.random() < 0.2:
        other("comment", [f"<p>{prose(4, 40)}</p>" for _ in range(rng.randint(1, 6))])
    if rng.random() < 0.9:
        other("foot", [line(rng.choice(("© ", "Copyright ", "")) + few(1, 8)) for _ in range(rng.randint(1, 3))])
    page = "".join(markup for markup, _ in parts)
    page = f'<table class="{name()}">{page}</table>' if layout == "table" else f"<div>{page}</div>" if rng.random() < 0.3 else page
    head = rng.choice((title, f"{title} - {top}", top, ""))
    return f"<html><head><title>{head}</title></head><body>{page}</body></html>", [y for _, own in parts for y in own]


def extract(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """page_id, url and text (the article's blocks, a line each) of every page."""
    held = pages.sparkSession.sparkContext.broadcast(train(pages) if weights is None else weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(held.value)
        for batch in batches:
            texts = [extractor.text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string")
