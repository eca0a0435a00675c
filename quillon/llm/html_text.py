"""Main text of web pages by a linear-chain CRF over DOM leaf blocks.

A page is read into its leaf blocks in page order: runs of text between block
boundaries, each with its ancestors' tags and class names.  Scripts, styles,
the head, form controls and comments are no text; formulas, drawings and the
fallback text of embedded media are text like any other.  A CRF labels the sequence of
blocks as main text or not, from ancestor and text features, decoded by
Viterbi.  It is trained here on labelled pages from ``training_pages``, which
write articles, menus, headers, footers, sidebars, adverts, notices, forms and
reader comments in many structures with invented words.

A page is read once from left to right: open elements carry the features of all
their ancestors, and each tag's open elements are indexed, so that time is
linear in the page however deep it is or broken its tags are.

Defined cases: null or empty html, or a page without main text, gives ''.
Unclosed and misnested tags are tolerated, a page may end anywhere; ``<`` that
opens no tag is text; a tag that its quotes keep from ending ends at its first
``>``; a script or style without an end goes on to the end of the page.  Repeated
rows, repeated or null page_ids give a row each; extra columns are kept by
``extract``.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, table
from .crf import ChainCRF

#: A tag's name and attributes; a quoted value stands behind "=", other quotes are plain characters.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes"}  # their content is no markup, and not shown as text
_TO_THE_END = {"script", "style"}
_SILENT = {"head", "select", "option", "datalist", "button", "template"}
_IN_HEAD = {"html", "head", "title", "base", "basefont", "bgsound", "link", "meta", "style", "script", "noscript", "template"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input math mi mo mn ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder semantics svg g text tspan object audio video picture canvas".split())
_CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_SELF_CLOSING = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

_TAGS = "article main section div p li ul ol nav header footer aside form h1 h2 h3 h4 h5 h6 td blockquote pre figure figcaption dl label fieldset table address details dialog body".split()
_CLASSES = {
    "ad": "ad ads advert advertisement advertising sponsor sponsored promo promotion banner adsense",
    "comment": "comment comments reply replies respond discussion disqus responses",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs skip",
    "side": "sidebar side widget related recommended recommendations rail trending popular more",
    "foot": "footer foot copyright legal colophon",
    "head": "header masthead topbar logo branding toolbar",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall warning",
    "share": "share social follow tags meta byline author",
    "form": "form search login",
    "main": "article content post entry story main text body blog page",
}
_CLASS_OF = {w: k for k, v in _CLASSES.items() for w in v.split()}
_WORDS = ("©", "copyright", "all rights reserved", "cookie", "subscribe", "sign in", "log in", "sign up", "privacy policy", "terms of", "advertisement", "sponsored", "share this", "newsletter", "read more", "reply", "posted by", "comments")

_NAMES = ["bias", *(f"in-{t}" for t in _TAGS), *(f"at-{t}" for t in _TAGS), *(f"class-{c}" for c in _CLASSES), "in-link", "short", "middle", "long", "stopped", "notice-words", "commas", "no-letters", "hidden", "inner-main"]
_F = {n: i for i, n in enumerate(_NAMES)}


class _Block:
    __slots__ = ("features", "text")

    def __init__(self, text: str, features: list[int]):
        self.text, self.features = text, features


def _marks(tag: str, attrs: str) -> frozenset[int]:
    """Features that an open element gives to all blocks in it."""
    out = set()
    if f"in-{tag}" in _F:
        out.add(_F[f"in-{tag}"])
    if attrs and tag not in ("html", "body"):
        for name, value in _ATTR.findall(attrs):
            low = name.lower()
            if low in ("class", "id", "role"):
                for w in _NAME.findall(value):
                    c = _CLASS_OF.get(w.lower())
                    if c:
                        out.add(_F[f"class-{c}"])
            elif low == "hidden" or (low == "style" and "display:none" in value.replace(" ", "").lower()):
                out.add(_F["hidden"])
    return frozenset(out)


class _Open:
    """An open element, with what it and its ancestors say about the blocks in it."""

    __slots__ = ("features", "inner", "inside", "links", "silent", "tag")

    def __init__(self, tag: str, above: _Open | None, marks: frozenset[int]):
        self.tag = tag
        self.features = marks if above is None else above.features if marks <= above.features else above.features | marks
        self.links = (above is not None and above.links) or tag == "a"
        self.silent = (above is not None and above.silent) or tag in _SILENT
        self.inner = tag if tag not in _INLINE else above.inner if above else "body"
        self.inside = above is not None and above.inside
        if tag in ("article", "main") or _F["class-main"] in marks:
            self.inside = True
        elif tag in ("aside", "nav", "footer", "form", "header") or marks & _OUTER:
            self.inside = False


class _Stack:
    """The open elements; the places of each tag's are known."""

    def __init__(self):
        self.items: list[_Open] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # places of elements that are not inline

    @property
    def top(self) -> _Open:
        return self.items[-1] if self.items else _ROOT

    def push(self, tag: str, marks: frozenset[int]) -> None:
        self.places.setdefault(tag, []).append(len(self.items))
        if tag not in _INLINE:
            self.blocks.append(len(self.items))
        self.items.append(_Open(tag, self.items[-1] if self.items else None, marks))

    def cut(self, place: int) -> None:
        """Close all elements from ``place`` on."""
        while len(self.items) > place:
            x = self.items.pop()
            self.places[x.tag].pop()
            if x.tag not in _INLINE:
                self.blocks.pop()

    def last(self, tags: set[str]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def close(self, tags: set[str], fence: set[str]) -> None:
        """Close the innermost of ``tags``, if no element of ``fence`` is open in it."""
        at = self.last(tags)
        if at >= 0 and at >= self.last(fence):
            self.cut(at)

    def end(self, tag: str) -> None:
        """An end tag; one of an inline element does not close a block around it."""
        held = self.places.get(tag)
        if held and (tag not in _INLINE or not self.blocks or held[-1] > self.blocks[-1]):
            self.cut(held[-1])


def blocks(page: str) -> list[_Block]:
    """The page's leaf blocks with text, in page order."""
    stack = _Stack()
    out: list[_Block] = []
    text: list[str] = []
    linked = chars = 0

    def close_block() -> None:
        nonlocal linked, chars
        if text:
            words = "".join(text).split()
            text.clear()
            if words and not stack.top.silent:
                joined = " ".join(words)
                out.append(_Block(joined, _features(joined, len(words), stack.top, linked * 2 > chars)))
        linked = chars = 0

    def add(piece: str) -> None:
        nonlocal linked, chars
        text.append(piece)
        chars += len(piece)
        if stack.top.links:
            linked += len(piece)

    at, n, last_end = 0, len(page), page.rfind(">")
    raw_end: dict[str, re.Pattern] = {}
    endless: set[str] = set()
    while at < n:
        start = page.find("<", at)
        if start < 0 or (start > last_end and not page.startswith(("<!", "<?"), start)):
            start = n  # no tag ends behind it
        if start > at:
            add(entities.unescape(page[at:start]))
            at = start
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = end + 3 if end >= 0 else n
            continue
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            at = end + 1 if end >= 0 else n
            continue
        m = _TAG.match(page, at) or _LOOSE_TAG.match(page, at)
        if m is None:
            add("<")
            at += 1
            continue
        at = m.end()
        tag = m.group(2).lower()
        if m.group(1):
            if tag not in _INLINE:
                close_block()
            stack.end(tag)
            continue
        if tag in _RAW:
            end = raw_end.setdefault(tag, re.compile(rf"</{tag}\b", re.I)).search(page, at) if tag not in endless else None
            if end and end.end() <= last_end:
                at = page.find(">", end.end()) + 1
            elif tag in _TO_THE_END:
                at = n
            else:  # not read over; no later one has an end either
                endless.add(tag)
            text.append(" ")
            continue
        if tag == "br":
            text.append(" ")
            continue
        if stack.places.get("head") and tag not in _IN_HEAD:
            close_block()
            stack.cut(stack.places["head"][-1])
        if tag not in _INLINE:
            close_block()
            if tag in _CLOSES_P:
                stack.close({"p"}, {"button", "table", "td", "th", "div", "article", "section", "aside"})
            if tag in _SELF_CLOSING:
                stack.close(*_SELF_CLOSING[tag])
        if tag not in _VOID and not (m.group(3).rstrip().endswith("/") and tag in _INLINE):
            stack.push(tag, _marks(tag, m.group(3)))
    close_block()
    return out


def _features(text: str, n: int, at: _Open, linked: bool) -> list[int]:
    out = {_F["bias"], *at.features}
    if f"at-{at.inner}" in _F:
        out.add(_F[f"at-{at.inner}"])
    if at.inside:
        out.add(_F["inner-main"])
    if linked:
        out.add(_F["in-link"])
    out.add(_F["short"] if n < 4 else _F["middle"] if n < 15 else _F["long"])
    if text[-1] in ".!?:\"”»":
        out.add(_F["stopped"])
    if ", " in text:
        out.add(_F["commas"])
    if len(text) < 300:
        low = text.lower()
        if any(w in low for w in _WORDS):
            out.add(_F["notice-words"])
        if not any(c.isalpha() for c in text):
            out.add(_F["no-letters"])
    return list(out)


_OUTER = frozenset(_F[f"class-{c}"] for c in ("ad", "comment", "menu", "side", "foot", "notice", "share", "form"))
_ROOT = _Open("body", None, frozenset())


def training_pages(n: int = 500, seed: int = 3) -> list[tuple[str, list[int]]]:
    """Labelled pages: html, and for each of its leaf blocks 1 for main text or 0."""
    r = random.Random(seed)
    parts = "an be co da el fi go ha in ju ka lo mi no or pe ra se ti un vo wa xe yo zu ér ön añ ça ß th sch tion".split()

    def word() -> str:
        return "".join(r.choice(parts) for _ in range(r.choice((1, 2, 2, 3))))

    def words(k: int) -> str:
        return " ".join(word() for _ in range(k)).capitalize()

    def sentence() -> str:
        s = words(r.choice((3, 6, 10, 18))) + r.choice("..!?")
        return s.replace(" ", ", ", 1) if r.random() < 0.3 else s

    def prose() -> str:
        if r.random() < 0.15:  # noisy main text is main text all the same
            return " ".join(w.upper() + "!!" if r.random() < 0.5 else w + "***" for w in words(r.choice((4, 12, 40))).split())
        return " ".join(sentence() for _ in range(r.choice((1, 1, 2, 4, 7)))) if r.random() < 0.85 else words(r.choice((1, 2, 3)))

    def pick(*names: str) -> str:
        return r.choice(names)

    def page() -> tuple[str, list[int]]:
        y: list[int] = []

        def leaf(tag: str, text: str, label: int, attrs: str = "") -> str:
            y.append(label)
            if r.random() < 0.1:
                text = f"<{(t := pick('b', 'em', 'span', 'strong'))}>{text}</{t}>"
            return f"<{tag}{attrs}>{text}" + ("" if tag in ("p", "li") and r.random() < 0.3 else f"</{tag}>")

        def links(k: int, label: int = 0) -> str:
            return "<ul>" + "".join(leaf("li", f'<a href="/{word()}">{words(r.choice((1, 1, 2, 3)))}</a>', label) for _ in range(k)) + "</ul>"

        def some(label: int, k: int) -> str:
            out = []
            for _ in range(k):
                kind = r.random()
                if kind < 0.7:
                    out.append(leaf("p", prose(), label))
                elif kind < 0.8:
                    out.append(leaf(pick("h2", "h3"), words(4), label))
                elif kind < 0.87:
                    out.append(f"<{(t := pick('ul', 'ol'))}>" + "".join(leaf("li", prose(), label) for _ in range(3)) + f"</{t}>")
                elif kind < 0.91:
                    out.append("<blockquote>" + leaf("p", prose(), label) + "</blockquote>")
                elif kind < 0.94:
                    out.append("<table><tr>" + leaf("td", words(2), label) + leaf("td", words(3), label) + "</tr></table>")
                elif kind < 0.97:
                    out.append("<figure><img src=x>" + leaf("figcaption", prose(), label) + "</figure>")
                else:
                    out.append(leaf("pre", words(6), label))
            return "".join(out)

        def boiler(inside: bool = False) -> str:
            kind = r.randrange(9)
            if kind == 0:
                return f'<div class="{pick("ad", "ads", "advert", "sponsored", "promo")}">' + (leaf("p", prose(), 0) if r.random() < 0.5 else leaf("span", prose(), 0)) + "</div>"
            if kind == 1:
                return f'<{(t := pick("div", "section"))} {pick("class", "id")}="{pick("cookie-notice", "newsletter", "consent", "alert", "cookie-banner")}">' + leaf("p", f"{pick('We use cookies.', 'Subscribe now', 'Notice:')} {prose()}", 0) + f"</{t}>"
            if kind == 2:
                y.append(0)
                return f"<form action=/x><label>{words(2)}</label><input name=q><button>{word()}</button></form>"
            if kind == 3:
                return f'<aside{pick("", " class=sidebar", " id=related")}>' + leaf("h3", words(2), 0) + (links(3) if r.random() < 0.5 else some(0, 2)) + "</aside>"
            if kind == 4:
                return f'<div class="{pick("related", "sidebar", "widget", "trending")}">' + links(3) + "</div>"
            if kind == 5:
                return f'<{(t := pick("section", "div"))} {pick("class", "id")}="{pick("comments", "comment-list", "replies")}">' + leaf("h3", pick("Comments", words(2)), 0) + "".join(f'<div class="comment">{leaf("p", prose(), 0)}</div>' for _ in range(r.choice((1, 3)))) + f"</{t}>"
            if kind == 6:
                return f'<div class="{pick("share", "social", "tags")}">' + links(3) + "</div>"
            if kind == 7:
                return "<nav>" + links(r.choice((2, 4))) + "</nav>"
            return "<script>var a='<p>x</p>';</script>" + ("" if inside else f'<div class="{pick("breadcrumb", "menu", "pagination")}">' + links(2) + "</div>")

        out = ["<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>"]
        bare = r.random() < 0.1  # nothing but the text, in no frame
        if bare:
            return out[0] + "".join(some(1, 1) for _ in range(r.choice((1, 1, 2, 5)))), y
        if r.random() < 0.5:
            out.append("<header>" + leaf(pick("h1", "div", "p"), words(2), 0) + (leaf("p", sentence(), 0) if r.random() < 0.3 else "") + (f"<nav>{links(3)}</nav>" if r.random() < 0.5 else "") + "</header>")
        if r.random() < 0.7:
            out.append(f"<{(t := pick('nav', 'nav', 'div class=menu', 'div id=navbar'))}>" + links(r.choice((3, 6))) + f"</{t.split()[0]}>")
        out += [boiler() for _ in range(r.choice((0, 1, 2)))]
        kind = r.random()
        shell = "article" if kind < 0.5 else "main" if kind < 0.65 else f'div class="{pick("content", "post-body", "entry-content", "article-text", "story")}"' if kind < 0.85 else 'div id="content"' if kind < 0.9 else "div" if kind < 0.95 else ""
        inner = [leaf("h1", words(5) if r.random() < 0.7 else prose(), 1)] if r.random() < 0.8 else []
        for _ in range(r.choice((1, 2, 4, 8))):
            inner.append(some(1, 1) if r.random() < 0.85 else "".join([leaf("p", f"<b>{prose()}</b><br>{prose()}", 1)]))
            if r.random() < 0.08:
                inner.append(boiler(inside=True))
        out.append(f"<{shell}>" + "".join(inner) + f"</{shell.split()[0]}>" if shell else "".join(inner))
        out += [boiler() for _ in range(r.choice((0, 1, 2)))]
        if r.random() < 0.8:
            out.append(f"<{(t := pick('footer', 'footer', 'div class=footer', 'div id=footer'))}>" + leaf(pick("p", "div"), pick("&copy; ", "Copyright ", "") + sentence() + (" " + prose() if r.random() < 0.5 else ""), 0) + (links(2) if r.random() < 0.4 else "") + f"</{t.split()[0]}>")
        return "".join(out), y

    return [page() for _ in range(n)]


@lru_cache(maxsize=1)
def trained() -> ChainCRF:
    """The CRF; trained once, on the driver, and broadcast."""
    xs, ys = [], []
    for page, y in training_pages():
        x = [b.features for b in blocks(page)]
        if len(x) != len(y):
            raise AssertionError("a training page and its labels differ in length")
        if x:
            xs.append(x)
            ys.append(y)
    return ChainCRF(len(_NAMES)).fit(xs, ys, epochs=150)


def main_text(page: str | None, crf: ChainCRF) -> str:
    found = blocks(page) if page else []
    return " ".join(b.text for b, y in zip(found, crf.decode([b.features for b in found])) if y)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with the main text of its column html; the name gets a leading underscore where taken."""
    at = pages.columns.index("html")
    schema = T.StructType([*pages.schema.fields, T.StructField(fresh("text", pages.columns), T.StringType())])
    cast = pages.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = cast.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([main_text(x, crf) for x in b.column(at).to_pylist()], pa.string())], names=schema.names)

    return pages.mapInArrow(run, schema)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
