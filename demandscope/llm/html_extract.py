"""Main text of web pages: maximum-scoring subsequence of words and tags.

A page becomes a sequence of words and tags. A word scores ``+1``. A tag scores below zero: its name's price for itself, and its toll for each
word that it encloses. One linear scan finds the contiguous region with the largest sum, which is the page's content.

All weights are learned from labelled pages (``labelled_pages``: generated, of many layouts, with and without ``article``; no page of the corpus is used, so
results don't depend on which rows are present):

* prices of names by a structured perceptron, so that the scan finds the labelled region;
* tolls by a logistic model over elements, whose features are the name, the words of class, id and role, the share of the page's words and of linked
  words, and what the element holds: the log-odds that it stands beside the content, where they are positive. No word of a class decides alone;
* holes: what interrupts an article (adverts, share bars, boxes) is left out of the region by a second such model, learned only from elements inside
  labelled articles. What surrounds an article is left to the scan.

Only what a browser never shows as text (scripts, styles, hidden elements, controls of forms) gives no words at all.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow, slices, table

#: Fixed vocabularies of HTML: elements without an end, of which nothing is text, that start a block, and that are part of a line.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas textarea select option audio video button".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Fixed rules of HTML for ends that are left out: what a start tag ends, and the elements that such an end doesn't pass.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("thead", "tbody"), "tfoot": ("thead", "tbody")}
LIMITS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "p": ("td", "th", "table", "caption", "li")}
_CELLS = ("table",)
#: Elements without attributes that take no toll: they are parts of a text.
PLAIN = frozenset("html body p li h1 h2 h3 h4 h5 h6 dt dd td th tr tbody thead tfoot blockquote pre figcaption caption br hr".split())
#: What a word's score loses for each unit of log-odds.
TOLL = 2.0
#: What a word scores at least: an advert or box in an article must not cost more than the text beyond it brings.
LEAST = -0.1
_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[A-Za-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|</?[A-Za-z][^>]*(?:>|\Z)|[^<]+|<", re.S)
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_MARKED = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS = re.compile(r"[A-Za-z]+")
_HIDDEN = re.compile(r"""\bhidden(?=[\s/>=])|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPACES = re.compile(r"\s+")


class Element:
    """An element: its place in the sequence, its marks, and counts of what it holds (differences of running counts)."""

    __slots__ = ("name", "marks", "first", "end", "at", "holds", "inside", "position")

    def __init__(self, name: str, marks: tuple[str, ...], first: int, at: tuple, inside: bool, position: int):
        self.name, self.marks, self.first, self.end, self.at, self.holds, self.inside, self.position = name, marks, first, 0, at, (), inside, position


class Page:
    """``pieces``: (name, words or 0, text or None, place in the html) of tags and texts in order; ``elements`` in order of their end; ``counts`` of the page."""

    def __init__(self, source: str):
        self.pieces: list[tuple[str, int, str | None, int]] = []
        self.elements: list[Element] = []
        self._parse(source)

    def _parse(self, source: str) -> None:
        pieces, elements, n = self.pieces, self.elements, len(source)
        stack: list[Element] = []
        opened: dict[str, list[int]] = {}  # places in the stack of open elements of a name
        blocks: list[int] = []  # places in the stack of open blocks
        words = linked = heads = bodies = paragraphs = 0
        raw_end: dict[str, re.Pattern] = {}
        at = 0
        none: list[int] = []

        def close(down_to: int) -> None:
            while len(stack) > down_to:
                x = stack.pop()
                opened[x.name].pop()
                if blocks and blocks[-1] == len(stack):
                    blocks.pop()
                x.end = len(pieces)
                a = x.at
                x.holds = (words - a[0], linked - a[1], heads - a[2], bodies - a[3], paragraphs - a[4])
                elements.append(x)

        def last(name: str) -> int:
            return (opened.get(name) or none or (-1,))[-1]

        while at < n:
            m = _PIECE.match(source, at)
            piece, place = m[0], at
            at = m.end()
            if not (piece[0] == "<" and len(piece) > 1):
                k = len(piece.split())
                pieces.append(("", k, piece, place))
                words += k
                if opened.get("a"):
                    linked += k
                continue
            named = _NAME.match(piece)
            if not named:
                continue  # comments, declarations
            name = named[1].lower()
            if piece[1] == "/":
                found = last(name)
                if found < 0 or (name in LIMITS and any(last(x) > found for x in LIMITS[name])) or (name not in BLOCK and blocks and blocks[-1] > found):
                    continue  # a stray end, or that of a line's element around blocks, which ends with its block
                close(found)
                pieces.append((name, 0, None, place))
                continue
            if (name in RAW and not piece.endswith("/>")) or ("=" in piece or " hidden" in piece) and name not in VOID and name not in ("html", "body", "article", "main") and _HIDDEN.search(piece):
                if name in RAW:
                    end = raw_end.setdefault(name, re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I)).search(source, at)
                    at = end.end() if end else n
                else:
                    at = _past(source, at, name)
                continue
            if name in VOID or piece.endswith("/>"):
                pieces.append((name, 0, None, place))
                continue
            if name in ENDS:
                found = max(last(x) for x in ENDS[name])
                if found > max(last(x) for x in LIMITS.get(name, _CELLS)):
                    close(found)
            elif name in BLOCK:
                found = last("p")
                if found > max(last(x) for x in LIMITS["p"]):
                    close(found)
            marks = tuple(sorted({p.lower() for v in _MARKED.finditer(piece) for p in _PARTS.findall(v[1] or v[2] or v[3] or "")})) if "=" in piece else ()
            inside = bool(opened.get("article") or opened.get("main"))
            heads += name == "h1"
            bodies += name in ("article", "main")
            paragraphs += name == "p"
            counts = (words, linked, heads - (name == "h1"), bodies - (name in ("article", "main")), paragraphs - (name == "p"))
            stack.append(Element(name, marks, len(pieces), counts, inside, place))
            opened.setdefault(name, []).append(len(stack) - 1)
            if name in BLOCK:
                blocks.append(len(stack) - 1)
            pieces.append((name, 0, None, place))
        close(0)
        self.counts = (words, linked, heads, bodies, paragraphs)


def _past(source: str, at: int, name: str) -> int:
    """The place after the end of an element whose start tag ends at ``at``: its own starts and ends are counted."""
    depth, end = 1, re.compile(rf"<(/?){re.escape(name)}\b[^>]*(?:>|\Z)", re.I)
    for m in end.finditer(source, at):
        depth += -1 if m[1] else 0 if m[0].endswith("/>") else 1
        if not depth:
            return m.end()
    return len(source)


# ---- features of an element, and the two models

def features(e: Element, page: Page) -> list[str]:
    words, linked, heads, bodies, paragraphs = e.holds
    share = words / max(page.counts[0], 1)
    size = "most" if share > 0.5 else "some" if share > 0.1 else "few"
    dense = linked / max(words, 1)
    links = "links" if dense > 0.7 else "mixed" if dense > 0.3 else "text"
    holds = "body" if bodies else "head" if heads else "none"
    away = page.counts[3] > 0 and not bodies and not e.inside
    out = ["bias", f"<{e.name}>", size, links, f"{size} {links}", f"holds {holds}", f"{size} holds {holds}", f"paragraphs {min(paragraphs, 3)}", f"away {away}", f"away {away} {size}"]
    for m in e.marks:
        out += [m, f"{m} {size}"]
    if e.marks:
        out.append(f"marked {size}")
    return out


def takes_toll(e: Element) -> bool:
    """Whether an element is judged at all: one with words that is marked, or isn't a plain part of a text."""
    return e.holds[0] > 0 and (bool(e.marks) or (e.name in BLOCK and e.name not in PLAIN))


class Weights:
    """``price`` of names, and weights of features in the two models of elements."""

    def __init__(self):
        self.price: dict[str, float] = {}
        self.beside: dict[str, float] = {}
        self.hole: dict[str, float] = {}

    def odds(self, model: dict[str, float], e: Element, page: Page) -> float:
        return sum(model.get(f, 0.0) for f in features(e, page))

    def spread(self, model: dict[str, float], page: Page) -> list[float]:
        """For each piece, the positive log-odds of the elements around it, added up."""
        step = [0] * (len(page.pieces) + 1)  # in thousandths
        for e in page.elements:
            if takes_toll(e) and (z := round(self.odds(model, e, page), 3)) > 0:
                step[e.first] += round(1000 * z)
                step[e.end] -= round(1000 * z)
        out, now = [], 0
        for s in step[:-1]:
            now += s
            out.append(now / 1000)
        return out

    def scores(self, page: Page) -> list[float]:
        toll = self.spread(self.beside, page)
        return [k * max(1.0 - TOLL * t, LEAST) if text is not None else -self.price.get(name, 1.0) for (name, k, text, _), t in zip(page.pieces, toll, strict=True)]


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and end of the contiguous part with the largest sum (the first, and shortest, of equals); (0, 0) if none is positive."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, found = total, (start, k + 1)
    return found


# ---- labelled pages

#: Words that the generator uses for classes and ids of what stands beside an article, of articles, and of wrappers whose names tell what a page has.
MENUS = "menu nav navbar navigation topnav".split()
TOPS = "header masthead banner topbar".split()
NOTICES = "cookie cookies consent gdpr notice notices alert popup modal overlay".split()
ADVERTS = "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion".split()
SIDES = "sidebar side widget widgets rail".split()
RELATED = "related recommended more readnext".split()
FORMS = "newsletter subscribe subscription signup login search".split()
COMMENTS = "comments commentlist respond replies disqus discussion reactions".split()
SHARES = "share sharing social toolbar tools".split()
ENDINGS = "footer copyright colophon legal pagination pager breadcrumb breadcrumbs skip".split()
BODIES = "content post entry article story body text page main".split()
LAYOUT = "sidebar header footer menu nav share side widget banner toolbar social skip topbar navbar masthead".split()
AROUND = "no has with is page layout post by fixed open wide left right".split()


SAID = "alpha beta gamma delta river stone cloud green walks under near bright".split() * 50


class _Maker:
    """One page: ``parts`` of html, each with whether it is content."""

    def __init__(self, rnd: random.Random):
        self.rnd, self.parts = rnd, []

    def add(self, source: str, content: bool = False) -> None:
        self.parts.append((source, content))

    def say(self, lo: int, hi: int) -> str:
        n, at = self.rnd.randint(lo, hi), self.rnd.randrange(len(SAID) // 2)
        return " ".join(SAID[at : at + n])

    def links(self, lo: int, hi: int, words: int = 2) -> str:
        return "".join(f'<li><a href="/{k}">{self.say(1, words)}</a></li>' for k in range(self.rnd.randint(lo, hi)))

    def mark(self, names: list[str]) -> str:
        name = self.rnd.choice(names)
        name = self.rnd.choice((name, name, f"{name}-{self.rnd.choice(('box', 'top', 'area', 'list', 'block'))}", f"site-{name}"))
        return f'{self.rnd.choice(("class", "class", "id"))}="{name}"'

    def beside(self, kind: str) -> str:
        rnd, say = self.rnd, self.say
        tag = rnd.choice(("div", "div", "section"))
        if kind == "menu":
            items = self.links(3, 9)
            return rnd.choice((f"<nav><ul>{items}</ul></nav>", f"<nav {self.mark(MENUS)}><ul>{items}</ul></nav>", f"<div {self.mark(MENUS)}><ul>{items}</ul></div>", f"<ul>{items}</ul>"))
        if kind == "top":
            inner = f'<a href="/">{say(1, 3)}</a><p>{say(2, 9)}</p>'
            return rnd.choice((f"<header>{inner}</header>", f"<div {self.mark(TOPS)}>{inner}</div>"))
        if kind == "notice":
            return f"<{tag} {self.mark(NOTICES)}><p>{say(4, 40)}</p><button>{say(1, 1)}</button></{tag}>"
        if kind == "ad":
            return rnd.choice((f"<{tag} {self.mark(ADVERTS)}>{say(3, 40)}</{tag}>", f"<{tag} {self.mark(ADVERTS)}><p>{say(3, 40)}</p></{tag}>"))
        if kind == "side":
            inner = f"<h3>{say(1, 4)}</h3>" + rnd.choice((f"<ul>{self.links(2, 6, 6)}</ul>", f"<p>{say(5, 90)}</p>", f"<p>{say(60, 250)}</p>", f"<p>{say(60, 250)}</p>", f"<p>{say(5, 60)}</p><p>{say(5, 60)}</p><p>{say(5, 60)}</p>"))
            return rnd.choice((f"<aside>{inner}</aside>", f"<aside><article>{inner}</article></aside>", f"<aside {self.mark(SIDES)}>{inner}</aside>", f"<{tag} {self.mark(SIDES)}>{inner}</{tag}>"))
        if kind == "related":
            inner = rnd.choice((f"<ul>{self.links(2, 6, 8)}</ul>", "".join(f"<article><h3><a href='/x'>{say(2, 6)}</a></h3><p>{say(2, 9)}</p></article>" for _ in range(rnd.randint(2, 5)))))
            return f"<{tag} {self.mark(RELATED)}>{inner}</{tag}>"
        if kind == "form":
            return rnd.choice((f"<form><p>{say(3, 20)}</p><input><button>{say(1, 1)}</button></form>", f"<{tag} {self.mark(FORMS)}><p>{say(3, 30)}</p><form><label>{say(1, 2)}</label><input></form></{tag}>"))
        if kind == "comments":
            each = "".join(f'<div class="comment"><p>{say(4, 60)}</p></div>' if rnd.random() < 0.6 else f"<p>{say(4, 90)}</p>" for _ in range(rnd.choice((1, 2, 4, 8, 16))))
            return f"<{tag} {self.mark(COMMENTS)}>{f'<h3>{say(1, 2)}</h3>' * rnd.randint(0, 1)}{each}</{tag}>"
        if kind == "share":
            return f"<{tag} {self.mark(SHARES)}>{''.join(f'<a>{say(1, 1)}</a> ' for _ in range(3))}</{tag}>"
        inner = rnd.choice((f"&copy; {say(3, 12)}", f"<p>{say(3, 40)}</p>", f"<ul>{self.links(2, 6)}</ul><p>{say(2, 20)}</p>"))
        return rnd.choice((f"<footer>{inner}</footer>", f"<footer {self.mark(ENDINGS)}>{inner}</footer>", f"<{tag} {self.mark(ENDINGS)}>{inner}</{tag}>"))

    def block(self) -> str:
        rnd, say = self.rnd, self.say
        return rnd.choice((
            f"<p>{say(1, 90)}</p>", f"<p>{say(10, 90)}</p>", f"<p>{say(5, 60)}", f'<p>{say(2, 40)} <a href="/x">{say(1, 6)}</a> {say(1, 40)}</p>', f"<p><b>{say(1, 20)}<br><p>{say(5, 60)}</p>", f"<div><p>{say(5, 90)}</p></div>",
            f"<h2>{say(1, 8)}</h2><p>{say(5, 60)}</p>", f"<ul>{''.join(f'<li>{say(1, 12)}' for _ in range(rnd.randint(2, 6)))}</ul>", f"<ul>{''.join(f'<li><a href=/r>{say(3, 9)}</a></li>' for _ in range(rnd.randint(2, 4)))}</ul><p>{say(4, 30)}</p>",
            f"<table><tr><td>{say(1, 6)}<td>{say(1, 6)}</table><p>{say(3, 40)}</p>", f"<blockquote><p>{say(5, 40)}</p></blockquote><p>{say(3, 40)}</p>", f"<figure><img src=x><figcaption>{say(2, 9)}</figcaption></figure><p>{say(5, 50)}</p>", f"<div>{say(5, 60)}</div>",
        ))

    def page(self) -> None:
        rnd, say = self.rnd, self.say
        self.add(f"<!DOCTYPE html><html><head><title>{say(1, 9)}</title><style>p {{}}</style></head><body>")
        before = rnd.sample(("menu", "top", "notice", "ad", "side", "related", "form", "share"), rnd.randint(0, 4))
        after = rnd.sample(("comments", "side", "related", "share", "ad", "form", "menu", "notice"), rnd.randint(0, 3)) + ["comments"] * (rnd.random() < 0.2) + ["end"] * rnd.randint(0, 1)
        wrapped = rnd.randint(0, len(before)), rnd.randint(0, len(after))
        classes = lambda: " ".join("-".join(rnd.sample((rnd.choice(AROUND), rnd.choice(LAYOUT)), 2)) if rnd.random() < 0.6 else rnd.choice((*BODIES, "wrapper", "container", "row", "site")) for _ in range(rnd.randint(1, 2)))
        wrap = f'<div class="{classes()}">' if rnd.random() < 0.7 else ""
        for k, kind in enumerate(before):
            if k == wrapped[0]:
                self.add(wrap)
            self.add(self.beside(kind))
        if wrapped[0] >= len(before):
            self.add(wrap)
        close = wrap and "</div>"
        start, end = rnd.choice(
            (("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ("<div>", "</div>"), ("<section>", "</section>"), ("", ""), (f'<div class="{classes()}">', "</div>"), (f'<div class="{rnd.choice(BODIES)}">', "</div>"), (f'<article class="{rnd.choice(BODIES)}">', "</article>"))
        )
        self.add(start)
        if rnd.random() < 0.7:
            self.add(f"<h1>{say(1, 9)}</h1>", True)
        for k in range(1 if rnd.random() < 0.15 else rnd.randint(2, 10)):
            if k and rnd.random() < 0.25:
                self.add(self.beside(rnd.choice(("ad", "share", "form", "related", "notice", "side", "menu"))))
            self.add(f"<p>{say(1, 5)}</p>" if rnd.random() < 0.1 else self.block(), True)
        self.add(end)
        for k, kind in enumerate(after):
            if k == wrapped[1]:
                self.add(close)
            self.add(self.beside(kind))
        if wrapped[1] >= len(after):
            self.add(close)
        self.add("</body></html>")


def labelled_pages(count: int = 600, seed: int = 7) -> list[tuple[str, list[tuple[int, int]]]]:
    """Generated pages as html and the places of their content."""
    rnd, out = random.Random(seed), []
    for _ in range(count):
        made = _Maker(rnd)
        made.page()
        at, spans = 0, []
        for source, content in made.parts:
            if content:
                spans.append((at, at + len(source)))
            at += len(source)
        out.append(("".join(x for x, _ in made.parts), spans))
    return out


def _labels(page: Page, spans) -> list[bool]:
    """Whether each piece is content."""
    inside = lambda p: any(a <= p < b for a, b in spans)
    return [inside(place) for *_, place in page.pieces]


def _logistic(rows: list[list[str]], y: list[int], steps: int = 500, rate: float = 2.0, ridge: float = 5e-5) -> dict[str, float]:
    """Weights of features; both classes count the same in all."""
    names = sorted({f for r in rows for f in r})
    place, most = {f: k for k, f in enumerate(names)}, max(map(len, rows))
    at = np.full((len(rows), most), len(names))  # the features of each row, filled up with one that weighs nothing
    for k, r in enumerate(rows):
        at[k, : len(r)] = [place[f] for f in r]
    t, w, before = np.array(y, dtype=float), np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    each = np.where(t > 0, 0.5 / t.sum(), 0.5 / (1 - t).sum())
    for k in range(steps):
        ahead = w + k / (k + 3) * (w - before)
        p = 1 / (1 + np.exp(-np.clip(ahead[at].sum(axis=1), -30, 30)))
        g = np.bincount(at.ravel(), weights=np.repeat((p - t) * each, most), minlength=len(names) + 1)
        before, w = w, ahead - rate * (g + ridge * ahead)
        w[-1] = 0
    return {f: round(v, 4) for f, v in zip(names, w[:-1].tolist(), strict=True)}


@cache
def learned(rounds: int = 12, least: float = 0.02) -> Weights:
    """Weights from the labelled pages."""
    out, cases = Weights(), []
    rows: dict[str, tuple[list, list]] = {"beside": ([], []), "hole": ([], [])}
    for source, spans in labelled_pages():
        page = Page(source)
        content = _labels(page, spans)
        upto = np.concatenate([[0], np.cumsum([k * c for (_, k, _, _), c in zip(page.pieces, content, strict=True)])])
        first = next(k for k, c in enumerate(content) if c)
        end = len(content) - next(k for k, c in enumerate(reversed(content)) if c)
        cases.append((page, content, first, end))
        covered: list[tuple[int, int]] = []
        for e in reversed(page.elements):  # outer elements first
            if not takes_toll(e) or any(a <= e.first and e.end <= b for a, b in covered):
                continue
            good = bool(upto[e.end] - upto[e.first])
            if not good:
                covered.append((e.first, e.end))
            f = features(e, page)
            rows["beside"][0].append(f)
            rows["beside"][1].append(0 if good else 1)
            if first <= e.first and e.end <= end:
                rows["hole"][0].append(f)
                rows["hole"][1].append(0 if good else 1)
            elif good:
                rows["hole"][0].append(f)
                rows["hole"][1].append(0)
    out.beside, out.hole = _logistic(*rows["beside"]), _logistic(*rows["hole"])
    # prices: the scan is run on each page, and what it takes wrongly becomes dearer, what it misses cheaper
    price, total = Counter({name: 0.5 for page, *_ in cases for name, _, text, _ in page.pieces if text is None}), Counter()
    tolls = [out.spread(out.beside, page) for page, *_ in cases]
    order = random.Random(1)
    for turn in range(rounds):
        numbers = list(range(len(cases)))
        order.shuffle(numbers)
        for i in numbers:
            page, _, first, end = cases[i]
            found = best_region([k * max(1.0 - TOLL * t, LEAST) if text is not None else -price[name] for (name, k, text, _), t in zip(page.pieces, tolls[i], strict=True)])
            if found != (first, end):
                for sign, (a, b) in ((1, found), (-1, (first, end))):
                    for name, _, text, _ in page.pieces[a:b]:
                        if text is None:
                            price[name] += sign * 0.3 / (1 + turn)
                for name in price:
                    price[name] = max(price[name], least)
        total.update(price)
    out.price = {name: v / rounds for name, v in total.items()}
    return out


# ---- text

def extract(source: str | None, weights: Weights | None = None) -> str:
    """The main text: blocks of the best region without its holes, white space as one space, joined by two line feeds; empty if there is none."""
    if not source:
        return ""
    weights = weights or learned()
    page = Page(source)
    start, end = best_region(weights.scores(page))
    if start == end:
        return ""
    holes = weights.spread(weights.hole, page)
    blocks: list[str] = []
    now: list[str] = []

    def close():
        text = _SPACES.sub(" ", html.unescape("".join(now))).strip()
        if text:
            blocks.append(text)
        now.clear()

    for (name, _, text, _), z in zip(page.pieces[start:end], holes[start:end], strict=True):
        if text is not None:
            if not z:
                now.append(text)
        elif name in BLOCK:
            close()
        elif name == "br":
            now.append(" ")
    close()
    return "\n\n".join(blocks)


def _extracted(weights: Weights):
    def run(batches):
        for b in slices(batches, "html"):
            texts = [extract(x, weights) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extract_text(pages: DataFrame) -> DataFrame:
    """Returns page_id, url, text, n_chars: one row for each row of ``pages`` (page_id, url, html used).

    Null, empty and wordless html give an empty text; null ids and urls stay null; repeated rows give a row each; an empty table gives an
    empty table; other columns are ignored; long pages are taken whole, in time linear in their length, whatever ends are left out. Of regions with
    equal scores the first counts.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return arrow(pages.select("page_id", "url", "html"), _extracted(learned()), f"page_id {kinds['page_id']}, url string, text string, n_chars long")


def op4_html_extract(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))
