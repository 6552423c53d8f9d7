"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into leaf blocks, runs of text between block-level tags. Each block has binary features of its ancestors
(tags, words of class and id) and of its text; a chain over the blocks in page order, with weights for features and for
pairs of neighbouring labels, gives each block one of two labels, main text or not. The weights are fitted on labelled
pages by gradient ascent of the conditional likelihood (forward-backward), and Viterbi decodes. `labelled_pages` writes
the training pages from templates with a fixed seed; a user with labelled pages passes those instead.

Pages are read whole, in time in proportion to their length whatever their markup: every sign is looked at a fixed number
of times, and open tags are counted, never searched.

Nulls: a null html is empty and gives an empty text, as does a page without blocks. Labels that are equally likely are
decided for "not". Repeated rows are extracted alike, an empty table gives an empty result, and other columns are not read.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import lean

#: Tags that hold no text for readers. A head is not one: what may stand in it is silent of itself, all else ends it.
SILENT = frozenset("script style noscript template svg iframe object canvas math title textarea select option".split())
#: Silent tags that hold raw text up to the end tag.
RAW = frozenset("script style title textarea iframe".split())
#: Tags that stand within a line of text; any other tag ends a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img br".split()
)
#: Tags without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that a new tag of the same kind closes.
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())
#: Sections, which a tag of the table above does not close across.
SCOPES = frozenset("table ul ol dl div section article main aside nav header footer form body".split())
#: Words of class and id, by the kind of section that they name.
KINDS = {
    "comment": "comment comments reply replies respond disqus discussion feedback",
    "menu": "menu nav navbar navigation breadcrumb breadcrumbs pagination pager tabs toc skip",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner affiliate adsense",
    "notice": "cookie cookies consent gdpr notice alert modal popup overlay newsletter subscribe paywall toast",
    "side": "sidebar side aside widget related recommended recommendations trending popular share sharing social",
    "frame": "header footer masthead copyright legal colophon topbar bottombar site-header site-footer toolbar",
    "form": "form login signup search searchbox register",
    "main": "content article post entry main story body text prose page-content post-content article-body",
}
_KIND_OF = {w: k for k, words in KINDS.items() for w in words.split()}
_TAGS = frozenset("article main nav header footer aside form section table ul ol li h1 h2 h3 h4 p div blockquote pre figure figcaption dl button label a".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)|<!--|<!\[CDATA\[|<[!?]")
#: What may end a tag, or begin a value that may hide its end.
_STOP = re.compile(r">|=\s*([\"'])")
#: The end tag of a raw element; another start of its kind before it tells that it is missing, but for code.
_RAW_ENDS = {t: re.compile(rf"<(/){t}(?=[\s/>])" + ("" if t in ("script", "style") else rf"|<{t}(?=[\s/>])"), re.I) for t in RAW}
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
#: Numbers of characters: those too large for any character, and zeros in front of others.
_FAR, _ZEROS = re.compile(r"&#(?:[1-9][0-9]{7,}|[xX][1-9a-fA-F][0-9a-fA-F]{7,});?"), re.compile(r"&#(?:0+(?=[0-9])|([xX])0+(?=[0-9a-fA-F]))")
_SPACE = re.compile(r"\s+")
_LEGAL = re.compile(r"©|\(c\)|copyright|all rights reserved|cookie|privacy|subscribe|newsletter|advertis|sponsor", re.I)


class Tags:
    """The marks of a page in order, each (start, end, name, closing): comments and the like have an empty name, and a raw
    element is one mark named `<` up to the end of its end tag, a section of plain characters one named `[`. A quoted value
    may hold a `>`, unless its quote never closes."""

    def __init__(self, page: str):
        self.page = page
        self.open_quotes: set[str] = set()

    def _after(self, sign: str, at: int) -> int:
        found = self.page.find(sign, at)
        return len(self.page) if found < 0 else found + len(sign)

    def _end(self, at: int) -> int:
        first = -1
        while stop := _STOP.search(self.page, at):
            if not stop[1]:
                return stop.end()
            at = stop.end()
            if stop[1] not in self.open_quotes:
                close = self.page.find(stop[1], at)
                if close < 0:
                    self.open_quotes.add(stop[1])
                else:
                    at = close + 1
        return len(self.page)

    def __iter__(self) -> Iterator[tuple[int, int, str, bool]]:
        page, at, cdata = self.page, 0, True
        while found := _TAG.search(page, at):
            start, at = found.start(), found.end()
            name = (found[2] or "").lower()
            if name:
                at = self._end(at)
                if name in RAW and not found[1] and page[at - 2 : at] != "/>":
                    end = self._raw(name, at)
                    name, at = ("<" if end > at or name in ("script", "style", "title") else name), end
            elif found[0] == "<!--":
                at = self._after("-->", at)
            elif cdata and found[0] == "<![CDATA[":
                close = page.find("]]>", at)
                cdata = close >= 0
                yield start, (close + 3 if cdata else at), "[" if cdata else "", False
                at = close + 3 if cdata else at
                continue
            else:
                at = self._after(">", at)
            yield start, at, name, bool(found[1])

    def _raw(self, name: str, at: int) -> int:
        """Where a raw element that is open at `at` ends."""
        end = _RAW_ENDS[name].search(self.page, at)
        if end and end[1]:
            return self._after(">", end.end())
        if name in ("script", "style"):
            return len(self.page)
        if name == "title":  # without its end it holds a line of text
            after = _TAG.search(self.page, at)
            return after.start() if after else len(self.page)
        return at


def _silent(tags: list[tuple[int, int, str, bool]]) -> dict[int, int]:
    """Start of each silent element that has its end tag, to the end of that tag; raw ones and options are left out."""
    out: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for start, end, name, closing in tags:
        if name in SILENT and name not in RAW and name != "option":
            if not closing:
                opened.setdefault(name, []).append(start)
            elif opened.get(name):
                out[opened[name].pop()] = end
    return out


class Open:
    """The open tags of a page, with places by name, of blocks and of scopes, so that no step searches them."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []
        self.marks: Counter[str] = Counter()

    def push(self, name: str, marks: tuple[str, ...]) -> None:
        place = len(self.stack)
        self.at.setdefault(name, []).append(place)
        if name not in INLINE:
            self.blocks.append(place)
        if name in SCOPES:
            self.scopes.append(place)
        self.marks.update(marks)
        self.stack.append((name, marks))

    def last(self, name: str) -> int:
        return self.at[name][-1] if self.at.get(name) else -1

    def close(self, place: int) -> None:
        """Closes the tag at a place and all within it."""
        while len(self.stack) > place:
            name, marks = self.stack.pop()
            self.at[name].pop()
            for held in (self.blocks, self.scopes):
                if held and held[-1] == len(self.stack):
                    held.pop()
            self.marks.subtract(marks)


def decoded(text: str) -> str:
    """Character references as characters; numbers of any length."""
    if "&#" in text:
        text = _FAR.sub("\ufffd", _ZEROS.sub(r"&#\1", text))
    return entities.unescape(text)


def blocks(page: str) -> list[tuple[str, tuple[str, ...], int]]:
    """The leaf blocks of a page in order: (text, features of its ancestors, characters within links)."""
    out: list[tuple[str, tuple[str, ...], int]] = []
    opened = Open()
    parts: list[str] = []
    linked = 0
    hush = -1  # place of the outermost silent tag that lacks its end

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", decoded("".join(parts))).strip()
        if text:
            marks = tuple(sorted(m for m, n in opened.marks.items() if n))
            inner = opened.stack[opened.blocks[-1]][0] if opened.blocks else ""
            out.append((text, (*marks, "in:" + (inner if inner in _TAGS else "other")), linked))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if opened.last("a") >= max(0, len(opened.stack) - 4):
            linked += len(text.strip())

    at = 0
    tags = list(Tags(page))
    ends = _silent(tags)
    for start, end, name, closing in tags:
        if start < at:
            continue  # within a silent element
        if hush < 0 and start > at:
            add(page[at:start])
        at = end
        if name == "[" and hush < 0:
            add(page[start + 9 : end - 3])
        if name in ("", "["):
            continue
        if name in ("head", "<"):
            flush()
            continue
        alone = page[end - 2 : end] == "/>"
        if name in SILENT and not closing:
            flush()
            if alone:
                continue
            if start in ends:
                at = ends[start]
                continue
        if name in INLINE:
            if name == "br":
                parts.append(" ")
        else:
            flush()
        if name in VOID:
            continue
        if closing:
            place = opened.last(name)
            # an inline end tag does not close blocks
            if place >= 0 and not (name in INLINE and opened.blocks and opened.blocks[-1] > place):
                opened.close(place)
                hush = hush if hush < len(opened.stack) else -1
            continue
        if name in SELF_CLOSING and opened.last(name) > (opened.scopes[-1] if opened.scopes else -1):
            opened.close(opened.last(name))
            hush = hush if hush < len(opened.stack) else -1
        if alone:
            continue
        marks = {"tag:" + name} if name in _TAGS else set()
        for value in _NAMED.findall(page, start, end):
            value = value.strip("\"'").lower()
            marks.update("kind:" + _KIND_OF[w] for w in {*value.split(), *re.split(r"[\s_\-]+", value)} if w in _KIND_OF)
        if name in SILENT and hush < 0:
            hush = len(opened.stack)
        opened.push(name, tuple(marks))
    if hush < 0 and at < len(page):
        add(page[at:])
    flush()
    return out


def features(block: tuple[str, tuple[str, ...], int]) -> list[str]:
    """Names of the binary features of a block."""
    text, marks, linked = block
    words = text.count(" ") + 1
    size = "1" if words == 1 else "2-4" if words < 5 else "5-14" if words < 15 else "15-39" if words < 40 else "40+"
    share = linked / len(text)
    out = [*marks, "words:" + size, "links:" + ("none" if share < 0.05 else "some" if share < 0.6 else "all")]
    if text[-1] in ".!?:…。":
        out.append("ends")
    if len(text) < 300 and _LEGAL.search(text):
        out.append("legal")
    return out


class Field:
    """A two-label linear-chain conditional random field over binary features."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, pairs: np.ndarray):
        self.names, self.weights, self.pairs = names, weights, pairs

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        """(blocks, 2): the sum of the weights of each block's features for each label."""
        out = np.zeros((len(rows), 2))
        for i, row in enumerate(rows):
            at = [self.names[f] for f in row if f in self.names]
            out[i] = self.weights[at].sum(axis=0) + self.weights[-1]
        return out

    def decode(self, rows: list[list[str]]) -> np.ndarray:
        """The likeliest labels (Viterbi)."""
        s = self.scores(rows).tolist()
        if not s:
            return np.zeros(0, dtype=int)
        (p00, p01), (p10, p11) = self.pairs.tolist()
        a, b = s[0]
        back = []
        for x, y in s[1:]:
            via0, via1 = (a + p00, b + p10), (a + p01, b + p11)
            back.append((via0[1] > via0[0], via1[1] > via1[0]))
            a, b = max(via0) + x, max(via1) + y
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return np.array(out[::-1])


def fit(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 100, rate: float = 2.0, ridge: float = 2e-4) -> Field:
    """A field fitted to labelled pages (features of the blocks, labels) by full-batch gradient ascent with momentum."""
    names = {f: i for i, f in enumerate(sorted({f for rows, _ in pages for row in rows for f in row}))}
    longest = max(len(rows) for rows, _ in pages)
    # pages side by side, short ones filled up with blocks that do not count
    x = np.zeros((len(pages), longest, len(names) + 1))
    y, real = np.zeros((len(pages), longest), dtype=int), np.zeros((len(pages), longest), dtype=bool)
    for p, (rows, labels) in enumerate(pages):
        y[p, : len(rows)], real[p, : len(rows)] = labels, True
        for i, row in enumerate(rows):
            x[p, i, [*(names[f] for f in row), -1]] = 1
    flat = x.reshape(-1, x.shape[2])
    last = real.sum(axis=1) - 1
    both = real[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
    w, t = np.zeros((len(names) + 1, 2)), np.zeros((2, 2))
    vw, vt = np.zeros_like(w), np.zeros_like(t)
    total = int(real.sum())
    for _ in range(rounds):
        s = (flat @ w).reshape(*y.shape, 2)
        fore, rear = np.zeros_like(s), np.zeros_like(s)
        fore[:, 0] = s[:, 0]
        for i in range(1, longest):
            fore[:, i] = np.logaddexp(fore[:, i - 1, :1] + t[0], fore[:, i - 1, 1:] + t[1]) + s[:, i]
        for i in range(longest - 2, -1, -1):
            ahead = s[:, i + 1] + rear[:, i + 1]
            step = np.logaddexp(t[:, 0] + ahead[:, :1], t[:, 1] + ahead[:, 1:])
            rear[:, i] = np.where(both[:, i, None], step, 0.0)
        z = np.logaddexp(*np.moveaxis(fore[np.arange(len(last)), last], -1, 0))[:, None, None]
        gap = np.where(real[:, :, None], np.eye(2)[y] - np.exp(np.minimum(fore + rear - z, 0)), 0.0)
        gw = flat.T @ gap.reshape(-1, 2) - ridge * total * w
        joint = np.exp(np.minimum(fore[:, :-1, :, None] + t + (s[:, 1:] + rear[:, 1:])[:, :, None, :] - z[..., None], 0))
        gt = seen - (joint * both[:, :, None, None]).sum(axis=(0, 1)) - ridge * total * t
        vw, vt = 0.9 * vw + gw / total, 0.9 * vt + gt / total
        w, t = w + rate * vw * 0.2, t + rate * vt * 0.2
    return Field(names, w, t)


#: Pages that the default field is fitted on, and the seed that writes them.
TRAINING_PAGES = 300
TRAINING_SEED = 7


def labelled_pages(count: int = TRAINING_PAGES, seed: int = TRAINING_SEED) -> list[list[tuple[str, int]]]:
    """Pages in the shape of common sites, as pieces of html each with the label of its text (1 main, 0 not)."""
    rng = random.Random(seed)
    syllables = "ka lo mi ten sor el va ri un che da po ist ern al qui".split()

    def words(n: int) -> str:
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))

    def sentence(low: int, high: int) -> str:
        return words(rng.randint(low, high)).capitalize() + rng.choice(".....?!")

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{words(1)}">{words(rng.randint(1, 3))}</a></li>' for _ in range(n))

    def prose(low: int = 1, high: int = 4) -> str:
        text = " ".join(sentence(1, 25) for _ in range(rng.randint(low, high)))
        return text if rng.random() < 0.7 else text + f' <a href="/x">{words(2)}</a> ' + sentence(3, 12)

    def attr(kind: str) -> str:
        # a fifth of the names mean nothing, as those that build tools make
        named = rng.choice(KINDS[kind].split()) if rng.random() < 0.8 else words(1)
        return f' {rng.choice(["class", "id"])}="{rng.choice(["", "site-", "block ", "x-"])}{named}"'

    def menu() -> list[tuple[str, int]]:
        shell = rng.choice([("<nav>", "</nav>"), (f"<div{attr('menu')}>", "</div>"), (f"<ul{attr('menu')}>", "</ul>"), ("<nav role=\"navigation\">", "</nav>")])
        return [(f"{shell[0]}<ul>{links(rng.randint(2, 8))}</ul>{shell[1]}", 0)]

    def box(kind: str, low: int, high: int, tags: str) -> list[tuple[str, int]]:
        tag = rng.choice(tags.split())
        named = attr(kind) if tag in ("div", "section", "p", "ul", "span") or rng.random() < 0.5 else ""
        inner = rng.choice([f"<p>{prose(low, high)}</p>", prose(low, high), f"<h3>{words(2)}</h3><p>{prose(low, high)}</p>", f"<h4>{words(2)}</h4><ul>{links(4)}</ul>"])
        return [(f"<{tag}{named}>{inner}</{tag}>", 0)]

    def frame(tag: str) -> list[tuple[str, int]]:
        text = rng.choice([f"&copy; {words(1)}.example &middot; {prose(1, 1)}", words(3), f"<p>{prose(1, 2)}</p>", f"<h2>{words(2)}</h2><p>{words(5)}</p>", f"<ul>{links(3)}</ul>"])
        shell = f"<{tag}>" if rng.random() < 0.6 else f"<div{attr('frame')}>"
        return [(shell + text + ("</div>" if shell.startswith("<div") else f"</{tag}>"), 0)]

    def form() -> list[tuple[str, int]]:
        fields = [f"<label>{words(2)}</label>", "<input name=q>", f"<button>{words(1)}</button>", f"<p>{prose(1, 1)}</p>"]
        inner = "".join(rng.sample(fields, rng.randint(1, 4)))
        return [(f"<form{rng.choice(['', attr('form')])}>{inner}</form>", 0)]

    def comments() -> list[tuple[str, int]]:
        shell = rng.choice(["section", "div", "ol", "ul"])
        item = rng.choice(["li", "div", "article"])
        each = "".join(f"<{item}><b>{words(1)}</b><p>{prose(1, 3)}</p></{item}>" for _ in range(rng.randint(1, 4)))
        return [(f"<{shell}{attr('comment')}><h3>{words(1)}</h3>{each}</{shell}>", 0)]

    def body_blocks() -> list[tuple[str, int]]:
        out = [(f"<h1>{sentence(2, 10)}</h1>", 1)] if rng.random() < 0.85 else []
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            if kind < 0.62:
                out.append((f"<p>{prose()}</p>", 1))
            elif kind < 0.7:
                out.append((f"<p><b>{words(4)}<br><p>{prose()}</p>", 1))
            elif kind < 0.78:
                out.append((f"<h2>{words(rng.randint(1, 6))}</h2>", 1))
            elif kind < 0.84:
                items = "".join(f"<li>{prose(1, 1)}</li>" for _ in range(3))
                out.append((f"<ul>{items}</ul>", 1))
            elif kind < 0.88:
                cells = "".join(f"<tr><td>{words(2)}</td><td>{words(1)}</td></tr>" for _ in range(3))
                out.append((f"<table>{cells}</table>", 1))
            elif kind < 0.91:
                out.append((f"<blockquote>{prose()}</blockquote>", 1))
            elif kind < 0.94:
                out.append((f"<pre>{words(9)}</pre>", 1))
            elif kind < 0.965:
                out += box(rng.choice(["advert", "side", "notice", "comment"]), 1, 2, "div aside section")
            else:
                out += form()
        return out

    made = []
    for _ in range(count):
        page = [("<html><head><title>t</title></head><body>", 0)]
        for part, chance in ((lambda: frame("header"), 0.5), (menu, 0.8), (lambda: box("notice", 1, 2, "div section"), 0.3), (lambda: box("advert", 1, 2, "div section"), 0.5), (form, 0.2)):
            if rng.random() < chance:
                page += part()
        opened, closed = rng.choice([("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), (f"<div{attr('main')}>", "</div>"), ("<main><article>", "</article></main>"), (f"<section{attr('main')}>", "</section>"), ("<div>", "</div>"), ("", "")])
        page += [(opened, 0), *body_blocks()]
        if rng.random() < 0.15:
            page += comments()
        page.append((closed, 0))
        for part, chance in ((comments, 0.4), (lambda: box("side", 1, 3, "aside div"), 0.5), (form, 0.2), (lambda: box("advert", 1, 2, "div"), 0.2), (lambda: box("notice", 1, 2, "div"), 0.2), (menu, 0.2), (lambda: frame("footer"), 0.8)):
            if rng.random() < chance:
                page += part()
        made.append([*page, ("</body></html>", 0)])
    return made


def examples(pages: list[list[tuple[str, int]]]) -> list[tuple[list[list[str]], list[int]]]:
    """Features and labels of the blocks of labelled pages: each piece's text is marked by a symbol that is taken out again."""
    out = []
    for pieces in pages:
        marked = "".join(re.sub(r">([^<]*[^<\s][^<]*)", ">\\1", p) if label else p for p, label in pieces)
        found = blocks(marked)
        labels = [int("" in text) for text, _, _ in found]
        rows = [features((text.replace("", "") or "x", marks, linked)) for text, marks, linked in found]
        if rows:
            out.append((rows, labels))
    return out


@functools.cache
def default_field() -> Field:
    """The field fitted on the pages of `labelled_pages`; the same on every run."""
    return fit(examples(labelled_pages()))


def main_text(page: str | None, field: Field) -> str:
    """The main text of a page: its blocks labelled so, in order, joined by one space."""
    found = blocks(page or "")
    labels = field.decode([features(b) for b in found])
    return " ".join(b[0] for b, label in zip(found, labels, strict=True) if label)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """Rows (page_id, url, text, n_chars): the main text of every page."""
    model, pages = field or default_field(), lean(pages)

    @F.pandas_udf("string")
    def texts(lots: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lot in lots:
            yield pd.Series([main_text(page, model) for page in lot], dtype="object")

    found = pages.select("page_id", "url", texts(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
