"""Main text of web pages by a conditional random field (operator 3).

A page is cut into its leaf blocks of text.  A linear-chain conditional random
field labels the sequence of blocks as article text or not, from the tags,
class and id words of a block's ancestors, from features of its text that no
language or vocabulary decides, and from its place: how the long text of the
page is spread over the elements, and what its neighbours are.  It is trained by
gradient steps on labelled pages, which ``training_pages`` lays out from the
kinds of parts that pages have, in named, unnamed and randomly named elements of
many layouts, and decoded by Viterbi.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.common import text_udf

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
                  r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_CLASS_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements whose content is raw text, to their end tag or the end of the page.
_RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"}
#: Elements whose content is no text of the page.  One without an end tag inside its
#: parent has no content: what follows it stays.
_DROPPED = {"noscript", "template", "svg", "object", "canvas", "audio", "video", "select", "annotation"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
           "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
           "sub", "sup", "time", "tt", "u", "var", "button", "math", "semantics", "mi", "mo", "mn", "mrow", "msup", "msub",
           "mfrac", "msqrt", "mtext", "mover", "munder"}
#: Elements of text: what they stand in is the container of their blocks.
_OF_TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre", "figure",
            "figcaption", "table", "thead", "tbody", "tfoot", "tr", "th", "caption"}
#: An opening tag ends these open elements (inside the given scope).
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "option": ({"option"}, {"select"})}


@dataclass(slots=True)
class Block:
    path: tuple[str, ...]  # ancestors from the outermost, each "tag class-and-id words"
    text: str
    linked: int  # characters inside links
    nodes: tuple[int, ...] = ()  # numbers of the ancestors within the page


class _Ends:
    """Where elements that are dropped end."""

    def __init__(self, page: str):
        self.page = page
        self.last: dict[str, int] = {}  # where the last end tag of a name begins

    def of(self, tag: str, at: int) -> int | None:
        """The place after the end tag of the element whose content begins at ``at``;
        None if its parent ends first, or the page."""
        if tag not in self.last:
            self.last[tag] = self.page.lower().rfind(f"</{tag}")
        if self.last[tag] < at:
            return None
        depth, inner = 1, {}
        for m in _TAG.finditer(self.page, at):
            name = (m[2] or "").lower()
            if name == tag:
                depth += -1 if m[1] else 1
                if not depth:
                    return m.end()
            elif name and name not in _VOID and name not in _INLINE and not m[3].endswith("/"):
                inner[name] = inner.get(name, 0) + (-1 if m[1] else 1)
                if inner[name] < 0:  # ends what was open before
                    return None
        return None


def leaf_blocks(page: str) -> list[Block]:
    """The blocks of text of a page in page order: character references decoded,
    runs of white space made one space, trimmed, none empty.  Never fails: what
    is no tag is text, open elements end with the page."""
    blocks: list[Block] = []
    path: list[str] = []  # of open elements other than inline ones
    tags: list[str] = []
    nodes: list[int] = []
    parts: list[str] = []
    links, linked, made = 0, 0, 0
    ends_of = _Ends(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                blocks.append(Block(tuple(path), text, min(linked, len(text)), tuple(nodes)))
            parts.clear()
        linked = 0

    def pop_to(i: int) -> None:
        del path[i:], tags[i:], nodes[i:]

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        piece = page[at:m.start()] if m else page[at:]
        if piece:
            parts.append(piece)
            if links:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:].removesuffix("]]>"))
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in _RAW or tag in _DROPPED:
            if tag not in ("script", "style"):
                flush()
            if closing or m[3].endswith("/"):
                continue
            if tag in _RAW:
                end = re.compile(rf"</{tag}\s*>?", re.I).search(page, at)
                at = end.end() if end else n
            else:
                at = ends_of.of(tag, at) or at
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag in _INLINE:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        links = 0
        if tag in _VOID:
            continue
        if closing:
            for i in range(len(tags) - 1, -1, -1):
                if tags[i] == tag:
                    pop_to(i)
                    break
            continue
        if tags and tags[-1] == "p":  # a paragraph ends where another block begins
            pop_to(len(tags) - 1)
        if tag in _ENDS:
            ends, scope = _ENDS[tag]
            for i in range(len(tags) - 1, -1, -1):
                if tags[i] in scope:
                    break
                if tags[i] in ends:
                    pop_to(i)
                    break
        path.append(tag + _class_words(m[3]) if m[3] else tag)
        tags.append(tag)
        made += 1
        nodes.append(made)
    flush()
    return blocks


def _class_words(attributes: str) -> str:
    words = []
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value)):
            words.append("hidden")
        elif name in ("class", "id", "role"):
            words += [w.lower() for w in _CLASS_WORD.findall(value)]
    return "".join(" " + w for w in words)


@lru_cache(maxsize=100_000)
def _path_features(path: tuple[str, ...]) -> tuple[str, ...]:
    out = set()
    for i, element in enumerate(path):
        tag, *words = element.split(" ")
        out.add(f"in {tag}")
        if i == len(path) - 1:
            out.add(f"leaf {tag}")
        for w in words:
            out.add(f"word {w}")
            if len(w) > 4:
                out.add(f"stem {w[:5]}")
    return tuple(out)


def _text_features(block: Block) -> tuple[str, ...]:
    text = block.text
    words = text.count(" ") + 1
    size = "1" if words == 1 else "few" if words < 5 else "line" if words < 12 else "some" if words < 30 else "many"
    share = block.linked / len(text)
    link = "none" if not share else "part" if share < 0.5 else "most"
    out = [f"words {size}", f"link {link}", "stop" if text[-1] in ".!?…。！？:;\"”»)" else "no stop"]
    if "©" in text or "(c)" in text.lower():
        out.append("copyright")
    return tuple(out)


def _bin(x: float, *edges: float) -> int:
    return sum(x >= e for e in edges)


def _place_features(blocks: list[Block]) -> list[tuple[str, ...]]:
    """Features of each block's place in the page.  A long block has twelve words or
    more outside of links.  The main element is the innermost one that holds most
    of the page's long text."""
    n = len(blocks)
    plain = [len(b.text) - b.linked for b in blocks]
    long = [b.text.count(" ") >= 11 and p > len(b.text) / 2 for b, p in zip(blocks, plain, strict=True)]
    held: dict[int, int] = {}       # long text by element
    total = sum(p for p, x in zip(plain, long, strict=True) if x)
    container, sizes, links, counts = [], {}, {}, {}
    tags = {0: ""}
    holds: dict[int, int] = {}      # blocks by element
    for b in blocks:
        for node in b.nodes:
            holds[node] = holds.get(node, 0) + 1
    for b, p, x in zip(blocks, plain, long, strict=True):
        own = 0
        for node, element in zip(b.nodes, b.path, strict=True):
            tag = tags.setdefault(node, element.split(" ", 1)[0])
            if x:
                held[node] = held.get(node, 0) + p
            if tag not in _OF_TEXT and (holds[node] > 1 or not own):
                own = node          # an element of one block only is like a paragraph
        container.append(own)
        sizes[own] = sizes.get(own, 0) + len(b.text)
        links[own] = links.get(own, 0) + b.linked
        counts[own] = counts.get(own, 0) + 1
    main, deepest = 0, -1
    for b, x in zip(blocks, long, strict=True):
        if x:
            for depth, node in enumerate(b.nodes):
                if depth > deepest and tags[node] not in _OF_TEXT and held[node] >= 0.6 * total:
                    main, deepest = node, depth
    inside = [not main or main in b.nodes for b in blocks]
    places = [i for i in range(n) if long[i] and inside[i]]
    first, last = (places[0], places[-1]) if places else (n, -1)
    before, after = [0] * n, [0] * n        # long neighbours in the same container, this one left out
    for i in range(1, n):
        before[i] = before[i - 1] + 1 if long[i - 1] and container[i - 1] == container[i] else 0
    for i in range(n - 2, -1, -1):
        after[i] = after[i + 1] + 1 if long[i + 1] and container[i + 1] == container[i] else 0
    out = []
    for i, b in enumerate(blocks):
        own = container[i]
        short = "long" if long[i] else "short"
        between = "before" if i < first else "after" if i > last else "between"
        steps = sum(tags[k] not in _OF_TEXT for k in b.nodes[b.nodes.index(main) + 1:]) if main and main in b.nodes else 0
        heading = b.path[-1][:2] in ("h1", "h2", "h3", "h4", "h5", "h6") if b.path else False
        out.append((
            f"{short} {'inside' if inside[i] else 'outside'} {_bin(steps, 1, 2)}", f"{short} {between} {_bin(steps, 1)}",
            f"{short} share {_bin(held.get(own, 0) / total if total else 0, 0.001, 0.05, 0.2, 0.5)}",
            f"{short} neighbours {_bin(before[i], 1, 2)} {_bin(after[i], 1, 2)}",
            f"container links {_bin(links[own] / max(1, sizes[own]), 0.05, 0.3, 0.6)}",
            f"container blocks {_bin(counts[own], 2, 4, 8)}", f"page {_bin(total, 1, 200, 1000)} {short}",
            f"heading {heading} {bool(after[i])} {between}"))
    return out


def features(blocks: list[Block]) -> list[tuple[str, ...]]:
    """The features of each block of a page."""
    return [_path_features(b.path) + _text_features(b) + place
            for b, place in zip(blocks, _place_features(blocks), strict=True)]


# --- labelled pages ---

_CONTENT = [("article", ""), ("main", ""), ("div", "content"), ("div", "post"), ("div", "entry-content"),
            ("div", "article-body"), ("section", "story"), ("div", "main-content"), ("div", "text"), ("article", "post"),
            ("div", "page"), ("td", "content"), ("body", "")]
_BOILERPLATE = {
    "menu": [("nav", ""), ("div", "menu"), ("div", "navbar"), ("ul", "navigation"), ("div", "breadcrumbs"), ("nav", "toc"),
             ("div", "tabs"), ("div", "pagination"), ("menu", "")],
    "head": [("header", ""), ("div", "header"), ("div", "masthead"), ("div", "site-title"), ("div", "topbar"), ("div", "logo")],
    "foot": [("footer", ""), ("div", "footer"), ("div", "copyright"), ("div", "legal"), ("div", "site-info"),
             ("div", "bottom")],
    "side": [("aside", ""), ("div", "sidebar"), ("div", "widget"), ("div", "related"), ("div", "recommended"),
             ("div", "popular"), ("section", "more-stories"), ("div", "author-bio")],
    "ad": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "banner"), ("div", "sponsored"),
           ("div", "promo"), ("section", "promotion"), ("ins", "adsbygoogle"), ("aside", "ad")],
    "notice": [("div", "cookie"), ("div", "cookie-notice"), ("div", "consent"), ("div", "alert"), ("div", "notice"),
               ("div", "popup"), ("div", "modal"), ("section", "gdpr"), ("dialog", ""), ("div", "message")],
    "form": [("form", ""), ("form", "search"), ("div", "newsletter"), ("div", "subscribe"), ("form", "login"),
             ("div", "signup"), ("fieldset", ""), ("form", "contact")],
    "comments": [("section", "comments"), ("div", "comment"), ("ol", "commentlist"), ("div", "disqus"), ("div", "discussion"),
                 ("div", "replies"), ("section", "reader-comments"), ("div", "responses"), ("div", "reviews")],
    "share": [("div", "share"), ("div", "social"), ("ul", "tags"), ("div", "meta"), ("div", "byline-tools")],
}


def _words(rng: random.Random, low: int, high: int, stop: bool) -> str:
    n = rng.randint(low, high)
    words = ["".join(rng.choice("aeiou") + rng.choice("bcdlmnrst") for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words).capitalize() + ("." if stop else "")


#: Marks article text in a training page; a private character that no page means.
_MARK = "\ue000"


def _named(rng: random.Random, choices: list[tuple[str, str]], known: float, plain: tuple[str, ...]) -> tuple[str, str]:
    """Tag and attributes of an element: of the known ones, or with a made-up name or none."""
    if rng.random() < known:
        tag, words = rng.choice(choices)
    else:
        tag, words = rng.choice(plain), rng.choice(["", "", _words(rng, 1, 2, False).lower().replace(" ", "-")])
    return tag, f' {rng.choice(["class", "id"])}="{words}"' if words else ""


def _part(rng: random.Random, kind: str, known: float = 0.7) -> str:
    if kind in ("comments", "form", "ad", "notice"):    # unnamed, their long text could be an article's
        known = max(known, 0.97)
    tag, attributes = _named(rng, _BOILERPLATE[kind], known, ("div", "div", "section", "table"))
    item = lambda: f'<li><a href="/x">{_words(rng, 1, 3, False)}</a></li>'
    many = rng.randint(2, 7)
    if kind in ("menu", "share"):
        inner = "".join(item() for _ in range(many))
        inner = inner if tag in ("ul", "menu") else f"<ul>{inner}</ul>"
        if rng.random() < 0.2:
            inner = rng.choice([" | ", " "]).join(f'<a href="/{i}">{_words(rng, 1, 2, False)}</a>' for i in range(many))
    elif kind == "head":
        inner = rng.choice([f"<h1>{_words(rng, 1, 4, False)}</h1>", f'<a href="/">{_words(rng, 1, 3, False)}</a>']) \
            + rng.choice(["", f"<p>{_words(rng, 3, 11, rng.random() < 0.5)}</p>"])
    elif kind == "foot":
        inner = rng.choice(["&copy; ", "&copy; 2020 ", "" if known > 0.9 else "&copy; "]) + _words(rng, 1, 25, rng.random() < 0.6) \
            + rng.choice(["", f"<p>{_words(rng, 3, 25, True)}</p>", f"<ul>{item()}{item()}</ul>"])
    elif kind == "comments":
        one = lambda: rng.choice(["<p>{}</p>", "<div>{}</div>", "<li>{}</li>", "<div class='comment'><p>{}</p></div>"]) \
            .format(_words(rng, 3, 60, True))
        inner = rng.choice(["", f"<h3>{_words(rng, 1, 3, False)}</h3>"]) + "".join(one() for _ in range(many))
    elif kind == "form":
        inner = f"<label>{_words(rng, 1, 6, False)}</label><input name='q'>" \
            + rng.choice(["", f"<p>{_words(rng, 4, 25, True)}</p>"]) + f"<button>{_words(rng, 1, 2, False)}</button>"
    elif kind == "side":
        teaser = lambda: f'<p><a href="/t">{_words(rng, 3, 14, False)}</a></p>'
        inner = f"<h3>{_words(rng, 1, 4, False)}</h3>" + rng.choice(
            ["<ul>" + "".join(item() for _ in range(many)) + "</ul>",
             f"<p>{_words(rng, 5, 45 if attributes else 11, True)}</p>", "".join(teaser() for _ in range(many))])
    else:
        body = _words(rng, 3, 35, rng.random() < 0.8)
        inner = rng.choice([body, f"<p>{body}</p>", f"<p>{body}</p><p>{_words(rng, 2, 20, True)}</p>"])
    if tag == "table":
        inner = f"<tr><td>{inner}</td></tr>"
    return f"<{tag}{attributes}>{inner}</{tag}>"


def _article(rng: random.Random) -> str:
    """Marked text of an article, and parts that stand inside it."""
    word = lambda low, high, stop: _MARK + _words(rng, low, high, stop)
    out = [f"<h{rng.choice('112')}>{word(1, 14, rng.random() < 0.5)}</h1>"] if rng.random() < 0.75 else []
    closing = rng.random() < 0.9          # whether paragraphs have end tags
    if rng.random() < 0.15:               # a very short article among longer parts
        return "".join([*out, f"<p>{word(2, 14, True)}"])
    style = rng.random()
    if style < 0.08:                      # lines instead of paragraphs
        return "".join([*out, rng.choice(["<br>", "<br><br>"]).join(word(8, 60, True) for _ in range(rng.randint(2, 8)))])
    for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 6, 8, 12])):
        if style < 0.18:
            out.append(f"<div>{word(8, 90, True)}</div>")
            continue
        text = word(8, 120, True) if rng.random() < 0.8 else word(1, 8, rng.random() < 0.7)
        if rng.random() < 0.2:
            text += f' <a href="/y">{_words(rng, 1, 5, False)}</a> {_words(rng, 2, 9, True)}'
        form = 1.06 * rng.random()
        if form < 0.62:
            out.append(f"<p>{text}" + ("</p>" if closing else ""))
        elif form < 0.68:
            out.append(f"<div>{text}</div>")
        elif form < 0.72:
            out.append(f"<h{rng.choice('234')}>{word(1, 7, False)}</h2><p>{word(10, 60, True)}</p>")
        elif form < 0.78:
            tag = rng.choice(["ul", "ol"])
            out.append(f"<{tag}>" + "".join(f"<li>{word(2, 25, rng.random() < 0.5)}</li>" for _ in range(rng.randint(2, 5))) + f"</{tag}>")
        elif form < 0.81:
            out.append(f"<dl><dt>{word(1, 3, False)}</dt><dd>{word(4, 30, True)}</dd></dl>")
        elif form < 0.85:
            out.append(rng.choice([f"<blockquote><p>{text}</p></blockquote>", f"<blockquote>{text}</blockquote>"]))
        elif form < 0.87:
            out.append(f"<pre><code>{word(3, 40, False)}</code></pre>")
        elif form < 0.89:
            out.append(f"<figure><img src='x.png'><figcaption>{word(3, 15, rng.random() < 0.5)}</figcaption></figure>")
        elif form < 0.91:
            cell = lambda: f"<td>{word(1, 4, False)}</td>"
            out.append("<table>" + "".join(f"<tr>{cell()}{cell()}</tr>" for _ in range(rng.randint(2, 4))) + "</table>")
        elif form < 0.94:
            out.append(f'<p>{text} <a href="/y">{_words(rng, 1, 3, False)}</a> {_words(rng, 3, 9, True)}</p>')
        elif form < 0.96:
            out.append(f"<section><h2>{word(1, 6, False)}</h2><p>{word(12, 60, True)}</p><p>{word(12, 60, True)}</p></section>")
        else:
            out.append(_part(rng, rng.choice(["ad", "share", "form", "notice", "side"]), 1.0))
    return "".join(out)


def _layout(rng: random.Random) -> str:
    """A whole page: parts around an article in a named, unnamed or made-up element,
    one after the other, in columns or in cells of a table."""
    parts = lambda kinds, most: [_part(rng, k) for k in rng.sample(kinds, rng.randint(0, most))]
    above = parts(["head", "menu", "ad", "notice", "form", "menu", "side"], 4)
    below = parts(["comments", "share", "side", "ad", "foot", "foot", "menu", "form", "notice"], 4)
    if "<p>" not in "".join(above) and rng.random() < 0.3:
        above.append(_part(rng, "ad", 1.0))
    content = _article(rng)
    known = 1.0 if len(content) < 160 else 0.35     # nothing but a name shows a very short article
    tag, attributes = _named(rng, _CONTENT, known, ("div", "div", "div", "section", "main", "article", "center", ""))
    if rng.random() < 0.25 and below:
        content += below.pop(0) if "comment" in below[0] or "share" in below[0] else ""
    for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
        inner, names = _named(rng, _CONTENT[:9], 0.2, ("div", "section"))
        content = f"<{inner}{names}>{content}</{inner}>"
    kind = rng.random()
    if kind < 0.12 or tag == "td":
        cells = [_part(rng, rng.choice(["menu", "side"])) for _ in range(rng.randint(0, 2))]
        cells.insert(rng.randint(0, len(cells)), content)
        main = "<table><tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr></table>"
    elif kind < 0.25:
        columns = [content, _part(rng, "side")] if rng.random() < 0.5 else [_part(rng, "menu"), content, _part(rng, "side")]
        main = "".join(f"<div{rng.choice(['', ' class=col', ''])}>{c}</div>" for c in columns)
    else:
        main = f"<{tag}{attributes}>{content}</{tag}>" if tag and tag != "body" else content
    page = "".join([*above, main, *below])
    for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
        outer, names = _named(rng, [("div", "wrapper"), ("div", "page"), ("div", "container"), ("div", "site")], 0.5, ("div",))
        page = f"<{outer}{names}>{page}</{outer}>"
    return f"<html><body>{page}</body></html>"


def training_pages(n: int, seed: int) -> list[list[tuple[Block, int]]]:
    """Labelled pages: the blocks of each, 1 for article text."""
    rng = random.Random(seed)
    pages = []
    for _ in range(n):
        body = []
        for b in leaf_blocks(_layout(rng)):
            marked = _MARK in b.text
            if text := b.text.replace(_MARK, "").strip():
                body.append((Block(b.path, text, min(b.linked, len(text)), b.nodes), int(marked)))
        if body:
            pages.append(body)
    return pages


# --- the field ---

@dataclass(frozen=True)
class Field:
    weights: dict[str, float]  # of a feature for article text
    start: tuple[float, float]
    steps: tuple[tuple[float, float], tuple[float, float]]  # from label, to label


def train(pages: list[list[tuple[Block, int]]], rounds: int = 250, rate: float = 0.15, ridge: float = 2e-5) -> Field:
    """Maximise the conditional likelihood of the labels: forward-backward over
    all pages at once, steps by Adam, a ridge on the weights."""
    found = [features([block for block, _ in page]) for page in pages]
    names = sorted({f for page in found for block in page for f in block})
    number = {f: i for i, f in enumerate(names)}
    longest, count = max(len(p) for p in pages), len(pages)
    cells, columns, truth = [], [], np.zeros((count, longest), np.int64)
    real = np.zeros((count, longest), bool)
    for p, page in enumerate(pages):
        for t, (_, label) in enumerate(page):
            truth[p, t], real[p, t] = label, True
            for f in found[p][t]:
                cells.append(p * longest + t)
                columns.append(number[f])
    cells, columns = np.array(cells), np.array(columns)
    sizes = real.sum(axis=1)
    total = real.sum()
    theta = np.zeros(len(names) + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(count)
    for step in range(1, rounds + 1):
        w, start, steps = theta[:-6], theta[-6:-4], theta[-4:].reshape(2, 2)
        score = np.bincount(cells, w[columns], count * longest).reshape(count, longest)
        emit = np.stack([np.zeros_like(score), score], axis=2)
        alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
        alpha[:, 0] = start + emit[:, 0]
        for t in range(1, longest):
            alpha[:, t] = np.logaddexp(alpha[:, t - 1, :1] + steps[0], alpha[:, t - 1, 1:] + steps[1]) + emit[:, t]
        for t in range(longest - 2, -1, -1):
            ahead = beta[:, t + 1] + emit[:, t + 1]
            back = np.logaddexp(steps[:, 0] + ahead[:, :1], steps[:, 1] + ahead[:, 1:])
            beta[:, t] = np.where(real[:, t + 1, None], back, 0)
        last = alpha[rows, sizes - 1]
        log_z = np.logaddexp(last[:, 0], last[:, 1])
        marginal = np.exp(alpha + beta - log_z[:, None, None]) * real[:, :, None]
        grad = np.zeros_like(theta)
        grad[:-6] = np.bincount(columns, ((truth == 1) * real - marginal[:, :, 1]).ravel()[cells], len(names))
        for y in (0, 1):
            grad[-6 + y] = ((truth[:, 0] == y) - marginal[:, 0, y]).sum()
            for z in (0, 1):
                pair = np.exp(alpha[:, :-1, y] + steps[y, z] + emit[:, 1:, z] + beta[:, 1:, z] - log_z[:, None])
                seen = (truth[:, :-1] == y) & (truth[:, 1:] == z)
                grad[-4 + 2 * y + z] = ((seen - pair) * real[:, 1:]).sum()
        grad = grad / total - ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    steps = theta[-4:].reshape(2, 2).tolist()
    return Field(dict(zip(names, theta[:-6].tolist(), strict=True)), (theta[-6], theta[-5]),
                 ((steps[0][0], steps[0][1]), (steps[1][0], steps[1][1])))


@lru_cache(maxsize=2)
def default_field(pages: int = 2500, seed: int = 3) -> Field:
    return train(training_pages(pages, seed))


def decode(blocks: list[Block], field: Field, known: dict[tuple[str, ...], float] | None = None) -> list[int]:
    """The most likely labels (Viterbi); ``known`` keeps the scores of paths."""
    known = {} if known is None else known
    weights = field.weights
    (s00, s01), (s10, s11) = field.steps
    back: list[tuple[int, int]] = []
    a = b = 0.0
    for t, (block, place) in enumerate(zip(blocks, _place_features(blocks), strict=True)):
        emit = known.get(block.path)
        if emit is None:
            emit = known[block.path] = sum(weights.get(f, 0.0) for f in _path_features(block.path))
        emit += sum(weights.get(f, 0.0) for f in _text_features(block) + place)
        if not t:
            a, b = field.start[0], field.start[1] + emit
            continue
        to0, to1 = (a + s00, b + s10), (a + s01, b + s11)
        back.append((int(to0[1] > to0[0]), int(to1[1] > to1[0])))
        a, b = max(to0), max(to1) + emit
    if not blocks:
        return []
    labels = [int(b > a)]
    for step in reversed(back):
        labels.append(step[labels[-1]])
    return labels[::-1]


def main_text(page: str, field: Field, known: dict | None = None) -> str:
    """The article's blocks in page order, joined by two line feeds."""
    blocks = leaf_blocks(page)
    return "\n\n".join(b.text for b, label in zip(blocks, decode(blocks, field, known), strict=True) if label)


def extract(pages: DataFrame, field: Field | None = None, key: str = "page_id") -> DataFrame:
    """key, url, text (empty if none), n_chars (code points) of every whole page.

    One row per input row; null html is an empty page; null or repeated keys and
    null urls are kept as they are; other columns are ignored."""
    field = field or default_field()

    def prepare():
        known: dict[tuple[str, ...], float] = {}

        def work(texts: list[str]) -> pd.DataFrame:
            if len(known) > 200_000:
                known.clear()
            out = [main_text(t, field, known) for t in texts]
            return pd.DataFrame({"text": pd.Series(out, dtype=object), "n_chars": pd.Series(map(len, out), dtype="int64")})

        return work

    return pages.select(key, "url", text_udf("text string, n_chars long", prepare)("html").alias("r")) \
        .select(key, "url", F.col("r.text").alias("text"), F.col("r.n_chars").alias("n_chars"))
