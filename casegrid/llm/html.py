"""Main text of web pages by minimum cut.

A page is cut into blocks of text. A logistic classifier, trained in numpy on the labelled page skeletons below, gives
each block a cost for the label "content" and one for "boilerplate": its terminal capacities. Neighbouring blocks, and
blocks under one parent, are tied by smoothness edges that weaken with their distance in the tree. The maximum flow
separates content from boilerplate at the least total cost.
"""

from __future__ import annotations

import functools
import html
import re
from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
#: Elements whose text is no markup: it ends at their closing tag alone. Code without one goes on to the end of the page.
RAW = {x: re.compile(rf"</{x}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for x in ("script", "style", "title", "textarea", "iframe", "xmp", "noembed", "noframes")}
CODE = ("script", "style")
RAW_END = re.compile(rf"</({'|'.join(RAW)})(?=[\s/>])", re.I)
#: Elements that aren't shown as text, where they are closed.
UNSEEN = frozenset("svg noscript template select canvas".split())
MATH = frozenset("math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input object".split()) | MATH
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag closes, besides what all block tags close (an open p).
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table body article section div main aside nav form td th".split())

BAD = re.compile(
    r"(?:^|[^a-z])(?:nav\w*|menu\w*|breadcrumb\w*|header|masthead|footer|foot|sidebar\w*|aside|rail|widget\w*|ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|notice\w*|gdpr|popup|modal|overlay|alert"
    r"|newsletter|subscri\w*|signup|login|search\w*|form|comments?|commentlist|replies|reply|respond|disqus|related|recommend\w*|share\w*|sharing|social|tags?|pagination|pager|toc|copyright|legal|skip|toolbar|topbar|hidden)(?:$|[^a-z])"
)
GOOD = re.compile(r"(?:^|[^a-z])(?:article\w*|content|main|post|entry|story|body|text|prose|hentry)(?:$|[^a-z])")
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|aria-label|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
FLAGS = ["article", "main", "nav", "header", "footer", "aside", "form", "bad", "good", "hidden", "list", "table", "figure", "quote", "header in article"]
BIT = {x: 1 << i for i, x in enumerate(FLAGS)}
NAMED = {"article": "article", "main": "main", "nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "button": "form", "fieldset": "form", "dialog": "bad", "ul": "list", "ol": "list", "dl": "list", "table": "table", "figure": "figure", "blockquote": "quote", "pre": "quote"}
KINDS = ("h1", "h2", "p", "li", "td", "div")
FEATURES = ["bias", *FLAGS, *KINDS, "other", "links", "all links", "length", "short", "stops", "mark"]
TIE, TIE_FAR, MOST_COST = 1.0, 0.5, 6.0


@functools.lru_cache(maxsize=20_000)
def own_flags(tag: str, attributes: str) -> int:
    """What a tag and its class, id and role say about the text under it."""
    flags = BIT[NAMED[tag]] if tag in NAMED else 0
    if attributes and tag not in ("body", "html"):
        if re.search(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", attributes, re.I):
            flags |= BIT["hidden"] | BIT["bad"]
        for m in ATTRIBUTE.finditer(attributes):
            value = CAMEL.sub("-", m[2].strip("\"'")).lower()
            bad, good = bool(BAD.search(value)), bool(GOOD.search(value))
            flags |= BIT["bad"] * bad | BIT["good"] * (good and not bad)
            flags |= BIT["nav"] * (value == "navigation") | BIT["footer"] * (value == "contentinfo") | BIT["header"] * (value == "banner") | BIT["aside"] * (value == "complementary")
    return flags


class Block:
    __slots__ = ("text", "flags", "tag", "links", "parent", "far")

    def __init__(self, text: str, flags: int, tag: str, links: int, parent: int, far: int):
        self.text, self.flags, self.tag, self.links, self.parent, self.far = text, flags, tag, links, parent, far


class Tag:
    """A tag of the page: where it starts, where the text after it starts, and what it says. ``name`` is empty for comments and declarations."""

    __slots__ = ("start", "end", "closes", "name", "attributes", "alone", "skip")

    def __init__(self, start: int, end: int, closes: bool = False, name: str = "", attributes: str = ""):
        self.start, self.end, self.closes, self.name, self.attributes = start, end, closes, name, attributes
        self.alone = attributes.endswith("/") and (name in ("svg", "math") or "-" in name)
        self.skip = 0


def tags(page: str) -> list[Tag]:
    """The page's tags in order. Raw text is part of its opening tag; ``skip`` of one that opens an unseen element is
    the number of the tag that closes it (0 if none does)."""
    last: dict[str, int] = {}
    for m in RAW_END.finditer(page):
        last[m[1].lower()] = m.start()
    cdata = page.rfind("]]>")
    out: list[Tag] = []
    opened: dict[str, list[int]] = {}
    at = 0
    while m := TAG.search(page, at):
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if m[0] == "<![CDATA[":  # its text is text, up to its end
                end = page.find("]]>", at) if cdata >= at else -1
                out.append(Tag(m.start(), at))
                if end >= 0:
                    out.append(Tag(end, end + 3))
                    at = end + 3
            else:
                out.append(Tag(m.start(), at))
            continue
        closes, attributes = (m[1], m[3]) if m[2] else (m[4], m[6])
        tag = Tag(m.start(), at, bool(closes), name, attributes.strip())
        if name in RAW and not closes:
            if last.get(name, -1) >= at:
                at = RAW[name].search(page, at).end()
            elif name in CODE:
                at = len(page)
            if at != tag.end:
                tag = Tag(m.start(), at)
        elif name in UNSEEN and closes:
            if opened.get(name):
                out[opened[name].pop()].skip = len(out)
        elif name in UNSEEN and not tag.alone:
            opened.setdefault(name, []).append(len(out))
        out.append(tag)
    return out


def blocks(page: str) -> list[Block]:
    """The page's blocks in order: text between block tags, character references decoded, white space made one space.

    ``parent`` numbers the element that holds the block's element; ``far`` is the distance in the tree from the parent
    of the block before. Tags that are never closed end with their scope or the page.
    """
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = [("", 0, 0)]  # tag, flags of it and all above, number
    depths: dict[str, list[int]] = {}  # where each open tag stands in the stack
    number, at = 0, 0
    text: list[str] = []
    links = anchors = 0
    lowest = depth_before = 0

    def flush() -> None:
        nonlocal links, lowest, depth_before
        if text:
            joined = " ".join("".join(text).split())
            text.clear()
            if joined:
                above = len(stack) - 2 if len(stack) > 1 else 0
                lowest = min(lowest, above)
                out.append(Block(joined, stack[-1][1], stack[-1][0], links, stack[above][2], depth_before + above - 2 * lowest))
                lowest = depth_before = above
            links = 0

    def close(upto: int) -> None:
        nonlocal lowest
        for name, _, _ in stack[upto:]:
            depths[name].pop()
        del stack[upto:]
        lowest = min(lowest, len(stack) - 1)

    def deepest(names: Iterable[str]) -> int:
        return max((depths[x][-1] for x in names if depths.get(x)), default=0)

    def add(raw: str) -> None:
        nonlocal links
        if raw:
            if "&" in raw:
                raw = html.unescape(raw)
            text.append(raw)
            if anchors:
                links += len(raw.strip())

    found = tags(page)
    upto = -1
    for k, mark in enumerate(found):
        if k < upto:
            continue
        if k > upto:
            add(page[at : mark.start])
        at = mark.end
        if mark.skip:
            upto = mark.skip
        end, tag, attributes = mark.closes, mark.name, mark.attributes
        if not tag or tag in UNSEEN or mark.alone:
            continue
        if tag in INLINE:
            if tag == "a":
                anchors = max(0, anchors - 1) if end else anchors + 1
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        if end:
            if i := deepest((tag,)):
                close(i)
            anchors = 0
            continue
        shut = ("p", *CLOSES.get(tag, ()))
        if (i := deepest(shut)) and i >= deepest(SCOPES):
            close(i)
        if tag in VOID:
            continue
        flags = stack[-1][1] | own_flags(tag, attributes)
        if tag == "header" and stack[-1][1] & (BIT["article"] | BIT["main"]):
            flags = flags & ~BIT["header"] | BIT["header in article"]
        number += 1
        depths.setdefault(tag, []).append(len(stack))
        stack.append((tag, flags, number))
        anchors = 0
    add(page[at:])
    flush()
    return out


def features(block: Block) -> list[float]:
    n = len(block.text)
    share = min(1.0, block.links / n)
    tag = "h2" if block.tag in ("h3", "h4", "h5", "h6") else "td" if block.tag in ("th", "tr") else "li" if block.tag in ("dd", "dt") else block.tag
    kinds = [float(tag == k) for k in KINDS]
    words = block.text.count(" ") + 1
    return [
        1.0,
        *(float(bool(block.flags & b)) for b in BIT.values()),
        *kinds,
        float(not any(kinds)),
        share,
        float(share > 0.8),
        min(1.0, float(np.log1p(n)) / 7),
        float(words < 4),
        float(block.text[-1] in ".!?…:;\"'»”"),
        float("©" in block.text or "·" in block.text),
    ]


def ties(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: each block with the next, and with the next under the same parent where that is another."""
    out = [(i, i + 1, TIE * 2.0 ** -b.far) for i, b in enumerate(found[1:]) if b.far < 8]
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        j = last.get(b.parent)
        if j is not None and j < i - 1:
            out.append((j, i, TIE_FAR))
        last[b.parent] = i
    return out


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a maximum flow's cut. costs: what it costs to put a node on the other
    side (negative: on the source's); an edge costs its weight if it is cut.

    The network is reduced first: a node tied to at most two others is taken out, and its capacities pass to those two
    as terminal capacities and one edge between them, exactly as much as can flow through it. Each such step is
    undone in reverse once its neighbours' sides are known. Edges between neighbours in page order and within parents
    never cross, so pages reduce in a time that grows with their blocks; augmenting paths serve whatever is left.
    """
    n = len(costs)
    u = list(costs)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    gone: list[tuple[int, float, list[tuple[int, float]]]] = []
    out = [False] * n
    ready = deque(i for i in range(n) if len(near[i]) <= 2)
    while ready:
        i = ready.popleft()
        if out[i] or len(near[i]) > 2:
            continue
        own = list(near[i].items())
        gone.append((i, u[i], own))
        out[i] = True
        for j, _ in own:
            del near[j][i]
        if len(own) == 1:
            j, w = own[0]
            u[j] -= min(w, -u[i]) - min(0.0, w - u[i])
        elif own:
            (j, v), (k, w) = own
            none, first, second, both = min(0.0, v + w - u[i]), min(v, w - u[i]), min(w, v - u[i]), min(v + w, -u[i])
            tie = max(0.0, (first + second - none - both) / 2)
            u[j] -= first - none - tie
            u[k] -= second - none - tie
            if tie > 0:
                near[j][k] = near[k][j] = near[j].get(k, 0.0) + tie
        ready.extend(j for j, _ in own if len(near[j]) <= 2)
    rest = [i for i in range(n) if not out[i]]
    place = {i: k for k, i in enumerate(rest)}
    side = [False] * n
    for i, on in zip(rest, _flow([u[i] for i in rest], [{place[j]: w for j, w in near[i].items()} for i in rest]), strict=True):
        side[i] = on
    for i, x, own in reversed(gone):
        side[i] = x > sum(-w if side[j] else w for j, w in own)
    return side


def _flow(u: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Augments shortest paths until none is left; the nodes that the source still reaches are its side. A search gives
    a blocking flow: all augmenting paths of the length it found."""
    n, s, t = len(u), len(u), len(u) + 1
    room: list[dict[int, float]] = [dict(x) for x in near] + [{}, {}]
    for i, x in enumerate(u):
        room[s][i], room[i][s] = max(x, 0.0), 0.0
        room[i][t], room[t][i] = max(-x, 0.0), 0.0
    while True:
        level, queue = {s: 0}, deque([s])
        while queue:
            i = queue.popleft()
            for j, c in room[i].items():
                if c > 1e-9 and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if t not in level:
            return [i in level for i in range(n)]
        arcs, at = {i: list(room[i]) for i in level}, dict.fromkeys(level, 0)
        path = [s]
        while path:
            i = path[-1]
            if i == t:
                steps = list(zip(path[:-1], path[1:], strict=True))
                most = min(room[a][b] for a, b in steps)
                for a, b in steps:
                    room[a][b] -= most
                    room[b][a] += most
                path = [s]
                continue
            while at[i] < len(arcs[i]) and not (room[i][arcs[i][at[i]]] > 1e-9 and level.get(arcs[i][at[i]]) == level[i] + 1):
                at[i] += 1
            if at[i] < len(arcs[i]):
                path.append(arcs[i][at[i]])
            else:
                path.pop()
                level[i] = -1


#: Labelled skeletons: {text} is an article's block and {x} one of boilerplate. Each is filled with words drawn anew.
TOP = ["<header><h1>{x}</h1><p>{x}</p></header>", "<div id='header'><a href='/'>{x}</a></div>", "<div class='topbar'>{x}</div>", "", ""]
MENU = ["<nav><ul>{li}</ul></nav>", "<div class='menu'><ul>{li}</ul></div>", "<ul id='main-nav'>{li}</ul>", "<div role='navigation'>{li}</div>", "<ul>{li}</ul>", "<nav>{a}</nav>", "<div class='breadcrumbs'>{a}</div>"]
NOTE = ["<div class='ad'>{x}</div>", "<div class='advert'><p>{x}</p></div>", "<div class='cookie-notice'><p>{x}</p><button>{x}</button></div>", "<div id='banner'>{x}</div>", "<div class='promo'>{x}</div>", "<div class='notice'>{x}</div>", "", ""]
SIDE = ["<aside><h3>{x}</h3><ul>{li}</ul><p>{x}</p></aside>", "<div class='sidebar'><h2>{x}</h2>{a}<p>{x}</p></div>", "<form action='/s'><label>{x}</label><input name=q><button>{x}</button></form>", "<div class='newsletter'><form><p>{x}</p><input></form></div>", "<div class='related'><h3>{x}</h3><ul>{li}</ul></div>", "<aside><p>{x}</p></aside>", ""]
TALK = ["<section id='comments'><h2>{x}</h2><div class='comment'><p>{x}</p></div><div class='comment'><p>{x}</p></div></section>", "<div class='comments'><p>{x}</p><p>{x}</p></div>", "<ol class='commentlist'><li><p>{x}</p></li></ol>", "", "", ""]
END = ["<footer>&copy; {s} &middot; {x}</footer>", "<footer><p>{x}</p><ul>{li}</ul></footer>", "<div id='footer'><p>&copy; {s}</p></div>", "<div class='footer'>{a}</div>", "<footer><p>{x}</p></footer>"]
WRAP = [("<article>", "</article>"), ("<main><article>", "</article></main>"), ("<main>", "</main>"), ("<div class='content'>", "</div>"), ("<div id='main'><div class='post'>", "</div></div>"), ("<div>", "</div>"), ("<article><div class='entry-content'>", "</div></article>"), ("", "")]
HEAD = ["<h1>{t}</h1>", "<header><h1>{t}</h1></header>", "<h1>{t}</h1><h2>{t}</h2>", "<h2>{t}</h2>", ""]
PART = ["<p>{text}</p>"] * 8 + ["<h2>{t}</h2>", "<p>{t}</p>", "<ul><li>{text}</li><li>{text}</li></ul>", "<blockquote><p>{text}</p></blockquote>", "<p>{linked}</p>", "<table><tr><td>{t}</td><td>{t}</td></tr></table>", "<figure><figcaption>{t}</figcaption></figure>", "<p><b>{text}<br><p>{text}</p>", "<pre>{text}</pre>", "<div>{text}</div>"]
MARKS = ("\ue000", "\ue001")  # content, boilerplate


def _filled(template: str, r: np.random.Generator) -> str:
    syllable = lambda: "".join("bdfgklmnprstvz"[r.integers(14)] + "aeiou"[r.integers(5)] for _ in range(r.integers(1, 4)))
    words = lambda a, b: " ".join(syllable() for _ in range(int(r.integers(a, b))))

    def fill(m: re.Match) -> str:
        good, bad = MARKS
        kind = m[1]
        if kind == "text":
            return f"{good}{words(4, 90)}."
        if kind == "linked":
            return f"{good}{words(10, 40)} <a href='/'>{words(1, 4)}</a> {words(5, 20)}."
        if kind == "t":
            return good + words(1, 9)
        if kind == "x":
            return bad + words(1, 70 if r.random() < 0.3 else 14) + ("." if r.random() < 0.6 else "")
        if kind == "s":
            return bad + words(1, 3)
        one = lambda: f"<a href='/'>{bad}{words(1, 3)}</a>"
        return "".join(f"<li>{one()}</li>" if kind == "li" else one() for _ in range(int(r.integers(3, 8))))

    return re.sub(r"\{(\w+)\}", fill, template)


def labelled_pages(pages: int = 400, seed: int = 8) -> list[list[tuple[Block, bool]]]:
    """Blocks of drawn pages with whether they are content; a block is content if any of its marks says so."""
    r = np.random.default_rng(seed)
    pick = lambda xs: xs[int(r.integers(len(xs)))]
    out = []
    for _ in range(pages):
        opened, closed = pick(WRAP)
        body = "".join(pick(PART) for _ in range(int(r.integers(2, 9))))
        among = pick(NOTE) if r.random() < 0.3 else ""
        inside = pick((NOTE, SIDE, TALK, END)[int(r.integers(4))]) if r.random() < 0.3 else ""
        body = pick(HEAD) + among + body
        page = f"<html><body>{pick(TOP)}{pick(MENU)}{pick(NOTE)}{opened}{body}{inside}{closed}{pick(SIDE)}{pick(TALK)}{pick(END)}</body></html>"
        found = []
        for b in blocks(_filled(page, r)):
            good = MARKS[0] in b.text
            b.text = b.text.replace(MARKS[0], "").replace(MARKS[1], "")
            if b.text:
                found.append((b, good))
        out.append(found)
    return out


def trained(ridge: float = 1.0) -> np.ndarray:
    """Weights of the logistic classifier, by Newton steps on the labelled pages."""
    rows = [x for page in labelled_pages() for x in page]
    X, y = np.array([features(b) for b, _ in rows]), np.array([g for _, g in rows], float)
    w = np.zeros(X.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        step = np.linalg.solve((X * (p * (1 - p))[:, None]).T @ X + ridge * np.eye(len(w)), X.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def main_text(page: str, weights: np.ndarray) -> str:
    found = blocks(page)
    if not found:
        return ""
    costs = np.clip(np.array([features(b) for b in found]) @ weights, -MOST_COST, MOST_COST).tolist()
    return "\n\n".join(b.text for b, on in zip(found, minimum_cut(costs, ties(found)), strict=True) if on)


def extracted(pages: DataFrame, keep: list[str], page: str = "html") -> DataFrame:
    """pages' columns ``keep`` with ``text``, the main text of the whole page (empty if there is none), and ``n_chars``,
    its code points. A null or empty page gives an empty text; clashing columns give way; repeated rows are alike."""
    source = pages.select(*dict.fromkeys([*keep, page]))
    weights = trained()

    def make():
        def compute(batch: pa.RecordBatch) -> list:
            found = [main_text(x, weights) for x in common.texts(batch, page)]
            return [found, [len(x) for x in found]]

        return compute

    return common.with_arrow(source, [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())], make, keep=keep)
