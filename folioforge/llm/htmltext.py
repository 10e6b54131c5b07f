"""Main text of HTML pages: boosted trees over DOM nodes, decoded along the tree.

The page is scanned once into a tree of block-level elements with their runs
of text; inline tags only count as features (links, markup), the content of
scripts, styles and the like is never text. Every node gets features: its
tag, what its class and id tokens and its role hint at, depth, the sizes of its
subtree (characters, words, links, tags and their densities), its place among
its siblings, and what its parent and any ancestor are or hint at. Boosted trees give each node the
probability that it holds main text. Decoding maximises the likelihood of all
nodes of the page under one law: below a dropped node nothing is kept. So an
advert inside an article can go while its article stays, but a paragraph
inside a dropped sidebar cannot come back.

The model is fitted here on pages built by rule with a fixed seed.

Text: character references decoded, white space (a line break tag counts)
inside a block becomes one space, blocks are trimmed, joined in page order by a
blank line; nothing is cut short. Null html counts as empty. Scans are linear,
decoding does not recurse. Further columns are not read; repeated rows give
repeated results.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .boosting import Boosted
from .common import ship

# Element classes of HTML (fixed values, in alphabetical order)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body button caption dd dt head html legend li option select summary tbody td tfoot th thead tr".split())
#: An opening tag ends these open elements, up to the given boundary.
ENDS = {
    "li": (frozenset(("li",)), frozenset(("dir", "menu", "ol", "ul"))),
    "dt": (frozenset(("dd", "dt")), frozenset(("dl",))),
    "dd": (frozenset(("dd", "dt")), frozenset(("dl",))),
    "option": (frozenset(("option",)), frozenset(("select",))),
    "tr": (frozenset(("td", "th", "tr")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("table", "tr"))),
    "th": (frozenset(("td", "th")), frozenset(("table", "tr"))),
    "tbody": (frozenset(("tbody", "td", "tfoot", "th", "thead", "tr")), frozenset(("table",))),
    "tfoot": (frozenset(("tbody", "td", "tfoot", "th", "thead", "tr")), frozenset(("table",))),
}
#: Attributes as HTML reads them: a quote opens a value only right after "=", elsewhere it is part of a name or of an unquoted value.
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^ \t\n\r\f>\"'][^ \t\n\r\f>]*+|(?=>))"
_ATTRS = rf"(?:[ \t\n\r\f/]++|(?:=[^ \t\n\r\f/>=]*+|[^ \t\n\r\f/>=]++)(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+{_VALUE}|(?![ \t\n\r\f]*+=)))*+"
_TAG = re.compile(rf"<(?:!--(?:.*?--!?>|.*+)|[!?][^>]*+>?|(/?)([a-zA-Z][^\s/>]*+)({_ATTRS})>)", re.S)
_ATTR = re.compile(r"(class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+))", re.I)
_SPLIT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")
_HINTS = tuple(
    re.compile(p, re.I)
    for p in (
        r"(?<![a-z])(?:article|body|content|entry|main|page|post|story|text|prose)",
        r"(?<![a-z])(?:nav|menu|breadcrumb|toc|pagination|pager|tabs|skip)",
        r"(?<![a-z])(?:ad|ads|advert\w*|banner|promo\w*|sponsor\w*|dfp|outbrain|taboola)(?![a-z])",
        r"(?<![a-z])(?:comment|disqus|reply|replies|discussion|respond)",
        r"(?<![a-z])(?:sidebar|aside|widget|rail|secondary|complementary)",
        r"(?<![a-z])(?:footer|copyright|legal|colophon|contentinfo|foot)",
        r"(?<![a-z])(?:header|masthead|topbar|logo|brand|site-title|banner)",
        r"(?<![a-z])(?:cookie|notice|alert|consent|gdpr|popup|modal|overlay|message)",
        r"(?<![a-z])(?:form|search|login|subscribe|newsletter|signup|contact)",
        r"(?<![a-z])(?:share|social|related|recommend\w*|tags|meta|byline|author|more|popular|trending)",
    )
)
_GROUPS = (("article",), ("main",), ("nav", "menu", "dir"), ("aside",), ("footer",), ("header", "hgroup"), ("form", "fieldset", "button", "select", "option", "legend", "label"), ("h1",), ("h2", "h3", "h4", "h5", "h6"), ("p",), ("ul", "ol", "dl"), ("li", "dt", "dd"), ("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("blockquote", "pre", "figure", "figcaption"), ("div", "section", "center", "details", "dialog", "address", "summary", "search"), ("body", "html", "#page"), ("#text",), ("head",))
_GROUP = {t: i for i, g in enumerate(_GROUPS) for t in g}


class Page:
    """Nodes in page order, parents before children. Text nodes have tag "#text"."""

    def __init__(self):
        self.tag: list[str] = ["#page"]
        self.parent: list[int] = [-1]
        self.hint: list[str] = [""]
        self.text: list[str] = [""]
        self.linked: list[int] = [0]  # characters inside links
        self.links: list[int] = [0]
        self.inline: list[int] = [0]  # inline tags


def parse(source: str | None) -> Page:
    page = Page()
    if not source:
        return page
    stack = [(0, "#page")]  # open elements: (node, tag); inline ones carry the node they stand in
    run: list[str] = []
    state = [0, 0, 0, 0]  # characters in links, links, inline tags, open links

    def flush():
        if run:
            text = " ".join("".join(run).split())
            if text:
                page.tag.append("#text")
                page.parent.append(stack[-1][0])
                page.hint.append("")
                page.text.append(text)
                page.linked.append(min(state[0], len(text)))
                page.links.append(state[1])
                page.inline.append(state[2])
            run.clear()
        state[0] = state[1] = state[2] = 0

    def put(raw: str):
        if raw:
            text = entities.unescape(raw) if "&" in raw else raw
            run.append(text)
            if state[3]:
                state[0] += len(text)

    def close(to: int):
        flush()
        for _, t in stack[to:]:
            if t == "a":
                state[3] = 0
        del stack[to:]

    at, n = 0, len(source)
    open_count: dict[str, int] = {}

    def recount():
        open_count.clear()
        for _, t in stack:
            open_count[t] = open_count.get(t, 0) + 1

    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            put(source[at:])
            break
        m = _TAG.match(source, lt)
        if m is None:
            after = source[lt + 1 : lt + 3]
            if after[:1].isalpha() or (after[:1] == "/" and after[1:].isalpha()):
                put(source[at:lt])
                break  # the page ends inside a tag
            put(source[at : lt + 1])
            at = lt + 1
            continue
        put(source[at:lt])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name in BLOCK:
                if open_count.get(name):
                    k = len(stack) - 1
                    while stack[k][1] != name:
                        k -= 1
                    close(k)
                    recount()
                elif name == "p":
                    flush()
            else:
                if name == "br":
                    run.append("\n")
                elif name == "a":
                    state[3] = 0
                if open_count.get(name):
                    k = len(stack) - 1
                    while stack[k][1] != name:
                        k -= 1
                    if all(t not in BLOCK for _, t in stack[k:]):
                        del stack[k]
                        open_count[name] -= 1
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
            if end is None:
                break
            close_at = source.find(">", end.end())
            at = n if close_at < 0 else close_at + 1
            continue
        if name in BLOCK:
            if name in CLOSES_P and open_count.get("p"):
                k = len(stack) - 1
                while stack[k][1] != "p":
                    k -= 1
                close(k)
                recount()
            elif name in ENDS:
                ended, boundary = ENDS[name]
                k, low = len(stack) - 1, None
                while k > 0 and stack[k][1] not in boundary:
                    if stack[k][1] in ended:
                        low = k
                        if name in ("li", "dt", "dd", "option"):
                            break
                    k -= 1
                if low is not None:
                    close(low)
                    recount()
            flush()
            if name == "hr" or (name in ("html", "body") and open_count.get(name)):
                continue
            page.tag.append(name)
            page.parent.append(stack[-1][0])
            attributes = m[3]
            page.hint.append(" ".join(" ".join(filter(None, a[1:])) for a in _ATTR.findall(attributes)) if attributes else "")
            page.text.append("")
            page.linked.append(0)
            page.links.append(0)
            page.inline.append(0)
            stack.append((len(page.tag) - 1, name))
            open_count[name] = open_count.get(name, 0) + 1
        else:
            state[2] += 1
            if name == "br":
                run.append("\n")
            elif name == "a":
                state[1] += 1
                state[3] = 1
            if name not in VOID and not m[0].endswith("/>"):
                stack.append((stack[-1][0], name))
                open_count[name] = open_count.get(name, 0) + 1
    flush()
    return page


@functools.lru_cache(maxsize=20_000)
def _hint(attributes: str) -> tuple[float, ...]:
    return tuple(float(bool(h.search(attributes))) for h in _HINTS)


def features(page: Page) -> np.ndarray:
    """One row a node, computed over whole columns."""
    n = len(page.tag)
    parent = np.array(page.parent)
    group = np.array([_GROUP.get(t, 14) for t in page.tag])
    text = np.array([len(t) for t in page.text], np.float64)
    words = np.array([t.count(" ") + (t != "") for t in page.text], np.float64)
    ends = np.array([t.count(". ") + t.endswith((".", "!", "?")) for t in page.text], np.float64)
    mark = np.array([("©" in t) or ("|" in t) or ("»" in t) for t in page.text], np.float64)
    sums = np.stack([text, words, ends, np.array(page.linked, np.float64), np.array(page.links, np.float64), np.array(page.inline, np.float64), (group == _GROUP["p"]).astype(float), (group == _GROUP["li"]).astype(float), (text > 0).astype(float), np.ones(n)], 1)
    depth = np.zeros(n)
    order = parent.tolist()
    flat = depth.tolist()
    for i in range(1, n):
        flat[i] = flat[order[i]] + 1
    depth = np.array(flat)
    for d in range(int(depth.max()), 0, -1):  # subtree sums, level by level
        at = np.flatnonzero(depth == d)
        np.add.at(sums, parent[at], sums[at])
    up = np.maximum(parent, 0)
    children = np.bincount(up[1:], minlength=n).astype(float)
    rank = np.zeros(n)
    by_parent = np.argsort(up[1:], kind="stable") + 1
    first = np.flatnonzero(np.diff(up[by_parent], prepend=-1))
    rank[by_parent] = np.arange(n - 1) - np.repeat(first, np.diff(np.append(first, n - 1)))
    same = np.zeros(n)
    key = up * 64 + group
    _, inverse, times = np.unique(key[1:], return_inverse=True, return_counts=True)
    same[1:] = times[inverse]
    mates = np.zeros(n)
    mates[1:] = np.bincount(inverse, sums[1:, 0])[inverse] / times[inverse]
    total = np.maximum(sums[0], 1)
    hints = np.array([_hint(h) for h in page.hint])
    one = np.eye(len(_GROUPS))[group]
    own = np.concatenate([one, hints], 1)
    above = np.zeros_like(own)  # what any ancestor is or hints at
    for d in range(1, int(depth.max()) + 1):
        at = np.flatnonzero(depth == d)
        above[at] = np.maximum(above[parent[at]], own[parent[at]])
    full = np.maximum(sums[:, 0], 1)
    numbers = np.stack(
        [
            depth, np.log1p(sums[:, 0]), np.log1p(sums[:, 1]), sums[:, 2] / np.maximum(sums[:, 1], 1), np.log1p(sums[:, 2]), sums[:, 3] / full, np.log1p(sums[:, 4]),
            sums[:, 5] / full, sums[:, 0] / sums[:, 9], sums[:, 6], sums[:, 7], sums[:, 7] / np.maximum(sums[:, 8], 1), sums[:, 6] / np.maximum(sums[:, 8], 1), np.log1p(sums[:, 9]),
            sums[:, 0] / total[0], sums[:, 8] / total[8], children, children[up], rank, rank / np.maximum(children[up], 1), same, np.log1p(mates), mark, sums[:, 0] / np.maximum(full[up], 1), sums[up, 3] / full[up],
            np.arange(n) / n, np.log1p(total[0]) * np.ones(n),
        ],
        1,
    )
    return np.concatenate([own, own[up], above, numbers], 1)


def decode(parent: list[int], prob: np.ndarray) -> np.ndarray:
    """Kept nodes: the likeliest choice in which nothing below a dropped node is kept."""
    n = len(parent)
    p = np.clip(prob, 1e-4, 1 - 1e-4)
    keep, drop = np.log(p).tolist(), np.log(1 - p).tolist()
    for i in range(n - 1, 0, -1):  # children come after their parents
        drop[parent[i]] += drop[i]
        keep[parent[i]] += max(keep[i], drop[i])
    kept = np.zeros(n, bool)
    for i in range(n):
        kept[i] = (i == 0 or kept[parent[i]]) and keep[i] > drop[i]
    return kept


# --- pages to fit on ---------------------------------------------------------------------


def _build(r: random.Random) -> tuple[str, list[str]]:
    """A page and the blocks of its main text."""
    letters = r.choice(("etaoinshrdlu", "enisratdhulcgmobwfkzü", "eaosrnidlcñé", "esaitnrulodcpéè"))
    word = lambda: "".join(r.choice(letters) for _ in range(r.randint(1, 9)))
    phrase = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    odd = r.random() < 0.15

    def sentences(a, b):
        s = " ".join(phrase(1, 16).capitalize() + r.choice((".", ".", ".", "?", "!")) for _ in range(r.randint(a, b)))
        return " ".join(w + r.choice(("***", "%%%", "###", "$$$")) for w in s.split()) if odd else s

    main: list[str] = []
    name = lambda *c: r.choice(("", "", f' class="{r.choice(c)}"', f' class="{r.choice(c)} {word()}"', f' id="{r.choice(c)}"'))
    sure = lambda *c: r.choice((f' class="{r.choice(c)}"', f' id="{r.choice(c)}"', f' class="{word()} {r.choice(c)}"'))

    def dressed(t):
        if r.random() < 0.25:
            ws = t.split(" ")
            k = r.randrange(len(ws))
            tag = r.choice(("b", "i", "em", "a href='/x'", "span", "strong"))
            ws[k] = f"<{tag}>{ws[k]}" + (f"</{tag.split()[0]}>" if r.random() < 0.8 else "")
            t = " ".join(ws)
        return t

    def para(text=None):
        t = text or sentences(1, 7)
        main.append(t)
        style = r.random()
        if style < 0.7:
            return f"<p>{dressed(t)}</p>"
        if style < 0.85:
            return f"<p>{dressed(t)}" if r.random() < 0.5 else f"<p><b>{t}<br>"
        return f"<div{name('para', 'text')}>{dressed(t)}</div>"

    def links(k):
        return "".join(f'<li><a href="/{word()}">{r.choice((word(), phrase(1, 3), word().capitalize()))}</a></li>' for _ in range(k))

    def nav():
        body = r.choice((f"<ul>{links(r.randint(2, 12))}</ul>", " ".join(f'<a href="#">{word()}</a>' for _ in range(r.randint(2, 8)))))
        return r.choice((f"<nav{name('nav', 'menu')}>{body}</nav>", f"<div{sure('nav', 'menu', 'navbar', 'breadcrumbs')}>{body}</div>", f"<nav>{body}</nav>"))

    def ad():
        t = r.choice((sentences(1, 2), phrase(2, 9), f'<a href="/buy">{phrase(2, 8)}</a>'))
        return r.choice((f"<div{sure('ad', 'ads', 'advert', 'promo', 'sponsored', 'banner')}>{t}</div>", f"<aside{sure('ad', 'promo')}><p>{t}</p></aside>", f'<div class="ad">{t}</div>'))

    def comments():
        body = "".join(f"<div{name('comment', 'reply')}><p>{sentences(1, 3)}</p></div>" for _ in range(r.randint(1, 6)))
        return f"<{(t := r.choice(('section', 'div')))}{sure('comments', 'comment-list', 'disqus', 'discussion')}><h3>{phrase(1, 2)}</h3>{body}</{t}>"

    def side():
        body = r.choice((f"<h3>{phrase(1, 3)}</h3><ul>{links(r.randint(2, 8))}</ul>", f"<p>{sentences(1, 2)}</p>", f"<h2>{phrase(1, 3)}</h2><p>{sentences(1, 3)}</p>"))
        return r.choice((f"<aside{name('sidebar', 'widget')}>{body}</aside>", f"<div{sure('sidebar', 'widget', 'related', 'rail', 'popular')}>{body}</div>"))

    def foot():
        body = r.choice((f"&copy; {word()}.example.com &middot; {sentences(1, 1)}", f"<p>&copy; {phrase(1, 4)}</p>", f"<ul>{links(r.randint(1, 6))}</ul><p>© {phrase(2, 6)}</p>", sentences(1, 2)))
        return r.choice((f"<footer{name('footer')}>{body}</footer>", f"<div{sure('footer', 'site-footer', 'copyright')}>{body}</div>", f"<footer>{body}"))

    def head():
        return r.choice(("", f"<header{name('header', 'masthead')}><h2>{phrase(1, 3)}</h2>{nav()}</header>", f"<div{sure('header', 'topbar', 'masthead')}><a href='/'>{word()}</a><p>{phrase(2, 6)}</p></div>", f"<header><p>{phrase(2, 7)}</p></header>"))

    def notice():
        return r.choice(("", f"<div{sure('cookie-notice', 'notice', 'consent', 'alert', 'gdpr-banner')}><p>{sentences(1, 2)}</p><button>{word()}</button></div>"))

    def form():
        return r.choice((f"<form{name('search', 'newsletter')}><label>{phrase(1, 3)}</label><input type='text'><button>{word()}</button></form>", f"<form action='/s'><p>{sentences(1, 1)}</p><input><select><option>{word()}<option>{word()}</select></form>"))

    blocks = []
    if r.random() < 0.85:
        t = r.choice((phrase(2, 10).capitalize(), sentences(1, 1)))
        main.append(t)
        blocks.append(f"<h1{name('title')}>{t}</h1>")
        if r.random() < 0.25:
            blocks.append(para(t + " " + sentences(0, 4) if r.random() < 0.7 else None))
    for _ in range(r.choice((1, 1, 2, 3, 5, 9, 14, 25))):
        z = r.random()
        if z < 0.78:
            blocks.append(para())
        elif z < 0.86:
            t = phrase(1, 6).capitalize()
            main.append(t)
            blocks.append(f"<h2>{t}</h2>")
        elif z < 0.91:
            items = [sentences(1, 2) for _ in range(r.randint(2, 5))]
            main += items
            blocks.append(f"<ul>{''.join(f'<li>{i}</li>' for i in items)}</ul>")
        elif z < 0.95:
            t = sentences(1, 3)
            main.append(t)
            blocks.append(f"<blockquote>{t}</blockquote>")
        else:
            blocks.append(r.choice((ad, side, form, lambda: f"<div{sure('share', 'social', 'related')}><a href='#'>{word()}</a> <a href='#'>{word()}</a></div>"))())
    body = "".join(blocks)
    if r.random() < 0.15:
        body += comments()
    box = r.choice(("article", "article", "main", "div", "section"))
    body = f"<{box}{name('content', 'post', 'article-body', 'entry-content', 'story') if box in ('article', 'main') else sure('content', 'post', 'article', 'entry-content', 'main-text')}>{body}</{box}>"
    if r.random() < 0.3:
        body = f"<div{name('wrapper', 'container', 'page')}>{head()}{body}{side() if r.random() < 0.5 else ''}</div>"
    around = [r.choice((nav, head, ad, notice)) for _ in range(r.randint(0, 4))]
    behind = [r.choice((side, comments, ad, form, nav)) for _ in range(r.choice((0, 0, 1, 2, 3)))]
    ending = foot() if r.random() < 0.8 else ""
    top = f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{phrase(2, 6)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>"
    return top + "".join(f() for f in around) + f"<!-- {word()} -->" + body + "".join(f() for f in behind) + ending + r.choice(("</body></html>", "</body></html>", "")), main


@functools.lru_cache(maxsize=1)
def model(pages: int = 500, seed: int = 5) -> Boosted:
    """Fitted once a process."""
    r = random.Random(seed)
    x, y = [], []
    for _ in range(pages):
        source, main = _build(r)
        page = parse(source)
        keep = np.zeros(len(page.tag))
        left = list(main)
        for i, t in enumerate(page.text):
            if left and t and t == " ".join(left[0].split()):
                left.pop(0)
                keep[i] = 1
        for i in range(len(keep) - 1, 0, -1):
            keep[page.parent[i]] = max(keep[page.parent[i]], keep[i])
        x.append(features(page))
        y.append(keep)
    return Boosted(trees=60, depth=4, rate=0.25).fit(np.concatenate(x), np.concatenate(y))


def extract(sources: list[str | None], fitted: Boosted) -> list[str]:
    """The main text of each page."""
    pages = [parse(s) for s in sources]
    rows = [features(p) for p in pages]
    if not rows:
        return []
    prob = 1 / (1 + np.exp(-np.clip(fitted.margin(np.concatenate(rows)), -40, 40)))
    out, at = [], 0
    for p in pages:
        kept = decode(p.parent, prob[at : at + len(p.tag)])
        at += len(p.tag)
        out.append("\n\n".join(t for t, k in zip(p.text, kept, strict=True) if t and k))
    return out


def main_text(df: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(columns to keep, text, n_chars) of every row."""
    spark = df.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model())  # a few thousand numbers
    src = df.select(*[df[c] for c in keep], df[html_col].cast("string").alias("__html"))
    at = len(keep)

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 128):
                s = b.slice(a, 128)
                text = extract(s.column(at).to_pylist(), held.value)
                yield pa.RecordBatch.from_arrays([*s.columns[:at], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], [*keep, "text", "n_chars"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:at])
    return src.mapInArrow(run, f"{fields}, text string, n_chars long")
