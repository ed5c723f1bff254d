"""HTML extraction: a tree-structured graphical model over the DOM, with content marginals by sum-product."""

from __future__ import annotations

import functools
import html
import random
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm._shared import map_batches

# Elements by what HTML says of them.
RAW = frozenset("script style noscript template iframe object svg math canvas textarea select datalist title head".split())
#: Raw elements whose content is markup: without an end tag only the start tag is left out, not the rest of the page.
MARKUP = frozenset("template object svg math canvas select datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img picture".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
KNOWN = RAW | VOID | INLINE | ENDS_P | frozenset("html body tbody thead tfoot tr td th caption colgroup li dt dd button label legend option optgroup output meter progress summary dialog center font video audio map search slot".split())
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

#: Attributes by the grammar of HTML: quotes only open a value, so that an apostrophe within an unquoted one ends nothing.
_VALUE = r"""(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)"""
_ATTRS = rf"""(?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+{_VALUE}?+)?+|=)*+"""
TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRS})(?:>|\Z)", re.S)
#: What follows a name that isn't one of HTML's, if this is a comparison in a text and no tag: words without values.
PROSE = re.compile(r"(?:\s+[^\s/>=\"']+)+\s*")
#: Ends of raw elements: nothing before them is markup, whatever it looks like.
RAW_END = {tag: re.compile(rf"</{tag}(?:[\s/][^>]*)?(?:>|\Z)", re.I | re.A) for tag in RAW}
NAMED = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

#: The kinds of elements and of names that are features, each by its words.
KINDS = {
    "article": "article", "main": "main", "section": "section", "div": "div", "p": "p", "heading": "h1 h2 h3 h4 h5 h6", "list": "ul ol dl menu", "item": "li dt dd",
    "table": "table tbody thead tr td th", "quote": "blockquote pre figure figcaption", "nav": "nav", "header": "header", "footer": "footer", "aside": "aside",
    "form": "form fieldset button input label legend dialog", "body": "html body",
}
NAMES = {
    "content": "article content post entry story main body text", "comment": "comment comments reply replies discussion respond disqus", "ad": "ad ads advert adverts advertisement sponsor sponsored promo banner",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toc pager pagination", "side": "sidebar side aside widget related recommended trending popular", "foot": "footer foot copyright legal",
    "head": "header masthead topbar logo brand", "notice": "cookie cookies consent notice gdpr popup modal alert subscribe newsletter signup", "share": "share sharing social follow tags meta byline",
    "form": "form search login",
}
_KIND = {w: i for i, words in enumerate(KINDS.values()) for w in words.split()}
_NAME = {w: i for i, words in enumerate(NAMES.values()) for w in words.split()}
N_FEATURES = len(KINDS) + 1 + len(NAMES) + 9
#: Kinds of edges, by the child: text blocks, elements of a telling name or tag, other containers, elements that announce content.
N_EDGES = 4


class Page:
    """The DOM of a page as arrays: nodes in document order (parents first), and segments of text."""

    __slots__ = ("chars", "kind", "links", "names", "parent", "segments", "label")

    def __init__(self) -> None:
        self.parent: list[int] = []
        self.kind: list[int] = []
        self.names: list[tuple[int, ...]] = []
        self.chars: list[int] = []
        self.links: list[int] = []
        self.label: list[int] = []
        self.segments: list[tuple[int, int, str]] = []  # (block, node, text)

    def add(self, parent: int, tag: str, attrs: str) -> int:
        self.parent.append(parent)
        self.kind.append(_KIND.get(tag, len(KINDS)))
        found: tuple[int, ...] = ()
        if "=" in attrs:
            words = {w for m in NAMED.finditer(attrs) for w in re.split(r"[^a-z]+", (m[1] or m[2] or m[3] or "").lower())}
            found = tuple(sorted({_NAME[w] for w in words if w in _NAME}))
            if "data-content=" in attrs:
                self.label.append(int('data-content="1"' in attrs))
        self.names.append(found)
        self.chars.append(0)
        self.links.append(0)
        return len(self.parent) - 1


def parse(source: str) -> Page:
    """A lenient parser: unknown and unclosed tags, implied ends and text outside any element are all taken."""
    page = Page()
    stack = [("#root", page.add(-1, "html", ""))]
    block = links = at = 0

    def text(to: int) -> None:
        part = source[at:to]
        if part and not part.isspace():
            node = stack[-1][1]
            page.segments.append((block, node, part))
            n = len(part)
            page.chars[node] += n
            page.links[node] += n if links else 0
        elif part and page.segments and page.segments[-1][0] == block:
            page.segments.append((block, stack[-1][1], " "))

    def pop(to: int) -> None:
        nonlocal block, links
        for tag, _ in stack[to:]:
            links -= tag == "a"
            block += tag not in INLINE
        del stack[to:]

    while m := TAG.search(source, at):
        tag = (m[2] or "").lower()
        if tag and not m[1] and tag.isalnum() and tag not in KNOWN and PROSE.fullmatch(m[3]):
            text(m.start(2))  # x <y and z> w
            at = m.start(2)
            continue
        text(m.start())
        at = m.end()
        if not tag:
            continue
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    pop(i)
                    break
            else:
                block += tag not in INLINE
            continue
        if tag in RAW:
            block += tag not in INLINE
            if not m[3].endswith("/") and tag != "head":
                end = RAW_END[tag].search(source, at)
                at = end.end() if end else at if tag in MARKUP else len(source)
            continue
        if tag in VOID:
            if tag == "br" and page.segments and page.segments[-1][0] == block:
                page.segments.append((block, stack[-1][1], " "))
            block += tag not in INLINE
            continue
        if tag in ENDS_P or tag in ENDED_BY:
            ended, scope = ENDED_BY.get(tag, {"p"}), SCOPE.get(tag, set())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ended:
                    pop(i)
                    break
                if stack[i][0] in scope or stack[i][0] not in INLINE and not scope:
                    break
        if tag in INLINE and "class" not in m[3] and " id" not in m[3] or tag == "a":
            stack.append((tag, stack[-1][1]))
        else:
            block += tag not in INLINE
            stack.append((tag, page.add(stack[-1][1], tag, m[3])))
        links += tag == "a"
    text(len(source))
    return page


def _forest(pages: list[Page]):
    """Of several pages: features, parents (-1 for roots), kinds of edges and levels, nodes numbered one after another."""
    sizes = [len(p.parent) for p in pages]
    base = np.repeat(np.cumsum([0, *sizes[:-1]]), sizes) if pages else np.empty(0, np.int64)
    own = np.array([x for p in pages for x in p.parent], dtype=np.int64)
    parent = np.where(own < 0, -1, own + base)
    kind = np.array([x for p in pages for x in p.kind], dtype=np.int64)
    chars = np.array([x for p in pages for x in p.chars], dtype=np.float64)
    links = np.array([x for p in pages for x in p.links], dtype=np.float64)
    n = len(parent)
    depth = np.zeros(n, dtype=np.int64)
    level = np.flatnonzero(parent < 0)
    order = np.argsort(parent, kind="stable")
    first = np.searchsorted(parent[order], np.arange(n + 1))
    levels = []
    while len(level):
        levels.append(level)
        counts = first[level + 1] - first[level]
        spread = np.repeat(first[level] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        level = order[spread]
        depth[level] = len(levels)
    below, linked, kids = chars.copy(), links.copy(), np.zeros(n)
    for level in reversed(levels[1:]):
        np.add.at(below, parent[level], below[level])
        np.add.at(linked, parent[level], linked[level])
        np.add.at(kids, parent[level], 1.0)
    x = np.zeros((n, N_FEATURES))
    x[np.arange(n), kind] = 1
    row, named, i = [], [], 0
    for p in pages:
        for names in p.names:
            for name in names:
                row.append(i)
                named.append(name)
            i += 1
    at = len(KINDS) + 1
    x[row, np.array(named, dtype=np.int64) + at if named else []] = 1
    at += len(NAMES)
    density = linked / np.maximum(below, 1)
    x[:, at : at + 9] = np.stack([np.ones(n), np.minimum(np.log1p(chars) / 5, 2), np.minimum(np.log1p(below) / 5, 2), density, density > 0.5, (chars > 80) & (density < 0.3), chars == 0, below == 0, np.minimum(kids, 10) / 10], axis=1)
    telling = x[:, len(KINDS) + 1 : at].any(axis=1) | np.isin(kind, [_KIND[t] for t in ("nav", "header", "footer", "aside", "form")])
    edge = np.where(telling, 1, np.where(np.isin(kind, [_KIND[t] for t in ("p", "h1", "li", "td", "pre")]), 0, 2))
    announced = (kind == _KIND["article"]) | (kind == _KIND["main"]) | (x[:, len(KINDS) + 1 + _NAME["content"]] > 0)
    return x, parent, np.where(announced, 3, edge), levels


def _sum_product(unary, pair, parent, edge, levels):
    """Marginals of being content, and of (parent, child) states along edges. unary: log potential of state 1; pair: by kind of edge, parent's and child's state."""
    n = len(parent)
    local = np.zeros((n, 2))
    local[:, 1] = unary
    inbox, up = np.zeros((n, 2)), np.zeros((n, 2))
    for level in reversed(levels[1:]):
        message = (local[level] + inbox[level])[:, None, :] + pair[edge[level]]
        up[level] = np.logaddexp(message[:, :, 0], message[:, :, 1])
        up[level] -= up[level].max(axis=1, keepdims=True)
        np.add.at(inbox, parent[level], up[level])
    down, joint = np.zeros((n, 2)), np.zeros((n, 2, 2))
    for level in levels[1:]:
        p = parent[level]
        cavity = local[p] + inbox[p] + down[p] - up[level]
        both = cavity[:, :, None] + pair[edge[level]]
        down[level] = np.logaddexp(both[:, 0, :], both[:, 1, :])
        down[level] -= down[level].max(axis=1, keepdims=True)
        both = both + (local[level] + inbox[level])[:, None, :]
        both = np.exp(both - both.max(axis=(1, 2), keepdims=True))
        joint[level] = both / both.sum(axis=(1, 2), keepdims=True)
    belief = local + inbox + down
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50))), joint


def fit(pages: list[Page], steps: int = 200, penalty: float = 0.005) -> tuple[np.ndarray, np.ndarray]:
    """(weights, pair) of labelled pages, by the likelihood's exact gradient: what is seen less what marginals expect."""
    x, parent, edge, levels = _forest(pages)
    y = np.array([v for p in pages for v in p.label])
    w, pair = np.zeros(x.shape[1]), np.zeros((N_EDGES, 2, 2))
    child = np.flatnonzero(parent >= 0)
    seen = np.zeros_like(pair)
    np.add.at(seen, (edge[child], y[parent[child]], y[child]), 1)
    theta, m, v = np.zeros(w.size + pair.size), 0.0, 0.0
    for step in range(1, steps + 1):
        w, pair = theta[: w.size], theta[w.size :].reshape(pair.shape)
        p, joint = _sum_product(x @ w, pair, parent, edge, levels)
        expected = np.zeros_like(pair)
        np.add.at(expected, edge[child], joint[child])
        g = np.append(x.T @ (y - p), (seen - expected).ravel()) / len(pages) - penalty * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[: w.size], theta[w.size :].reshape(pair.shape)


# --- labelled pages ---


def labelled_page(rng: random.Random) -> str:
    """A made-up page whose elements all say, in data-content, whether they belong to the article."""
    letters = "abcdefghijklmnopqrstuvwxyzäéñ"

    def words(low: int, high: int) -> str:
        out = ["".join(rng.choices(letters, k=rng.randint(1, 10))) for _ in range(rng.randint(low, high))]
        return " ".join(out).capitalize() + rng.choice(["", "."])

    def el(tag: str, inside: str, content: int, name: str = "") -> str:
        attr = f' {rng.choice(["class", "id"])}="{name}"' if name else ""
        return f'<{tag}{attr} data-content="{content}">{inside}</{tag}>'

    def links(n: int) -> str:
        return el("ul", "".join(el("li", f'<a href="/x">{words(1, 5)}</a>', 0) for _ in range(n)), 0)

    def pick(*options: str) -> str:
        return rng.choice(options)

    def boilerplate() -> str:
        n = rng.randint(2, 8)
        return rng.choice(
            [
                lambda: el("nav", links(n), 0, pick("", "menu", "navbar")),
                lambda: el("header", pick(words(1, 4), el("h1", words(1, 4), 0), links(n)), 0, pick("", "masthead", "site-header")),
                lambda: el("footer", pick(words(3, 20), el("p", words(3, 20), 0), links(n)), 0, pick("", "site-footer")),
                lambda: el("aside", el("h3", words(1, 3), 0) + pick(links(n), el("p", words(5, 40), 0)), 0, pick("", "sidebar")),
                lambda: el("div", pick(words(3, 30), el("p", words(3, 40), 0)), 0, pick("ad", "ads", "advert", "sponsored", "promo-banner")),
                lambda: el("div", pick(links(n), el("p", words(5, 40), 0)), 0, pick("sidebar", "related", "widget", "trending")),
                lambda: el("div", el("p", words(8, 40), 0) + el("button", words(1, 2), 0), 0, pick("cookie-notice", "consent", "newsletter", "popup", "notice")),
                lambda: el("form", el("p", words(1, 15), 0) + el("button", words(1, 2), 0), 0, pick("", "search", "login")),
                lambda: el(pick("div", "section"), el("h2", words(1, 3), 0) + "".join(el("div", el("p", words(2, 60), 0), 0, pick("", "comment", "reply")) for _ in range(n)), 0, pick("comments", "comment-list", "discussion")),
                lambda: el("div", links(n), 0, pick("", "share", "social", "breadcrumb", "pagination", "tags")),
                lambda: el("p", pick(f"<small>{words(3, 12)}</small>", f'<a href="/x">{words(1, 4)}</a>'), 0, pick("copyright", "legal", "byline", "share")),
            ]
        )()

    def article(short: bool) -> str:
        title = el("h1", words(2, 12), 1)
        if rng.random() < 0.15:
            title = el("header", title + pick("", el("p", words(2, 12), 1)), 1, pick("", "entry-header"))
        parts = [title] if rng.random() < (0.4 if short else 0.8) else []
        if short:
            return "".join([*parts, *(el("p", words(1, rng.choice([3, 12, 40])), 1) for _ in range(rng.randint(1, 3)))])
        for _ in range(rng.randint(1, 14)):
            parts.append(
                rng.choices(
                    [
                        lambda: el("p", words(1, 120), 1),
                        lambda: el("p", f'{words(3, 40)} <a href="/x">{words(1, 4)}</a> {words(3, 40)}', 1),
                        lambda: el(pick("h2", "h3"), words(1, 8), 1),
                        lambda: el(pick("ul", "ol"), "".join(el("li", words(1, 30), 1) for _ in range(rng.randint(1, 6))), 1),
                        lambda: el("blockquote", pick(words(5, 40), el("p", words(5, 40), 1)), 1),
                        lambda: el("table", el("tr", el("td", words(1, 5), 1) + el("td", words(1, 5), 1), 1), 1),
                        lambda: el("div", el("p", words(5, 80), 1), 1, pick("", "section", "text")),
                        boilerplate,
                    ],
                    [8, 2, 1, 1, 0.5, 0.3, 0.5, 0.5],
                )[0]()
            )
        return "".join(parts)

    root, short = rng.choice(["article", "article", "div", "main", "section"]), rng.random() < 0.35
    name = pick("", "post", "entry-content") if root in ("article", "main") else pick("", "", "content", "post", "entry", "story", "article-body", "main-content")
    middle = el(root, article(short), 1, name)
    if rng.random() < 0.3:
        middle = el(pick("div", "main"), middle + "".join(boilerplate() for _ in range(rng.randint(0, 2))), 0, pick("", "wrap", "page", "main"))
    most = rng.choice([0, 4, 4, 4])
    before = "".join(boilerplate() for _ in range(rng.randint(0, most)))
    after = "".join(boilerplate() for _ in range(rng.randint(0, most)))
    return middle if not before + after and rng.random() < 0.5 else el("html", el("body", before + middle + after, 0), 0)


def labelled_pages(n: int, seed: int = 7) -> list[Page]:
    rng = random.Random(seed)
    pages = []
    for _ in range(n):
        page = parse(labelled_page(rng))
        page.label.insert(0, 0)  # the root that the parser adds
        pages.append(page)
    return pages


@functools.lru_cache(maxsize=1)
def default_model() -> tuple[np.ndarray, np.ndarray]:
    """The model of 400 made-up pages, the same each time."""
    return fit(labelled_pages(400))


# --- extraction ---

SPACES = re.compile(r"\s+")
#: Where no text of a page has a marginal above one half, what has more than this is taken: menus and the like stay far below it.
LEAST = 0.25


def extract(pages: list[Page], model: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """The main text of each page: segments whose node is content, put together by blocks."""
    x, parent, edge, levels = _forest(pages)
    p = _sum_product(x @ model[0], model[1], parent, edge, levels)[0] if pages else np.empty(0)
    content, base = (p > 0.5).tolist(), 0
    for page in pages:
        own = slice(base, base + len(page.parent))
        if len(page.parent) == 1:  # text without any element
            content[base] = True
        elif not (p[own][np.array(page.chars) > 0] > 0.5).any():
            content[own] = (p[own] > LEAST).tolist()
        base += len(page.parent)
    out, base = [], 0
    for page in pages:
        blocks: dict[int, list[str]] = {}
        for block, node, part in page.segments:
            if content[base + node]:
                blocks.setdefault(block, []).append(part)
        lines = (SPACES.sub(" ", html.unescape("".join(parts))).strip() for parts in blocks.values())
        out.append("\n".join(line for line in lines if line))
        base += len(page.parent)
    return out


def extract_text(pages: DataFrame, html_col: str = "html", model: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Returns the pages with text, the article's blocks joined by one newline, and n_chars, its code points.

    Every element is a node with a state, content or not. Its tag, its names, its text and links give a potential,
    each edge from parent to child another by the child's kind; messages up and down the tree give the marginals, and
    text of nodes above one half is kept, or, on a page without any, of nodes above LEAST. Scripts, styles, titles and markup are no text. Character references are
    decoded; white space in a block, <br> too, becomes one space. A "<" before a name that HTML doesn't know and words
    without values is text, as in "x <y and z> w". A page without any element is its own text.

    A null or empty page, or one without content, has an empty text. Pages of any length are taken whole. Repeated
    rows get the same results. Empty tables stay empty. Input columns named as the results are replaced.
    """
    model = model or default_model()
    keep = [f for f in pages.schema.fields if f.name.lower() not in ("text", "n_chars")]
    names = [f.name for f in keep]

    def apply(batches):
        import pyarrow as pa

        for batch in batches:
            sources = batch.column(batch.num_columns - 1)
            texts = []
            for at in range(0, len(sources), 256):
                texts += extract([parse(s or "") for s in sources.slice(at, 256).to_pylist()], model)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*names, "text", "n_chars"])

    schema = T.StructType([*keep, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return map_batches(pages.select(*[f"`{x}`" for x in names], F.col(html_col).alias("__html")), apply, schema)
