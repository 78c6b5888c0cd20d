"""Main text of web pages by tag-path ratios (operator 7).

A page is read as text nodes, each under its path of block tags from the root.  For
every path the text length and the punctuation of its nodes are added up and divided
by the number of nodes; both ratios are smoothed along the page, fused, and held
against a threshold.  The nodes above it vote, weighted by their text, for the
container that holds the article; the text of the container outside of boilerplate
blocks is the result.

What speaks against an element only casts doubt on what it holds, and not where it
holds the page's article or most of its text: a whole page may stand in a form.  Words
in class, id or role lower the scores, and a block above the threshold stays all the
same; forms, dialogs, hidden elements, articles inside an article (reader comments) and
lists that are nothing but links need more than a score to stay.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

#: HTML tags by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object select option".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike "
                   "strong sub sup time tt u var".split())
HEAD_ONLY = frozenset(["head"])
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
                     "section table ul".split())
NEVER_CONTENT = frozenset("nav footer aside button label legend".split())
DOUBTFUL = frozenset("form dialog menu".split())
CONTENT = ("article", "main")
#: Words in class, id or role that speak for a block beside the article.
BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adslot|adbox|banner|sponsor\w*|promo\w*|menu|nav|navbar|navigation|breadcrumbs?|sidebar|side|"
    r"footer|header|masthead|comments?|replies|disqus|cookies?|consent|notices?|newsletter|subscribe|signup|share|sharing|"
    r"social|related|recommended|popup|modal|toolbar|complementary|contentinfo|search|login|pager|pagination|widget|"
    r"alerts?|alertdialog|feedback|responses?|discussion|reactions|talkback|toast|gdpr|paywall)(?:$|[\s_-]|\d)", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
#: A headline's block: the word header does not speak against it.
HEADLINE = re.compile(r"(?:^|[\s_-])(?:entry|article|post|story|content|page)[_-]+header(?=$|[\s_-])", re.I)
DOUBT = 0.1                  # factor on the score of a block under such a word
TAG = re.compile(r"</?[A-Za-z]|<!--")
#: A comment's own element, also where it is an article.
COMMENT = re.compile(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies)|responses?)(?:$|[\s_-]|\d)", re.I)
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORDS, STRONG = 1, 2         # doubt by words, doubt that a score does not overrule
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")
SPACE = re.compile(r"\s+")


class Node:
    """A block element: its tag, parent, number of its path of tags, whether it or an ancestor is boilerplate, and what doubt it stands under."""

    __slots__ = ("tag", "parent", "path", "beside", "doubt", "depth")

    def __init__(self, tag: str, parent: Node | None, beside: bool, doubt: int, paths: dict[tuple[int, str], int]):
        self.tag, self.parent = tag, parent
        self.path = paths.setdefault((parent.path if parent else 0, tag), len(paths) + 1)
        self.beside = beside or bool(parent and parent.beside)
        self.doubt = doubt
        self.depth = parent.depth + 1 if parent else 0


def _beside(tag: str, in_article: bool) -> bool:
    return tag in NEVER_CONTENT or tag == "header" and not in_article


def _doubt(tag: str, attributes: str, in_article: bool) -> int:
    """What the tag, its words and its visibility say against the element."""
    if tag in DOUBTFUL:
        return STRONG
    found = 0
    if attributes and tag not in ("html", "body"):
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and UNSEEN.search(value):
                return STRONG
            if name in ("class", "id", "role"):
                if tag == "article" and COMMENT.search(value):
                    return STRONG
                value = HEADLINE.sub(" ", value)
                if tag not in CONTENT and BESIDE.search(value) and not (in_article and tag == "header" and value.strip().lower() == "header"):
                    found = WORDS
    return found


def blocks(html: str) -> list[tuple[Node, str, bool]]:
    """Text blocks in page order with the element that holds each, and whether all of it is link text; character
    references decoded, white space joined."""
    paths: dict[tuple[int, str], int] = {}
    root = Node("#", None, False, 0, paths)
    at, node = 0, root
    out: list[tuple[Node, str, bool]] = []
    pending: list[str] = []
    plain: list[str] = []                  # of these, what stands outside of links
    articles, linked = 0, False

    def flush():
        if pending:
            text = SPACE.sub(" ", unescape("".join(pending))).strip()
            if text:
                out.append((node, text, not any(x.strip() for x in plain)))
            pending.clear()
            plain.clear()

    def take(text: str):
        pending.append(text)
        if not linked:
            plain.append(text)

    find = TOKEN.search
    while True:
        m = find(html, at)
        if m is None:
            take(html[at:])
            break
        if m.start() > at:
            take(html[at:m.start()])
        at = m.end()
        name = m[2]
        if not name:
            continue
        tag = name.lower()
        if tag in INLINE:
            linked = linked if tag != "a" else not m[1]
            continue
        if tag == "br":
            pending.append(" ")
            continue
        if m[1]:
            if tag in VOID:
                continue
            up = node
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None and up.parent is not None:
                flush()
                node = up.parent
            elif tag == "p":
                flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)[^>]*>?", re.I).search(html, at)
            if tag == "option" or not end and tag not in ("script", "style", "svg", "math", "object", "select"):
                end = TAG.search(html, at)            # left open: its text ends at the next tag
                at = end.start() if end else len(html)
            elif end or tag in ("script", "style"):
                at = end.end() if end else len(html)
            continue
        flush()
        if tag in VOID:
            continue
        if tag in CLOSES_P:
            up = node
            while up.parent is not None and up.tag not in ("p", "table", "td", "th", "button", "object"):
                up = up.parent
            if up.tag == "p":
                node = up.parent
        if tag in ("li", "dt", "dd", "tr", "td", "th"):
            alike = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th")}.get(tag, ("td", "th"))
            stop = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",)}.get(tag, ("tr", "table"))
            up = node
            while up.parent is not None and up.tag not in alike and up.tag not in stop:
                up = up.parent
            if up.tag in alike:
                node = up.parent
                if tag == "tr" and node.tag == "tr":
                    node = node.parent
        articles += tag in CONTENT
        node = Node(tag, node, tag in HEAD_ONLY or _beside(tag, articles > 0),
                    _doubt(tag, m[3], articles > 0), paths)
        if m[3].endswith("/") and tag not in CLOSES_P:
            node = node.parent
    flush()
    return out


def path_scores(items: list[tuple[Node, str, bool]], sigma: float = 1.0) -> np.ndarray:
    """Fused text and punctuation ratio of each block's path, smoothed along the page."""
    length, signs, nodes = defaultdict(int), defaultdict(int), defaultdict(int)
    paths = [n.path for n, *_ in items]
    for path, (_, text, _) in zip(paths, items):
        length[path] += len(text)
        signs[path] += len(PUNCTUATION.findall(text))
        nodes[path] += 1
    text_ratio = np.array([length[p] / nodes[p] for p in paths])
    sign_ratio = np.array([signs[p] / nodes[p] for p in paths])
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    kernel /= kernel.sum()

    def smooth(x):
        return np.convolve(np.pad(x, reach, mode="edge"), kernel, mode="valid")

    return smooth(text_ratio) * (1 + smooth(sign_ratio))


def doubted(items: list[tuple[Node, str, bool]]) -> np.ndarray:
    """The doubt that each block stands under: 0, WORDS or STRONG.

    An element that holds the largest article, or without any article more than half
    of the page's text, is not doubted.  The largest article is sought first among
    those that nothing speaks against; an article inside another one is a comment
    unless it holds most of the outer one's text.
    """
    size: dict[Node, int] = defaultdict(int)
    own: dict[Node, list[bool]] = defaultdict(list)
    for node, text, link in items:
        own[node].append(link)
        while node is not None:
            size[node] += len(text)
            node = node.parent
    inner: set[Node] = set()
    outer: dict[Node | None, Node | None] = {None: None}     # nearest article that holds an element
    menus: set[Node] = set()
    links: dict[Node, int] = defaultdict(int)
    plain: set[Node] = set()
    for node, blocks_ in own.items():
        up = node
        while up is not None:
            links[up] += len(blocks_)
            if not all(blocks_):
                plain.add(up)
            up = up.parent
    for n in size:
        way = []
        up = n
        while up not in outer:
            way.append(up)
            up = up.parent
        for x in reversed(way):
            holder = outer[x.parent]
            if x.tag == "article" and holder is not None and 2 * size[x] <= size[holder]:
                inner.add(x)
            outer[x] = x if x.tag == "article" else holder
        if n.tag in ("ul", "ol", "div", "section") and n not in plain and links[n] >= 3:
            menus.add(n)
    total = sum(len(t) for _, t, _ in items)
    articles = [n for n in size if n.tag in CONTENT and n not in inner and (n.doubt < STRONG or 2 * size[n] > total)]
    article = max(articles, key=lambda n: (n.doubt == 0, size[n], -n.depth), default=None)
    cleared = set()
    up = article
    while up is not None:
        cleared.add(up)
        up = up.parent
    held: dict[Node | None, int] = {None: 0}

    def under(n: Node | None) -> int:
        way = []
        while n not in held:
            way.append(n)
            n = n.parent
        for x in reversed(way):
            free = x in cleared or article is None and 2 * size[x] > total
            held[x] = max(held[x.parent], 0 if free else STRONG if x in inner or x in menus else x.doubt)
        return held[way[0]] if way else held[n]

    return np.array([under(n) for n, *_ in items], int)


def main_text(html: str | None) -> str:
    """The article's text: its blocks in page order, joined by one space; empty if there is none."""
    items = blocks(html or "")
    items = [x for x in items if not x[0].beside]
    if not items:
        return ""
    doubt = doubted(items)
    score = path_scores(items) * np.where(doubt > 0, DOUBT, 1.0)
    threshold = score.std()
    chosen = [i for i in range(len(items)) if score[i] >= threshold and doubt[i] < STRONG]
    chosen = chosen or [i for i in range(len(items)) if doubt[i] < STRONG] or list(range(len(items)))
    voted = set(chosen)
    weight: dict[Node, int] = defaultdict(int)
    for i in chosen:
        up = items[i][0]
        while up is not None:
            weight[up] += len(items[i][1])
            up = up.parent
    total = sum(len(items[i][1]) for i in chosen)
    named = [n for n in weight if n.tag in CONTENT and 2 * weight[n] >= total]
    if named:
        container = max(named, key=lambda n: n.depth)
    else:
        most = [n for n in weight if weight[n] >= 0.8 * total]
        container = max(most, key=lambda n: n.depth)
        if container.tag in ("p", "pre", "blockquote", "li", "td", "h1", "h2", "h3") and container.parent is not None:
            container = container.parent

    def inside(n: Node) -> bool:
        while n is not None:
            if n is container:
                return True
            n = n.parent
        return False

    return " ".join(t for i, (n, t, _) in enumerate(items) if inside(n) and (i in voted or not doubt[i]))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page from its whole html: page_id, url, text, n_chars (code points).

    Null or empty html and pages without text give an empty text.  Null ids and urls
    are kept; repeated rows give a row each; other columns are ignored; an empty table
    gives no rows.  One pass without a shuffle.
    """
    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    src = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].cast("string").alias("html"))
    kinds = [src.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return src.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
