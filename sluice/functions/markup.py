"""HTML pages as records: a small element tree on the standard parser, and what is read from it.

A page is parsed once, in Arrow batches; one struct holds all that is taken from it.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser
from itertools import groupby, pairwise
from urllib.parse import urljoin, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice.functions.text import WHITE_POINTS

# Fixed values of HTML: elements without end tags, and elements that end others left open.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
ENDS_SAME = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}

# Where articles stand, most specific first; elements that hold no text; what classes and ids of furniture contain.
ARTICLE_PLACES = [
    ".entry-content", ".post-content", ".article-content", ".post-body", ".article-body", ".content-body", ".td-post-content", ".jeg_inner_content",
    ".single-content", ".article__content", "article .content", "article .entry", ".single-post-content", ".post-entry", ".the-content",
    '[itemprop="articleBody"]', "article", "#content .entry", "#content", "main .content", "main",
]
NO_TEXT = frozenset("script style noscript iframe form button input svg canvas video audio map".split())
FURNITURE = re.compile(r"\b(?:sidebar|widget|menu|footer|header|comment|social|share|related|advertisement|ad-box|ads-|promo|banner)\b", re.IGNORECASE)
NO_BLOCK = ("header", "footer", "sidebar", "nav", "menu", "widget")
SHARE_LINKS = ("facebook.com/share", "twitter.com/intent", "linkedin.com/share")
#: Elements with more text than this are never furniture; articles with less than LEAST characters are none.
PROTECTED, LEAST = 500, 100
MOST_SOURCES, MOST_LINK_TEXT, MOST_DESCRIPTION, LEAST_IMAGE = 20, 200, 500, 100

_SPACE = re.compile("[" + "".join(map(chr, WHITE_POINTS)) + "]+")
_ZERO = dict.fromkeys([0x200B, 0x200C, 0x200D, 0xFEFF])


class Node:
    """An element: name, attributes, children (elements and text), parent."""

    __slots__ = ("name", "attrs", "children", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """This element's descendants in document order; no recursion, pages may nest deeply."""
        stack = self.children[::-1]
        while stack:
            node = stack.pop()
            if isinstance(node, Node):
                yield node
                stack += node.children[::-1]

    def strings(self) -> Iterator[str]:
        stack = self.children[::-1]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            else:
                stack += item.children[::-1]

    def text(self, between: str = "") -> str:
        """The stripped strings below, empties left out, joined."""
        return between.join(t for t in (s.strip() for s in self.strings()) if t)

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()


# Tags in their plain form, which most have; the standard parser reads all others.
_WHITE, _KEY = r"[ \t\n\r\f]", "[a-zA-Z][a-zA-Z0-9:_-]*"
_START = re.compile(f'<([a-zA-Z][a-zA-Z0-9]*)((?:{_WHITE}+{_KEY}="[^"]*")*){_WHITE}*>')
_ATTRIBUTE = re.compile(f'({_KEY})="([^"]*)"')
_END = re.compile("</([a-zA-Z][a-zA-Z0-9]*)>")
# Fixed values of HTML: elements whose text is no markup; how it is read is left to the standard parser.
NO_MARKUP = frozenset("script style textarea title iframe noembed noframes noscript xmp plaintext".split())
_P_WALLS: frozenset[str] = frozenset({"div", "article", "section", "body", "td", "li", "blockquote", "main"})


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_P:
            self._close("p", _P_WALLS)
        if tag in ENDS_SAME:
            self._close(tag, ENDS_SAME[tag])
        known: dict[str, str] = {}
        for key, value in attrs:
            known.setdefault(key, value or "")
        node = Node(tag, known, self.open)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open.name == tag and self.open.parent:
            self.open = self.open.parent

    def handle_endtag(self, tag: str) -> None:
        self._close(tag, frozenset())

    def parse_starttag(self, i: int) -> int:
        plain = _START.match(self.rawdata, i)
        if plain is None or (tag := plain[1].lower()) in NO_MARKUP:
            return super().parse_starttag(i)
        self.handle_starttag(tag, [(k.lower(), html.unescape(v) if "&" in v else v) for k, v in _ATTRIBUTE.findall(plain[2])] if plain[2] else [])
        return plain.end()

    def parse_endtag(self, i: int) -> int:
        plain = _END.match(self.rawdata, i) if self.cdata_elem is None else None
        if plain is None or (tag := plain[1].lower()) in NO_MARKUP:
            return super().parse_endtag(i)
        self.handle_endtag(tag)
        return plain.end()

    def updatepos(self, i: int, j: int) -> int:
        """Lines aren't counted: nothing asks for them."""
        return j

    def _close(self, tag: str, walls: frozenset[str] | set[str]) -> None:
        node = self.open
        while node.parent is not None and node.name != tag:
            if node.name in walls:
                return
            node = node.parent
        if node.parent is not None:
            self.open = node.parent

    def handle_data(self, data: str) -> None:
        self.open.children.append(data)


def parse(page: str | None) -> Node:
    """The page's tree.  Anything parses; comments and declarations are left out, missing end tags are supplied."""
    builder = _Builder()
    builder.feed(page or "")
    builder.close()
    return builder.root


def _simple(part: str) -> Callable[[Node], bool]:
    if part.startswith("."):
        return lambda n: part[1:] in n.classes()
    if part.startswith("#"):
        return lambda n: n.attrs.get("id") == part[1:]
    if part.startswith("["):
        key, value = part[1:-1].split("=")
        return lambda n: n.attrs.get(key) == value.strip('"')
    return lambda n: n.name == part


#: The article's places by their last part: rank and what stands above.
_PLACES: defaultdict[str, list[tuple[int, list[Callable[[Node], bool]]]]] = defaultdict(list)
for _rank, _place in enumerate(ARTICLE_PLACES):
    *_above, _last = _place.split(" ")
    _PLACES[_last].append((_rank, [_simple(p) for p in _above]))
_PLACE_KEYS = [p[1:].split("=")[0] for p in _PLACES if p.startswith("[")]


def _lasts(node: Node) -> Iterator[str]:
    """What may be the last part of a selector that the element matches."""
    yield node.name
    if attrs := node.attrs:
        if "class" in attrs:
            yield from ["." + x for x in node.classes()]
        if "id" in attrs:
            yield "#" + attrs["id"]
        for key in _PLACE_KEYS:
            if key in attrs:
                yield f'[{key}="{attrs[key]}"]'


def _below(node: Node, above: list[Callable[[Node], bool]]) -> bool:
    """Whether elements above match, the last of them nearest."""
    up, left = node.parent, list(above)
    while up is not None and left:
        if left[-1](up):
            left.pop()
        up = up.parent
    return not left


def _class_matches(node: Node, pattern: re.Pattern) -> bool:
    """A pattern matches a multi-valued attribute by any of its values or by all of them joined."""
    values = node.classes()
    return any(pattern.search(v) for v in values) or bool(values and pattern.search(" ".join(values)))


def _first(root: Node, test: Callable[[Node], bool]) -> Node | None:
    return next((n for n in root.walk() if test(n)), None)


def absolute(url: str, base: str) -> str:
    if url.startswith("http"):
        return url
    try:
        return urljoin(base, url)
    except ValueError:
        return url


_DATE, _AUTHOR = re.compile("published|entry-date"), re.compile("author|byline")


def metadata(root: Node, url: str) -> dict:
    """Title, description, dates, author, feature image and locale, each by the first of its places that is filled."""
    # One walk: of each place the first element.
    metas: dict[tuple[str, str], str] = {}
    places: dict[str, Node] = {}
    for n in root.walk():
        if n.name == "meta":
            for key in ("property", "name"):
                if key in n.attrs:
                    metas.setdefault((key, n.attrs[key]), n.attrs.get("content", ""))
        elif n.name in ("title", "h1"):
            places.setdefault(n.name, n)
        if "class" in n.attrs:
            if n.name == "time" and "time" not in places and _class_matches(n, _DATE):
                places["time"] = n
            if "author" not in places and _class_matches(n, _AUTHOR):
                places["author"] = n
    named = lambda value, key="property": metas.get((key, value), "")
    title = named("og:title").strip() or None
    if not named("og:title"):
        node = places.get("title") or places.get("h1")
        title = node.text() if node else None
    description = named("og:description") or named("description", "name")
    published = named("article:published_time")
    if not published and "time" in places:
        published = places["time"].attrs.get("datetime", "")
    author = named("author", "name").strip()
    if not named("author", "name") and (node := places.get("author")):
        author = (_first(node, lambda n: n.name == "a") or node).text()
    image = named("og:image")
    locale = named("og:locale")
    return {
        "title": title, "description": description.strip() if description else None, "published_date": published or None,
        "modified_date": named("article:modified_time") or None, "author": author or None,
        "feature_image": {"url": absolute(image, url), "alt": title or ""} if image else None, "locale": locale[:2].lower() if locale else "en",
    }


def article(root: Node) -> Node | None:
    """The element that holds the article: the first place that matches, else the `div` with most text that is no furniture."""
    found, least = None, len(ARTICLE_PLACES)
    for node in root.walk():
        for last in _lasts(node):
            for rank, above in _PLACES.get(last, ()):
                if rank < least and _below(node, above):
                    found, least = node, rank
        if least == 0:
            break
    if found is not None:
        return found
    # Characters of text below each node, from the leaves up: one look at each, however deep they nest.
    order = list(root.walk())
    sizes: dict[int, int] = {}
    for node in reversed(order):
        sizes[id(node)] = sum(len(c.strip()) if isinstance(c, str) else sizes[id(c)] for c in node.children)
    best, most = None, 0
    for node in order:
        if node.name == "div" and sizes[id(node)] > most and not any(x in " ".join(node.classes()).lower() for x in NO_BLOCK):
            best, most = node, sizes[id(node)]
    return best


def _whole_number(text: str) -> int | None:
    try:
        return int(text)
    except ValueError:
        return None


def images(node: Node, base: str) -> list[dict]:
    """Images with absolute addresses, the first of equal ones, but none whose given sizes are small."""
    found: dict[str, dict | None] = {}
    given = {"", None}
    for n in node.walk():
        if n.name != "img" or (url := n.attrs.get("src") or n.attrs.get("data-src") or n.attrs.get("data-lazy-src")) in given:
            continue
        given.add(url)
        if (url := absolute(url, base)) in found:
            continue
        sizes = [_whole_number(n.attrs[k]) for k in ("width", "height") if n.attrs.get(k)]
        small = len(sizes) == 2 and None not in sizes and min(sizes) < LEAST_IMAGE
        # Sizes are read one after the other: a small width counts even if the height can't be read.
        small = small or (len(sizes) == 2 and sizes[0] is not None and sizes[0] < LEAST_IMAGE)
        found[url] = None if small else {"url": url, "alt": n.attrs.get("alt", "").strip()}
    return [x for x in found.values() if x]


def labels(root: Node) -> tuple[list[str], list[str]]:
    """(categories, tags), by the relation of links, else by the first container of either kind."""

    def below(pattern: str) -> list[str]:
        node = _first(root, lambda n: _class_matches(n, re.compile(pattern)))
        return [a.text() for a in node.walk() if a.name == "a"] if node else []

    anchors = [(a, a.attrs["rel"].split()) for a in root.walk() if a.name == "a" and "rel" in a.attrs]
    both = [a.text() for a, rel in anchors if " ".join(rel) == "category tag"]
    tagged = [(a, rel) for a, rel in anchors if "tag" in rel]
    tags = [a.text() for a, rel in tagged if not any("category" in r for r in rel)] if tagged else below("tag-links|tags")
    return list(dict.fromkeys(both or below("cat-links|categories"))), list(dict.fromkeys(tags))


def _netloc(url: str) -> str | None:
    try:
        return urlsplit(url).netloc
    except ValueError:
        return None


def external_links(node: Node, base: str) -> list[dict]:
    """The first links to other hosts, one per address, without those that share the page."""
    found: dict[str, dict | None] = {}
    own = (None, _netloc(base))
    for a in node.walk():
        if a.name != "a" or not (href := a.attrs.get("href", "")).startswith("http") or href in found or _netloc(href) in own:
            continue
        shares = any(x in href.lower() for x in SHARE_LINKS)
        found[href] = None if shares else {"text": (a.text() or href)[:MOST_LINK_TEXT], "url": href}
    return [x for x in found.values() if x][:MOST_SOURCES]


def links_of(text: str | None) -> list[tuple[str, str]]:
    """(text, url) of each link with an address, in order; the address stands for missing text."""
    out = []
    for a in parse(text).walk():
        href = a.attrs.get("href") if a.name == "a" else None
        if href and href.strip():
            out.append((a.text() or href, href.strip()))
    return out


def normalised(text: str) -> str:
    """As `sluice.functions.text.normalise`, of one Python string."""
    text = _SPACE.sub(" ", html.unescape(text)).translate(_ZERO)
    return re.sub(r"[-]{3,}", "---", re.sub(r"[.]{3,}", "...", text)).strip()


def plain_text(page: str | None, least: int = LEAST) -> str:
    """The page's text without elements that hold none and without furniture; '' if it is shorter than `least`."""
    return _content(parse(page), Node.children.__get__, least)


def _content(top: Node, children: Callable[[Node], list[Node | str]], least: int = LEAST) -> str:
    """As `plain_text`, of an element and all below."""
    out: list[str] = []
    stack: list[Node | str] = [top]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            if text := item.strip():
                out.append(text)
        elif item.name not in NO_TEXT and not _is_furniture(item, children):
            stack += children(item)[::-1]
    text = normalised(" ".join(out))
    return text if len(text) >= least else ""


def _whole(node: Node) -> list[Node | str]:
    """The element's children, texts side by side as one: comments between them part no words."""
    if not any(isinstance(a, str) and isinstance(b, str) for a, b in pairwise(node.children)):
        return node.children
    return [x for text, run in groupby(node.children, lambda c: isinstance(c, str)) for x in (["".join(run)] if text else run)]


def _is_furniture(node: Node, children: Callable[[Node], list[Node | str]] = Node.children.__get__) -> bool:
    """Whether class or id say so and there is no more than PROTECTED text, of elements that hold text."""
    named = FURNITURE.search(" ".join(node.classes())) or FURNITURE.search(node.attrs.get("id", "")) if node.attrs else None
    if not named:
        return False
    left, stack = PROTECTED, children(node)[::-1]
    while stack and left >= 0:
        item = stack.pop()
        if isinstance(item, str):
            left -= len(item.strip())
        elif item.name not in NO_TEXT:
            stack += children(item)[::-1]
    return left >= 0


def short_text(text: str | None, limit: int = MOST_DESCRIPTION) -> str:
    """A description without tags, normalised, cut at a word."""
    bare = normalised(parse(text).text(" "))
    return bare if len(bare) <= limit else bare[:limit].rsplit(" ", 1)[0] + "..."


@F.pandas_udf(StringType())
def short(texts: pd.Series) -> pd.Series:
    """`short_text` of a column, in Arrow batches; null gives ''."""
    return texts.map(lambda t: short_text(t or ""))


def read_page(url: str, page: str, only: frozenset[str] | None = None) -> dict:
    """All that is taken from a page; with `only`, at least these fields of it."""
    root = parse(page)
    wanted = lambda *names: only is None or not only.isdisjoint(names)
    body = article(root) if wanted(*_OF_BODY) else None
    read = metadata(root, url) if only is None or not only <= _OF_BODY | _LABELS | {"content_hash"} else {}
    if wanted(*_LABELS):
        read["categories"], read["tags"] = labels(root)
    if wanted("images"):
        read["images"] = images(body, url) if body else []
    if wanted("sources"):
        read["sources"] = external_links(body, url) if body else []
    if wanted("content"):
        read["content"] = _content(body, _whole) if body else ""
    if wanted("content_hash"):
        read["content_hash"] = hashlib.md5(page.encode("utf-8", "surrogatepass")).hexdigest()
    return read


_LINK = pa.struct([("text", pa.string()), ("url", pa.string())])
_IMAGE = pa.struct([("url", pa.string()), ("alt", pa.string())])
_KINDS = {"string": pa.string(), "struct<url: string, alt: string>": _IMAGE, "array<string>": pa.list_(pa.string()), "array<struct<url: string, alt: string>>": pa.list_(_IMAGE), "array<struct<text: string, url: string>>": pa.list_(_LINK)}
_FIELDS = {
    "title": "string", "description": "string", "published_date": "string", "modified_date": "string", "author": "string", "feature_image": "struct<url: string, alt: string>", "locale": "string",
    "images": "array<struct<url: string, alt: string>>", "categories": "array<string>", "tags": "array<string>", "sources": "array<struct<text: string, url: string>>", "content": "string", "content_hash": "string",
}
_OF_BODY, _LABELS = frozenset({"images", "sources", "content"}), frozenset({"categories", "tags"})


def articles(pages: DataFrame, url: str = "url", page: str = "html", only: Iterable[str] | None = None) -> DataFrame:
    """(url, ok, error, article) per row: a page that can't be read has an error instead of failing the job.  Null pages are errors.

    `only` names the article's fields, if not all are asked for: the others are then not looked for.
    """
    fields = dict(_FIELDS) if only is None else {name: _FIELDS[name] for name in only}
    asked = None if only is None else frozenset(fields)
    kind = pa.struct([(name, _KINDS[x]) for name, x in fields.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read, errors = [], []
            for u, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    if text is None:
                        raise ValueError("no page")
                    read.append(read_page(u or "", text, asked))
                    errors.append(None)
                except Exception as problem:  # one page must not end the run
                    read.append(None)
                    errors.append(f"{type(problem).__name__}: {problem}")
            ok = pa.array([e is None for e in errors])
            yield pa.RecordBatch.from_arrays([batch.column(0), ok, pa.array(errors, pa.string()), pa.array(read, kind)], ["url", "ok", "error", "article"])

    return pages.select(url, page).mapInArrow(run, f"url string, ok boolean, error string, article struct<{', '.join(f'{name}: {x}' for name, x in fields.items())}>")
