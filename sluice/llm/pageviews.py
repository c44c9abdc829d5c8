"""Seed labels for main-body extraction, from what pages of one site have in common; no phrase is named.

Four views label the lines of a bounded sample of pages, on which the trees are trained:

repetition  a line, or what stands before its first separator, that recurs on one page in twenty of its site is furniture,
            and so is a short line right below the headline whose first two words stand there on one page in five;
place       of each such line the sample tells what follows it: hardly any prose (it opens the page's tail), only short
            lines (it heads a box of pointers), or prose;
agreement   the headline agrees with the record's title, bylines with its author, pointers and taglines name the site;
form        prose, short lines and cut-off teasers are told by words and end marks.

So the views know no language, and learn the furniture of whatever sites the corpus holds.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import pairwise
from typing import NamedTuple

#: Lines on one page in so many of the site's sample (20: 5 %), and on so many pages at least, are furniture.
ONE_IN, LEAST = 20, 3
#: Two words that open the line below the headline on one page in so many of the site's are furniture with the rest of the line.
OPENS_IN = 5
#: A line opens the tail if at most so large a share of its pages has more than TAIL_PROSE of its prose after it.
TAIL, TAIL_PROSE = 0.05, 0.3
#: A line heads a box if at most so large a share of what follows it, furniture aside, is prose.
BOX = 0.15
#: So many teasers cut off by an ellipsis in brackets make a page of pointers; one is enough where no line is the title.
TEASERS = 2

_COUNT = re.compile(r" ?\(\d{1,9}\)$")
_PROSE = re.compile(r"[.!?…。！？।؟][\"'”’»“)」]*(\s*[–-] .*)?$")
_CUT = re.compile(r"\[(…|\.\.\.)\]$")
_SEPARATOR = re.compile(r"\s?[:|/>›»·]\s|\s[–—]\s")
_ZERO = re.compile("[" + "".join(map(chr, [0xAD, *range(0x200B, 0x2010), *range(0x2060, 0x2065), 0xFEFF])) + "]")
_OTHER = re.compile(r"[\W\d_]+")
_LISTED = re.compile(r"\s*[•\-–]")


class Page(NamedTuple):
    content: str
    title: str
    site: str
    address: str
    author: str = ""


class Views(NamedTuple):
    """Per site: the part each furniture line plays (`tail`, `box` or `other`), the same for what stands before a separator, its authors."""

    lines: dict[str, dict[str, str]]
    heads: dict[str, dict[str, str]]
    authors: dict[str, frozenset[str]]


class _Line(NamedTuple):
    text: str
    key: str
    head: str
    opening: str


def visible(text: str) -> str:
    """The text without invisible characters, in NFKC.  A line of which this leaves only spacing is blank."""
    return text if text.isascii() else unicodedata.normalize("NFKC", _ZERO.sub("", text))


def plain(line: str) -> str:
    """The line without invisible characters, decoration at its ends and odd spacing, in NFKC.  Linear in its length."""
    text = " ".join(visible(line).split()).lstrip(" •-–»›>→★!*·…")
    for _ in range(2):
        text = _COUNT.sub("", text.rstrip(" »›→★*·"))
        for end in (" …", " ...", " !"):
            text = text.removesuffix(end)
    return text


def _letters(text: str) -> str:
    return _OTHER.sub("", text.lower())


def is_prose(text: str) -> bool:
    """Whether a line ends like a sentence and is long enough for one; scripts without spaces are measured in characters."""
    return bool(_PROSE.search(text)) and (len(text.split()) >= 6 or (len(text) >= 18 and " " not in text))


@lru_cache(maxsize=50_000)
def _line(raw: str) -> _Line:
    text = plain(raw)
    cut = _SEPARATOR.search(text)
    words = text.split(None, 10)
    opening = "^" + _letters(words[0] + words[1]) if 3 <= len(words) <= 10 and not is_prose(text) else ""
    return _Line(text, _letters(text), _letters(text[: cut.start()]) if cut else "", opening)


def _lines(page: Page) -> list[_Line]:
    return [_line(raw) for raw in page.content.split("\n")]


def _kinds(page: Page, lines: list[_Line], repeated: frozenset[str] | dict, heads: frozenset[str] | dict, authors: frozenset[str]) -> list[tuple[str, str]]:
    """Of each line its kind and, for furniture, the key by which it recurs."""
    title, site, own = _letters(plain(page.title)), _letters(page.site), _letters(page.author)
    out, before = [], ""
    for text, key, head, opening in lines:
        if not text:
            kind = ("blank", "")
        elif key and key == title:
            kind = ("title", "")
        elif not key or key in repeated:
            kind = ("line", key)
        elif head and head in heads:
            kind = ("head", head)
        elif opening in heads and before == "title":
            kind = ("head", opening)
        elif site and (key.startswith(site) or key.endswith(site)):
            kind = ("site", "")
        elif (own and key.startswith(own)) or (not is_prose(text) and (key.endswith(tuple(authors)) or (head and head.endswith(tuple(authors))))):
            kind = ("author", "")
        else:
            kind = ("prose" if is_prose(text) or _CUT.search(text) else "short", "")
        out.append(kind)
        before = before if kind[0] == "blank" else kind[0]
    return out


def learn_views(pages: list[Page], read: list[list[_Line]] | None = None) -> Views:
    """What the sample's sites repeat, and where."""
    read = [_lines(p) for p in pages] if read is None else read
    sizes = Counter(p.site for p in pages)
    lines, heads, openings, authors = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for page, of in zip(pages, read, strict=True):
        lines[page.site].update({x.key for x in of if x.key})
        heads[page.site].update({x.head for x in of if x.head})
        full, title = [x for x in of if x.text], _letters(plain(page.title))
        openings[page.site].update({b.opening for a, b in pairwise(full) if b.opening and a.key == title != ""})
        if len(page.author.split()) > 1:
            authors[page.site].add(_letters(page.author))
    often = lambda counts, site, one_in=ONE_IN: frozenset(k for k, n in counts.items() if n >= LEAST and n * one_in >= sizes[site])
    repeated = {s: often(c, s) for s, c in lines.items()}
    fronts = {s: often(heads[s], s) | often(openings[s], s, OPENS_IN) | repeated[s] for s in lines}
    named = {s: frozenset(authors[s]) for s in lines}
    # Of each furniture line: pages, those with much prose after it, what follows it: prose, short lines.
    seen: dict[tuple[str, str, str], list[int]] = defaultdict(lambda: [0, 0, 0, 0])
    for page, of in zip(pages, read, strict=True):
        kinds = _kinds(page, of, repeated[page.site], fronts[page.site], named[page.site])
        total = sum(len(x.text) for x, k in zip(of, kinds, strict=True) if k[0] == "prose")
        if not total:
            continue
        after, following = 0, ""
        for x, (kind, key) in zip(reversed(of), reversed(kinds), strict=True):
            if kind == "prose":
                after += len(x.text)
            elif kind in ("line", "head"):
                row = seen[page.site, kind, key]
                row[0] += 1
                row[1] += after > TAIL_PROSE * total
                row[2] += following in ("prose", "title")
                row[3] += following in ("short", "site")
            following = following if kind == "blank" else kind
    parts: dict[str, dict[str, dict[str, str]]] = {k: {s: {} for s in lines} for k in ("line", "head")}
    for (site, kind, key), (n, much, prose, short) in seen.items():
        part = "tail" if n >= LEAST and much <= TAIL * n else "box" if short >= LEAST and prose <= BOX * (prose + short) else "other"
        parts[kind][site][key] = part
    for site in lines:  # furniture of pages without prose
        for key in repeated[site]:
            parts["line"][site].setdefault(key, "other")
        for key in fronts[site]:
            parts["head"][site].setdefault(key, "other")
    return Views(parts["line"], parts["head"], named)


def learn_labels(pages: list[Page]) -> tuple[Views, list[list[bool | None]]]:
    """The sample's views and the labels of its lines."""
    read = [_lines(p) for p in pages]
    views = learn_views(pages, read)
    return views, [seed_labels(p, views, x) for p, x in zip(pages, read, strict=True)]


def seed_labels(page: Page, views: Views, lines: list[_Line] | None = None) -> list[bool | None]:
    """Of each line: True main body, False not, None blank.  A line of decoration only separates like a blank one, but is not blank: False.

    Pages of sites that the sample doesn't hold are judged by agreement and form alone.
    """
    lines = _lines(page) if lines is None else lines
    parts, fronts = views.lines.get(page.site, {}), views.heads.get(page.site, {})
    kinds = _kinds(page, lines, parts, fronts, views.authors.get(page.site, frozenset()))
    titled = any(k == "title" for k, _ in kinds)
    if sum(bool(x.key and _CUT.search(x.text)) for x in lines) >= (TEASERS if titled else 1):
        kinds = [("blank" if k == "blank" else "site", "") for k, _ in kinds]
    follows, following = [""] * len(kinds), ""  # of each line the kind of the next that is not blank
    for i in range(len(kinds) - 1, -1, -1):
        follows[i] = following
        following = following if kinds[i][0] == "blank" else kinds[i][0]
    raw = page.content.split("\n")
    zone, box, headed, opened = "start", False, False, False
    out: list[bool | None] = []
    for i, (kind, key) in enumerate(kinds):
        body = False
        if kind == "blank":
            out.append(False if visible(raw[i]).strip() else None)
            continue
        if kind == "title":
            body, headed, box = zone == "start" and not headed, True, False
        elif kind == "prose":
            body = zone != "tail" and not (box and bool(_CUT.search(lines[i].text)))
            if body:
                zone, box = "body", False
        elif kind == "short":
            # Before the first prose a short line is of the body below the headline, in a list, or right above prose.
            body = zone != "tail" and not box and (zone == "body" or headed or bool(_LISTED.match(raw[i])) or (opened and follows[i] == "prose"))
        else:
            part = (parts if kind == "line" else fronts).get(key, "other") if kind in ("line", "head") else "other"
            zone = "tail" if part == "tail" else zone
            box, opened = part == "box" or (box and kind == "site"), True
        out.append(body)
    return out
