"""Keyword-stuffed pages, link lists and product tags, by suffix automata.

The automaton of a page's words knows every repeated substring and how often it
occurs.  From it follow the characters that maximal repeated substrings cover.
Sentences repeat words too, so coverage counts only where clause structure is
missing: in a unit (line or sentence) whose connecting words, if any, are
themselves parts of repeated phrases.  Links and tags are recognised by form.
A page is spam if such units make up more than half of its characters.

No word is listed.  A connecting word recurs in a page with ever other
neighbours, as articles and prepositions do, while a keyword recurs with the
same few.  Words that connect in many documents of the corpus are taken for
connecting words wherever they stand; in pages that hold hardly any of them, in
languages rare in the corpus, the page's own are used.  Scripts without spaces
are read by characters.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate, compress, count
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.nested import sound
from sluice.session import materialise

#: A page is spam from this share of its characters, exclusive.
SHARE = 0.5
#: A phrase of two words or more is repeated from two occurrences, a single word from so many.
WORD_REPEATS = 4
#: A unit without clause structure counts whole from this coverage of its letters.
COVERAGE = 0.45
#: A unit has clause structure if so large a share of its words are connecting words outside of phrases repeated this often.
CLAUSE, PHRASE_REPEATS = 0.13, 4
#: In a phrase at most every third word connects.  Longer repeated substrings are repeated sentences, not phrases; their connecting words make clauses.
PHRASE_WORDS = 8
#: Of the other words of a repeated sentence, more than so large a share are different words.
ONCE = 0.9
#: So many units of keywords or links in a row count, a long unit once for so many words; fewer only if they are most of the page.
STRUNG, LONG_LINE = 3, 10
#: Units of so many words need two different connecting words for a clause.
LONG_UNIT = 6
#: A word that recurs in a page connects if it has so many different neighbours on either side, as a share of its occurrences.
DIVERSE = 0.6
#: A word connects in the corpus if it connects in one in so many documents, in three at least, and in so large a share of those that hold it.
#: The last is what tells it from the topics of some documents, which recur in few of those that hold them, whatever the language's part of the corpus.
ONE_IN, LEAST, USUALLY = 1000, 3, 0.3
#: A page is judged by the corpus' connecting words if they are so large a share of its words.
KNOWN = 0.03

# Characters without width, and the soft hyphen.
_INVISIBLE = re.compile("[" + "".join(map(chr, [0xAD, 0x34F, 0x61C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xFEFF])) + "]")
# Every pattern is linear: what it repeats is possessive, and it starts only where a run starts.
_LINK = re.compile(
    r"""<a\b[^<>]*+>[^<>]*+(?:</a\s*+>)?+|!?\[[^\[\]]*+\]\([^()\s]*+\)|(?:https?://|ftp://|www\.)[^\s<>"')\]]++|(?<![\w.@\-])[a-z0-9][a-z0-9\-]*+(?:\.[a-z0-9\-]++)++(?:/[^\s<>"')\]]*+)?+(?![\w@])""",
    re.IGNORECASE,
)
#: A host without scheme ends in letters.
_HOST = re.compile(r"[^/]*\.[a-z]{2,}(?:/|$)", re.IGNORECASE)
#: Every link has one of these, in lower case.
_LINKISH = ("://", "](", "href")
_DOMAIN = re.compile(r"\.[a-z]{2}")
_ONES = b"\x01" * 64
_TAG = re.compile(r"<[^<>]*+>")
_DIGIT = re.compile(r"\d")
_HASHTAG = re.compile(r"#\w++")
# Scripts written without spaces (Thai, Lao, Myanmar, Khmer, kana, Han).
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]++(?:['’][^\W{_UNSPACED}]++)*+")
_ENDS = re.compile(r"""[.!?…]++["'”»)]*+|[。！？]++["'”」』）]*+|\n""")
_PIECE = re.compile(rf"{_WORD.pattern}|[.!?…]++[\"'”»)]*+(?=\s)|[。！？]++|\n")


#: Stands for a link or hashtag: a character of private use.
_MARK = "\ue000"


class Verdict(NamedTuple):
    """Characters of the page, of units made of links or tags, of repeated keywords; letters covered by repeats."""

    total: int
    links: int
    keywords: int
    covered: int

    @property
    def share(self) -> float:
        return (self.links + self.keywords) / self.total if self.total else 0.0


def repeats(tokens: list[int], many: int = PHRASE_REPEATS) -> tuple[list[int], list[int], list[int]]:
    """Of each position: the lengths of the longest substrings that end there and occur twice and `many` times, and how often the first occurs.

    Builds the suffix automaton of the sequence, online, with the number of end positions of each
    state; the substring sought is the longest of the first state on the suffix path that occurs often enough.
    A negative token stands for a word that occurs once: no repeated substring holds it, so it
    cuts the sequence, and the automaton is that of the parts.
    """
    following: list[dict[int, int]] = [{}]
    link, length, ends, last = [-1], [0], [0], 0
    own = []
    for token in tokens:
        if token < 0:
            own.append(0)
            last = 0
            continue
        q = following[last].get(token)
        if q is not None and length[q] == length[last] + 1:
            ends[q] += 1
            own.append(q)
            last = q
            continue
        p = last
        if q is None:
            new = len(length)
            following.append({})
            link.append(0)
            length.append(length[last] + 1)
            ends.append(1)
            while p >= 0 and token not in following[p]:
                following[p][token] = new
                p = link[p]
            if p >= 0:
                q = following[p][token]
                if length[p] + 1 == length[q]:
                    link[new] = q
                    q = None
        else:
            new = -1
        if q is not None:
            copy = len(length)
            following.append(following[q].copy())
            link.append(link[q])
            length.append(length[p] + 1)
            ends.append(0)
            while p >= 0 and following[p].get(token) == q:
                following[p][token] = copy
                p = link[p]
            link[q] = copy
            if new < 0:
                new = copy
                ends[copy] = 1
            else:
                link[new] = copy
        own.append(new)
        last = new
    for s in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
        ends[link[s]] += ends[s]
    longest, often, steady = [], [], []
    for s in own:
        while s > 0 and ends[s] < 2:
            s = link[s]
        longest.append(length[s] if s > 0 else 0)
        often.append(ends[s] if s > 0 else 0)
        while s > 0 and ends[s] < many:
            s = link[s]
        steady.append(length[s] if s > 0 else 0)
    return longest, often, steady


class Words(NamedTuple):
    """A page's units and their sizes in characters, what they are made of, and the sizes of its links and hashtags.

    `times`: occurrences of each word, of no word ("", after each unit) first; `numbers`: each word as its place among these.
    """

    units: list[str]
    spans: list[tuple[int, int]]
    names: list[str]
    times: dict[str, int]
    numbers: list[int]
    marks: list[int]


class _Normal(dict):
    """Words as they are compared, remembered: digits within words are all one, as in article numbers; ends of units are no word."""

    def __missing__(self, word: str) -> str:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = word if word.isalpha() or word.isdigit() else _DIGIT.sub("0", word) if word[0].isalnum() or word[0] == "_" else ""
        return value


_NORMAL = _Normal()


def read_words(text: str | None) -> Words | None:
    """The words of a page by unit; None for null, empty and blank texts."""
    if not text or text.isspace():
        return None
    text = html.unescape(text) if "&" in text else text
    if not text.isascii():
        text = _INVISIBLE.sub("", text)
    # Links and hashtags become single marks, so that their words don't take part in the repeats.
    marks: list[int] = []

    def mark(m: re.Match) -> str:
        found = m.group()
        if found[0] == "<" and "href" not in found.lower():
            return found
        if found[0].isalnum() and "://" not in found[:8] and not found[:4].lower() == "www." and not _HOST.match(found):
            return found
        marks.append(len(found))
        return _MARK

    low = text.lower()
    if any(x in low for x in _LINKISH) or _DOMAIN.search(low):
        text = _LINK.sub(mark, text)
    if "#" in text:
        text = _HASHTAG.sub(mark, text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    text = text.lower()
    units, at = [], 0
    for m in _ENDS.finditer(text):
        end = m.end()
        if text[m.start()] not in ".!?…" or text[end : end + 1].isspace():  # a point within a number or a word ends nothing
            units.append(text[at:end])
            at = end
    units.append(text[at:])
    units = [u for u in units if u and not u.isspace()]
    names: list[str] = []
    spans: list[tuple[int, int]] = []
    normal, find = _NORMAL.__getitem__, _WORD.findall
    for unit in units:
        start = len(names)
        names += map(normal, find(unit))
        spans.append((start, len(names)))
        names.append("")  # repeats end with a unit
    times = {"": 0} | Counter(names)
    place = dict(zip(times, range(len(times)), strict=True))
    numbers = list(map(place.__getitem__, names))
    return Words(units, spans, names, times, numbers, marks)


def connecting(words: Words) -> set[str]:
    """The words that connect in the page: they recur, with ever other words before and after them.  All ends of units are one neighbour; repeated units count once."""
    spans = {tuple(words.numbers[a:b]): (a, b + 1) for a, b in words.spans}.values()
    numbers = [0, *(n for a, b in spans for n in words.numbers[a:b])]
    pairs = set(zip(numbers, numbers[1:], strict=False))
    seen, after, before = Counter(numbers), Counter(map(itemgetter(0), pairs)), Counter(map(itemgetter(1), pairs))
    times = [seen[i] for i in range(len(words.times))]
    found = {w for i, (w, n) in enumerate(zip(words.times, times, strict=True)) if n > 1 and after[i] >= DIVERSE * n and before[i] >= DIVERSE * n and not _DIGIT.search(w)}
    found.discard("")
    return found


class Cover(NamedTuple):
    """Characters of the page, letters covered by repeats, the units covered enough for a closer look, and the most characters that these could make spam."""

    total: int
    letters: int
    units: list[tuple]
    most: int


def cover(words: Words, known: list[bool]) -> Cover:
    """What repeats cover, from counts of pairs: a repeated substring of two words or more consists of repeated pairs."""
    names, numbers = words.names, words.numbers
    recurring = [i > 0 and n > 1 for i, n in enumerate(words.times.values())]
    kept = [n if recurring[n] else 0 for n in numbers]
    pairs = Counter([p for p in zip(kept, kept[1:], strict=False) if p[0] and p[1]])
    again = {p for p, n in pairs.items() if n > 1}
    covered = bytearray(len(names))
    for i in [i for i, p in enumerate(zip(numbers, numbers[1:], strict=False)) if p in again] if again else []:
        covered[i] = covered[i + 1] = 1
    often = {w for w, n in words.times.items() if n >= WORD_REPEATS and w and not w.isdigit()}
    if often:
        for i in [i for i, w in enumerate(names) if w in often]:
            covered[i] |= not known[i]
    # Words outside of pairs repeated often are in no phrase: those of them that connect make clauses, whatever the automaton says.
    steady = {p for p in again if pairs[p] >= PHRASE_REPEATS}
    free = bytearray(known)
    for i in [i for i, p in enumerate(zip(numbers, numbers[1:], strict=False)) if p in steady] if steady else []:
        free[i] = free[i + 1] = 0
    total = covered_letters = at = most = 0
    left = []
    for unit, (start, end) in zip(words.units, words.spans, strict=True):
        own = unit.count(_MARK) if words.marks else 0
        marked = sum(words.marks[at : at + own]) if own else 0
        at += own
        size = marked + len(unit.strip()) - own
        total += size
        hits = covered.count(1, start, end)
        if not (hits or own):
            continue
        letters = sum(map(len, names[start:end]))
        hit = letters if hits == end - start else sum(map(len, compress(names[start:end], covered[start:end])))
        covered_letters += hit
        if own or hit >= COVERAGE / 2 * letters or 2 * hits >= end - start:
            clauses = free.count(1, start, end)
            if not own and end > start and clauses >= CLAUSE * (end - start) and (end - start < LONG_UNIT or len(set(compress(names[start:end], free[start:end]))) > 1):
                continue
            left.append((unit, start, end, own, marked, size, letters, hit, hits))
            if own or hit >= COVERAGE * letters or 2 * hits >= end - start or unit.count("|") >= 2:
                most += size
    return Cover(total, covered_letters, left, most)


def judge(text: str | None, corpus: frozenset[str] = frozenset(), measure: bool = True) -> Verdict | None:
    """The page's characters by kind; nothing for null, empty and blank texts.  Reads the whole text.  `corpus`: connecting words of all documents.

    Without `measure`, None for a page that would be no spam even if no unit had clause structure: for the decision it needs no automaton.
    """
    words = read_words(text)
    if words is None:
        return Verdict(0, 0, 0, 0)
    names = words.names
    known = list(map(corpus.__contains__, names))
    if sum(known) < KNOWN * len(names):
        known = list(map((connecting(words) | corpus).__contains__, names))
    total, covered_letters, left, most = cover(words, known)
    if not measure and most <= SHARE * total:
        return None
    links = 0
    # The automaton tells whether what covers a unit is phrases or sentences.
    phrase, sentence = _phrases(words, known) if left else (b"", b"")
    runs: list[tuple[int, int, int]] = []  # of runs of such units: their weight, characters of keywords, where the run ends
    for unit, start, end, own, marked, size, letters, hit, hits in left:
        clause = [names[i] for i in range(start, end) if known[i] and (sentence[i] or not phrase[i])]
        clauseless = len(clause) < CLAUSE * (end - start) or (end - start >= LONG_UNIT and len(set(clause)) < 2) or end == start
        found = 0
        if own:
            whole = clauseless and (marked * 3 >= size or hit >= COVERAGE * letters)
            links += size if whole else marked
        elif clauseless and unit.count("|") >= 2 and hit >= COVERAGE / 2 * letters:
            links += size
            whole = True
        else:
            whole = clauseless and end > start and (hit >= COVERAGE * letters or (not clause and 2 * hits >= end - start))
            found = size if whole else 0
        if whole:
            last = runs.pop() if runs and runs[-1][2] + 1 == start else (0, 0, 0)
            runs.append((last[0] + max(1, (end - start) // LONG_LINE), last[1] + found, end))
    # Lists and articles with stock phrases hold units like these here and there; keywords are strung together.
    keywords = sum(size for n, size, _ in runs if n >= STRUNG or 2 * size > total)
    return Verdict(total, links, keywords, covered_letters)


def _phrases(words: Words, known: list[bool]) -> tuple[bytearray, bytearray]:
    """Of each word whether it stands in a phrase repeated often, and whether in a repeated sentence, from the suffix automaton."""
    once = {i for i, n in enumerate(words.times.values()) if n < 2} | {0}
    numbers = [-1 if n in once else n for n in words.numbers]
    longest, _, steady = repeats(numbers)
    before = list(accumulate(known, initial=0))
    phrase, sentence = bytearray(len(numbers)), bytearray(len(numbers))
    for i, n in enumerate(longest):
        if n >= 2:
            # Only the end of a repeat needs a look, its beginnings are within it.
            if n > PHRASE_WORDS and (i + 1 == len(longest) or longest[i + 1] <= n):
                # Without the words that connect, a sentence has each word once or nearly so; strung phrases come again within it.
                own = [w for w, k in zip(numbers[i - n + 1 : i + 1], known[i - n + 1 : i + 1], strict=True) if not k]
                if len(set(own)) > ONCE * len(own):
                    sentence[i - n + 1 : i + 1] = b"\x01" * n
            n = min(steady[i], PHRASE_WORDS)
            if n >= 2 and 3 * (before[i + 1] - before[i - n + 1]) <= n:
                phrase[i - n + 1 : i + 1] = _ONES[:n]
    return phrase, sentence


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.diff(values, prepend=-1) != 0]


def count_connecting(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Of the words of many pages: in how many pages each connects, and how many hold it; first of no word, which all that aren't blank hold.

    Agrees with `connecting` page by page, but that links are read as their words.
    """
    place: dict[str, int] = defaultdict(count().__next__)
    number = place.__getitem__
    number("")
    flat: list[int] = []
    ends = [0]
    for text in texts:
        if text and not text.isspace():
            text = html.unescape(text) if "&" in text else text
            if not text.isascii():
                text = _INVISIBLE.sub("", text)
            flat += map(number, map(_NORMAL.__getitem__, _PIECE.findall(text.lower())))
            flat.append(0)
            ends.append(len(flat))
    words, pages = np.array(flat, np.int64), len(ends) - 1
    page = np.repeat(np.arange(pages), np.diff(ends))
    # Units end at 0; repeated ones of a page count once: told by a hash of their words in order.
    unit = np.cumsum(words == 0) - (words == 0)
    starts = np.searchsorted(unit, np.arange(unit[-1] + 1 if len(unit) else 0))
    rank = np.arange(len(words)) - (starts[unit] if len(unit) else 0)
    with np.errstate(over="ignore"):
        mixed = ((words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ (rank.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
        digest = np.add.reduceat(mixed * np.uint64(0x94D049BB133111EB), starts) if len(starts) else mixed
        _, first = np.unique(digest ^ (page[starts].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), return_index=True)
    fresh = np.zeros(len(starts), bool)
    fresh[first] = True
    size = len(place)
    held = np.bincount(_distinct(page * size + words) % size, minlength=size)
    held[0] = pages
    keep = fresh[unit] if len(unit) else np.zeros(0, bool)
    words, page = words[keep], page[keep]
    before, after = np.concatenate([[0], words[:-1]]) if len(words) else words, np.concatenate([words[1:], [0]]) if len(words) else words
    full = words > 0
    keys, at, times = np.unique((page * size + words)[full], return_inverse=True, return_counts=True)
    sides = [np.bincount(_distinct(at * size + side[full]) // size, minlength=len(keys)) for side in (before, after)]
    digits = np.fromiter((_DIGIT.search(w) is not None for w in place), bool, size)
    connects = (times > 1) & (sides[0] >= DIVERSE * times) & (sides[1] >= DIVERSE * times) & ~digits[keys % size]
    return list(place), np.bincount(keys[connects] % size, minlength=size), held


def connecting_words(documents: DataFrame, text: str = "text") -> frozenset[str]:
    """The words that connect in the corpus, from counts over all documents.

    Each batch sums its documents' words before they are shuffled.  What reaches the driver is bounded: a document has
    some tens of connecting words, so fewer than some tens of ONE_IN words connect in one in ONE_IN documents.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, yes, held = count_connecting(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(map(sound, words)), pa.array(yes), pa.array(held)], ["word", "yes", "held"])

    sums = documents.select(text).mapInArrow(counted, "word string, yes long, held long").groupBy("word").agg(F.sum("yes").alias("yes"), F.sum("held").alias("held"))
    often = materialise(sums.where((F.col("yes") >= LEAST) & (F.col("yes") >= USUALLY * F.col("held")) | (F.col("word") == "")), "connecting-words")
    n = often.where("word = ''").select("held").head()
    return frozenset(r[0] for r in often.where((F.col("yes") * ONE_IN >= (n[0] if n else 0)) & (F.col("word") != "")).select("word").collect())


def spam_measures(documents: DataFrame, id_: str = "doc_id", text: str = "text", words: frozenset[str] | None = None, spam_only: bool = False) -> DataFrame:
    """(document, total, links, keywords, covered, share, spam) per row.  Other columns are not read; null text is no spam.

    `words`: connecting words, by default those of these documents (a pass of its own).  `spam_only`: only the rows of spam, the same
    as otherwise, without building automata of pages that can't be spam.
    """
    kind = documents.schema[id_].dataType.simpleString()
    corpus = documents.sparkSession.sparkContext.broadcast(connecting_words(documents, text) if words is None else words)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(t, corpus.value, not spam_only) for t in batch.column(1).to_pylist()]
            at = pa.array([i for i, v in enumerate(found) if not spam_only or (v is not None and v.share > SHARE)], pa.int32())
            found = [found[i] for i in at.to_pylist()]
            columns = [pa.array([v[k] for v in found], pa.int64()) for k in range(4)]
            share = pa.array([v.share for v in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *columns, share], ["document", "total", "links", "keywords", "covered", "share"])

    out = documents.select(F.col(id_), F.col(text)).mapInArrow(measure, f"document {kind}, total long, links long, keywords long, covered long, share double")
    return out.withColumn("spam", F.col("share") > SHARE)
