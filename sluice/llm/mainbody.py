"""Main body of web pages: boosted trees over the nodes of a page tree, decoded top down without contradictions.

What arrives is the text of the whole page, a line per text block, so the tree
is rebuilt from it: a page holds blocks (between blank lines), a block holds
runs (lines of one kind, prose or short), a run holds lines.  Every node gets
the same features: density and size of its subtree, the weights of its tokens,
depth, statistics of its siblings and parent, its place.  One model scores all
nodes.  A node is kept or pruned as a whole tree says best: nothing below a
pruned node is kept, and a kept node keeps something.

The trees learn from `pageviews`, which labels a bounded sample of pages by
what the pages of a site have in common, whatever the language.
"""

from __future__ import annotations

import hashlib
import inspect
import pickle
import re
import sys
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import boosting
from sluice.llm.lines import content_of, version
from sluice.llm.pageviews import Page, Views, learn_labels, seed_labels, visible
from sluice.operators.nested import read_json, sound

#: Pages on which the tokens' weights and the trees are trained: a bounded sample, in like parts from so many sites at most, by a hash of the id.
SAMPLE_PAGES, SAMPLE_SITES = 3000, 100
#: Longer records are trained on only where shorter ones are fewer than that, and while the sample has at most so many
#: characters in all.  They are extracted like all others.
SAMPLE_CHARS, SAMPLE_TOTAL = 50_000, 30_000_000
#: Fewer pages are not trained on: their seed labels are the result.  (Trained on 80 pages, 96 % of held-out lines are right, on 10, 80 %.)
LEAST_PAGES = 100
#: Tokens with weights of their own; pairs of tokens share so many weights; the most frequent words are taken for function words.
TOKENS, PAIRS, FREQUENT = 20_000, 1 << 17, 100

_TOKEN = re.compile(r"\w+|[^\w\s]|\n")
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SENTENCE_ENDS = frozenset(".!?…”\"»“)")
_BULLETS = frozenset("•-–*")


class Weights(NamedTuple):
    """Log-odds learned from the sample. `tokens`: number of each known token; `single`, `pair`: of being main body;
    `single_end`, `pair_end`: of nothing of the body following; `line_keys`, `line_odds`: of whole lines; `address`: of path segments."""

    tokens: dict[str, int]
    single: np.ndarray
    pair: np.ndarray
    single_end: np.ndarray
    pair_end: np.ndarray
    line_keys: np.ndarray
    line_odds: np.ndarray
    address: dict[str, float]


class Model(NamedTuple):
    """`weights` and `trees` are None if the sample was too small for them: then the seed labels are the result."""

    views: Views
    weights: Weights | None
    trees: boosting.Trees | None


class Lines(NamedTuple):
    """The non-blank lines of a batch of pages, as arrays, and their tokens."""

    page: np.ndarray
    number: np.ndarray
    block: np.ndarray
    chars: np.ndarray
    key: np.ndarray
    owner: np.ndarray  # of each token its line
    token: np.ndarray  # of each token its number among the known, 0 for others
    flags: np.ndarray  # of each token: 1 word, 2 capital, 4 digits, 8 frequent word, 16 site name
    is_title: np.ndarray
    ends: np.ndarray
    bullet: np.ndarray


def page_of(attributes: str | None, source: str | None) -> Page | None:
    """The page in a record's JSON; None if it has no content or is not valid."""
    if content_of(attributes) is None:
        return None
    record = read_json(attributes)
    text = lambda k: record.get(k) if isinstance(record.get(k), str) else ""
    return Page(record["content"], text("title"), (source or "").rsplit("/", 1)[-1].lower(), text("original_url"), text("author"))


def segment(address: str) -> str:
    """The first part of a URL's path, digits as 0: what the site calls this kind of page."""
    parts = address.split("/", 4)
    return re.sub(r"\d", "0", parts[3]) if len(parts) > 4 else ""


def read_lines(pages: list[Page], known: dict[str, int]) -> Lines:
    """Tokens and shapes of the lines of many pages; equal lines (but for case, spacing and decoration) have equal keys."""
    local: dict[str, int] = {"\n": 0}
    ids: list[int] = []
    chars: list[int] = []
    counts: list[int] = []
    place = local.setdefault
    for page in pages:
        text = visible(page.content)
        chars += [len(x) for x in text.split("\n")]
        counts.append(len(chars))
        tokens = _TOKEN.findall(text)
        ids += [place(t, len(local)) for t in tokens]
        ids.append(0)
    names = list(local)
    lower = [t.lower() for t in names]
    number = np.array([known.get("0" if t.isdigit() else t, 0) for t in lower], np.int64)
    digest = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in lower], np.uint64)
    word = np.array([t[0].isalnum() or t[0] == "_" for t in names])
    flags = word + 2 * np.array([t[0].isupper() for t in names]) + 4 * np.array([t.isdigit() for t in names]) + 8 * (word & (number > 0) & (number <= FREQUENT))
    end_mark = np.array([t in _SENTENCE_ENDS for t in names])
    bullet = np.array([t in _BULLETS for t in names])

    every = np.array(ids, np.int64)
    line_of = np.cumsum(every == 0) - (every == 0)
    total = len(chars)
    page = np.repeat(np.arange(len(pages)), np.diff([0, *counts]))
    kept = every != 0
    every, line_of = every[kept], line_of[kept]
    # The key of a line: a polynomial over the hashes of its words.
    words = word[every]
    w_line, w_hash = line_of[words], digest[every[words]]
    rank = np.arange(len(w_line)) - np.searchsorted(w_line, w_line)
    with np.errstate(over="ignore"):
        mixed = (w_hash ^ (w_hash >> np.uint64(31))) * (_PRIME + np.uint64(2) * rank.astype(np.uint64) * np.uint64(0x5851F42D4C957F2D))
    key = np.zeros(total, np.uint64)
    np.add.at(key, w_line, mixed)
    titles = [_TOKEN.findall(visible(p.title).lower()) for p in pages]
    title_key = np.zeros(len(pages), np.uint64)
    for i, tokens in enumerate(titles):
        r = 0
        for t in tokens:
            if t[0].isalnum() or t[0] == "_":
                h = xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass"))
                title_key[i] = np.uint64((int(title_key[i]) + ((h ^ (h >> 31)) * ((int(_PRIME) + 2 * r * 0x5851F42D4C957F2D) & (2**64 - 1)))) & (2**64 - 1))
                r += 1
    site = np.array([xxhash.xxh3_64_intdigest(p.site.encode()) for p in pages], np.uint64)
    token_flags = flags[every] + 16 * (digest[every] == site[page[line_of]])
    size = np.bincount(line_of, minlength=total)
    blank = size == 0
    last = np.cumsum(size) - 1
    first = last - size + 1
    at_end = np.zeros(total, bool)
    opens = np.zeros(total, bool)
    full = ~blank
    at_end[full] = end_mark[every[last[full]]]
    opens[full] = bullet[every[first[full]]]
    number_in_page = np.arange(total) - np.array([0, *counts[:-1]])[page] + 1
    # A block ends where a blank line or a page ends.
    breaks = blank | (np.diff(page, prepend=-1) != 0)
    block = np.cumsum(breaks)
    index = np.cumsum(full) - 1
    return Lines(
        page[full], number_in_page[full], block[full], np.array(chars)[full], key[full], index[line_of], number[every], token_flags,
        (key == title_key[page])[full] & (key != 0)[full], at_end[full], opens[full],
    )


def _pairs(lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the pairs of neighbouring tokens, with a mark before the first of a line, and each pair's line."""
    token = lines.token + 1
    before = np.concatenate([[0], token[:-1]]) if len(token) else token
    before[np.diff(lines.owner, prepend=-1) != 0] = 0
    return ((before * 31_337 + token) * 2_654_435_761 % (1 << 31)) % PAIRS, lines.owner


def _sums(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, value, n)


def _extremes(owner: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.zeros(n), np.zeros(n)
    if len(owner):
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        low[owner[starts]], high[owner[starts]] = np.minimum.reduceat(value, starts), np.maximum.reduceat(value, starts)
    return low, high


#: Statistics that are summed over a subtree, then divided by what is named.
_OWN = 12


def _line_table(lines: Lines, w: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line: summable statistics, extremes of the token weights, and how much it says the body has ended."""
    n = len(lines.page)
    words = _sums(lines.owner, lines.flags & 1, n)
    pair, owner = _pairs(lines)
    single, double = w.single[lines.token], w.pair[pair]
    s_low, s_high = _extremes(lines.owner, single, n)
    p_low, p_high = _extremes(owner, double, n)
    tokens = np.maximum(1, _sums(lines.owner, np.ones(len(lines.owner)), n))
    at = np.searchsorted(w.line_keys, lines.key)
    at[at == len(w.line_keys)] = 0
    known = w.line_keys[at] == lines.key if len(w.line_keys) else np.zeros(n, bool)
    key_odds = np.where(known, w.line_odds[at], 0.0) if len(w.line_keys) else np.zeros(n)
    prose = (words >= 6) & lines.ends
    sums = np.stack([
        np.ones(n), lines.chars, words, prose, _sums(lines.owner, (lines.flags >> 3) & 1, n), _sums(lines.owner, (lines.flags >> 1) & 1, n),
        _sums(lines.owner, (lines.flags >> 2) & 1, n), tokens - words, _sums(lines.owner, single, n) / np.sqrt(tokens), _sums(owner, double, n) / np.sqrt(tokens), key_odds, lines.bullet,
    ], 1)
    site = _sums(lines.owner, (lines.flags >> 4) & 1, n) > 0
    firsts = np.flatnonzero(np.diff(lines.owner, prepend=-1))
    first, last = np.zeros(n), np.zeros(n)
    first[lines.owner[firsts]] = double[firsts]
    lasts = np.flatnonzero(np.diff(lines.owner, append=-1))
    last[lines.owner[lasts]] = single[lasts]
    share = _sums(lines.owner, lines.token > 0, n) / tokens
    extra = np.stack([s_low, s_high, p_low, p_high, site, lines.is_title, lines.ends, first, last, known, share], 1)
    ended = (_sums(lines.owner, w.single_end[lines.token], n) + _sums(owner, w.pair_end[pair], n)) / np.sqrt(tokens)
    return sums, extra, ended


def _roll(parent: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(parent, values[:, k], n) for k in range(values.shape[1])], 1)


def _ratios(sums: np.ndarray) -> np.ndarray:
    """Subtree statistics as densities."""
    lines, chars, words = sums[:, 0], sums[:, 1], np.maximum(1, sums[:, 2])
    return np.stack([chars / lines, words / lines, sums[:, 3] / lines, sums[:, 4] / words, sums[:, 5] / words, sums[:, 6] / words, sums[:, 7] / words, sums[:, 8] / lines, sums[:, 9] / lines, sums[:, 10] / lines, sums[:, 11] / lines], 1)


def _shift(values: np.ndarray, group: np.ndarray, by: int) -> np.ndarray:
    """The values of the sibling `by` places on (before, if negative); -9 where there is none."""
    out = np.full_like(values, -9.0)
    if by > 0:
        same = group[by:] == group[:-by]
        out[:-by][same] = values[by:][same]
    else:
        same = group[:by] == group[-by:]
        out[-by:][same] = values[:by][same]
    return out


class Tree(NamedTuple):
    """Nodes of depth 0 (pages) to 3 (lines): features, and of each node its parent; a page is its own, so that it has no siblings."""

    features: list[np.ndarray]
    parents: list[np.ndarray]


def _running(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Sum over the group's rows before each; groups stand together."""
    total = np.cumsum(value) - value
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    return total - np.repeat(total[starts], np.diff([*starts, len(group)]))


def _running_max(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Greatest value over the group's rows before each; -9 at the first."""
    out = np.full(len(value), -9.0)
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for start, end in pairwise([*starts, len(group)]):
        out[start + 1 : end] = np.maximum.accumulate(value[start : end - 1])
    return np.maximum(out, -9.0)


def tree_of(lines: Lines, pages: list[Page], w: Weights) -> Tree:
    """The page trees of a batch with their nodes' features."""
    sums, extra, ended = _line_table(lines, w)
    n = len(lines.page)
    prose = sums[:, 3] > 0
    new_run = (np.diff(lines.block, prepend=-1) != 0) | (np.diff(prose.astype(int), prepend=-1) != 0)
    run = np.cumsum(new_run) - 1
    block_ids, block = np.unique(lines.block, return_inverse=True)
    run_first = np.flatnonzero(new_run)
    runs, blocks = len(run_first), len(block_ids)
    parent_run, parent_block = block[run_first], lines.page[np.unique(block, return_index=True)[1]] if n else block
    levels = [_roll(lines.page, sums, len(pages)), _roll(block, sums, blocks), _roll(run, sums, runs), sums]
    levels[0][:, 0] = np.maximum(1, levels[0][:, 0])
    extras = [_fold(lines.page, extra, len(pages)), _fold(block, extra, blocks), _fold(run, extra, runs), extra]
    parents = [np.arange(len(pages)), parent_block, parent_run, run]
    page_at = [np.arange(len(pages)), parent_block, parent_block[parent_run], lines.page]
    firsts = [np.searchsorted(lines.page, np.arange(len(pages))), np.searchsorted(block, np.arange(blocks)), run_first, np.arange(n)]
    total = levels[0][:, 0]
    prose_above = _running(lines.page, prose.astype(float))
    end_above = _running_max(lines.page, ended)
    place = np.arange(n) - firsts[0][lines.page]
    address = np.array([w.address.get(segment(p.address), 0.0) for p in pages])
    ratios = [_ratios(s) for s in levels]
    # Of a line: the last line before it that is not short and title-like, through the run of shorts it stands in.
    score = sums[:, 8] + sums[:, 9] + sums[:, 10]
    opener = np.maximum.accumulate(np.where((score < -2) | prose | (np.diff(lines.page, prepend=-1) != 0), np.arange(n), 0)) if n else place
    before = np.where(place > 0, np.concatenate([[0], opener[:-1]]) if n else opener, np.arange(n))
    features = []
    for depth in range(4):
        r, e, at = ratios[depth], extras[depth], np.minimum(firsts[depth], max(0, n - 1))
        count = len(r)
        own = np.concatenate([r, e], 1)
        compact = np.stack([r[:, 0], r[:, 2], r[:, 7], r[:, 8], r[:, 9], e[:, 4]], 1)
        siblings = [_shift(compact, parents[depth] if depth < 3 else lines.page, k) for k in (-2, -1, 1, 2)]
        up = ratios[depth - 1][parents[depth]] if depth else np.full_like(r, -9.0)
        page = page_at[depth]
        if n:
            spot = np.stack([place[at] / total[page], prose_above[at], levels[0][page, 3] - prose_above[at], end_above[at], ended[at], score[before[at]], place[at] - place[before[at]], sums[before[at], 3], total[page], ratios[0][page, 2], address[page]], 1)
        else:
            spot = np.zeros((count, 11))
        features.append(np.concatenate([np.full((count, 1), float(depth)), levels[depth][:, :1], own, *siblings, up[:, [0, 2, 7, 8, 9]], spot], 1))
    return Tree(features, parents)


def _fold(parent: np.ndarray, extra: np.ndarray, n: int) -> np.ndarray:
    """Extremes of a subtree: least of the lows, greatest of the rest."""
    out = np.zeros((n, extra.shape[1]))
    if len(parent):
        starts = np.flatnonzero(np.diff(parent, prepend=-1))
        where = parent[starts]
        out[where] = np.maximum.reduceat(extra, starts, axis=0)
        out[where[:, None], [0, 2]] = np.minimum.reduceat(extra[:, [0, 2]], starts, axis=0)
    return out


def decode(scores: list[np.ndarray], parents: list[np.ndarray]) -> np.ndarray:
    """Which lines to keep: the best labelling of each tree in which nothing is kept below a pruned node and a kept node keeps a child."""
    yes = [-np.logaddexp(0, -s) for s in scores]
    no = [-np.logaddexp(0, s) for s in scores]
    keep, prune = [yes[3]], [no[3]]
    for depth in (2, 1, 0):
        child, n = parents[depth + 1], len(scores[depth])
        gain = keep[0] - prune[0]
        best = np.bincount(child, np.maximum(keep[0], prune[0]), n)
        top = np.full(n, -np.inf)
        np.maximum.at(top, child, gain)
        keep.insert(0, yes[depth] + best + np.minimum(0, top))
        prune.insert(0, no[depth] + np.bincount(child, prune[0], n))
    kept = keep[0] > prune[0]
    for depth in (1, 2, 3):
        child, n = parents[depth], len(scores[depth - 1])
        gain = keep[depth] - prune[depth]
        top = np.full(n, -np.inf)
        np.maximum.at(top, child, gain)
        kept = kept[child] & ((gain > 0) | ((top[child] <= 0) & (gain == top[child])))
    return kept


def _log_odds(yes: np.ndarray, no: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    share = (yes.sum() + 1) / (no.sum() + 1)
    return np.clip(np.log((yes + smooth * share / (1 + share)) / (no + smooth / (1 + share))) - np.log(share), -5, 5)


def learn_weights(pages: list[Page], labels: list[list[bool | None]]) -> Weights:
    """Token weights of labelled pages."""
    body = np.array([x for y in labels for x in y if x is not None], bool)
    counts = Counter(t for p in pages for t in ("0" if t.isdigit() else t for t in _TOKEN.findall(visible(p.content).lower())) if t != "\n")
    known = {t: i + 1 for i, (t, n) in enumerate(counts.most_common(TOKENS)) if n > 2}
    lines = read_lines(pages, known)
    body = _aligned(body, lines)
    after = _running(len(pages) - 1 - lines.page[::-1], body[::-1].astype(float))[::-1] == 0
    pair, owner = _pairs(lines)
    odds = []
    for label, use in ((body, np.ones(len(body), bool)), (after, ~body)):
        for number, token_owner, size in ((lines.token, lines.owner, len(known) + 1), (pair, owner, PAIRS)):
            once_owner, once = np.divmod(np.unique(token_owner * size + number), size)
            used = use[once_owner]
            once, yes = once[used], label[once_owner[used]]
            odds.append(_log_odds(np.bincount(once[yes], minlength=size), np.bincount(once[~yes], minlength=size)).astype(np.float32))
    for single in odds[0], odds[2]:
        single[0] = 0.0  # an unknown token says nothing
    keys, at = np.unique(lines.key, return_inverse=True)
    yes, no = np.bincount(at, body, len(keys)), np.bincount(at, ~body, len(keys))
    often = yes + no > 2
    listed = np.bincount(lines.page, body, len(pages)) > 0
    segments: dict[str, list[float]] = {}
    for p, x in zip(pages, listed, strict=True):
        segments.setdefault(segment(p.address), [0.5, 0.5])[int(not x)] += 1
    address = {s: float(np.clip(np.log(a / b), -5, 5)) for s, (a, b) in segments.items() if a + b > 2}
    return Weights(known, *odds, keys[often], np.clip(np.log((yes + 0.5) / (no + 0.5)), -5, 5)[often], address)


def train(pages: list[Page], seed: int = 0) -> Model:
    """Token weights from one half of the pages, trees from the other, both against the seed labels.

    The trees see each page twice: with the weights of all sites, and with those of sites other than its own, so
    that they also learn to judge pages whose furniture is unknown.
    """
    views, labels = learn_labels(pages)
    if len(pages) < LEAST_PAGES:
        return Model(views, None, None)
    weights = learn_weights(pages[0::2], labels[0::2])
    group = np.array([xxhash.xxh3_64_intdigest(p.site.encode()) % 2 for p in pages])
    ways = [(weights, list(range(1, len(pages), 2)))]
    for g in (0, 1):
        known, fresh = np.flatnonzero(group[0::2] != g) * 2, np.flatnonzero(group[1::2] == g) * 2 + 1
        if len(known) and len(fresh):
            ways.append((learn_weights([pages[i] for i in known], [labels[i] for i in known]), fresh.tolist()))
        elif len(fresh):  # sites of one group only: as if nothing were known
            ways.append((Weights({}, *(np.zeros(n, np.float32) for n in (1, PAIRS, 1, PAIRS)), np.empty(0, np.uint64), np.empty(0), {}), fresh.tolist()))
    features, targets = [], []
    for weighted, at in ways:
        some = [pages[i] for i in at]
        lines = read_lines(some, weighted.tokens)
        tree = tree_of(lines, some, weighted)
        label = [_aligned(np.array([x for i in at for x in labels[i] if x is not None], bool), lines).astype(float)]
        for depth in (2, 1, 0):
            label.insert(0, (np.bincount(tree.parents[depth + 1], label[0], len(tree.features[depth])) > 0).astype(float))
        features += tree.features
        targets += label
    return Model(views, weights, boosting.fit(np.concatenate(features), np.concatenate(targets), seed=seed))


def _aligned(labels: np.ndarray, lines: Lines) -> np.ndarray:
    """Seed labels skip blank lines, and so do the lines read: both by what is visible."""
    if len(labels) != len(lines.page):
        raise ValueError(f"{len(labels)} labels for {len(lines.page)} lines")
    return labels


def body_lines(model: Model, pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """(page, line number) of the main body's lines, over a list of pages; by the seed labels if the model has no trees."""
    if model.trees is None:
        seeds = [(i, k) for i, p in enumerate(pages) for k, keep in enumerate(seed_labels(p, model.views), 1) if keep]
        page, number = np.array(seeds, np.int64).reshape(-1, 2).T
        return page, number
    lines = read_lines(pages, model.weights.tokens)
    if not len(lines.page):
        return lines.page, lines.number
    tree = tree_of(lines, pages, model.weights)
    ends = np.cumsum([len(f) for f in tree.features])
    scores = np.split(boosting.log_odds(model.trees, np.concatenate(tree.features)), ends[:-1])
    kept = decode(scores, tree.parents)
    return lines.page[kept], lines.number[kept]


def sample_pages(records: DataFrame, n: int, id_: str, source: str, attributes: str) -> list[Page]:
    """Up to n pages with content, the same for the same records: like parts of up to SAMPLE_SITES sites, large enough ones first.

    Two passes: one counts the rows of each source, the other reads what passes a threshold on the ids' hashes.  Where
    many rows have no content, the second is run again with a higher threshold.
    """
    slim = records.select(F.col(id_).alias("__id"), F.coalesce(F.col(source), F.lit("\0")).alias("source"), F.col(attributes).alias("attributes")).where("__id IS NOT NULL AND attributes IS NOT NULL")
    sizes = slim.groupBy("source").agg(F.count("*").alias("n"))
    part = n // SAMPLE_SITES
    sites = sizes.orderBy(F.col("n") < part, F.xxhash64("source"), "source").limit(SAMPLE_SITES).collect()
    # Shares of the sample: small sites give all they have, the others divide the rest.
    left, quota = n, {}
    for i, (site, rows) in enumerate(sorted(sites, key=lambda r: r[1])):
        quota[site] = min(rows, left // (len(sites) - i))
        left -= quota[site]
    more = 1.0
    while True:
        shares = {site: min(1.0, more * quota[site] / rows) for site, rows in sites}
        pages = _picked(slim, n, shares)
        if len(pages) >= 0.8 * n or all(x in (0.0, 1.0) for x in shares.values()):
            return pages
        more *= min(10.0, max(2.0, 1.1 * n / max(1, len(pages))))


def _picked(slim: DataFrame, n: int, shares: dict[str, float]) -> list[Page]:
    """The pages whose id's hash is below their site's share, n at most; of each id the shortest record."""
    if not shares:
        return []
    spark = slim.sparkSession
    limits = spark.createDataFrame([(s, int(x * (1 << 32))) for s, x in shares.items()], "source string, __limit long")  # SAMPLE_SITES rows
    some = slim.join(F.broadcast(limits), "source").where(F.pmod(F.xxhash64("__id"), F.lit(1 << 32)) < F.col("__limit")).select("__id", "source", "attributes")

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([content_of(a) is not None for a in batch.column(2).to_pylist()], pa.bool_()))

    some = some.mapInArrow(filled, some.schema).withColumn("__chars", F.length("attributes"))
    once = some.groupBy("__id").agg(F.min(F.struct("__chars", "attributes", "source")).alias("r")).select("__id", "r.*")
    order = [F.col("__chars") > SAMPLE_CHARS, F.xxhash64("__id"), F.col("__id")]
    total = F.sum("__chars").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    few = once.orderBy(*order).limit(n).withColumn("__total", total).withColumn("__rank", F.row_number().over(Window.orderBy(*order)))
    few = few.where((F.col("__total") <= SAMPLE_TOTAL) | (F.col("__rank") == 1))
    return [page_of(a, s) for s, a in few.select("source", "attributes").collect()]


def fit(records: DataFrame, id_: str = "id", source: str = "source", attributes: str = "attributes", sample: int = SAMPLE_PAGES) -> Model:
    """A model trained on at most `sample` pages of the records.  Fit once; `save` and `load` it."""
    return train(sample_pages(records, sample, id_, source, attributes))


def signature() -> str:
    """Changes with the code and the parameters that make a model."""
    return hashlib.md5("".join(inspect.getsource(sys.modules[m.__module__]) for m in (Model, Views, boosting.Trees)).encode()).hexdigest()


def save(model: Model, spark: SparkSession, path: str) -> None:
    """Writes the model to a folder that executors need not see."""
    spark.createDataFrame([(bytearray(pickle.dumps(model)),)], "model binary").coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Model:
    """A model written by `save`; load only what you wrote yourself."""
    return pickle.loads(bytes(spark.read.parquet(path).head()[0]))


def _extracted(records: DataFrame, model: Model | None, id_: str, source: str, attributes: str, texts: bool) -> DataFrame:
    """(id, version) and either line_nos, an array, or body of each record with a main body, straight from the scan."""
    slim = records.where(F.col(id_).isNotNull())
    shared = records.sparkSession.sparkContext.broadcast(model or fit(slim, id_, source, attributes))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 400):
                part = batch.slice(start, 400)
                read = [page_of(a, s) for a, s in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
                at = [i for i, p in enumerate(read) if p is not None]
                page, number = body_lines(shared.value, [read[i] for i in at]) if at else (np.empty(0, np.int64),) * 2
                rows = np.array(at, np.int32)[page] if at else np.empty(0, np.int32)
                of, starts = np.unique(rows, return_index=True)
                offsets = np.append(starts, len(rows))
                if texts:
                    split = {i: read[i].content.split("\n") for i in of.tolist()}
                    bodies = [sound("\n".join(split[i][k - 1] for k in number[a:b].tolist())) for i, (a, b) in zip(of.tolist(), pairwise(offsets.tolist()), strict=True)]
                    last = pa.array(bodies, pa.string())
                else:
                    last = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(number.astype(np.int32)))
                at_rows = pa.array(of, pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0).take(at_rows), part.column(3).take(at_rows), last], ["id", "version", "body" if texts else "line_nos"])

    slim = slim.select(F.col(id_).alias("id"), F.col(attributes).alias("attributes"), F.col(source).alias("source"), version(source, attributes).alias("version"))
    return slim.mapInArrow(extract, f"id string, version long, {'body string' if texts else 'line_nos array<int>'}")


def main_body(records: DataFrame, id_: str = "id", source: str = "source", attributes: str = "attributes", model: Model | None = None) -> DataFrame:
    """(id, version, line_no) of the lines of each page's main body, distinct.

    Null, invalid and empty records have none, nor have pages that only list other articles.  A
    record repeated under its id gives its lines once; different records of one id differ in `version`.  Other columns are not read.  Without a `model`
    one is fitted; it is applied to all records, each whole.
    """
    once = _extracted(records, model, id_, source, attributes, texts=False).dropDuplicates(["id", "version"])
    return once.select("id", "version", F.explode("line_nos").alias("line_no"))


def body_numbers(records: DataFrame, id_: str = "id", source: str = "source", attributes: str = "attributes", model: Model | None = None) -> DataFrame:
    """(id, line_no), distinct: as `main_body`, the numbers of all records of an id together.  One array a record is shuffled."""
    found = _extracted(records, model, id_, source, attributes, texts=False)
    return found.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("line_nos"))).alias("n")).select("id", F.explode("n").alias("line_no"))


def body_texts(records: DataFrame, id_: str = "id", source: str = "source", attributes: str = "attributes", model: Model | None = None) -> DataFrame:
    """(id, body) of each page with a main body: its lines, joined by line feeds, in order, distinct.  An id with several contents has a row for each body."""
    return _extracted(records, model, id_, source, attributes, texts=True).select("id", "body").distinct()
