"""Evaluation passages inside training documents: size-partitioned MinHash containment search.

Items are partitioned by size: those of ten words or more are cut into their
windows of ten words, each shorter item is one window of its own size.  For
each window size w that occurs, the sketch of a text is the set of the MinHash
values (one permutation) of all its windows of w words, over shingles of half
that length.  A document that contains a window of an item shares its MinHash
value, so the search misses nothing, however long the document is and however
little of the item it holds; long and short documents need no different bands.
What the values bring together is verified by the whole window.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import broadcast_up_to, materialise

WINDOW = 10
#: The filter of item sketches that goes to every worker has at least and at most so many bits (2 MB at 2**24).
LEAST_BITS, MOST_BITS = 20, 27
#: Item sketches are broadcast for the join up to so many rows, some 15 MB.
BROADCAST_ROWS = 100_000

_TAG = re.compile(r"<[^<>]*>")
_WORD = re.compile(r"[^\W_]+")
# Characters without width, and the soft hyphen.
_INVISIBLE = re.compile("[" + "".join(map(chr, [0xAD, 0x34F, 0x61C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), *range(0xFE00, 0xFE10), 0xFEFF])) + "]")
_PRIME = 0x9E3779B97F4A7C15
_SKETCH = "size int, minhash long, window string"


def words(text: str | None) -> list[str]:
    """Words as they are compared: entities resolved, tags out, invisible characters deleted, NFKD without marks, lower case."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", _INVISIBLE.sub("", text))
        if not text.isascii():
            marks = [c for c in set(text) if unicodedata.category(c)[0] == "M"]
            for c in marks:
                text = text.replace(c, "")
    return _WORD.findall(text.lower())


class _Hashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def window_minhashes(hashed: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of `size` words that lie within one text, and their MinHash values.

    `hashed` are the word hashes of many texts one after another, `owner` says whose each is.
    """
    if len(hashed) < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    span = (size + 1) // 2
    n = len(hashed) - span + 1
    shingle = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(span):
            shingle = shingle * np.uint64(_PRIME) + hashed[j : j + n]
        shingle ^= shingle >> np.uint64(29)
        shingle *= np.uint64(0xBF58476D1CE4E5B9 + 2 * size)
        shingle ^= shingle >> np.uint64(32)
    windows = len(hashed) - size + 1
    least = shingle[:windows].copy()
    for j in range(1, size - span + 1):
        np.minimum(least, shingle[j : j + windows], out=least)
    whole = np.flatnonzero(owner[:windows] == owner[size - 1 :])
    return whole, least[whole]


def _flatten(texts: list[str | None], known: _Hashes) -> tuple[list[str], np.ndarray, np.ndarray]:
    lists = [words(t) for t in texts]
    flat = [w for one in lists for w in one]
    hashed = np.fromiter(map(known.__getitem__, flat), np.uint64, len(flat))
    return flat, hashed, np.repeat(np.arange(len(lists)), [len(x) for x in lists])


def item_sketches(items: DataFrame, id_: str, text: str) -> DataFrame:
    """(item, size, minhash, window) of each window of each item; items without words have none."""
    kind = items.schema[id_].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            rows = []
            for i, t in enumerate(batch.column(1).to_pylist()):
                flat, hashed, owner = _flatten([t], known)
                size = min(WINDOW, len(flat))
                if size:
                    starts, least = window_minhashes(hashed, owner, size)
                    rows += [(i, size, m, " ".join(flat[s : s + size])) for s, m in zip(starts.tolist(), least.view(np.int64).tolist(), strict=True)]
            yield _rows(batch.column(0), rows, "item")

    return items.select(F.col(id_), F.col(text)).mapInArrow(sketch, f"item {kind}, {_SKETCH}")


def _rows(ids: pa.Array, rows: list[tuple[int, int, int, str]], name: str) -> pa.RecordBatch:
    at, size, least, window = ([r[k] for r in rows] for k in range(4))
    return pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int32())), pa.array(size, pa.int32()), pa.array(least, pa.int64()), pa.array(window, pa.string())], [name, "size", "minhash", "window"])


def sketch_filter(sketches: DataFrame, n: int) -> tuple[np.ndarray, int, list[int]]:
    """(bytes, bits, sizes): a bit map of the n MinHash values modulo 2**bits, and the window sizes in use.

    The map's size is bounded by MOST_BITS (16 MB) whatever the number of items; the fuller it is,
    the more windows pass it for nothing, none is missed.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))
    sizes = sorted(r[0] for r in sketches.select("size").distinct().collect())  # at most WINDOW of them
    place = sketches.select(F.expr(f"minhash & {(1 << bits) - 1}L").alias("at"))
    blocks = place.groupBy(F.expr("at div 32768").alias("block")).agg(F.expr("bitmap_construct_agg(at % 32768)").alias("bits"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for block, part in blocks.collect():  # at most 2**MOST_BITS / 32768 blocks of 4 kB
        out[block * 4096 : block * 4096 + len(part)] = np.frombuffer(bytes(part), np.uint8)
    return out, bits, sizes


def document_sketches(documents: DataFrame, id_: str, text: str, filtered: tuple[np.ndarray, int, list[int]]) -> DataFrame:
    """(document, size, minhash, window) of the windows whose MinHash value passes the filter of the items'."""
    kind = documents.schema[id_].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(filtered)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        table, bits, sizes = shared.value
        for batch in batches:
            flat, hashed, owner = _flatten(batch.column(1).to_pylist(), known)
            rows = []
            for size in sizes:
                starts, least = window_minhashes(hashed, owner, size)
                at = least & np.uint64((1 << bits) - 1)
                hit = np.flatnonzero((table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1)
                for s, m in zip(starts[hit].tolist(), least[hit].view(np.int64).tolist(), strict=True):
                    rows.append((int(owner[s]), size, m, " ".join(flat[s : s + size])))
            yield _rows(batch.column(0), rows, "document")

    return documents.select(F.col(id_), F.col(text)).mapInArrow(sketch, f"document {kind}, {_SKETCH}")


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(document, item, windows, containment): the documents that contain ten consecutive words of an item, or a shorter item whole,
    how many different windows of it they contain, and what share of the item's different windows that is.

    Null and empty texts contain nothing and are contained in nothing; repeated documents and items
    each get their rows.  Other columns are not read.  Each document is read once, whole.
    """
    sketches = materialise(item_sketches(items, item_id, text).distinct(), "item-sketches")
    n = sketches.count()
    seen = document_sketches(documents, doc_id, text, sketch_filter(sketches, n)).distinct()
    # A passage in a third of all documents makes some MinHash values that hot.  Few item sketches are broadcast, so that
    # no window moves for the join; with more of them the join is by shuffle, and Spark splits hot values (adaptive skew join).
    own = broadcast_up_to(sketches, BROADCAST_ROWS)
    met = seen.alias("d").join(own.alias("i"), ["size", "minhash"]).where(F.col("d.window") == F.col("i.window"))
    counts = met.groupBy("document", "item").agg(F.countDistinct("d.window").alias("windows"))
    # Exact shingle containment: how much of the item leaked.  One row an item; left to Spark to broadcast by size.
    sizes = sketches.groupBy("item").agg(F.countDistinct("window").alias("all"))
    return counts.join(sizes, "item").select("document", "item", "windows", (F.col("windows") / F.col("all")).alias("containment"))
