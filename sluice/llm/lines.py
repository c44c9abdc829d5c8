"""Lines repeated across one source's documents.

Each distinct line of a source has a compressed bitmap of the documents that
contain it, over the source's dense document numbers (see `bitmaps`).  The
bitmaps of lines that differ only in case, spacing or punctuation are united;
a line is excessive if its exact cardinality passes the thresholds.  Each
document then asks the excessive bitmaps for its own bit, and loses the lines
whose bitmaps hold it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import bitmaps
from sluice.operators.nested import read_json, sound
from sluice.operators.ordinals import with_prefix
from sluice.session import materialise

MIN_DOCUMENTS = 5
#: A line is excessive if one document in so many of its source has it (20: 5 %).
ONE_IN = 20
#: The map of likely keys that goes to every worker has at least and at most so many bits (16 MB at 2**27).
LEAST_BITS, MOST_BITS = 20, 27
#: Excessive bitmaps are broadcast up to so many containers and bytes; beyond, documents and bitmaps meet by source and block.
CONTAINERS, BYTES = 100_000, 16_000_000
#: Excessive keys are broadcast to the scan of texts up to so many: 8 MB of hashes.  Beyond, lines go by number, joined by id.
KEYS = 1_000_000

_RECORDS = "source string, id string, line_nos array<int>, keys array<long>, variants array<short>"
_NOT_ASCII_LETTER = bytes(b for b in range(128) if not (97 <= b <= 122 or b == 10))


class Repeated(NamedTuple):
    """`lines`: source, key, block, bits of the excessive lines.  `counts`: source, key, source_ids, n_ids.
    `gone`: source, id, line_nos, keys of the lines to delete, arrays in order of the numbers, one row a document with any."""

    lines: DataFrame
    counts: DataFrame
    gone: DataFrame

    @property
    def found(self) -> DataFrame:
        """source, id, line_no, key: each occurrence."""
        each = self.gone.select("source", "id", F.explode(F.arrays_zip("line_nos", "keys")).alias("line"))
        return each.select("source", "id", F.col("line.line_nos").alias("line_no"), F.col("line.keys").alias("key"))


def content_of(attributes: str | None) -> str | None:
    """The page text in a record's JSON; None if there is none, or the JSON is not valid."""
    try:
        content = read_json(attributes)
    except ValueError:
        return None
    content = content.get("content") if isinstance(content, dict) else None
    return content if isinstance(content, str) else None


def normal_lines(content: str) -> list[bytes]:
    """The lines after NFKC, lower-casing and removal of all but letters, as UTF-8."""
    if content.isascii():
        return content.lower().encode().translate(None, _NOT_ASCII_LETTER).split(b"\n")
    text = unicodedata.normalize("NFKC", content).lower()
    drop = {ord(c): None for c in set(text) if c != "\n" and not c.isalpha()}
    return text.translate(drop).encode("utf-8", "surrogatepass").split(b"\n")


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def line_keys(records: DataFrame, source: str, id_: str, attributes: str) -> DataFrame:
    """(source, id, line_nos, keys, variants) per record: of each line with letters its number, the hash of its
    normal form and a short hash of its exact form (variants that share it share a bitmap, and would be united anyway).
    Records without lines stay, with empty arrays."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            at, key, exact, ends = [], [], [], [0]
            for text in batch.column(2).to_pylist():
                content = content_of(text)
                if content is not None:
                    raw = content.encode("utf-8", "surrogatepass").split(b"\n")
                    for i, line in enumerate(normal_lines(content)):
                        if line:
                            at.append(i + 1)
                            key.append(digest(line))
                            exact.append(digest(raw[i]) & 0x7FFF)
                ends.append(len(at))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (np.array(at, np.int32), _signed(key), np.array(exact, np.int16))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["source", "id", "line_nos", "keys", "variants"])

    slim = records.select(F.col(source).alias("source"), F.col(id_).alias("id"), F.col(attributes).alias("attributes"))
    return slim.mapInArrow(keys, _RECORDS)


def key_map(keys: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """(bytes, bits): a bit map of the n keys modulo 2**bits, of at most 2**MOST_BITS bits; it lets other keys pass, never loses one."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))
    place = keys.select(F.expr(f"key & {(1 << bits) - 1}L").alias("at"))
    blocks = place.groupBy(F.expr("at div 32768").alias("block")).agg(F.expr("bitmap_construct_agg(at % 32768)").alias("bits"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for block, part in blocks.collect():  # at most 2**MOST_BITS / 32768 blocks of 4 kB
        out[block * 4096 : block * 4096 + len(part)] = np.frombuffer(bytes(part), np.uint8)
    return out, bits


def _passes(keys: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    at = keys & ((1 << bits) - 1)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _slices(lists: pa.ListArray, keep: np.ndarray) -> pa.Array:
    """Offsets of the lists after dropping values."""
    total = np.concatenate([[0], np.cumsum(keep)])
    return pa.array(total[lists.offsets.to_numpy() - lists.offsets[0].as_py()], pa.int32())


def _values(lists: pa.ListArray) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def likely_lines(pages: DataFrame, likely: tuple[np.ndarray, int]) -> DataFrame:
    """The records with those of their lines whose keys pass the map; records without any are dropped."""
    shared = pages.sparkSession.sparkContext.broadcast(likely)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = _passes(_values(batch.column(3)), *shared.value)
            offsets = _slices(batch.column(3), keep)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(_values(batch.column(k))[keep])) for k in (2, 3, 4)]
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["source", "id", "line_nos", "keys", "variants"])
            yield out.filter(pa.array(np.diff(offsets.to_numpy()) > 0))

    return pages.mapInArrow(passing, _RECORDS)


def line_bitmaps(numbered: DataFrame) -> DataFrame:
    """(source, key, block, bits, n): the united bitmap of the variants of each line, by blocks of documents.

    Each batch builds the bitmaps of its variants, so that only compressed containers are shuffled.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch.column(0).dictionary_encode()
            row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(2).offsets.to_numpy()))
            number = batch.column(1).to_numpy()[row]
            columns = (number % bitmaps.BLOCK, _values(batch.column(3)), _values(batch.column(2)), number // bitmaps.BLOCK, sources.indices.to_numpy()[row])
            order = np.lexsort(columns)
            low, variant, key, block, source = (c[order] for c in columns)
            new = np.ones(len(order), bool)
            if len(order):
                new[1:] = (np.diff(source) != 0) | (np.diff(block) != 0) | (key[1:] != key[:-1]) | (variant[1:] != variant[:-1])
            starts = np.flatnonzero(new)
            once = new.copy()  # a line may stand in a document more than once
            once[1:] |= np.diff(low) != 0
            bits = [bitmaps.encode(low[a:b][once[a:b]]) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True)]
            yield pa.RecordBatch.from_arrays([sources.dictionary.take(pa.array(source[starts])), pa.array(key[starts]), pa.array(block[starts]), pa.array(bits, pa.binary())], ["source", "key", "block", "bits"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            united = [bitmaps.union(parts) for parts in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([u[0] for u in united], pa.binary()), pa.array([u[1] for u in united], pa.int64())], ["source", "key", "block", "bits", "n"])

    parts = numbered.select("source", "number", "keys", "variants").mapInArrow(build, "source string, key long, block long, bits binary")
    # A block has at most 65,536 documents, so that no group grows with its source.
    return parts.groupBy("source", "key", "block").agg(F.collect_list("bits").alias("parts")).mapInArrow(unite, "source string, key long, block long, bits binary, n long")


def _asked(records: pa.RecordBatch | pa.Table, lines: dict[tuple[str, int, int], bytes]) -> pa.RecordBatch:
    """Of numbered records, the lines whose bitmaps hold the record's document; each document once, in order."""
    source, id_, number = records.column("source").to_pylist(), records.column("id").to_pylist(), records.column("number").to_pylist()
    row = np.repeat(np.arange(records.num_rows), pc.list_value_length(records.column("keys")).to_numpy(zero_copy_only=False))
    key, line_no = (pc.list_flatten(records.column(k)).to_numpy(zero_copy_only=False) for k in ("keys", "line_nos"))
    spot = {}
    place = np.array([spot.setdefault((s, n // bitmaps.BLOCK), len(spot)) for s, n in zip(source, number, strict=True)], np.int64)[row] if len(row) else row
    low = np.array(number, np.int64)[row] % bitmaps.BLOCK if len(row) else row
    names = list(spot)
    held = np.zeros(len(row), bool)
    order = np.lexsort((key, place))
    starts = np.flatnonzero((np.diff(place[order], prepend=-1) != 0) | (np.diff(key[order], prepend=0) != 0))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True):
        at = order[a:b]
        s, block = names[place[at[0]]]
        bits = lines.get((s, int(key[at[0]]), block))
        if bits is not None:
            held[at] = bitmaps.contains(bits, low[at])
    # Records repeated under an id: each line number and key once.
    document = {}
    first = np.array([document.setdefault((s, i), k) for k, (s, i) in enumerate(zip(source, id_, strict=True))], np.int64)
    row, key, line_no = first[row[held]] if len(row) else row, key[held], line_no[held]
    order = np.lexsort((key, line_no, row))
    row, key, line_no = row[order], key[order], line_no[order]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(line_no) != 0) | (key[1:] != key[:-1])
    row, key, line_no = row[new], key[new], line_no[new]
    own, counts = np.unique(row, return_counts=True)
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (line_no.astype(np.int32), key.astype(np.int64))]
    return pa.RecordBatch.from_arrays([pa.array([source[k] for k in own], pa.string()), pa.array([id_[k] for k in own], pa.string()), *lists], ["source", "id", "line_nos", "keys"])


_GONE = "source string, id string, line_nos array<int>, keys array<long>"


def ask_bitmaps(numbered: DataFrame, lines: DataFrame) -> DataFrame:
    """(source, id, line_nos, keys): the lines of each record whose bitmaps hold its document's number."""
    size = lines.agg(F.count("*"), F.coalesce(F.sum(F.length("bits")), F.lit(0))).head()
    records = numbered.select("source", "id", "number", "line_nos", "keys")
    if size[0] <= CONTAINERS and size[1] <= BYTES:
        shared = numbered.sparkSession.sparkContext.broadcast({(s, k, b): bytes(bits) for s, k, b, bits in lines.select("source", "key", "block", "bits").collect()})

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield _asked(batch, shared.value)

        return records.mapInArrow(ask, _GONE)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        of = zip(*(right.column(k).to_pylist() for k in ("source", "key", "block", "bits")), strict=True)
        return pa.Table.from_batches([_asked(left.combine_chunks(), {(s, k, b): bits for s, k, b, bits in of})])

    # 65,536 documents at most, and their bitmaps, in a group.
    placed = records.withColumn("block", F.expr(f"number div {bitmaps.BLOCK}"))
    return placed.groupBy("source", "block").cogroup(lines.groupBy("source", "block")).applyInArrow(meet, _GONE)


def repeated_lines(
    records: DataFrame,
    source: str = "source",
    id_: str = "id",
    attributes: str = "attributes",
    min_documents: int = MIN_DOCUMENTS,
    one_in: int = ONE_IN,
) -> Repeated:
    """Finds the lines that at least `min_documents` documents, and one in `one_in` of all documents, of a source contain.

    A document is a distinct id; repeated and re-delivered records of one id count once.  Documents
    without lines count among a source's documents.  Rows without id are left out; a null source
    is a source of its own.  Other columns are not read.  Lines are compared by 64-bit hashes.
    """
    pages = line_keys(records.where(F.col(id_).isNotNull()), source, id_, attributes)
    pages = pages.withColumn("source", F.coalesce("source", F.lit("\0")))
    pages = materialise(pages, "page-lines")
    ids = pages.select("source", "id").distinct()
    totals = ids.groupBy("source").agg(F.count("*").alias("source_ids"))

    # Rows are never fewer than distinct ids: below the threshold a line needs no bitmap.
    occurrences = pages.select("source", F.explode("keys").alias("key")).groupBy("source", "key").agg(F.count("*").alias("n"))
    enough = lambda n: (F.col(n) >= min_documents) & (F.col(n) * one_in >= F.col("source_ids"))
    likely = materialise(occurrences.where(F.col("n") >= min_documents).join(totals, "source").where(enough("n")).select("key").distinct(), "likely-keys")
    few = likely_lines(pages, key_map(likely, likely.count()))

    numbers = with_prefix(ids, "source", [F.col("id")], name="number")
    numbered = materialise(few.join(numbers, ["source", "id"]), "likely-lines")
    built = materialise(line_bitmaps(numbered), "line-bitmaps")
    counts = built.groupBy("source", "key").agg(F.sum("n").alias("n_ids")).where(F.col("n_ids") >= min_documents).join(totals, "source").where(enough("n_ids"))
    counts = materialise(counts.select("source", "key", "source_ids", "n_ids"), "line-counts")
    lines = materialise(built.join(counts.select("source", "key"), ["source", "key"]).select("source", "key", "block", "bits"), "excessive-lines")
    gone = ask_bitmaps(numbered, lines)
    return Repeated(lines, counts, gone)


def example_lines(records: DataFrame, repeated: Repeated, source: str = "source", id_: str = "id", attributes: str = "attributes") -> DataFrame:
    """(source, key, line): an exact form, the least, of each excessive line.  Each batch gives one form a key, so that few lines are shuffled."""
    shared = records.sparkSession.sparkContext.broadcast(key_map(repeated.counts, repeated.counts.count()))

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            least: dict[tuple[str, int], str] = {}
            for own, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                content = content_of(text)
                if content is None:
                    continue
                keys = _signed([digest(x) for x in normal_lines(content)])
                lines = content.split("\n")
                for i in np.flatnonzero(_passes(keys, *shared.value)).tolist():
                    at, line = (own, int(keys[i])), lines[i]
                    if at not in least or line < least[at]:
                        least[at] = line
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in least], pa.string()), pa.array([k[1] for k in least], pa.int64()), pa.array(map(sound, least.values()), pa.string())], ["source", "key", "line"])

    slim = records.where(F.col(id_).isNotNull()).select(F.coalesce(F.col(source), F.lit("\0")).alias("source"), F.col(attributes).alias("attributes"))
    lines = slim.mapInArrow(forms, "source string, key long, line string").groupBy("source", "key").agg(F.min("line").alias("line"))
    return lines.join(repeated.counts.select("source", "key"), ["source", "key"])


def version(source: str, attributes: str) -> Column:
    """Tells records of one id apart that differ in text or source; equal for a record delivered again."""
    return F.xxhash64(F.col(source), F.col(attributes))


def without_repeated(records: DataFrame, repeated: Repeated, source: str = "source", id_: str = "id", attributes: str = "attributes") -> DataFrame:
    """(id, content, n_removed), one row per distinct (id, content): each content without its source's excessive lines.  No content: null and 0.

    Lines go by what they say, so that of an id with several contents each loses its own excessive lines only.  What a
    document's bits say of a line, its key says too; texts are read and cut in one pass, and only what is left is shuffled.
    """
    n = repeated.counts.count()
    slim = records.where(F.col(id_).isNotNull()).select(F.coalesce(F.col(source), F.lit("\0")).alias("source"), F.col(id_).alias("id"), F.col(attributes).alias("attributes"))
    if n <= KEYS:
        of: dict[str, list[int]] = {}
        for s, k in repeated.counts.select("source", "key").collect():
            of.setdefault(s, []).append(k)
        shared = records.sparkSession.sparkContext.broadcast({s: np.sort(np.array(k, np.int64)) for s, k in of.items()})
        slim = slim.withColumn("keys", F.lit(None).cast("array<long>"))
    else:
        shared = None
        gone = repeated.gone.groupBy("source", "id").agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"))
        slim = slim.join(gone, ["source", "id"], "left").select("source", "id", "attributes", "keys")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, none = xxhash.xxh3_64_intdigest, np.empty(0, np.int64)
        for batch in batches:
            texts, removed = [], []
            for own, text, keys in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                content = content_of(text)
                bad = shared.value.get(own, none) if shared is not None else np.array(keys or [], np.int64)
                if content is None or not len(bad):
                    texts.append(content)
                    removed.append(0)
                    continue
                normal = normal_lines(content)
                stays = ~np.isin(_signed([digest(x) for x in normal]), bad) | np.array([not x for x in normal])
                texts.append("\n".join(compress(content.split("\n"), stays.tolist())))
                removed.append(len(normal) - int(stays.sum()))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([None if t is None else sound(t) for t in texts], pa.string()), pa.array(removed, pa.int32())], ["id", "content", "n_removed"])

    return slim.select("source", "id", "attributes", "keys").mapInArrow(cut, "id string, content string, n_removed int").distinct()
