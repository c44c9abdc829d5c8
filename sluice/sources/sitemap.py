"""XML sitemaps: an index of sitemaps, sitemaps of URLs."""

from __future__ import annotations

import xml.etree.ElementTree as ElementTree
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import urls
from sluice.sources.transport import Fetch, Retry, fetched

_SPACE = "{http://www.sitemaps.org/schemas/sitemap/0.9}"
_ENTRY = pa.struct([("url", pa.string()), ("lastmod", pa.string())])


def _text(node: ElementTree.Element, name: str) -> str | None:
    found = node.find(_SPACE + name)
    return (found.text or "").strip() or None if found is not None else None


def parse(xml: bytes | str | None) -> tuple[list[str], list[tuple[str, str | None]]]:
    """(addresses of an index, entries of a sitemap); both empty for malformed XML."""
    try:
        root = ElementTree.fromstring(xml or "")
    except ElementTree.ParseError:
        return [], []
    if root.tag == _SPACE + "sitemapindex":
        return [loc for node in root.findall(_SPACE + "sitemap") if (loc := _text(node, "loc"))], []
    return [], [(loc, _text(node, "lastmod")) for node in root.iter(_SPACE + "url") if (loc := _text(node, "loc"))]


def _run(fetch: Fetch, retry: Retry, batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps, entries, problems = [], [], []
        for address in batch.column(batch.num_columns - 1).to_pylist():
            answer, problem = fetched(fetch, address, None, retry)
            inner, found = parse(answer)
            maps.append(inner if level == 0 else [])
            entries.append([{"url": u, "lastmod": m} for u, m in found])
            problems.append(problem)
        new = [pa.array(maps, pa.list_(pa.string())), pa.array(entries, pa.list_(_ENTRY)), pa.array(problems, pa.string())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "maps", "entries", "problem"])


def fetch_sitemaps(addresses: DataFrame, fetch: Fetch, retry: Retry = Retry(), level: int = 1) -> DataFrame:
    """Adds to rows whose last column is a sitemap's address: maps (only for level 0), entries, problem."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in addresses.schema) + ", maps array<string>, entries array<struct<url: string, lastmod: string>>, problem string"
    return addresses.mapInArrow(lambda batches: _run(fetch, retry, batches, level), schema)


def crawl(sites: DataFrame, fetch: Fetch, retry: Retry = Retry()) -> tuple[DataFrame, DataFrame]:
    """((site, source, sitemap_url, url, lastmod), problems) of all sites.

    An index is followed one level down; an index within an index has no entries.  A sitemap that can't be
    fetched gives no URLs and a row among the problems, and the others go on.  URLs listed twice come twice.
    """
    roots = fetch_sitemaps(sites.select("site", "source", F.col("sitemap_url").alias("address")).repartition("address"), fetch, retry, 0)
    below = roots.select("site", "source", F.explode("maps").alias("address")).repartition("address")
    leaves = fetch_sitemaps(below, fetch, retry).unionByName(roots)
    found = leaves.select("site", "source", F.col("address").alias("sitemap_url"), F.explode("entries").alias("e")).select("site", "source", "sitemap_url", "e.url", "e.lastmod")
    return found, leaves.where("problem IS NOT NULL").select("site", "address", "problem")


def content_urls(found: DataFrame) -> DataFrame:
    return found.where(urls.is_content(F.col("url")))


def crawl_counts(found: DataFrame) -> DataFrame:
    """Per site: URLs found, kept and skipped."""
    kept = F.count_if(urls.is_content(F.col("url")))
    return found.groupBy("site").agg(F.count("*").alias("total_found"), kept.alias("total_filtered"), (F.count("*") - kept).alias("skipped"))
