"""Paged GraphQL collections as a Spark data source: a partition per page, failed pages as rows.

    spark.dataSource.register(CmsPages)
    spark.read.format("cms_pages").options(endpoint=..., response_key="posts", fields="id attributes { title }").load()

gives (response_key, page, page_count, total, problem, body): body is the page's JSON.  `records` makes rows of it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sluice.sources.transport import Fetch, Folder, Http, Retry, fetched

PAGES = "response_key string, page int, page_count int, total int, problem string, body string"
ENVELOPE = "data array<struct<id: string, attributes: string>>, meta struct<pagination: struct<total: int, page: int, pageSize: int, pageCount: int>>"


def query(response_key: str, fields: str, page: int, size: int) -> bytes:
    """The request for one page: only the fields asked for cross the wire."""
    text = f"query($pagination: PaginationArg) {{ {response_key}(pagination: $pagination) {{ data {{ {fields} }} meta {{ pagination {{ total page pageSize pageCount }} }} }} }}"
    return json.dumps({"query": text, "response_key": response_key, "variables": {"pagination": {"page": page, "pageSize": size}}}).encode()


def answer_of(answer: bytes | None, response_key: str) -> tuple[dict | None, str | None]:
    """(the collection's part of an answer, None) or (None, the problem); any `errors` make the answer a failure."""
    try:
        whole = json.loads(answer or b"")
        if whole.get("errors"):
            return None, str(whole["errors"][0].get("message", "error"))
        return whole["data"][response_key], None
    except (ValueError, KeyError, TypeError, AttributeError, IndexError) as odd:
        return None, f"{type(odd).__name__}: {odd}"


#: So many pages are asked for the number of pages before a collection is given up.
FIRST = 3


class Page(InputPartition):
    def __init__(self, page: int, known: tuple[int, int, str] | None = None) -> None:
        self.page, self.known = page, known


class CmsPages(DataSource):
    """Options: endpoint, response_key, fields, page_size (100), start_page (1), max_pages (all), folder (answers from files), token,
    attempts (3), pause (0, seconds between a task's requests), timeout (30).

    The number of pages is what the first page that answers says; the pages before it become rows with their problems, and
    after FIRST pages without an answer the collection is given up, with a row for each.
    """

    @classmethod
    def name(cls) -> str:
        return "cms_pages"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema) -> CmsReader:  # noqa: ANN001
        return CmsReader(dict(self.options))


class CmsReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.key, self.fields, self.endpoint = options["response_key"], options.get("fields", "id attributes"), options["endpoint"]
        self.size, self.start, self.most = int(options.get("page_size", 100)), int(options.get("start_page", 1)), int(options["max_pages"]) if options.get("max_pages") else None
        headers = (("Content-Type", "application/json"), *((("Authorization", f"Bearer {options['token']}"),) if options.get("token") else ()))
        self.fetch: Fetch = Folder(options["folder"]) if options.get("folder") else Http(headers, float(options.get("timeout", 30.0)))
        self.retry = Retry(attempts=int(options.get("attempts", 3)), pause=float(options.get("pause", 0.0)))

    def _ask(self, page: int) -> tuple[dict | None, str | None]:
        answer, problem = fetched(self.fetch, self.endpoint, query(self.key, self.fields, page, self.size), self.retry)
        return (None, problem) if answer is None else answer_of(answer, self.key)

    def partitions(self) -> list[Page]:
        """A page that was asked while the read was planned isn't fetched again."""
        asked: list[Page] = []
        for page in range(self.start, self.start + min(FIRST, self.most or FIRST)):
            first, problem = self._ask(page)
            if first is None:
                asked.append(Page(page, (0, 0, json.dumps({"problem": problem}))))
                continue
            counts = (first.get("meta") or {}).get("pagination") or {}
            pages, total = int(counts.get("pageCount") or 1), int(counts.get("total") or 0)
            last = pages if self.most is None else min(pages, self.start + self.most - 1)
            return [*asked, Page(page, (pages, total, json.dumps(first))), *(Page(p, (pages, total, "")) for p in range(page + 1, last + 1))]
        return asked

    def read(self, partition: Page) -> Iterator[tuple]:
        pages, total, body = partition.known or (0, 0, "")
        if body:
            known = json.loads(body)
            problem = known.get("problem") if set(known) == {"problem"} else None
            yield self.key, partition.page, pages, total, problem, None if problem else body
            return
        part, problem = self._ask(partition.page)
        yield self.key, partition.page, pages, total, problem, json.dumps(part) if part is not None else None


def records(pages: DataFrame, max_records: int | None = None) -> DataFrame:
    """(response_key, page, position, id, attributes) of the records on the pages that were read, attributes as JSON text.

    `max_records` keeps the first in the order of pages.
    """
    read = pages.where("problem IS NULL").withColumn("envelope", F.from_json("body", ENVELOPE))
    rows = read.select("response_key", "page", F.posexplode("envelope.data").alias("position", "record")).select("response_key", "page", "position", "record.id", "record.attributes")
    return rows.orderBy("page", "position").limit(max_records) if max_records else rows


def page_stats(pages: DataFrame) -> DataFrame:
    """Per collection: pages and records there are, pages read, failed pages."""
    size = F.size(F.coalesce(F.from_json("body", ENVELOPE)["data"], F.array().cast("array<struct<id: string, attributes: string>>")))
    return pages.groupBy("response_key").agg(
        F.max("page_count").alias("page_count"), F.max("total").alias("total_available"), F.count_if(F.col("problem").isNull()).alias("pages_read"),
        F.sum(size).alias("fetched"), F.array_sort(F.collect_set(F.when(F.col("problem").isNotNull(), F.col("page")))).alias("failed_pages"),
    )
