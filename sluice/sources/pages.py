"""Web pages by URL."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.sources.transport import Fetch, Retry, fetched


def fetch_pages(urls: DataFrame, fetch: Fetch, retry: Retry = Retry(), column: str = "url") -> DataFrame:
    """(url, html, problem) per row; a page that can't be fetched has a problem and no text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fetched(fetch, u, None, retry) if u else (None, "no URL") for u in batch.column(0).to_pylist()]
            texts = [a.decode("utf-8", "replace") if a is not None else None for a, _ in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([p for _, p in got], pa.string())], ["url", "html", "problem"])

    return urls.select(column).mapInArrow(run, "url string, html string, problem string")
