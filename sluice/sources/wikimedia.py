"""Lookup tables for enrichment from a MediaWiki API: searches, pages, their files, and the files' data.

Each function asks once per row of its input, in Arrow batches; give it distinct rows.  `tasks` tasks ask at a time, each
no faster than `retry.pause`, so the API sees at most tasks / pause requests a second.  What can't be had is a row with
a problem and nulls.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any
from urllib.parse import urlencode

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.sources.transport import Fetch, Retry, fetched

ENDPOINT = "https://en.wikipedia.org/w/api.php"
#: One request a second and task; servers that are busy are given time.
POLITE = Retry(attempts=4, first=2.0, factor=2.0, most=60.0, pause=1.0)
SEARCH_RESULTS = 3


def address(endpoint: str, **asked: Any) -> str:
    """A request's URL; the same request always has the same."""
    return f"{endpoint}?{urlencode(sorted({'action': 'query', 'format': 'json', **asked}.items()))}"


def search_address(endpoint: str, query: str) -> str:
    return address(endpoint, list="search", srsearch=query, srlimit=SEARCH_RESULTS)


def page_address(endpoint: str, page_id: int) -> str:
    return address(endpoint, pageids=page_id, prop="pageimages|images|info", piprop="original|thumbnail", inprop="url", imlimit=50)


def file_address(endpoint: str, file: str) -> str:
    return address(endpoint, titles=file, prop="imageinfo", iiprop="url|size|extmetadata", iiurlwidth=800)


def _of_search(answer: dict) -> list[tuple]:
    return [(rank, int(x["pageid"])) for rank, x in enumerate(answer["query"]["search"], 1)]


def _of_page(answer: dict) -> list[tuple]:
    (page,) = answer["query"]["pages"].values()
    files = [x["title"] for x in page.get("images", [])]
    return [(page.get("title"), page.get("fullurl"), (page.get("thumbnail") or {}).get("source"), (page.get("original") or {}).get("source"), files)]


def _of_file(answer: dict) -> list[tuple]:
    (page,) = answer["query"]["pages"].values()
    info = (page.get("imageinfo") or [None])[0]
    if info is None:
        return []
    more = {k: v.get("value") for k, v in (info.get("extmetadata") or {}).items() if isinstance(v, dict)}
    text = lambda key: None if more.get(key) is None else str(more[key])
    return [(info.get("thumburl") or info.get("url"), info.get("url"), info.get("width"), info.get("height"), text("LicenseShortName"), text("Artist"), text("ImageDescription"))]


def _ask(asked: DataFrame, key: str, to: Callable[[Any], str], read: Callable[[dict], list[tuple]], columns: list[tuple[str, pa.DataType, str]], fetch: Fetch, retry: Retry, tasks: int) -> DataFrame:
    kind = asked.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows, problems = [], [], []
            for i, value in enumerate(batch.column(0).to_pylist()):
                answer, problem = fetched(fetch, to(value), None, retry) if value is not None else (None, "nothing asked")
                found: list[tuple] = []
                if answer is not None:
                    try:
                        found = read(json.loads(answer))
                    except (ValueError, KeyError, TypeError, AttributeError) as odd:
                        problem = f"{type(odd).__name__}: {odd}"
                for row in found or ([(None,) * len(columns)] if problem else []):
                    at.append(i)
                    rows.append(row)
                    problems.append(problem)
            new = [pa.array([r[k] for r in rows], t) for k, (_, t, _) in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), *new, pa.array(problems, pa.string())], [key, *(n for n, _, _ in columns), "problem"])

    schema = f"{key} {kind}, " + ", ".join(f"{n} {t}" for n, _, t in columns) + ", problem string"
    return asked.select(key).repartition(tasks).mapInArrow(run, schema)


def searches(queries: DataFrame, fetch: Fetch, endpoint: str = ENDPOINT, retry: Retry = POLITE, tasks: int = 1) -> DataFrame:
    """(query, rank, page_id, problem) of the first pages each query finds."""
    return _ask(queries, "query", lambda q: search_address(endpoint, q), _of_search, [("rank", pa.int32(), "int"), ("page_id", pa.int64(), "long")], fetch, retry, tasks)


def pages(page_ids: DataFrame, fetch: Fetch, endpoint: str = ENDPOINT, retry: Retry = POLITE, tasks: int = 1) -> DataFrame:
    """(page_id, page_title, page_url, thumb_url, original_url, files, problem) of pages."""
    text = [(n, pa.string(), "string") for n in ("page_title", "page_url", "thumb_url", "original_url")]
    return _ask(page_ids, "page_id", lambda i: page_address(endpoint, i), _of_page, [*text, ("files", pa.list_(pa.string()), "array<string>")], fetch, retry, tasks)


def page_files(found: DataFrame) -> DataFrame:
    """(page_id, rank, file) of the files that pages name."""
    return found.select("page_id", F.posexplode("files").alias("rank", "file")).withColumn("rank", F.col("rank") + 1)


def files(names: DataFrame, fetch: Fetch, endpoint: str = ENDPOINT, retry: Retry = POLITE, tasks: int = 1) -> DataFrame:
    """(file, image_url, full_url, width, height, license, author, description, problem) of files."""
    text, number = (pa.string(), "string"), (pa.int32(), "int")
    kinds = [("image_url", *text), ("full_url", *text), ("width", *number), ("height", *number), ("license", *text), ("author", *text), ("description", *text)]
    return _ask(names, "file", lambda f: file_address(endpoint, f), _of_file, kinds, fetch, retry, tasks)
