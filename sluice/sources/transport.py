"""Fetching with retries.  What fetches is given by the caller: HTTP in production, files in tests and replays."""

from __future__ import annotations

import json
import os
import time
import urllib.request
from collections.abc import Callable
from typing import NamedTuple
from urllib.parse import quote

Fetch = Callable[[str, bytes | None], bytes]


# Answers of a server that may do better next time.
PASSING = frozenset({429, 500, 502, 503, 504})


class Retry(NamedTuple):
    """Attempts, and seconds between them: first, factor, most; `pause` before each request, so that a task asks no faster."""

    attempts: int = 3
    first: float = 1.0
    factor: float = 2.0
    most: float = 10.0
    pause: float = 0.0


class Http(NamedTuple):
    """HTTP GET, or POST if there is a body."""

    headers: tuple[tuple[str, str], ...] = ()
    timeout: float = 30.0

    def __call__(self, url: str, body: bytes | None) -> bytes:
        with urllib.request.urlopen(urllib.request.Request(url, data=body, headers=dict(self.headers)), timeout=self.timeout) as answer:
            return answer.read()


class Folder(NamedTuple):
    """Answers from files named by `file_name` of the request."""

    path: str

    def __call__(self, url: str, body: bytes | None) -> bytes:
        with open(os.path.join(self.path, file_name(url, body)), "rb") as file:
            return file.read()


def file_name(url: str, body: bytes | None) -> str:
    """The name under which a `Folder` keeps a request's answer: the URL, and for a paged query its key and page."""
    name = quote(url, safe="")
    if body:
        asked = json.loads(body)
        name += f"#{asked['response_key']}-{asked['variables']['pagination']['page']}"
    return name


def fetched(fetch: Fetch, url: str, body: bytes | None = None, retry: Retry = Retry(), sleep: Callable[[float], None] = time.sleep) -> tuple[bytes | None, str | None]:
    """(answer, None) or, after the last attempt, (None, the problem).

    What can't pass, such as a page that isn't there, is not tried again; a server that says how long to wait is obeyed, up to `most`.
    """
    wait, problem = retry.first, "not tried"
    for attempt in range(retry.attempts):
        if retry.pause:
            sleep(retry.pause)
        asked = None
        try:
            return fetch(url, body), None
        except Exception as failed:  # any failure of the other side counts as one
            problem = f"{type(failed).__name__}: {failed}"
            code = getattr(failed, "code", None)
            if (isinstance(code, int) and code not in PASSING) or isinstance(failed, FileNotFoundError):
                break
            asked = (getattr(failed, "headers", None) or {}).get("Retry-After", "")
        if attempt + 1 < retry.attempts:
            sleep(min(max(wait, float(asked)) if asked and asked.isdigit() else wait, retry.most))
            wait *= retry.factor
    return None, problem
