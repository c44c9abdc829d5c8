"""Settings of runs: defaults, then a JSON file, then the environment (SLUICE_ and the setting's name in capitals)."""

from __future__ import annotations

import json
import logging
import logging.handlers
import os
from collections.abc import Mapping
from typing import Any, NamedTuple, get_type_hints

from sluice.sources.transport import Retry

PREFIX = "SLUICE_"
LEVELS = ["DEBUG", "INFO", "WARNING", "ERROR"]
FORMAT = "[%(asctime)s] [%(levelname)s] [%(name)s] | %(message)s"
#: Log files are turned over at so many bytes, and so many are kept.
LOG_BYTES, LOG_FILES = 10_000_000, 5


class Settings(NamedTuple):
    """`pause`: seconds between requests of a task; `attempts`, `timeout`: of each; `shared`: the folder for intermediate tables."""

    endpoint: str = ""
    token: str = ""
    registry: str = ""
    state: str = ""
    sink: str = ""
    shared: str = ""
    page_size: int = 100
    pause: float = 0.1
    attempts: int = 3
    timeout: float = 30.0
    log_level: str = "INFO"
    log_file: str = ""

    @property
    def retry(self) -> Retry:
        return Retry(attempts=self.attempts, pause=self.pause)


def load(path: str | None = None, environment: Mapping[str, str] = os.environ) -> Settings:
    """The settings; ValueError for names that aren't known and values that aren't of their kind."""
    kinds = get_type_hints(Settings)
    given: dict[str, Any] = {}
    if path:
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
    if unknown := sorted(set(given) - set(kinds)):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    given |= {k: environment[PREFIX + k.upper()] for k in kinds if environment.get(PREFIX + k.upper())}
    read = {}
    for name, value in given.items():
        try:
            read[name] = kinds[name](value)
        except (TypeError, ValueError) as odd:
            raise ValueError(f"{name}: {odd}") from odd
    return Settings(**read)


def problems(settings: Settings, pipeline: str) -> list[str]:
    """What keeps a run of the pipeline from starting; empty if nothing does."""
    needed = ["registry", "state", "sink", *(["endpoint"] if pipeline == "cms" else [])]
    found = [f"{name} is missing" for name in needed if not getattr(settings, name)]
    found += [f"{name} must be positive" for name in ("page_size", "attempts", "timeout") if getattr(settings, name) <= 0]
    if settings.pause < 0:
        found.append("pause must not be negative")
    if settings.log_level not in LEVELS:
        found.append(f"log_level must be one of {', '.join(LEVELS)}")
    if settings.registry and not os.path.exists(settings.registry):
        found.append(f"no file {settings.registry}")
    return found


def shown(settings: Settings) -> dict[str, Any]:
    """The settings for people to see: without the token."""
    return settings._asdict() | {"token": "***" if settings.token else ""}


def start_log(settings: Settings) -> None:
    """Logs to the console, and to a file that is turned over if one is named."""
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if settings.log_file:
        handlers.append(logging.handlers.RotatingFileHandler(settings.log_file, maxBytes=LOG_BYTES, backupCount=LOG_FILES, encoding="utf-8"))
    logging.basicConfig(level=settings.log_level, format=FORMAT, handlers=handlers)
