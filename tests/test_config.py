"""Settings from file and environment, the log, and progress."""

import json
import logging

import pytest

from sluice import config
from sluice.plans import runner


def test_load(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"endpoint": "https://api", "page_size": 50, "token": "secret"}))
    settings = config.load(str(path), {"SLUICE_PAGE_SIZE": "7", "SLUICE_PAUSE": "0", "OTHER": "x"})
    assert (settings.endpoint, settings.page_size, settings.pause, settings.attempts) == ("https://api", 7, 0.0, 3)
    assert config.shown(settings)["token"] == "***" and config.shown(config.Settings())["token"] == ""
    assert settings.retry.attempts == 3 and config.load(None, {}) == config.Settings()
    path.write_text('{"colour": 1}')
    with pytest.raises(ValueError, match="unknown settings: colour"):
        config.load(str(path), {})
    with pytest.raises(ValueError, match="page_size"):
        config.load(None, {"SLUICE_PAGE_SIZE": "many"})


def test_problems(tmp_path):
    assert config.problems(config.Settings(), "cms") == ["registry is missing", "state is missing", "sink is missing", "endpoint is missing"]
    (tmp_path / "r.json").write_text("[]")
    good = config.Settings(registry=str(tmp_path / "r.json"), state="s", sink="k")
    assert config.problems(good, "wp") == [] and config.problems(good, "cms") == ["endpoint is missing"]
    odd = good._replace(registry="no such file", page_size=0, pause=-1.0, log_level="LOUD")
    assert len(config.problems(odd, "wp")) == 4


def test_log_file(tmp_path):
    root = logging.getLogger()
    before, level = list(root.handlers), root.level
    for handler in before:
        root.removeHandler(handler)
    try:
        config.start_log(config.Settings(log_file=str(tmp_path / "l.log")))
        logging.getLogger("sluice").info("hello")
        assert "[INFO] [sluice] | hello" in (tmp_path / "l.log").read_text()
    finally:
        for handler in list(root.handlers):
            root.removeHandler(handler)
            handler.close()
        root.setLevel(level)
        for handler in before:
            root.addHandler(handler)


def test_progress(spark):
    told = []
    with runner.Progress(spark, 0.05, lambda done, total: told.append((done, total))):
        spark.sparkContext.parallelize(range(8), 8).map(lambda x: __import__("time").sleep(0.3)).count()
    assert told and all(0 <= d <= t for d, t in told)
