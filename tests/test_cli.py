import importlib.util
import os

import pytest

from sluice import cli

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_verbs(spark, capsys, tmp_path):
    assert cli.main(["stats", "--folder", FOLDER]) == 0 and cli.main(["check-new", "--folder", FOLDER]) == 0
    assert cli.main(["query", "cms_totals", "--folder", FOLDER, "--out", f"{tmp_path}/out"]) == 0
    assert cli.main(["diagnose", "--folder", FOLDER]) == 0 and cli.main(["diagnose", "--folder", str(tmp_path)]) == 1
    assert "new_estimate" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["query", "no such query", "--folder", FOLDER])


@pytest.mark.skipif(not os.path.isdir(FOLDER) or importlib.util.find_spec("sluice.llm") is None, reason="no tables, or no corpus operators")
def test_corpus_queries(spark, tmp_path):
    assert cli.main(["query", "p8_found", "--folder", FOLDER, "--out", f"{tmp_path}/out"]) == 0
    assert spark.read.parquet(f"{tmp_path}/out").columns == ["doc_id"]


def test_only_a_missing_package_is_forgiven():
    """The entry works without the corpus operators; a fault within them is not hidden."""
    import builtins
    import sys

    real = builtins.__import__

    def without(name):
        def load(module, *more, **named):
            if module == "sluice.llm" or module.startswith("sluice.llm."):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)
            return real(module, *more, **named)

        kept = {m: sys.modules.pop(m) for m in list(sys.modules) if m == "__spark_entry__" or m.startswith("sluice.llm")}
        builtins.__import__ = load
        try:
            import __spark_entry__ as entry

            return entry.queries()
        finally:
            builtins.__import__ = real
            sys.modules.pop("__spark_entry__", None)
            sys.modules.update(kept)

    assert not any(q.startswith("p1_") for q in without("sluice.llm"))
    with pytest.raises(ModuleNotFoundError):
        without("xxhash")
