"""Queries of the whole operators, without SQL, against brute force."""

import datetime as dt
import hashlib
import html
import re

from sluice.plans import registry


def test_iso_instants(spark, tmp_path):
    good = ["2024-02-29", "2024-01-02T03:04", "2024-01-02 03:04:05", "2024-01-02T03:04:05.25", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05.123456Z", "2024-01-02T03:04:05+02:00", "2024-07-02T23:30:00.5-05:30", "2024-01-02T03:04:05+0530", "1969-12-31T23:59:59-01:00"]
    bad = ["2023-02-29", "2024-01-02T25:00:00Z", "2024-13-01", "2 Jan 2024", "2024-01-02T03:04:05 CET", "", None]
    rows = [(f"i{n}", x) for n, x in enumerate(good + bad)] * 2
    spark.createDataFrame(rows, "id string, published_at string").write.parquet(str(tmp_path / "unified_all_cms_content.parquet"))
    expected = set()
    for n, x in enumerate(good):
        t = dt.datetime.fromisoformat(x)
        t = t.replace(tzinfo=t.tzinfo or dt.UTC)
        expected.add((f"i{n}", x, (t - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)) // dt.timedelta(microseconds=1)))
    got = [tuple(r) for r in registry.QUERIES["iso_instants"](spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    assert "iso_instants" not in registry.SQL


TEXTS = ["Caf&eacute; &amp; bar", "AT&amp;amp;T", "a&nbsp;&nbsp;b &hellip; c.....d", "&#8211; x ------ y", "&lt;p&gt; 1 &lt; 2 &unknown; &amp", " no  entity\u200b here \n", "Zero&#8203;width", "Mill &ndash; Site", "Mill &#124; Site", "Mill - Part &mdash; Site", "", None]


def test_normalise_text_entities(spark, tmp_path):
    spark.createDataFrame([(f"d{n}", x) for n, x in enumerate(TEXTS)], "doc_id string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    expected = {}
    for n, x in enumerate(TEXTS):
        plain = re.sub("[\u200b\u200c\u200d\ufeff]", "", re.sub(r"\s+", " ", html.unescape(x or "")))
        expected[f"d{n}"] = hashlib.md5(re.sub("-{3,}", "---", re.sub(r"[.]{3,}", "...", plain)).strip(" ").encode()).hexdigest()
    assert dict(map(tuple, registry.QUERIES["normalise_text_entities"](spark, str(tmp_path)).collect())) == expected


def test_title_clean_entities(spark, tmp_path):
    rows = [(f"i{n}", x) for n, x in enumerate(TEXTS)]
    spark.createDataFrame(rows * 2, "id string, title string").write.parquet(str(tmp_path / "unified_all_cms_content.parquet"))
    expected = sorted((i, " ".join(re.sub(r"\s*[-|–—]\s*[^-|–—]+$", "", html.unescape(x or "")).split())) for i, x in rows)
    got = sorted(tuple(r) for r in registry.QUERIES["title_clean_entities"](spark, str(tmp_path)).collect())
    assert got == expected and ("i7", "Mill") in got and ("i8", "Mill") in got
