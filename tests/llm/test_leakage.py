import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import leakage

SOFT, ZERO = chr(0xAD), chr(0x200B)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, []), ("", []), ("&amp;&lt;b&gt;Bold&lt;/b&gt; caf&eacute;", ["bold", "cafe"]), (f"so{SOFT}ft ze{ZERO}ro", ["soft", "zero"]), ("a<br>b a < b", ["a", "b", "a", "b"]),
        ("ÀÉ ﬁve x²_y", ["ae", "five", "x2", "y"]), ("don't 3.5", ["don", "t", "3", "5"]),
    ],
)
def test_words(text, expected):
    assert leakage.words(text) == expected


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=14), max_size=5), st.integers(1, 10))
def test_equal_windows_have_equal_minhashes(texts, size):
    flat = np.array([w * 1_000_003 + 7 for t in texts for w in t], np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    starts, least = leakage.window_minhashes(flat, owner, size)
    expected = sum(max(0, len(t) - size + 1) for t in texts)
    assert len(starts) == expected
    by = {}
    for s, m in zip(starts, least, strict=True):
        by.setdefault(tuple(flat[s : s + size]), set()).add(m)
    assert all(len(v) == 1 for v in by.values())


def brute(documents, items):
    found = set()
    for d, text in documents:
        have = leakage.words(text)
        for i, own in items:
            want = leakage.words(own)
            n = min(10, len(want))
            windows = {tuple(want[k : k + n]) for k in range(len(want) - n + 1)} if n else set()
            if any(tuple(have[k : k + n]) in windows for k in range(len(have) - n + 1)):
                found.add((d, i))
    return found


def test_brute_force(spark):
    random.seed(6)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(random.choice(vocabulary) for _ in range(random.choice([1, 2, 5, 9, 10, 11, 40])))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "..."), (103, items[5][1])]
    documents = []
    for d in range(120):
        text = [random.choice(vocabulary) for _ in range(random.randint(0, 150))]
        for _ in range(random.choice([0, 1, 2])):
            own = random.choice(items[:40])[1].split()
            cut = own[: random.choice([9, 10, 40])]
            at = random.randint(0, len(text))
            text[at:at] = cut
        documents.append((d, "\n".join(text).title()))
    documents += [(500, None), (501, ""), (502, documents[0][1]), (None, "x")]
    d = spark.createDataFrame(documents, "doc_id long, text string").withColumn("item", F.lit(1)).withColumn("window", F.lit("clash"))
    i = spark.createDataFrame(items, "item_id int, text string").withColumn("doc_id", F.lit(9))
    rows = leakage.leaks(d, i).collect()
    got = [(r["document"], r["item"]) for r in rows]
    text_of, item_of = dict(documents), dict(items)
    for r in rows[:40]:
        want, have = leakage.words(item_of[r["item"]]), leakage.words(text_of[r["document"]])
        n = min(10, len(want))
        windows = {tuple(want[k : k + n]) for k in range(len(want) - n + 1)}
        assert r["containment"] == len(windows & {tuple(have[k : k + n]) for k in range(len(have) - n + 1)}) / len(windows)
    assert len(got) == len(set(got)) and set(got) == brute(documents, items) and len(got) > 50


def test_empty(spark):
    d, i = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b c")], "item_id int, text string")
    assert leakage.leaks(d, i).count() == 0
    assert leakage.leaks(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), i.limit(0)).count() == 0


def test_long_document(spark):
    text = "filler " * 300_000 + "this passage of ten words stands at the very end"
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    i = spark.createDataFrame([(1, "this passage of ten words stands at the very end")], "item_id int, text string")
    assert [tuple(r) for r in leakage.leaks(d, i).collect()] == [(1, 1, 1, 1.0)]


def test_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(leakage, "LEAST_BITS", 16)
    monkeypatch.setattr(leakage, "MOST_BITS", 16)
    monkeypatch.setattr(leakage, "BROADCAST_ROWS", 0)
    random.seed(7)
    documents = [(n, " ".join(str(random.randint(0, 3)) for _ in range(60))) for n in range(30)]
    items = [(n, " ".join(str(random.randint(0, 3)) for _ in range(random.choice([3, 12])))) for n in range(200)]
    got = leakage.leaks(spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string"))
    assert {(r["document"], r["item"]) for r in got.collect()} == brute(documents, items)
