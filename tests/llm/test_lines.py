import json
import random
import unicodedata
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import bitmaps, lines

SCHEMA = "id string, source string, attributes string"


def page(*content):
    return json.dumps({"content": "\n".join(content)})


def brute(data):
    ids, seen, at = defaultdict(set), defaultdict(set), []
    for i, s, a in data:
        if i is None:
            continue
        ids[s].add(i)
        content = lines.content_of(a)
        for n, line in enumerate(content.split("\n") if content is not None else [], 1):
            key = "".join(c for c in unicodedata.normalize("NFKC", line).lower() if c.isalpha())
            if key:
                seen[s, key].add(i)
                at.append((i, n, s, key))
    return {(i, n) for i, n, s, k in at if len(seen[s, k]) >= 5 and 20 * len(seen[s, k]) >= len(ids[s])}


def check(spark, data):
    df = spark.createDataFrame(data, SCHEMA).withColumn("key", F.lit("clash")).withColumn("number", F.lit(1))
    got = lines.repeated_lines(df)
    found = [(r["id"], r["line_no"]) for r in got.found.select("id", "line_no").distinct().collect()]
    assert set(found) == brute(data) and len(found) == len(set(found))
    return df, got


def test_brute_force(spark):
    random.seed(4)
    words = ["Home", "HOME ", "ho me!", "Ｈome", "Über uns", "über  uns", "•", "", "12", "One of a kind", "rare"]
    data = []
    for n in range(260):
        source = "big" if n < 200 else random.choice(["small", None])
        content = [random.choice(words[:9]) for _ in range(random.randint(0, 6))] + [f"text {n} {c}" for c in "ab"]
        if n % 45 == 0:
            content += ["One of a kind"] * 9
        data += [(f"i{n}", source, page(*content))] * random.choice([1, 1, 2])
    df, got = check(spark, data)
    assert got.found.count() and {r["n_ids"] >= 5 for r in got.counts.collect()} == {True}
    cleaned = {r["id"]: r for r in lines.without_repeated(df, got).collect()}
    gone = brute(data)
    for i, s, a in data:
        kept = [x for n, x in enumerate(lines.content_of(a).split("\n"), 1) if (i, n) not in gone]
        assert cleaned[i]["content"] == "\n".join(kept)
    assert all(r["line"] for r in lines.example_lines(df, got).collect())


def test_thresholds(spark):
    five = [(f"a{i}", "s", page("Menu", "t" + "abcde"[i])) for i in range(5)]
    none = [(f"b{i}", "s", None) for i in range(95)]
    df, got = check(spark, five + none)
    assert got.found.count() == 5  # 5 of 100 are 5 %
    assert check(spark, five + none + [("c", "s", "{}")])[1].found.count() == 0
    assert check(spark, five[:4])[1].found.count() == 0


def test_repeats_within_a_page_do_not_count(spark):
    assert check(spark, [("a", "s", page(*["Refrain"] * 50)), ("a", "s", page(*["Refrain"] * 50))])[1].found.count() == 0


def test_edges(spark):
    data = [(None, "s", page("x")), ("a", None, page("x")), ("b", "s", "{cut"), ("c", "s", '{"content": 3}'), ("d", "s", '"text"'), ("e", "s", ""), ("f", "s", page("y" * 200_000, " ")), ("g", "s", '{"content": "\\ud800"}')]
    df, got = check(spark, data)
    assert lines.without_repeated(df, got).count() == 7
    check(spark, [])


def test_two_contents_of_one_id(spark):
    """Each loses its own excessive lines, not what stands at their place in the other."""
    data = [(f"a{i}", "s", page("Menu", f"text {'abcdefg'[i]}")) for i in range(7)] + [("x", "s", page("Menu", "old")), ("x", "s", page("Genuine", "Also new", "MENU"))]
    df, got = check(spark, data)
    cleaned = {(r["content"], r["n_removed"]) for r in lines.without_repeated(df, got).where("id = 'x'").collect()}
    assert cleaned == {("old", 1), ("Genuine\nAlso new", 1)}
    assert [r["line"] for r in lines.example_lines(df, got).collect()] == ["MENU"]


def test_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(lines, "KEYS", 0)
    monkeypatch.setattr(lines, "CONTAINERS", 0)
    data = [(f"a{i}", "s", page("Menu", "x" * i, "menu")) for i in range(9)] + [("a1", "s", page("MENU")), ("z", None, "{}")]
    df, got = check(spark, data)
    assert got.found.count() == 18
    cleaned = {(r["id"], r["content"], r["n_removed"]) for r in lines.without_repeated(df, got).collect()}
    assert cleaned == {(f"a{i}", "x" * i, 2) for i in range(9)} | {("a1", "", 1), ("z", None, 0)}


def test_more_than_one_block(spark):
    """Ordinals past 65,536 go to further bitmaps; the kinds of containers differ."""
    data = spark.range(70_000).select(F.concat(F.lit("i"), "id").alias("id"), F.lit("s").alias("source"))
    some = F.when(F.col("id").endswith("0"), F.lit(page("Menu", "12"))).when(F.col("id").endswith("1"), F.lit(page("34"))).otherwise(F.lit(page("All")))
    got = lines.repeated_lines(data.withColumn("attributes", some))
    assert sorted(r["n_ids"] for r in got.counts.collect()) == [7000, 56_000]
    assert got.found.count() == 63_000 and got.lines.select("block").distinct().count() == 2
    kinds = {bytes(r["bits"])[:1] for r in got.lines.collect()}
    assert kinds <= {b"a", b"b", b"r"} and len(kinds) > 1


def test_many_small_sources(spark):
    """100,000 sources of a few documents: containers hold some bytes each."""
    data = spark.range(500_000).select(F.concat(F.lit("i"), "id").alias("id"), F.expr("concat('s', id div 5)").alias("source"), F.when(F.col("id") < 499_990, F.lit(page("Menu", "Home"))).otherwise(F.lit(page("Menu", "12"))).alias("attributes"))
    got = lines.repeated_lines(data)
    assert got.counts.count() == 199_998
    total = got.lines.agg(F.sum(F.length("bits")), F.count("*")).head()
    assert total[1] == 199_998 and total[0] <= 11 * total[1]
    assert got.gone.agg(F.sum(F.size("line_nos"))).head()[0] == 999_990


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.lists(st.integers(0, 65535), max_size=60), st.tuples(st.integers(0, 65000), st.integers(1, 30_000), st.sampled_from([1, 1, 2, 7])).map(lambda t: list(range(t[0], min(65536, t[0] + t[1]), t[2])))), min_size=1, max_size=5))
def test_bitmaps(lists):
    containers = [bitmaps.encode(np.array(sorted(set(x)), np.int64)) for x in lists]
    for x, c in zip(lists, containers, strict=True):
        assert bitmaps.decode(c).tolist() == sorted(set(x)) and bitmaps.cardinality(c) == len(set(x))
        assert len(c) <= 1 + min(2 * len(set(x)), 8192)
        probe = np.arange(0, 65536, 61)
        assert bitmaps.contains(c, probe).tolist() == [p in set(x) for p in probe.tolist()]
    united, n = bitmaps.union(containers)
    every = sorted({v for x in lists for v in x})
    assert bitmaps.decode(united).tolist() == every and n == len(every) and united == bitmaps.encode(np.array(every, np.int64))
