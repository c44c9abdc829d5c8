"""State, statistics, enrichment, sink: against plain Python, with nulls, repeats, ties and empty tables."""

import datetime
import os
import random
from urllib.parse import urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice import schemas
from sluice.operators import enrich, sink, state, stats
from sluice.session import materialise, release, shared_dir

KEYS = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 9)), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(KEYS, KEYS)
def test_insert_absent(spark, old, new):
    old = list({k: (k, v) for k, v in old if k}.values())
    a, b = (spark.createDataFrame(x, "k string, v int") for x in (old, new))
    expected = dict(old)
    for k, v in sorted(new, key=lambda r: r[1]):
        if k is not None:
            expected.setdefault(k, v)
    once = state.insert_absent(a, b, ["k"], [F.col("v")])
    assert {tuple(r) for r in once.collect()} == set(expected.items()) and once.count() == len(expected)
    assert {tuple(r) for r in state.insert_absent(once, b, ["k"], [F.col("v")]).collect()} == set(expected.items())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(KEYS, KEYS)
def test_semi_and_anti(spark, left, right):
    a, b = (spark.createDataFrame(x, "k string, v int") for x in (left, right))
    known = {k for k, _ in right if k is not None}
    assert sorted(map(tuple, state.present(a, b, ["k"]).collect()), key=repr) == sorted((r for r in left if r[0] in known), key=repr)
    assert sorted(map(tuple, state.absent(a, b, ["k"]).collect()), key=repr) == sorted((r for r in left if r[0] not in known), key=repr)


def test_apply_events(spark, rows):
    known = spark.createDataFrame([("a", "pending", "old", None), ("b", "failed", "old", 2), ("c", "pending", None, 1)], "k string, status string, error string, n int")
    events = spark.createDataFrame([("a", 1, "failed", "e1"), ("a", 2, "success", None), ("a", 2, "success", None), ("b", 1, "success", None), ("z", 1, "success", "e")], "k string, at int, new string, e string")
    got = state.apply_events(known, events, ["k"], ["at"], {"status": "new"}, {"error": "e"}, "n")
    assert rows(got) == [("a", "success", "e1", 3), ("b", "success", "old", 3), ("c", "pending", None, 1)]
    assert rows(state.apply_events(known, events.limit(0), ["k"], ["at"], {"status": "new"}, {"error": "e"}, "n")) == rows(known)


def test_without_absent(spark, rows):
    known = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", None)], "k string, s string")
    kept, gone = state.without_absent(known, spark.createDataFrame([("a",)], "k string"), ["k"], F.col("s") == "x")
    assert rows(kept) == [("a", "x"), ("c", "y"), ("d", None)] and rows(gone) == [("b", "x")]
    assert rows(state.delete_keys(known, spark.createDataFrame([("d",), ("q",)], "k string"), ["k"])) == [("a", "x"), ("b", "x"), ("c", "y")]


def test_newest(spark):
    df = spark.createDataFrame([("a", 2), ("b", None), ("c", 2), ("d", 3)], "k string, t int")
    assert [r["k"] for r in state.newest(df, "t", 3, nulls_first=True, key="k").collect()] == ["b", "d", "a"]
    assert [r["k"] for r in state.newest(df, "t", 3, key="k").collect()] == ["d", "a", "c"]
    assert [r["k"] for r in state.equals(df, k="a").collect()] == ["a"] and state.equals(df, k=None).count() == 4


def test_store(spark, tmp_path):
    store = state.StateStore(spark, f"file://{tmp_path}/state", "k string, v int")
    assert store.read().count() == 0 and store.note() is None
    store.write(spark.createDataFrame([("a", 1)], "k string, v int"), "first")
    store.write(store.read().unionByName(spark.createDataFrame([("b", 2)], "k string, v int")))
    assert sorted(r["k"] for r in store.read().collect()) == ["a", "b"] and store.note() is None


def test_totals(spark):
    schema = "scrape_status string, last_scraped timestamp, source string"
    empty = stats.totals(spark.createDataFrame([], schema)).collect()
    assert [tuple(r) for r in empty] == [(0, 0, 0, 0, 0, None)]
    at = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([("success", at, "a"), ("failed", None, "a"), (None, None, "b")], schema)
    assert tuple(stats.totals(df).first())[:5] == (3, 0, 1, 1, 0)
    assert stats.breakdown_json(df.limit(0), ["source"]).first()[0] == "{}"
    assert '"b":{"total":1' in stats.breakdown_json(df, ["source"]).first()[0]


def test_rates(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 2)], "s long, t long")
    assert [r[0] for r in df.select(stats.success_rate(F.col("s"), F.col("t"))).collect()] == [33.3, 0.0, 100.0]


def test_new_estimate(spark):
    listed = spark.createDataFrame([("a", 10), ("b", 1), ("c", 4)], "c string, total long")
    tracked = spark.createDataFrame([("a", 8, 3), ("b", 9, 0)], "c string, total long, pending long")
    assert {r["c"]: r["new_estimate"] for r in stats.new_estimate(listed, tracked, ["c"]).collect()} == {"a": 5, "b": 0, "c": 4}


def test_checked(spark, rows):
    df = spark.createDataFrame([("a", "pending"), (None, "pending"), ("b", "odd"), ("c", None)], "k string, s string")
    good, bad = schemas.checked(df, {"s": schemas.STATUSES}, ["k"])
    assert rows(good) == [("a", "pending"), ("c", None)] and bad.count() == 2


@pytest.fixture
def lookups(spark):
    searches = spark.createDataFrame([("new york", 1, 10), ("new york", 2, 11), ("new york", 3, 13), ("New York", 1, 11), ("x", 1, 12), ("early river crossing oxbridge", 1, 11)], "query string, rank int, page_id long")
    pages = spark.createDataFrame([(10, "NY", "u10", None, "o10"), (11, "NYC", "u11", None, None), (13, "Z", "u13", "t", "o")], "page_id long, page_title string, page_url string, thumb_url string, original_url string")
    page_files = spark.createDataFrame([(10, 1, "File:Site-logo.svg"), (10, 2, "File:small.jpg"), (11, 1, "File:a.jpg"), (11, 2, "File:b.jpg"), (11, 3, "File:small.jpg"), (11, 4, "x.jpg")], "page_id long, rank int, file string")
    files = spark.createDataFrame(
        [("File:a.jpg", "ia", "fa", 800, 10, "cc-by-4.0", None, "<i>d</i>"), ("File:b.jpg", "ib", "fb", 600, 600, None, "B", None), ("File:small.jpg", "is", "fs", 599, None, None, None, None), ("File:Site-logo.svg", "il", "fl", 90, 90, None, None, None)],
        "file string, image_url string, full_url string, width int, height int, license string, author string, description string",
    )
    return searches, pages, page_files, files


def test_large_images(spark, lookups):
    searches, _, page_files, files = lookups
    records = spark.createDataFrame([("r1", "new york", "new-york"), ("r2", "unknown", "x"), ("r3", None, None), ("r1", "new york", "new-york")], "id string, title string, slug string").withColumn("images", F.lit("clash"))
    queries = enrich.title_queries(records, "id", "title", "slug")
    assert {tuple(r) for r in queries.collect()} == {("r1", 0, "new york"), ("r1", 1, "New York"), ("r2", 0, "unknown"), ("r2", 1, "X")}
    found = enrich.large_images(queries, searches, page_files, files)
    got = {r["id"]: [i["image_url"] for i in r["external_images"]] for r in enrich.with_images(records, "id", found).collect()}
    assert got == {"r1": ["ia", "ib"], "r2": [], "r3": []}
    assert [i["author"] for i in found.first()["images"]] == ["Unknown", "B"]
    skipped = enrich.with_images(records, "id", found, F.col("id") == "r1").where("id = 'r1'").first()
    assert skipped["external_images"] == []
    assert enrich.large_images(queries.limit(0), searches, page_files, files).count() == 0


def test_page_images(spark, lookups):
    searches, pages, page_files, files = lookups
    articles = spark.createDataFrame([("k", "The early river crossing in Oxbridge", ["News today"]), ("l", "", None)], "id string, title string, c array<string>")
    queries = enrich.keyword_queries(articles, "id", "title", "c")
    assert [r["query"] for r in queries.orderBy("step").collect()] == ["early river crossing oxbridge", "early river"]
    images = enrich.page_images(queries, searches, pages, page_files, files).first()["images"]
    assert [(i["image_url"], i["title"], i["description"], i["license"]) for i in images] == [("ia", "a.jpg", "d", "CC BY 4.0"), ("ib", "b.jpg", "Image from Wikipedia", "Unknown")]
    two = spark.createDataFrame([("k", 0, "new york")], "key string, step int, query string")
    images = enrich.page_images(two, searches, pages, page_files, files, n=3).first()["images"]
    assert [(i["image_url"], i["article_url"]) for i in images] == [("o10", "u10"), ("is", "u10"), ("ia", "u11")]


def test_entity_queries(spark):
    df = spark.createDataFrame([("1", "Oxford", "City"), ("2", "Ann", "odd"), ("3", None, "city")], "id string, title string, kind string")
    assert {tuple(r) for r in enrich.entity_queries(df, "id", "title", "kind").collect()} == {("1", 0, "Oxford"), ("1", 1, "Oxford city"), ("2", 0, "Ann")}


def test_sink(spark, tmp_path):
    schema = "source string, url string, title string, description string, published_date string, modified_date string, author string, categories array<string>, tags array<string>, feature_image struct<url: string, alt: string>, images array<struct<url: string, alt: string>>, sources array<struct<text: string, url: string>>, locale string, content string, content_hash string"
    df = spark.createDataFrame([("W/A", "https://h/a/", "t" * 600, None, "2024-01-02", "odd", None, [], None, None, [], [], None, "one two", "h")], schema)
    now = F.lit("2024-05-05 10:00:00").cast("timestamp")
    out = sink.page_rows(df.unionByName(df), now)
    row = out.first()
    assert len(row["title"]) == 500 and row["slug"] == "a" and row["locale"] == "en" and row["updated_at"] is None and str(row["published_at"])[:10] == "2024-01-02"
    assert '"author":null' in row["attributes"] and '"word_count":2' in row["attributes"]
    once = sink.not_yet_stored(out, spark.createDataFrame([], schemas.SINK), ["id"])
    assert sink.dry_run(once) == 1
    sink.append(once, f"{tmp_path}/sink")
    stored = spark.read.parquet(f"{tmp_path}/sink")
    assert stored.count() == 1 and str(stored.first()["day"]) == "2024-05-05"
    assert sink.not_yet_stored(out, stored, ["id"]).count() == 0


def test_first_by_is_total(spark):
    random.seed(1)
    data = [("k", random.randint(0, 2), random.randint(0, 50)) for _ in range(60)]
    picks = {tuple(state.first_by(spark.createDataFrame(random.sample(data, len(data)), "k string, o int, v int").repartition(3), ["k"], [F.col("o")]).first()) for _ in range(3)}
    assert picks == {min(data, key=lambda r: (r[1], r))}


def test_shared_folder(spark, tmp_path):
    assert shared_dir(spark).startswith("file://")
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert materialise(df, "x").schema == df.schema and materialise(df.limit(0), "x").count() == 0
    made = materialise(df, "y").inputFiles()[0]
    assert os.path.exists(urlparse(made).path) and release(spark) >= 3 and not os.path.exists(urlparse(made).path)


def test_unknown_name(spark):
    from sluice.sources import registry

    sites = spark.createDataFrame([("a", "s", "u")], registry.SITES)
    registry.check(sites, "site", "a")
    with pytest.raises(ValueError, match="unknown site"):
        registry.check(sites, "site", "b")


def test_appended_parts(spark, tmp_path, monkeypatch):
    """Appending writes the new rows only; now and then the parts become one."""
    monkeypatch.setattr(state, "PARTS", 3)
    store = state.StateStore(spark, f"file://{tmp_path}/s", "id int, v string")
    for n in range(9):
        store.append(spark.createDataFrame([(n, "x")], "id int, v string"), str(n))
        assert sorted(r["id"] for r in store.read().collect()) == list(range(n + 1)) and store.note() == str(n)
        assert len(store._pointed(store._current())["versions"]) <= 3
    store.write(spark.createDataFrame([(7, "y")], "id int, v string"))
    assert [tuple(r) for r in store.read().collect()] == [(7, "y")] and store.note() is None
