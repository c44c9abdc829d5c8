"""Sources over files, whole runs twice, and the stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sluice import schemas
from sluice.operators.state import StateStore
from sluice.plans import jobs
from sluice.sources import cms, sitemap, transport
from sluice.streaming import incremental

SPACE = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
ONCE = transport.Retry(attempts=1)


@pytest.fixture
def now(spark):
    return F.lit("2024-05-05 10:00:00").cast("timestamp")


def put(folder, url, text):
    with open(os.path.join(folder, transport.file_name(url, None)), "w") as file:
        file.write(text)


@pytest.fixture
def site(tmp_path):
    folder = str(tmp_path / "web")
    os.mkdir(folder)
    put(folder, "https://h/index.xml", f"<sitemapindex {SPACE}><sitemap><loc> https://h/1.xml </loc></sitemap><sitemap><loc>https://h/gone.xml</loc></sitemap><sitemap><loc/></sitemap></sitemapindex>")
    entries = "".join(f"<url><loc>https://h/{x}</loc>{m}</url>" for x, m in (("a", "<lastmod>2024-01-01</lastmod>"), ("b", "<lastmod>odd</lastmod>"), ("tag/x", ""), ("", ""), ("a", ""), ("lost", "")))
    put(folder, "https://h/1.xml", f"<urlset {SPACE}>{entries}</urlset>")
    for x in "ab":
        put(folder, f"https://h/{x}", f"<title>Page {x} - Site</title><article>{'Words of ' + x + ' and more. '}{'filler text ' * 20}</article>")
    return folder


def test_transport():
    waits = []

    def broken(url, body):
        raise OSError("down")

    assert transport.fetched(broken, "u", None, transport.Retry(), waits.append) == (None, "OSError: down") and waits == [1.0, 2.0]


def test_what_is_tried_again():
    from urllib.error import HTTPError

    def answers(*codes, headers=None):
        left = list(codes)

        def fetch(url, body):
            code = left.pop(0)
            if code != 200:
                raise HTTPError(url, code, "odd", headers or {}, None)
            return b"ok"

        return fetch

    waits = []
    ask = lambda fetch, retry=transport.Retry(): transport.fetched(fetch, "u", None, retry, waits.append)
    assert ask(answers(404))[0] is None and ask(answers(403))[0] is None and waits == []
    assert ask(answers(503, 200)) == (b"ok", None) and waits == [1.0]
    assert ask(answers(429, 200, headers={"Retry-After": "7"})) == (b"ok", None) and waits[1:] == [7.0]
    assert ask(answers(429, 200, headers={"Retry-After": "700"})) == (b"ok", None) and waits[2:] == [10.0]
    assert ask(answers(200), transport.Retry(pause=0.5)) == (b"ok", None) and waits[3:] == [0.5]


def test_first_page_lost(spark, tmp_path, now):
    meta = {"pagination": {"total": 3, "page": 2, "pageSize": 1, "pageCount": 3}}
    part = lambda i: {"data": {"posts": {"data": [{"id": str(i), "attributes": {}}], "meta": meta}}}
    answers(str(tmp_path), {1: {"errors": [{"message": "no"}]}, 2: part(2), 3: part(3)})
    spark.dataSource.register(cms.CmsPages)
    load = lambda **k: spark.read.format("cms_pages").options(endpoint="https://api", response_key="posts", page_size="2", folder=str(tmp_path), **k).load()
    stats = cms.page_stats(load()).first()
    assert (stats["page_count"], stats["pages_read"], stats["failed_pages"]) == (3, 2, [1])
    assert sorted(r["id"] for r in cms.records(load()).collect()) == ["2", "3"] and [r["id"] for r in cms.records(load(max_pages="2")).collect()] == ["2"]
    gone = spark.read.format("cms_pages").options(endpoint="https://no", response_key="posts", folder=str(tmp_path)).load()
    assert sorted(r["page"] for r in gone.where("problem IS NOT NULL").collect()) == [1, 2, 3]


def test_cms_run_counts_what_reaches_the_sink(spark, now):
    schema = "cms_key string, collection string, source string, id string, attributes string"
    records = [("k", "post", "S", None, '{"title": "A"}'), ("k", "post", "S", None, '{"title": "B"}'), ("k", "post", "S", "1", '{"title": "C"}'), ("k", "post", "S", "1", '{"title": "D"}'), ("k", "post", "S", "2", '{"title": 5}'), ("k", "post", "S", "3", '{"title": "E"}')]
    fetched = spark.createDataFrame(records, schema)
    none = spark.createDataFrame([], schemas.CMS_STATE)
    stored = spark.createDataFrame([("3", "0", "post")], "id string, source string, content_type string")
    run = jobs.cms_run(fetched, none, stored, now)
    assert [(r["id"], r["title"]) for r in run.rows.collect()] == [("1", "C")]
    assert {r["record_id"]: r["scrape_status"] for r in run.state.collect()} == {"k_post_1": "success", "k_post_2": "failed", "k_post_3": "success"}
    assert [tuple(r) for r in run.counts.collect()] == [("S", 5, 1, 3)]
    again = jobs.cms_run(fetched, run.state, run.rows.unionByName(stored, allowMissingColumns=True), now)
    assert again.rows.count() == 0 and [tuple(r) for r in again.counts.collect()] == [("S", 2, 0, 2)]


@pytest.mark.parametrize("xml", ["", "<x", "<urlset/>", "<a>text</a>", None])
def test_sitemaps_that_hold_nothing(xml):
    assert sitemap.parse(xml) == ([], [])


def test_crawl(spark, site, rows):
    sites = spark.createDataFrame([("h", "W/H", "https://h/index.xml"), ("dead", "W/D", "https://dead/x.xml")], "site string, source string, sitemap_url string")
    found, problems = sitemap.crawl(sites, transport.Folder(site), ONCE)
    assert rows(found.select("url", "lastmod"))[:2] == [("https://h/", None), ("https://h/a", "2024-01-01")] and found.count() == 6
    assert {r["address"] for r in problems.collect()} == {"https://h/gone.xml", "https://dead/x.xml"}
    assert rows(sitemap.crawl_counts(found)) == [("h", 6, 4, 2)]


def test_wp_runs(spark, site, now):
    sites = spark.createDataFrame([("h", "W/H", "https://h/index.xml")], "site string, source string, sitemap_url string")
    found, _ = sitemap.crawl(sites, transport.Folder(site), ONCE)
    none, no_rows = spark.createDataFrame([], schemas.URL_STATE), spark.createDataFrame([], schemas.SINK)
    run = jobs.wp_run(found, none, no_rows, transport.Folder(site), now, retry=ONCE)
    stored = run.rows.cache()
    assert sorted(r["title"] for r in stored.collect()) == ["Page a", "Page b"]
    after = {r["url"]: r for r in run.state.collect()}
    assert {u: r["scrape_status"] for u, r in after.items()} == {"https://h/a": "success", "https://h/b": "success", "https://h/lost": "failed"}
    assert after["https://h/a"]["scrape_count"] == 1 and "FileNotFound" in after["https://h/lost"]["error_message"] and after["https://h/b"]["last_modified"] is None
    assert tuple(run.counts.first()) == ("W/H", 3, 2, 1)
    known = spark.createDataFrame(list(after.values()), schemas.URL_STATE)
    again = jobs.wp_run(found, known, stored, transport.Folder(site), now, retry=ONCE)
    assert again.rows.count() == 0 and again.counts.count() == 0
    full = jobs.wp_run(found, known, stored, transport.Folder(site), now, full=True, retry=ONCE)
    assert full.rows.count() == 0 and {r["scrape_count"] for r in full.state.collect()} == {1, 2}
    point = jobs.checkpoint(run.counts, "c1", "wp", "incremental", now, now).first()
    assert (point["status"], point["successful_items"], point["failed_items"]) == ("completed", 2, 1)


def answers(folder, pages):
    for page, body in pages.items():
        asked = cms.query("posts", "id attributes", page, 2)
        with open(os.path.join(folder, transport.file_name("https://api", asked)), "w") as file:
            json.dump(body, file)


def test_cms_source_and_runs(spark, tmp_path, now):
    meta = {"pagination": {"total": 7, "page": 1, "pageSize": 2, "pageCount": 4}}
    record = lambda i, **k: {"id": str(i), "attributes": {"title": f"T{i}", "slug": f"t-{i}", **k}}
    part = lambda *r: {"data": {"posts": {"data": list(r), "meta": meta}}}
    answers(str(tmp_path), {1: part(record(1), record(2, applications={"data": [{"id": 3}]})), 2: {"errors": [{"message": "no"}]}, 3: part(record(3, title=5)), 4: part(record(1))})
    spark.dataSource.register(cms.CmsPages)
    read = spark.read.format("cms_pages").options(endpoint="https://api", response_key="posts", page_size="2", folder=str(tmp_path)).load()
    stats = cms.page_stats(read).first()
    assert (stats["page_count"], stats["total_available"], stats["pages_read"], stats["fetched"], stats["failed_pages"]) == (4, 7, 3, 4, [2])
    assert [r["id"] for r in cms.records(read, 2).collect()] == ["1", "2"]
    fetched = cms.records(read).select(F.lit("k").alias("cms_key"), F.lit("post").alias("collection"), F.lit("S").alias("source"), "id", "attributes")
    none, no_rows = spark.createDataFrame([], schemas.CMS_STATE), spark.createDataFrame([], schemas.SINK)
    run = jobs.cms_run(fetched, none, no_rows, now)
    stored = run.rows.cache()
    assert {(r["id"], r["source"], r["title"]) for r in stored.collect()} == {("1", "0", "T1"), ("2", "3", "T2")}
    after = {r["record_id"]: r for r in run.state.collect()}
    assert {k: r["scrape_status"] for k, r in after.items()} == {"k_post_1": "success", "k_post_2": "success", "k_post_3": "failed"} and after["k_post_3"]["error_message"]
    known = spark.createDataFrame(list(after.values()), schemas.CMS_STATE)
    assert jobs.cms_run(fetched, known, stored, now).rows.count() == 0
    assert jobs.cms_run(fetched, known, stored, now, full=True).rows.count() == 0


def test_stream(spark, tmp_path):
    schema = "id string, v int"
    store = StateStore(spark, f"file://{tmp_path}/state", "id string")
    run = lambda: incremental.run_available(spark, f"{tmp_path}/in", schema, f"file://{tmp_path}/out", f"{tmp_path}/check", lambda d: d.withColumn("w", F.col("v") * 2), ["id"], store).awaitTermination(60)
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], schema).write.parquet(f"{tmp_path}/in", mode="append")
    run()
    spark.createDataFrame([("b", 9), ("c", 5)], schema).write.parquet(f"{tmp_path}/in", mode="append")
    run()
    run()
    out = spark.read.parquet(f"file://{tmp_path}/out")
    assert sorted((r["id"], r["w"]) for r in out.collect()) == [("a", 2), ("b", 6), ("c", 10)]
    assert sorted(r[0] for r in store.read().collect()) == ["a", "b", "c"] and store.note() == "1"


def test_checkpoints(spark, now):
    counts = spark.createDataFrame([("s", 3, 2, 1)], "source string, fetched int, inserted int, failed int")
    running = jobs.checkpoint(counts, "c", "wp", "full", now, F.lit(None).cast("timestamp")).withColumn("status", F.lit("running"))
    updates = spark.createDataFrame(
        [("c", "s", "2024-05-05 11:00:00", "", 9, None, None, "x"), ("c", "s", "2024-05-05 12:00:00", "completed", None, 8, 0, ""), ("z", "s", "2024-05-05 12:00:00", "failed", 1, 1, 1, "y")],
        "crawl_id string, source string, at string, status string, processed_items int, successful_items int, failed_items int, last_item_id string",
    ).withColumn("at", F.col("at").cast("timestamp"))
    row = jobs.update_checkpoints(running, updates).first()
    assert (row["status"], row["processed_items"], row["successful_items"], row["failed_items"], row["last_item_id"], str(row["end_time"])) == ("completed", 9, 8, 0, "x", "2024-05-05 12:00:00")


def test_ensure(spark, tmp_path):
    from sluice.operators import sink

    assert sink.ensure(spark, f"{tmp_path}/t") and not sink.ensure(spark, f"{tmp_path}/t") and spark.read.parquet(f"{tmp_path}/t").count() == 0


def registry_file(tmp_path, rows):
    path = str(tmp_path / "registry.json")
    with open(path, "w") as file:
        json.dump(rows, file)
    return path


def test_runs_by_command(spark, tmp_path, capsys):
    """Both pipelines from the command line over answers in files: dry, incremental, again, full, stopped."""
    from sluice import cli
    from sluice.plans import runner

    meta = {"pagination": {"total": 3, "page": 1, "pageSize": 2, "pageCount": 2}}
    part = lambda *r: {"data": {"posts": {"data": list(r), "meta": meta}}}
    record = lambda i, **k: {"id": str(i), "attributes": {"title": f"T{i}", **k}}
    web = tmp_path / "web"
    web.mkdir()
    answers(str(web), {1: part(record(1), record(2)), 2: part(record(3, title=7))})
    path = registry_file(tmp_path, [{"cms_key": "k", "collection": "post", "response_key": "posts", "source": "S", "fields": None}, {"cms_key": "k", "collection": "page", "response_key": "pages", "source": "S", "fields": "id"}])
    state, out = f"file://{tmp_path}/state", f"file://{tmp_path}/out"
    run = lambda *more: cli.main(["run", "cms", "--registry", path, "--endpoint", "https://api", "--state", state, "--sink", out, "--answers", str(web), "--collection", "post", *more])
    stores = runner.Stores(spark, state)
    assert run("--dry-run") == 0 and stores.records.read().count() == 0 and stores.checkpoints.read().count() == 0
    assert run() == 0
    assert {r["record_id"]: r["scrape_status"] for r in stores.records.read().collect()} == {"k_post_1": "success", "k_post_2": "success", "k_post_3": "failed"}
    point = stores.checkpoints.read().first()
    assert (point["status"], point["processed_items"], point["successful_items"], point["failed_items"]) == ("completed", 3, 2, 1) and point["end_time"] is not None
    assert spark.read.parquet(out).count() == 2 and stores.runs.read().first()["last_result"] == "completed"
    assert run("--mode", "full") == 0 and spark.read.parquet(out).count() == 2
    with pytest.raises(SystemExit):
        cli.main(["run", "cms", "--registry", path, "--state", state, "--sink", out])
    with pytest.raises(ValueError, match="unknown collection"):
        run("--collection", "none")
    assert cli.main(["diagnose", "cms", "--registry", path, "--state", state, "--sink", out]) == 1  # no endpoint
    assert cli.main(["diagnose", "wp", "--registry", registry_file(tmp_path / "web", [{"site": "h", "source": "W", "sitemap_url": "u"}]), "--state", state, "--sink", out]) == 0
    assert cli.main(["diagnose", "cms", "--registry", f"{path}.no", "--sink", f"{out}/no"]) == 1


def test_wp_by_command(spark, site, tmp_path):
    from sluice import cli
    from sluice.plans import runner

    path = registry_file(tmp_path, [{"site": "h", "source": "W/H", "sitemap_url": "https://h/index.xml"}, {"site": "g", "source": "W/G", "sitemap_url": "https://g/x.xml"}])
    state, out = f"file://{tmp_path}/state", f"file://{tmp_path}/out"
    stores = runner.Stores(spark, state)
    other = spark.createDataFrame([("https://g/a", "W/G", "pending")], "url string, source string, scrape_status string")
    stores.urls.write(jobs._typed(other, schemas.URL_STATE))
    assert cli.main(["run", "wp", "--registry", path, "--state", state, "--sink", out, "--answers", site, "--site", "h"]) == 0
    assert {r["url"]: r["scrape_status"] for r in stores.urls.read().collect()} == {"https://h/a": "success", "https://h/b": "success", "https://h/lost": "failed", "https://g/a": "pending"}
    assert sorted(r["title"] for r in spark.read.parquet(out).collect()) == ["Page a", "Page b"]


def test_stop(spark, tmp_path, now):
    """A run that is asked to stop stores nothing and closes its checkpoint."""
    from datetime import UTC, datetime

    from sluice.plans import runner

    state, out = f"file://{tmp_path}/state", f"file://{tmp_path}/out"
    stores = runner.Stores(spark, state)
    rows = spark.createDataFrame([("1", "S")], "id string, source string").selectExpr("*", "current_timestamp() AS created_at")

    def work(tracked, stored, full):
        runner.request_stop(stores, "cms")
        return jobs.Run(jobs._typed(rows, schemas.SINK), tracked, spark.createDataFrame([("S", 1, 1, 0)], "source string, fetched int, inserted int, failed int"))

    with pytest.raises(runner.Stopped):
        runner._run(spark, "cms", stores.records, stores, out, "full", False, ["S"], datetime(2024, 1, 1, tzinfo=UTC), work)
    assert spark.read.parquet(out).count() == 0 and [r["status"] for r in stores.checkpoints.read().collect()] == ["cancelled"]
    row = stores.runs.read().first()
    assert row["last_result"] == "cancelled" and row["shutdown_requested"] is False and row["last_completed_at"] is not None


def test_lookups(spark, tmp_path):
    """Enrichment from the API's answers to images: what can't be had leaves the rest."""
    from sluice.plans import runner
    from sluice.sources import wikimedia as w

    api = "https://wiki/api"
    put_json = lambda url, body: put(str(tmp_path), url, json.dumps(body))
    put_json(w.search_address(api, "old mill"), {"query": {"search": [{"title": "Mill", "pageid": 7}, {"title": "Lost", "pageid": 8}]}})
    put_json(w.page_address(api, 7), {"query": {"pages": {"7": {"title": "Mill", "fullurl": "https://w/Mill", "original": {"source": "o"}, "images": [{"title": "File:Logo.png"}, {"title": "File:Mill.jpg"}]}}}})
    info = {"url": "full", "thumburl": "thumb", "width": 900, "height": 10, "extmetadata": {"LicenseShortName": {"value": "CC0"}, "ImageDescription": {"value": "<i>A mill</i>"}, "Artist": {"value": "Ann"}}}
    put_json(w.file_address(api, "File:Mill.jpg"), {"query": {"pages": {"-1": {"imageinfo": [info]}}}})
    fetch = transport.Folder(str(tmp_path))
    queries = spark.createDataFrame([("r1", 0, "old mill"), ("r2", 0, "unknown")], "key string, step int, query string")
    got = {r["key"]: r["images"] for r in runner.look_up(queries, fetch, api, ONCE, 2).collect()}
    assert set(got) == {"r1"} and [(i["image_url"], i["license"], i["title"], i["description"]) for i in got["r1"]] == [("o", "Wikipedia", "Mill", "Image from Wikipedia article: Mill"), ("thumb", "CC0 1.0", "Mill.jpg", "A mill")]
    failed = w.searches(queries.select("query"), fetch, api, ONCE).where("problem IS NOT NULL").collect()
    assert [r["query"] for r in failed] == ["unknown"]
    assert w.files(spark.createDataFrame([(None,)], "file string"), fetch, api, ONCE).first()["problem"] == "nothing asked"
