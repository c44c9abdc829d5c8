"""Ingestion runs: source -> tracking state -> work list -> content -> sink -> state, each one lazy plan over all collections."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice import schemas
from sluice.functions import jsonattrs, markup, text
from sluice.operators import enrich, sink, state
from sluice.session import materialise
from sluice.sources import pages, sitemap
from sluice.sources.transport import Fetch, Retry


class Run(NamedTuple):
    """Rows for the sink, the state after the run, and counts per source: fetched, inserted, failed."""

    rows: DataFrame
    state: DataFrame
    counts: DataFrame


def _typed(df: DataFrame, schema: str) -> DataFrame:
    """Columns and types of a schema; missing ones null."""
    wanted = df.sparkSession.createDataFrame([], schema).schema
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted])


def cms_run(records: DataFrame, tracked: DataFrame, stored: DataFrame, now: Column, full: bool = False, fixed_source: str | None = None) -> Run:
    """One run over fetched CMS records (cms_key, collection, source, id, attributes).

    New records are tracked as pending.  An incremental run works on pending ones, a full run on all.  Records
    that can't be structured become failed, with the reason; those whose row goes to the sink, or is there already, become
    successes, and only rows that go there now count as inserted.  Records without id have no key: they count as failed and
    are neither tracked nor stored.  Of records repeated under a key the least is taken.
    """
    keyed = records.withColumn("record_id", F.when(F.col("id").isNotNull(), text.joined_id(F.col("cms_key"), F.col("collection"), F.col("id"))))
    title = text.clean(F.get_json_object("attributes", "$.title"))
    seen = keyed.select("record_id", "source", "cms_key", "collection", F.col("id").alias("strapi_id"), title.alias("title"),
                        F.try_to_timestamp(F.get_json_object("attributes", "$.publishedAt")).alias("published_at"), now.alias("first_seen"), F.lit("pending").alias("scrape_status"))
    known = state.insert_absent(tracked, _typed(seen, schemas.CMS_STATE), ["record_id"])
    whole = keyed.where("record_id IS NOT NULL")
    todo = whole if full else state.present(whole, known.where("scrape_status = 'pending'"), ["record_id"])
    work = materialise(jsonattrs.structured(state.first_by(todo, ["record_id"], []), fixed_source=fixed_source), "cms-work")
    # Written before the sink is, so that counts don't change when the sink has taken the rows.
    rows = materialise(sink.not_yet_stored(sink.cms_rows(work, now), stored, ["source", "content_type", "id"]), "cms-rows")
    good = F.col("problem").isNull()
    events = work.select("record_id", now.alias("at"), F.when(good, "success").otherwise("failed").alias("status"), F.col("problem").alias("error"))
    after = state.apply_events(known, events, ["record_id"], ["at"], {"scrape_status": "status", "last_scraped": "at"}, {"error_message": "error"})
    mine = rows.select(F.col("source").alias("app_source"), F.col("content_type").alias("collection"), "id", F.lit(1).alias("new"))
    landed = state.first_by(work.where(good).select("app_source", "collection", F.col("id").cast("string").alias("id"), "source"), ["app_source", "collection", "id"], [])
    inserted = landed.join(mine, ["app_source", "collection", "id"]).groupBy("source").agg(F.count("*").alias("inserted"))
    lost = keyed.where("record_id IS NULL").groupBy("source").agg(F.count("*").alias("lost"))
    done = work.groupBy("source").agg(F.count("*").alias("n"), F.count_if(~good).alias("bad"))
    counts = done.join(inserted, "source", "left").join(lost, "source", "full").fillna(0, ["n", "bad", "inserted", "lost"])
    return Run(rows, after, counts.select("source", (F.col("n") + F.col("lost")).alias("fetched"), "inserted", (F.col("bad") + F.col("lost")).alias("failed")))


def wp_run(found: DataFrame, tracked: DataFrame, stored: DataFrame, fetch: Fetch, now: Column, full: bool = False, images: DataFrame | None = None, retry: Retry = Retry()) -> Run:
    """One run over URLs of sitemaps (source, sitemap_url, url, lastmod).

    New URLs are tracked as pending.  An incremental run works on all pending URLs, also those that left
    the sitemap; a full run on those of the sitemap that are no success yet.  Each page is fetched and parsed once.
    """
    content = sitemap.content_urls(found)
    seen = content.select("url", "source", "sitemap_url", now.alias("first_seen"), F.try_to_timestamp("lastmod").alias("last_modified"), F.lit("pending").alias("scrape_status"), F.lit(0).alias("scrape_count"))
    known = state.insert_absent(tracked, _typed(seen, schemas.URL_STATE), ["url"])
    if full:
        todo = state.absent(state.first_by(content.select("url", "source"), ["url"], []), known.where("scrape_status = 'success'"), ["url"])
    else:
        todo = known.where("scrape_status = 'pending'").select("url", "source")
    raw = materialise(pages.fetch_pages(todo.repartition("url"), fetch, retry), "wp-raw")  # each page is fetched once
    read = materialise(markup.articles(raw.where("problem IS NULL")).join(todo, "url"), "wp-pages")
    lost = raw.where("problem IS NOT NULL").select("url", F.col("problem").alias("error"))
    flat = read.where("ok").select("url", "source", "article.*")
    flat = flat.withColumn("title", text.clean_title(F.col("title"))).withColumn("description", markup.short(F.col("description")))
    if images is not None:
        flat = enrich.with_images(flat, "url", images)
    rows = materialise(sink.not_yet_stored(sink.page_rows(flat, now), stored, ["id"]), "wp-rows")
    good = read.where("ok").select("url", F.lit("success").alias("status"), F.lit(None).cast("string").alias("error"), F.col("article.content_hash").alias("hash"))
    bad = read.where("NOT ok").select("url", F.lit("failed").alias("status"), "error", F.lit(None).cast("string").alias("hash"))
    gone = lost.select("url", F.lit("failed").alias("status"), "error", F.lit(None).cast("string").alias("hash"))
    events = good.unionByName(bad).unionByName(gone).withColumn("at", now)
    after = state.apply_events(known, events, ["url"], ["at"], {"scrape_status": "status", "last_scraped": "at"}, {"error_message": "error", "content_hash": "hash"}, "scrape_count")
    counts = events.join(known.select("url", "source"), "url").groupBy("source").agg(
        F.count("*").alias("fetched"), F.count_if(F.col("status") == "success").alias("inserted"), F.count_if(F.col("status") == "failed").alias("failed")
    )
    return Run(rows, after, counts)


def checkpoint(counts: DataFrame, crawl_id: str, pipeline: str, mode: str, start: Column, end: Column) -> DataFrame:
    """A finished checkpoint per source; its key is (crawl_id, source)."""
    row = counts.select(
        F.lit(crawl_id).alias("crawl_id"), F.lit(pipeline).alias("pipeline"), "source", F.lit(mode).alias("mode"), start.alias("start_time"), end.alias("end_time"), F.col("fetched").alias("total_items"),
        F.col("fetched").alias("processed_items"), F.col("inserted").alias("successful_items"), F.col("failed").alias("failed_items"), F.lit("completed").alias("status"),
    )
    return _typed(row, schemas.CHECKPOINTS)


def update_checkpoints(known: DataFrame, updates: DataFrame) -> DataFrame:
    """The checkpoints after updates (crawl_id, source, at, status, processed_items, successful_items, failed_items, last_item_id).

    Null and empty values change nothing; a terminal status stamps the end, once.
    """
    blank = {c: F.nullif(F.col(c), F.lit("")) for c in ("status", "last_item_id")}
    numbers = ["processed_items", "successful_items", "failed_items"]
    ended = F.when(F.col("status").isin(schemas.TERMINAL), F.col("at"))
    renamed = updates.withColumns(blank).withColumn("ended", ended).select("crawl_id", "source", "at", "ended", *[F.col(c).alias(f"u_{c}") for c in ("status", "last_item_id", *numbers)])
    first_end = known.withColumn("__end", F.col("end_time"))
    after = state.apply_events(first_end, renamed, ["crawl_id", "source"], ["at"], {}, {"status": "u_status", "last_item_id": "u_last_item_id", "end_time": "ended"} | {c: f"u_{c}" for c in numbers})
    return after.withColumn("end_time", F.coalesce("__end", "end_time")).drop("__end")
