"""Whole runs: read what the registry names, work on it, store rows, state and checkpoints.

Rows are stored before the state, so that a run that dies in between is made up for by the next: its records are still
pending, and rows the sink has are not stored again.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import schemas
from sluice.operators import enrich, sink
from sluice.operators.state import StateStore, insert_absent
from sluice.plans import jobs
from sluice.session import materialise
from sluice.sources import cms, registry, sitemap, wikimedia
from sluice.sources.transport import Fetch, Retry

log = logging.getLogger("sluice")

Work = Callable[[DataFrame, DataFrame, bool], jobs.Run]


class Stores:
    """The state tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.records = StateStore(spark, f"{folder}/cms", schemas.CMS_STATE)
        self.urls = StateStore(spark, f"{folder}/wp", schemas.URL_STATE)
        self.checkpoints = StateStore(spark, f"{folder}/checkpoints", schemas.CHECKPOINTS)
        self.runs = StateStore(spark, f"{folder}/runs", schemas.RUN_STATE)


def request_stop(stores: Stores, pipeline: str) -> None:
    """Asks the pipeline's run to stop before it stores anything more."""
    known = stores.runs.read()
    row = known.sparkSession.createDataFrame([(pipeline,)], "pipeline string")
    whole = insert_absent(known, jobs._typed(row, schemas.RUN_STATE), ["pipeline"])
    stores.runs.write(whole.withColumn("shutdown_requested", F.when(F.col("pipeline") == pipeline, True).otherwise(F.col("shutdown_requested"))))


def stop_requested(stores: Stores, pipeline: str) -> bool:
    return bool(stores.runs.read().where((F.col("pipeline") == pipeline) & F.col("shutdown_requested")).limit(1).count())


def _note(spark: SparkSession, stores: Stores, pipeline: str, mode: str, result: str, message: str, at: datetime, first: bool) -> None:
    """The pipeline's row of the run state: when it last began or ended, and how."""
    known = stores.runs.read()
    old = known.where(F.col("pipeline") == pipeline).head()
    started = at if first else (old["last_started_at"] if old else None)
    row = (pipeline, started, None if first else at, mode, result, message, False, at)
    stores.runs.write(known.where(F.col("pipeline") != pipeline).unionByName(spark.createDataFrame([row], schemas.RUN_STATE)))


class Progress:
    """Tells, every few seconds while a run works, how many of the tasks at hand are done: to the log, or to what is given."""

    def __init__(self, spark: SparkSession, every: float = 30.0, tell: Callable[[int, int], None] | None = None) -> None:
        self.tracker, self.every = spark.sparkContext.statusTracker(), every
        self.tell = tell or (lambda done, total: log.info("%d of %d tasks done", done, total))
        self.ended = threading.Event()
        self.thread = InheritableThread(target=self._watch)  # gives its connection to the JVM back when it ends
        self.thread.daemon = True

    def _watch(self) -> None:
        while not self.ended.wait(self.every):
            stages = [s for i in self.tracker.getActiveStageIds() if (s := self.tracker.getStageInfo(i)) is not None]
            if stages:
                self.tell(sum(s.numCompletedTasks for s in stages), sum(s.numTasks for s in stages))

    def __enter__(self) -> Progress:
        self.thread.start()
        return self

    def __exit__(self, *_: object) -> None:
        self.ended.set()
        self.thread.join()


class Stopped(Exception):
    """A run was asked to stop."""


def _run(spark: SparkSession, pipeline: str, store: StateStore, stores: Stores, sink_path: str, mode: str, dry: bool, sources: list[str], at: datetime, work: Work) -> DataFrame:
    """Runs `work` (tracked, stored, full), with a checkpoint per source that is open while it runs; gives the counts per source."""
    if not dry:
        try:
            sink.ensure(spark, sink_path)
        except Exception as problem:  # no sink: compute all the same, store nothing
            log.warning("the sink can't be used, dry run instead: %s", f"{problem}".splitlines()[0])
            dry = True
    stored = spark.createDataFrame([], schemas.SINK) if dry else spark.read.schema(schemas.SINK).parquet(sink_path)
    crawl = f"{pipeline}-{at:%Y%m%dT%H%M%S}"
    begin = F.lit(at).cast("timestamp")
    if dry:
        run = work(store.read(), stored, mode == "full")
        log.info("dry run: %d rows", sink.dry_run(run.rows))
        return materialise(run.counts, "counts")
    opened = spark.createDataFrame([(s, 0, 0, 0) for s in sources], "source string, fetched int, inserted int, failed int")
    opened = jobs.checkpoint(opened, crawl, pipeline, mode, begin, F.lit(None).cast("timestamp")).withColumn("status", F.lit("running"))
    stores.checkpoints.write(insert_absent(stores.checkpoints.read(), opened, ["crawl_id", "source"]))
    _note(spark, stores, pipeline, mode, "running", "", at, True)

    def close(status: str, counts: DataFrame | None) -> None:
        ended = spark.createDataFrame([(s,) for s in sources], "source string")
        if counts is None:
            ended = ended.selectExpr("source", "int(null) AS fetched", "int(null) AS inserted", "int(null) AS failed")
        else:
            ended = ended.join(counts, "source", "left").fillna(0, ["fetched", "inserted", "failed"])
        updates = ended.select(
            F.lit(crawl).alias("crawl_id"), "source", F.lit(datetime.now(UTC)).cast("timestamp").alias("at"), F.lit(status).alias("status"), F.col("fetched").cast("int").alias("processed_items"),
            F.col("inserted").cast("int").alias("successful_items"), F.col("failed").cast("int").alias("failed_items"), F.lit("").alias("last_item_id"),
        )
        stores.checkpoints.write(jobs.update_checkpoints(stores.checkpoints.read(), updates))

    try:
        run = work(store.read(), stored, mode == "full")
        counts = materialise(run.counts, "counts")
        if stop_requested(stores, pipeline):
            raise Stopped
        sink.append(run.rows, sink_path)
        store.write(run.state)
    except BaseException as problem:
        stopped = isinstance(problem, (KeyboardInterrupt, Stopped))
        close("cancelled" if stopped else "failed", None)
        _note(spark, stores, pipeline, mode, "cancelled" if stopped else "failed", f"{type(problem).__name__}: {problem}"[:500], datetime.now(UTC), False)
        raise
    close("completed", counts)
    _note(spark, stores, pipeline, mode, "completed", "", datetime.now(UTC), False)
    return counts


def run_cms(spark: SparkSession, collections: DataFrame, endpoint: str, state: str, sink_path: str, mode: str = "incremental", collection: str | None = None, dry: bool = False, at: datetime | None = None, **options: str) -> DataFrame:
    """A run over the CMS collections of a registry (see `registry.COLLECTIONS`), or over one; gives counts per source.  `options` go to the reader of pages."""
    if collection:
        registry.check(collections, "collection", collection)
        collections = collections.where(F.col("collection") == collection)
    at = at or datetime.now(UTC)
    stores = Stores(spark, state)

    def work(tracked: DataFrame, stored: DataFrame, full: bool) -> jobs.Run:
        pages = materialise(registry.read_pages(spark, collections, endpoint, **options), "cms-pages")  # each page is fetched once
        for row in cms.page_stats(pages).where("size(failed_pages) > 0").collect():  # a row per collection
            log.error("%s: pages %s of %d can't be read", row["response_key"], row["failed_pages"], row["page_count"])
        return jobs.cms_run(registry.records(pages, collections), tracked, stored, F.lit(at).cast("timestamp"), full)

    sources = [r[0] for r in collections.select("source").distinct().collect()]  # the registry is a few rows
    return _run(spark, "cms", stores.records, stores, sink_path, mode, dry, sources, at, work)


def look_up(queries: DataFrame, fetch: Fetch, endpoint: str, retry: Retry, tasks: int) -> DataFrame:
    """(key, images) for (key, step, query): asks the API for what the queries find."""
    ok = lambda df, name: materialise(df, name).where("problem IS NULL")
    found = ok(wikimedia.searches(queries.select("query").distinct(), fetch, endpoint, retry, tasks), "searches")
    pages = ok(wikimedia.pages(found.select("page_id").distinct(), fetch, endpoint, retry, tasks), "lookup-pages")
    named = wikimedia.page_files(pages)
    shown = named.where(enrich.shows_subject(F.col("file"))).select("file").distinct()
    files = ok(wikimedia.files(shown, fetch, endpoint, retry, tasks), "lookup-files")
    return enrich.page_images(queries, found, pages, named, files)


def run_wp(spark: SparkSession, sites: DataFrame, fetch: Fetch, state: str, sink_path: str, mode: str = "incremental", site: str | None = None, dry: bool = False, at: datetime | None = None, retry: Retry = Retry(), images: DataFrame | None = None) -> DataFrame:
    """A run over the sites of a registry (see `registry.SITES`), or over one; gives counts per source."""
    if site:
        registry.check(sites, "site", site)
        sites = sites.where(F.col("site") == site)
    at = at or datetime.now(UTC)
    stores = Stores(spark, state)
    sources = [r[0] for r in sites.select("source").distinct().collect()]

    def work(tracked: DataFrame, stored: DataFrame, full: bool) -> jobs.Run:
        found, problems = sitemap.crawl(sites, fetch, retry)
        found = materialise(found, "found-urls")
        for row in problems.limit(100).collect():  # for the log
            log.error("%s: %s: %s", row["site"], row["address"], row["problem"])
        mine, others = tracked.where(F.col("source").isin(sources)), tracked.where(~F.coalesce(F.col("source").isin(sources), F.lit(False)))
        run = jobs.wp_run(found, mine, stored, fetch, F.lit(at).cast("timestamp"), full, images, retry)
        return run._replace(state=run.state.unionByName(others))

    return _run(spark, "wp", stores.urls, stores, sink_path, mode, dry, sources, at, work)
