"""Queries of the ingestion operators over the project's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import schemas
from sluice.functions import dates, jsonattrs, markup, text, urls
from sluice.operators import sink, state, stats
from sluice.session import table
from sluice.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

CONTENT, URLS, CMS, RECORDS, CHECKPOINTS = "unified_all_cms_content", "aidna_wp_scraped_urls", "unified_cms_content_combined", "aidna_cms_scraped_records", "aidna_pipeline_checkpoints"

# White space as the functions count it, for regular expressions of DuckDB.
_W = "".join(rf"\x{{{p:x}}}" for p in text.WHITE_POINTS)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_W}]+|[{_W}]+$', '', 'g')"


def _collapse(x: str) -> str:
    return _strip(f"regexp_replace({x}, '[{_W}]+', ' ', 'g')")


def _words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{_W}]+'), lambda w: w <> '')"


# --- functions of text, URLs and dates


@query(rf"""SELECT DISTINCT url FROM {URLS} WHERE NOT regexp_matches(url, '(?i)/tag/|/list-tags/|/category/|/author/|/page/\d+|\?|/feed/?$|/wp-json/|/wp-admin/|/wp-content/|/wp-includes/')
 AND trim(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '/') <> ''""")
def url_content_filter(spark: SparkSession, folder: str) -> DataFrame:
    """URLs that may be of articles."""
    return table(spark, folder, URLS).select("url").where(urls.is_content(F.col("url"))).distinct()


@query(rf"""SELECT DISTINCT url, string_split(trim(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '/'), '/')[-1] AS slug,
 string_split(source, '/')[-1] || '_' || left(md5(url), 12) AS record_id, regexp_extract(url, '^[^:]+://([^/?#]*)', 1) AS host FROM {URLS}""")
def url_slug_record_id(spark: SparkSession, folder: str) -> DataFrame:
    """Slug, record id and host of each URL."""
    u = F.col("url")
    return table(spark, folder, URLS).select("url", urls.slug(u).alias("slug"), urls.record_id(F.col("source"), u).alias("record_id"), urls.host(u).alias("host")).distinct()


@query(f"""SELECT doc_id, md5({_collapse("regexp_replace(coalesce(text, ''), '<.*?>', '', 'g')")}) AS clean_md5 FROM documents""")
def strip_tags_text(spark: SparkSession, folder: str) -> DataFrame:
    """Texts without tags and odd spacing, as hashes."""
    return table(spark, folder, "documents").select("doc_id", F.md5(text.clean(F.col("text"))).alias("clean_md5"))


_NORMAL = _strip(
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '[" + _W + "]+', ' ', 'g'), '[\\x{200b}\\x{200c}\\x{200d}\\x{feff}]', '', 'g'), '[.]{3,}', '...', 'g'), '[-]{3,}', '---', 'g')"
)


@query(f"SELECT doc_id, md5({_NORMAL}) AS normal_md5 FROM documents")
def normalise_text(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with normal spacing and punctuation, entities as they are, as hashes."""
    return table(spark, folder, "documents").select("doc_id", F.md5(text.normalise(F.col("text"), entities=False)).alias("normal_md5"))


@query()
def normalise_text_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with normal spacing and punctuation, entities resolved, as hashes.  No SQL: DuckDB has no decoder."""
    return table(spark, folder, "documents").select("doc_id", F.md5(text.normalise(F.col("text"))).alias("normal_md5"))


@query(f"""SELECT doc_id, CAST(n AS BIGINT) AS words, CAST(greatest(1, round_even(n / 200.0, 0)) AS BIGINT) AS minutes
 FROM (SELECT doc_id, len({_words("coalesce(text, '')")}) AS n FROM documents)""")
def word_count_reading_time(spark: SparkSession, folder: str) -> DataFrame:
    """Words and reading minutes of each document."""
    counted = table(spark, folder, "documents").select("doc_id", text.word_count(F.col("text")).cast("long").alias("words"))
    return counted.withColumn("minutes", text.reading_minutes(F.col("words")).cast("long"))


@query("SELECT doc_id, CASE WHEN length(text) > 500 THEN regexp_replace(left(text, 500), ' [^ ]*$', '') || '...' ELSE text END AS description FROM documents")
def description_truncate(spark: SparkSession, folder: str) -> DataFrame:
    """Texts cut to descriptions at a word."""
    return table(spark, folder, "documents").select("doc_id", text.truncate_words(F.col("text"), 500).alias("description"))


@query(f"""SELECT doc_id, {_strip("CASE WHEN length(ended) > 151 THEN ended WHEN length(w) > 300 THEN regexp_replace(left(w, 300), ' [^ ]*$', '') || '...' ELSE w END")} AS excerpt FROM
 (SELECT doc_id, left(coalesce(text, ''), 600) AS w, regexp_extract(left(coalesce(text, ''), 300), '(?s)^(.*[.!?]) ', 1) AS ended FROM documents)""")
def excerpt(spark: SparkSession, folder: str) -> DataFrame:
    """Texts cut to excerpts at a sentence end."""
    return table(spark, folder, "documents").select("doc_id", text.excerpt(F.col("text")).alias("excerpt"))


@query(f"""SELECT DISTINCT id, {_collapse(f"regexp_replace(coalesce(title, ''), '[{_W}]*[-|–—][{_W}]*[^-|–—]+$', '')")} AS title FROM {CONTENT}""")
def title_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Titles without what follows their last dash."""
    return table(spark, folder, CONTENT).select("id", text.clean_title(F.col("title"), entities=False).alias("title")).distinct()


@query()
def title_clean_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Titles with entities resolved, without what then follows their last dash.  No SQL: DuckDB has no decoder."""
    return table(spark, folder, CONTENT).select("id", text.clean_title(F.col("title")).alias("title")).distinct()


_STOP = "[" + ", ".join(f"'{w}'" for w in text.STOPWORDS) + "]"


def _keywords(x: str, n: int) -> str:
    return f"""list_slice(list_filter({_words(rf"regexp_replace(lower(coalesce({x}, '')), '[^\pL\pN\pM\p{{Pc}}{_W}]', ' ', 'g')")}, lambda w: length(w) > 2 AND NOT list_contains({_STOP}, w)), 1, {n})"""


@query(f"SELECT DISTINCT id, array_to_string({_keywords('title', 5)}, ' ') AS keywords, array_to_string(list_slice({_keywords('title', 5)}, 1, 4), ' ') AS query FROM {CONTENT}")
def keywords(spark: SparkSession, folder: str) -> DataFrame:
    """Keywords of titles and the search query they make."""
    t = F.col("title")
    return table(spark, folder, CONTENT).select("id", F.array_join(text.keywords(t), " ").alias("keywords"), text.search_query(t, F.lit(None).cast("string")).alias("query")).distinct()


@query(f"SELECT DISTINCT id, coalesce(lower(left(nullif(locale, ''), 2)), 'en') AS locale, translate(lower(coalesce(slug, '')), '-_', '  ') AS slug_words FROM {CONTENT}")
def locale_and_slug(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of records, and slugs as words."""
    return table(spark, folder, CONTENT).select("id", text.locale(F.col("locale")).alias("locale"), F.lower(text.slug_query(F.lower("slug"))).alias("slug_words")).distinct()


@query(rf"""SELECT doc_id, CAST(len(l) AS BIGINT) AS links, CAST(len(list_distinct(l)) AS BIGINT) AS distinct_links
 FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '<a\s[^>]*href="([^"]*)"', 1) AS l FROM documents)""")
def distinct_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links in the markup of each document, and how many differ."""
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))
    return table(spark, folder, "documents").select("doc_id", F.size(found).cast("long").alias("links"), F.size(F.array_distinct(found)).cast("long").alias("distinct_links"))


@query(rf"""SELECT DISTINCT id, published_at, epoch_us(try_cast(published_at AS TIMESTAMPTZ)) AS micros FROM {CONTENT}
 WHERE regexp_matches(published_at, '^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}(\.\d{{1,6}})?Z$') AND try_cast(published_at AS TIMESTAMPTZ) IS NOT NULL""")
def iso_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Instants of the dates in strict ISO form, impossible dates left out."""
    rows = table(spark, folder, CONTENT).where(F.col("published_at").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z$"))
    return rows.select("id", "published_at", F.unix_micros(dates.iso_instant(F.col("published_at"))).alias("micros")).where("micros IS NOT NULL").distinct()


@query()
def iso_instants(spark: SparkSession, folder: str) -> DataFrame:
    """Instants of the dates in all forms that `iso_instant` reads: with Z, an offset or no zone, or a date alone; impossible dates left out.  No SQL: DuckDB reads other forms."""
    rows = table(spark, folder, CONTENT).select("id", "published_at", F.unix_micros(dates.iso_instant(F.col("published_at"))).alias("micros"))
    return rows.where("micros IS NOT NULL").distinct()


@query(f"""SELECT CAST(n AS BIGINT) AS records, CAST((n + 99) // 100 AS BIGINT) AS batches FROM (SELECT count(*) AS n FROM {RECORDS})""")
def batch_count(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of a hundred."""
    return table(spark, folder, RECORDS).agg(F.count("*").alias("records")).withColumn("batches", dates.batches(F.col("records"), 100))


@query(f"SELECT crawl_id, (epoch_us(end_time) - epoch_us(start_time)) / 1e6 AS seconds FROM {CHECKPOINTS}")
def durations(spark: SparkSession, folder: str) -> DataFrame:
    """Seconds each run took; null while it runs."""
    return table(spark, folder, CHECKPOINTS).select("crawl_id", dates.seconds_between(F.col("start_time"), F.col("end_time")).alias("seconds"))


# --- joins with the state


_LAST = f"(SELECT max(snapshot_date) FROM {URLS})"
_FIRST = f"(SELECT min(snapshot_date) FROM {URLS})"


def _by_date(spark: SparkSession, folder: str, which: str) -> DataFrame:
    rows = table(spark, folder, URLS)
    edge = rows.agg(F.expr(f"{which}(snapshot_date)").alias("edge"))
    return rows.join(F.broadcast(edge), F.col("snapshot_date") == F.col("edge")).drop("edge")


@query(f"SELECT DISTINCT bigquery_id, record_id FROM {RECORDS} r WHERE scrape_status = 'success' AND EXISTS (SELECT 1 FROM {CMS} c WHERE c.id = r.strapi_id AND c.content_type = r.collection)")
def delivered_semi(spark: SparkSession, folder: str) -> DataFrame:
    """Tracked successes that the sink holds."""
    tracked = table(spark, folder, RECORDS).where("scrape_status = 'success'").withColumns({"id": F.col("strapi_id"), "content_type": F.col("collection")})
    return state.present(tracked, table(spark, folder, CMS).select("id", "content_type"), ["id", "content_type"]).select("bigquery_id", "record_id").distinct()


@query(f"SELECT record_id FROM {RECORDS} r WHERE NOT EXISTS (SELECT 1 FROM {CMS} c WHERE c.id = r.strapi_id AND c.content_type = r.collection)")
def undelivered_anti(spark: SparkSession, folder: str) -> DataFrame:
    """Tracked records that the sink lacks."""
    tracked = table(spark, folder, RECORDS).withColumns({"id": F.col("strapi_id"), "content_type": F.col("collection")})
    return state.absent(tracked, table(spark, folder, CMS), ["id", "content_type"]).select("record_id")


@query(f"SELECT source, count(DISTINCT url) AS new_urls FROM {URLS} WHERE snapshot_date = {_LAST} AND url NOT IN (SELECT url FROM {URLS} WHERE snapshot_date = {_FIRST}) GROUP BY source")
def new_urls(spark: SparkSession, folder: str) -> DataFrame:
    """URLs of the last snapshot that the first lacks, per source."""
    new = state.absent(_by_date(spark, folder, "max"), _by_date(spark, folder, "min"), ["url"])
    return new.groupBy("source").agg(F.countDistinct("url").alias("new_urls"))


@query(f"""SELECT DISTINCT url FROM {URLS} WHERE snapshot_date = {_LAST} AND url NOT IN (SELECT url FROM {URLS} WHERE snapshot_date = {_LAST} AND scrape_status = 'success')""")
def full_work_list(spark: SparkSession, folder: str) -> DataFrame:
    """URLs a full run has to fetch: listed, and no success yet."""
    now = _by_date(spark, folder, "max")
    return state.absent(now.select("url").distinct(), now.where("scrape_status = 'success'"), ["url"])


@query(f"""SELECT source, count(DISTINCT url) AS removed FROM {URLS} WHERE snapshot_date = {_FIRST} AND url NOT IN (SELECT url FROM {URLS} WHERE snapshot_date = {_LAST}) GROUP BY source""")
def sync_delete(spark: SparkSession, folder: str) -> DataFrame:
    """URLs of the first snapshot that the last no longer lists, which a synchronisation deletes, per source."""
    _, removed = state.without_absent(_by_date(spark, folder, "min"), _by_date(spark, folder, "max"), ["url"], F.lit(True))
    return removed.groupBy("source").agg(F.countDistinct("url").alias("removed"))


@query(f"SELECT DISTINCT id FROM {CONTENT} WHERE id IN (SELECT bigquery_id FROM {URLS} WHERE bigquery_id IS NOT NULL)")
def existing_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of the sink that the state knows."""
    known = table(spark, folder, URLS).where("bigquery_id IS NOT NULL").select(F.col("bigquery_id").alias("id"))
    return state.present(table(spark, folder, CONTENT).select("id"), known, ["id"]).distinct()


@query(f"""SELECT url, min(snapshot_date) AS since FROM {URLS} GROUP BY url""")
def insert_absent(spark: SparkSession, folder: str) -> DataFrame:
    """The state after all snapshots are inserted one after another: of each URL the first row stays."""
    rows = table(spark, folder, URLS).select("url", "snapshot_date")
    empty = rows.where(F.lit(False))
    return state.insert_absent(empty, rows, ["url"], [F.col("snapshot_date")]).select("url", F.col("snapshot_date").alias("since"))


@query(f"""WITH e AS (SELECT url, scrape_status, error_message, snapshot_date FROM {URLS} WHERE snapshot_date > {_FIRST}),
s AS (SELECT url, max(scrape_count) AS c0, max(error_message) AS e0 FROM {URLS} WHERE snapshot_date = {_FIRST} GROUP BY url),
m AS (SELECT url, count(*) AS n, max(snapshot_date) AS last_date, arg_max(error_message, (snapshot_date, error_message)) FILTER (error_message IS NOT NULL) AS e1 FROM e GROUP BY url)
SELECT url, CAST(coalesce(c0, 0) + coalesce(n, 0) AS BIGINT) AS attempts, coalesce(e1, e0) AS error, last_date FROM s LEFT JOIN m USING (url)""")
def apply_events(spark: SparkSession, folder: str) -> DataFrame:
    """The first snapshot's state after the later rows are applied as events: last time, kept errors, counted attempts."""
    rows = table(spark, folder, URLS)
    first = _by_date(spark, folder, "min").groupBy("url").agg(F.max("scrape_count").alias("attempts"), F.max("error_message").alias("error"))
    first = first.select("url", F.coalesce("attempts", F.lit(0)).cast("long").alias("attempts"), "error", F.lit(None).cast("date").alias("last_date"))
    edge = rows.agg(F.min("snapshot_date").alias("edge"))
    events = rows.join(F.broadcast(edge), F.col("snapshot_date") > F.col("edge")).select("url", "snapshot_date", F.col("error_message").alias("problem"))
    return state.apply_events(first, events, ["url"], ["snapshot_date"], {"last_date": "snapshot_date"}, {"error": "problem"}, "attempts")


@query(f"""SELECT record_id, CASE WHEN scrape_status = 'failed' THEN 'pending' ELSE scrape_status END AS scrape_status,
 CASE WHEN scrape_status = 'failed' THEN NULL ELSE error_message END AS error_message FROM {RECORDS}""")
def reset_failed(spark: SparkSession, folder: str) -> DataFrame:
    """Failed records made pending again."""
    failed = F.coalesce(F.col("scrape_status") == "failed", F.lit(False))
    rows = table(spark, folder, RECORDS).select("record_id", "scrape_status", "error_message")
    return state.reset(rows, failed, {"scrape_status": F.lit("pending"), "error_message": F.lit(None).cast("string")})


# --- statistics


_STATUS_SUMS = ", ".join(f"CAST(count(*) FILTER (scrape_status = '{s}') AS BIGINT) AS {s}" for s in schemas.STATUSES)
_GROUP_SUMS = ", ".join(f"CAST(count(*) FILTER (scrape_status = '{s}') AS BIGINT) AS {s}" for s in ("success", "pending", "failed"))


@query(f"SELECT count(*) AS total, {_STATUS_SUMS}, max(last_scraped) AS last_scraped FROM {RECORDS}")
def cms_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over the CMS state."""
    return stats.totals(table(spark, folder, RECORDS))


@query(f"SELECT count(*) AS total, {_STATUS_SUMS}, max(last_scraped) AS last_scraped FROM {RECORDS} WHERE source = 'no such source'")
def cms_totals_empty(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over nothing: one row."""
    return stats.totals(state.equals(table(spark, folder, RECORDS), source="no such source", collection=None))


@query(f"SELECT source, collection, count(*) AS total, {_GROUP_SUMS}, max(last_scraped) AS last_scraped FROM {RECORDS} GROUP BY source, collection")
def cms_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    """Totals per source and collection."""
    return stats.breakdown(table(spark, folder, RECORDS), ["source", "collection"])


@query(f"SELECT key, count(*) AS total, CAST(count(*) FILTER (scrape_status = 'success') AS BIGINT) AS success FROM (SELECT source || '/' || collection AS key, scrape_status FROM {RECORDS}) GROUP BY key")
def cms_breakdown_json(spark: SparkSession, folder: str) -> DataFrame:
    """The breakdown as one JSON object, read again: key, total, successes."""
    packed = stats.breakdown_json(table(spark, folder, RECORDS), ["source", "collection"])
    entries = F.from_json("breakdown", "map<string, struct<total: long, success: long>>")
    return packed.select(F.explode(entries).alias("key", "v")).select("key", "v.total", "v.success")


@query(f"SELECT count(*) AS total, {_STATUS_SUMS}, max(last_scraped) AS last_scraped FROM {URLS}")
def wp_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals over the URL state."""
    return stats.totals(table(spark, folder, URLS))


@query(f"SELECT source, count(*) AS total, {_GROUP_SUMS}, max(last_scraped) AS last_scraped FROM {URLS} GROUP BY source")
def wp_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    """Totals per site."""
    return stats.breakdown(table(spark, folder, URLS), ["source"])


@query(f"SELECT source, count(*) AS total_records, min(published_at) AS earliest, max(published_at) AS latest, max(processing_timestamp) AS last_processed FROM {CMS} GROUP BY source")
def source_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Records and dates per source of the sink."""
    return stats.source_stats(table(spark, folder, CMS))


@query(f"SELECT source, CASE WHEN count(*) > 0 THEN round(count(*) FILTER (scrape_status = 'success') / count(*) * 100, 1) ELSE 0.0 END AS rate FROM {URLS} GROUP BY source")
def success_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Percent of successes per site."""
    groups = stats.breakdown(table(spark, folder, URLS), ["source"])
    return groups.select("source", stats.success_rate(F.col("success"), F.col("total")).alias("rate"))


@query(f"""SELECT pipeline, CAST(coalesce(sum(total_items), 0) AS BIGINT) AS total_items, CAST(coalesce(sum(successful_items), 0) AS BIGINT) AS successful_items,
 CAST(coalesce(sum(failed_items), 0) AS BIGINT) AS failed_items FROM {CHECKPOINTS} GROUP BY ROLLUP (pipeline)""")
def run_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Items of all runs per pipeline and together."""
    return stats.run_totals(table(spark, folder, CHECKPOINTS), ["pipeline"], ["total_items", "successful_items", "failed_items"])


@query(f"""WITH l AS (SELECT content_type AS collection, count(*) AS total FROM {CMS} GROUP BY content_type),
t AS (SELECT collection, count(*) AS tracked, count(*) FILTER (scrape_status = 'pending') AS pending FROM {RECORDS} GROUP BY collection)
SELECT collection, total, CAST(coalesce(tracked, 0) AS BIGINT) AS tracked, CAST(coalesce(pending, 0) AS BIGINT) AS pending,
 CAST(greatest(0, total - coalesce(tracked, 0) + coalesce(pending, 0)) AS BIGINT) AS new_estimate FROM l LEFT JOIN t USING (collection)""")
def new_estimate(spark: SparkSession, folder: str) -> DataFrame:
    """Estimated new records per collection."""
    listed = table(spark, folder, CMS).groupBy(F.col("content_type").alias("collection")).agg(F.count("*").alias("total"))
    return stats.new_estimate(listed, stats.breakdown(table(spark, folder, RECORDS), ["collection"]), ["collection"])


@query(f"SELECT strftime(created_at, '%Y-%m-%d') AS day, count(*) AS records FROM {CONTENT} GROUP BY day")
def records_per_day(spark: SparkSession, folder: str) -> DataFrame:
    """Records per day of creation: the sink's partitions."""
    return table(spark, folder, CONTENT).groupBy(F.date_format("created_at", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("records"))


@query("SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, event_type AS status, count(*) AS n FROM events GROUP BY day, status")
def status_per_day(spark: SparkSession, folder: str) -> DataFrame:
    """State events per day and status, by the plan that also runs on a stream."""
    counts = incremental.status_counts(table(spark, folder, "events"), "ts", "event_type")
    return counts.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "status", "n")


@query(f"""SELECT (scrape_status IS NULL OR scrape_status IN ('pending', 'success', 'failed', 'skipped')) AND record_id IS NOT NULL AND source IS NOT NULL AS valid, count(*) AS n FROM {RECORDS} GROUP BY valid""")
def constraints(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that satisfy the state's constraints and rows that don't."""
    good, bad = schemas.checked(table(spark, folder, RECORDS), {"scrape_status": schemas.STATUSES}, ["record_id", "source"])
    parts = good.withColumn("valid", F.lit(True)).unionByName(bad.withColumn("valid", F.lit(False)))
    return parts.groupBy("valid").agg(F.count("*").alias("n"))


# --- the newest


@query(f"SELECT record_id, published_at FROM {RECORDS} WHERE scrape_status = 'pending' ORDER BY published_at DESC NULLS FIRST, record_id LIMIT 100")
def pending_newest(spark: SparkSession, folder: str) -> DataFrame:
    """Pending records, newest first, those without date before them."""
    return state.newest(state.equals(table(spark, folder, RECORDS), scrape_status="pending"), "published_at", 100, nulls_first=True, key="record_id").select("record_id", "published_at")


@query(f"SELECT published_at FROM {RECORDS} WHERE scrape_status = 'success' ORDER BY published_at DESC NULLS FIRST LIMIT 1")
def last_published(spark: SparkSession, folder: str) -> DataFrame:
    """The date of the newest success; null if any has none."""
    return state.newest(state.equals(table(spark, folder, RECORDS), scrape_status="success"), "published_at", 1, nulls_first=True).select("published_at")


@query(f"SELECT record_id, last_scraped, error_message FROM {RECORDS} WHERE scrape_status = 'failed' ORDER BY last_scraped DESC NULLS LAST, record_id LIMIT 100")
def failed_newest(spark: SparkSession, folder: str) -> DataFrame:
    """The last failures."""
    return state.newest(state.equals(table(spark, folder, RECORDS), scrape_status="failed"), "last_scraped", 100, key="record_id").select("record_id", "last_scraped", "error_message")


@query(f"SELECT record_id, last_scraped FROM {RECORDS} WHERE last_scraped IS NOT NULL ORDER BY last_scraped DESC, record_id LIMIT 50")
def recent(spark: SparkSession, folder: str) -> DataFrame:
    """What was scraped last."""
    return state.newest(table(spark, folder, RECORDS).where("last_scraped IS NOT NULL"), "last_scraped", 50, key="record_id").select("record_id", "last_scraped")


@query(f"SELECT crawl_id, start_time, status FROM {CHECKPOINTS} WHERE pipeline = 'wp' ORDER BY start_time DESC NULLS LAST, crawl_id LIMIT 10")
def recent_checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    """The last runs of a pipeline."""
    return state.newest(state.equals(table(spark, folder, CHECKPOINTS), pipeline="wp"), "start_time", 10, key="crawl_id").select("crawl_id", "start_time", "status")


@query(f"SELECT crawl_id, start_time FROM {CHECKPOINTS} WHERE status = 'running' ORDER BY start_time DESC NULLS LAST, crawl_id LIMIT 1")
def active_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """The run that is under way."""
    return state.newest(state.equals(table(spark, folder, CHECKPOINTS), status="running"), "start_time", 1, key="crawl_id").select("crawl_id", "start_time")


# --- records and pages


@query(f"SELECT DISTINCT ON (id) id, source, 'post' AS content_type, left(title, 500) AS title, left(slug, 200) AS slug, coalesce(locale, 'en') AS locale FROM (SELECT DISTINCT id, source, title, slug, locale FROM {CONTENT}) ORDER BY id, source, title, slug, locale NULLS FIRST")
def sink_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The sink's plain columns, one row per id however often a record came."""
    rows = table(spark, folder, CONTENT).select("id", "source", "title", "slug", "locale").distinct()
    once = state.first_by(rows, ["id"], [F.col("source"), F.col("title"), F.col("slug"), F.col("locale")])
    return once.select("id", "source", F.lit("post").alias("content_type"), F.left("title", F.lit(sink.TITLE)).alias("title"), F.left("slug", F.lit(sink.SLUG)).alias("slug"), F.coalesce("locale", F.lit("en")).alias("locale"))


_IDS = "list_filter(json_extract_string(attributes, '$.applications.data[*].id'), lambda x: x IS NOT NULL AND x NOT IN ('', '0', 'false'))"


@query(f"""SELECT DISTINCT source AS stored_source, content_type, id, CASE len({_IDS}) WHEN 0 THEN '0' WHEN 1 THEN {_IDS}[1] ELSE '[' || array_to_string({_IDS}, ', ') || ']' END AS app_source,
 {_collapse("regexp_replace(coalesce(json_extract_string(attributes, '$.title'), ''), '<.*?>', '', 'g')")} AS clean_title,
 CASE WHEN json_type(attributes, '$.slug') IS NULL THEN '' ELSE json_extract_string(attributes, '$.slug') END AS clean_slug
 FROM {CMS} WHERE json_valid(attributes) AND json_type(attributes) = 'OBJECT' AND coalesce(json_type(attributes, '$.title'), 'NULL') IN ('VARCHAR', 'NULL')""")
def cms_structured(spark: SparkSession, folder: str) -> DataFrame:
    """Source by application, cleaned title and slug of the CMS records that can be structured."""
    rows = table(spark, folder, CMS).select(F.col("source").alias("stored_source"), "content_type", "id", "attributes")
    return jsonattrs.structured(rows).where("problem IS NULL").select("stored_source", "content_type", "id", "app_source", "clean_title", "clean_slug").distinct()


_MEDIA = ["feature_image", "cover_image", "widgetPicture", "photo"]


@query(f"""SELECT DISTINCT source AS stored_source, content_type, id, {", ".join(f"nullif(json_extract_string(attributes, '$.{m}.data.attributes.url'), '') AS {m}" for m in _MEDIA)}
 FROM {CMS} WHERE json_valid(attributes) AND json_type(attributes) = 'OBJECT' AND coalesce(json_type(attributes, '$.title'), 'NULL') IN ('VARCHAR', 'NULL')""")
def cms_media(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses of the CMS records' own images."""
    rows = table(spark, folder, CMS).select(F.col("source").alias("stored_source"), "content_type", "id", "attributes")
    done = jsonattrs.structured(rows).where("problem IS NULL")
    return done.select("stored_source", "content_type", "id", *[F.get_json_object("flat_json", f"$.{m}.url").alias(m) for m in _MEDIA]).distinct()


_NAMES = "title name fullname slug country countryCode".split()


@query(f"""WITH r AS (SELECT DISTINCT source AS stored_source, content_type, id, attributes FROM {CMS} WHERE json_valid(attributes) AND json_type(attributes) = 'OBJECT' AND coalesce(json_type(attributes, '$.title'), 'NULL') IN ('VARCHAR', 'NULL')),
items AS (SELECT stored_source, content_type, id, unnest(CASE json_type(attributes, '$.categories.data') WHEN 'ARRAY' THEN json_extract(attributes, '$.categories.data[*]') WHEN 'OBJECT' THEN [json_extract(attributes, '$.categories.data')] ELSE [] END) AS item FROM r),
own AS (SELECT *, json_extract(item, '$.attributes') AS a FROM items WHERE json_type(item) = 'OBJECT')
SELECT DISTINCT stored_source, content_type, id, {", ".join(f"json_extract_string(a, '$.{n}') AS {n}" for n in _NAMES)} FROM own
 WHERE json_type(a) = 'OBJECT' AND len(list_intersect(json_keys(a), [{", ".join(f"'{n}'" for n in _NAMES)}])) > 0""")
def cms_relations(spark: SparkSession, folder: str) -> DataFrame:
    """The CMS records' categories: what names each, in columns."""
    rows = table(spark, folder, CMS).select(F.col("source").alias("stored_source"), "content_type", "id", "attributes")
    done = jsonattrs.structured(rows).where("problem IS NULL")
    listed = F.from_json(F.get_json_object("flat_json", "$.categories"), "array<map<string, string>>")
    one = done.select("stored_source", "content_type", "id", F.explode(listed).alias("r"))
    return one.select("stored_source", "content_type", "id", *[F.try_element_at("r", F.lit(n)).alias(n) for n in _NAMES]).distinct()


@query()
def cms_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """CMS records flattened: source by application, cleaned title, kept attributes, links, problems."""
    rows = table(spark, folder, CMS).select(F.col("source").alias("stored_source"), "content_type", "id", "attributes")
    done = jsonattrs.structured(rows)
    return done.select("stored_source", "content_type", "id", "app_source", "clean_title", "flat_json", "n_sources", "problem").distinct()


@query()
def page_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Texts read as pages: what metadata, links and content their markup gives."""
    pages = table(spark, folder, "documents").select(F.concat(F.lit("https://"), "source", F.lit(".example/"), "doc_id").alias("url"), F.col("text").alias("html"))
    read = markup.articles(pages)
    return read.select("url", "ok", "error", F.size("article.sources").alias("n_sources"), F.size("article.images").alias("n_images"), F.length("article.content").alias("n_chars"), F.col("article.content_hash").alias("content_hash"))
