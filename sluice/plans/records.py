"""Queries of whole records: runs, sink rows, checkpoints, names, enrichment, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import schemas
from sluice.functions import jsonattrs, text
from sluice.operators import enrich, sink, state, stats
from sluice.plans import ingestion, jobs
from sluice.plans.ingestion import _IDS, _LAST, CHECKPOINTS, CMS, CONTENT, URLS, Query, _collapse, _keywords
from sluice.session import table
from sluice.sources import cms

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

NOW = "2025-01-01 00:00:00"


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def _now() -> Column:
    return F.to_timestamp(F.lit(NOW))


def _valid(column: str) -> Column:
    return F.try_parse_json(column).isNotNull()


def _values(name: str, columns: str, rows: list[tuple]) -> str:
    """A table in SQL; the same rows that `createDataFrame` is given."""
    cell = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return f"{name}({columns}) AS (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)})"


def _capital(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"


# --- names and ids


@query(f"SELECT DISTINCT content_type, {_capital("trim(replace(replace(content_type, '_', ' '), 'url', ''), ' ')")} AS shown FROM {CMS}")
def display_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names of fields for display."""
    return table(spark, folder, CMS).select("content_type", text.display_name(F.col("content_type")).alias("shown")).distinct()


@query(f"SELECT DISTINCT id, {_capital("translate(coalesce(slug, ''), '-_', '  ')")} AS title FROM {CONTENT}")
def slug_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Slugs as titles."""
    return table(spark, folder, CONTENT).select("id", text.slug_query(F.col("slug")).alias("title")).distinct()


@query("SELECT doc_id, coalesce(nullif(left(regexp_replace(coalesce(text, ''), '<[^>]+>', '', 'g'), 200), ''), 'Image from Wikipedia') AS about FROM documents")
def short_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as short descriptions of images, with a default."""
    return table(spark, folder, "documents").select("doc_id", text.short_description(F.col("text"), F.lit("Image from Wikipedia")).alias("about"))


@query(f"SELECT DISTINCT source, content_type, id, concat_ws('_', source, content_type, id) AS joined, replace('File:' || title, 'File:', '') AS file FROM {CMS}")
def joined_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of records, and file names without their prefix."""
    rows = table(spark, folder, CMS)
    joined = text.joined_id(F.col("source"), F.col("content_type"), F.col("id"))
    return rows.select("source", "content_type", "id", joined.alias("joined"), text.without_prefix(F.concat(F.lit("File:"), F.col("title"))).alias("file")).distinct()


_CATEGORY = "CASE WHEN json_valid(attributes) THEN json_extract_string(attributes, '$.categories[0]') END"


@query(f"""WITH r AS (SELECT DISTINCT id, title, {_CATEGORY} AS category FROM {CONTENT})
SELECT DISTINCT id, array_to_string(list_slice(k, 1, 4), ' ') AS query, array_to_string(list_slice(k, 1, 2), ' ') AS wider FROM (SELECT id, list_concat({_keywords('title', 5)}, {_keywords('category', 2)}) AS k FROM r)""")
def search_queries(spark: SparkSession, folder: str) -> DataFrame:
    """The queries an enrichment asks: of title and first category, and a wider one."""
    category = F.when(_valid("attributes"), F.get_json_object("attributes", "$.categories[0]"))
    return table(spark, folder, CONTENT).select("id", text.search_query(F.col("title"), category).alias("query"), text.fallback_query(F.col("title"), category).alias("wider")).distinct()


# --- checkpoints and state


@query(f"SELECT crawl_id, pipeline, status, total_items FROM {CHECKPOINTS} WHERE crawl_id = (SELECT min(crawl_id) FROM {CHECKPOINTS})")
def checkpoint_by_id(spark: SparkSession, folder: str) -> DataFrame:
    """One checkpoint, by its id."""
    rows = table(spark, folder, CHECKPOINTS)
    first = rows.agg(F.min("crawl_id")).head()[0]  # one value
    return state.equals(rows, crawl_id=first).select("crawl_id", "pipeline", "status", "total_items")


@query(f"""SELECT crawl_id, CASE WHEN status = 'running' THEN 'completed' ELSE status END AS status, CASE WHEN status = 'running' THEN coalesce(total_items, processed_items) ELSE processed_items END AS processed_items,
 last_item_id, CASE WHEN status = 'running' THEN coalesce(end_time, start_time + INTERVAL 1 HOUR) ELSE end_time END AS end_time FROM {CHECKPOINTS} WHERE source IS NOT NULL""")
def checkpoint_updates(spark: SparkSession, folder: str) -> DataFrame:
    """The checkpoints after all running ones are reported complete: blank values change nothing, the end is stamped once."""
    known = table(spark, folder, CHECKPOINTS).where("source IS NOT NULL").select(*[F.col(c.split()[0]) for c in schemas.CHECKPOINTS.split(", ")])
    running = known.where("status = 'running'")
    none = F.lit(None).cast("int")
    updates = running.select(
        "crawl_id", "source", F.expr("start_time + INTERVAL 1 HOUR").alias("at"), F.lit("completed").alias("status"), F.col("total_items").alias("processed_items"),
        none.alias("successful_items"), none.alias("failed_items"), F.lit("").alias("last_item_id"),
    )
    return jobs.update_checkpoints(known, updates).select("crawl_id", "status", "processed_items", "last_item_id", "end_time")


@query(f"""SELECT 'run' AS crawl_id, 'cms' AS pipeline, source, 'full' AS mode, count(*) AS total_items, 'completed' AS status FROM {CMS} GROUP BY source""")
def checkpoint_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A finished checkpoint per source."""
    counts = table(spark, folder, CMS).groupBy("source").agg(F.count("*").alias("fetched"), F.count("*").alias("inserted"), F.lit(0).alias("failed"))
    return jobs.checkpoint(counts, "run", "cms", "full", _now(), _now()).select("crawl_id", "pipeline", "source", "mode", F.col("total_items").cast("long").alias("total_items"), "status")


@query(f"SELECT DISTINCT url FROM {URLS} WHERE snapshot_date = {_LAST} AND url NOT IN (SELECT url FROM {URLS} WHERE snapshot_date = {_LAST} AND scrape_status = 'failed')")
def urls_deleted(spark: SparkSession, folder: str) -> DataFrame:
    """The last snapshot's URLs after those that failed are deleted."""
    now = ingestion._by_date(spark, folder, "max")
    return state.delete_keys(now, now.where("scrape_status = 'failed'"), ["url"]).select("url").distinct()


# --- sink rows and runs

_OBJECT = "json_valid(attributes) AND json_type(attributes) = 'OBJECT'"
_PROBLEM = f"""CASE WHEN attributes IS NULL OR NOT json_valid(attributes) THEN 'attributes are no JSON' WHEN json_type(attributes) <> 'OBJECT' THEN 'attributes are no object'
 WHEN coalesce(json_type(attributes, '$.title'), 'NULL') NOT IN ('VARCHAR', 'NULL') THEN 'title is no text' END"""
_APP = f"CASE len({_IDS}) WHEN 0 THEN '0' WHEN 1 THEN {_IDS}[1] ELSE '[' || array_to_string({_IDS}, ', ') || ']' END"
_TITLE = _collapse("regexp_replace(coalesce(json_extract_string(attributes, '$.title'), ''), '<.*?>', '', 'g')")
_SLUG = "CASE WHEN json_type(attributes, '$.slug') IS NULL THEN '' ELSE json_extract_string(attributes, '$.slug') END"
_LOCALE = "CASE WHEN json_type(attributes, '$.locale') IS NULL THEN 'en' ELSE json_extract_string(attributes, '$.locale') END"


@query(f"SELECT DISTINCT id, {_APP} AS source, content_type, {_TITLE} AS title, {_SLUG} AS slug, {_LOCALE} AS locale, '[]' AS external_images FROM {CMS} WHERE id IS NOT NULL AND {_PROBLEM} IS NULL")
def cms_sink_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of CMS records for the sink."""
    rows = table(spark, folder, CMS).select(F.col("content_type").alias("collection"), "id", "attributes")
    return sink.cms_rows(jsonattrs.structured(rows), _now()).select("id", "source", "content_type", "title", "slug", "locale", "external_images").distinct()


def _cms_run(spark: SparkSession, folder: str) -> jobs.Run:
    fetched = table(spark, folder, CMS).select(F.lit("main").alias("cms_key"), F.col("content_type").alias("collection"), F.lit("all").alias("source"), "id", "attributes")
    return jobs.cms_run(fetched, spark.createDataFrame([], schemas.CMS_STATE), spark.createDataFrame([], schemas.SINK), _now())


# Of records repeated under a key the least is taken, and a null is less than any text.
_FETCHED = f"WITH f AS (SELECT content_type, id, CASE WHEN count(*) > count(attributes) THEN NULL ELSE min(attributes) END AS attributes FROM {CMS} WHERE id IS NOT NULL GROUP BY content_type, id)"


@query(f"""{_FETCHED}, p AS (SELECT content_type, id, {_PROBLEM} AS problem FROM f)
SELECT concat_ws('_', 'main', content_type, id) AS record_id, id AS strapi_id, CASE WHEN problem IS NULL THEN 'success' ELSE 'failed' END AS scrape_status, problem AS error_message FROM p""")
def cms_run_state(spark: SparkSession, folder: str) -> DataFrame:
    """The tracking state after a first run over all CMS records."""
    return _cms_run(spark, folder).state.select("record_id", "strapi_id", "scrape_status", "error_message")


@query(f"{_FETCHED} SELECT id, {_APP} AS source, content_type, {_TITLE} AS title FROM f WHERE {_PROBLEM} IS NULL")
def cms_run_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What that run gives the sink."""
    return _cms_run(spark, folder).rows.select("id", "source", "content_type", "title")


@query(f"""{_FETCHED}, p AS (SELECT {_PROBLEM} AS problem FROM f)
SELECT 'all' AS source, count(*) + (SELECT count(*) FROM {CMS} WHERE id IS NULL) AS fetched, count(*) FILTER (problem IS NULL) AS inserted, count(*) FILTER (problem IS NOT NULL) + (SELECT count(*) FROM {CMS} WHERE id IS NULL) AS failed FROM p""")
def cms_run_counts(spark: SparkSession, folder: str) -> DataFrame:
    """And its counts."""
    return _cms_run(spark, folder).counts


_FIELDS = "title description content published_date modified_date author categories tags feature_image images sources original_url".split()


@query(rf"""WITH a AS (SELECT DISTINCT source, locale, {", ".join(f"json_extract_string(attributes, '$.{f}') AS {f}" for f in _FIELDS)} FROM {CONTENT} WHERE attributes IS NOT NULL AND {_OBJECT})
SELECT DISTINCT string_split(source, '/')[-1] || '_' || left(md5(original_url), 12) AS id, source, 'post' AS content_type, left(title, 500) AS title, left(string_split(trim(regexp_extract(original_url, '^[^:]+://[^/?#]*([^?#]*)', 1), '/'), '/')[-1], 200) AS slug,
 coalesce(locale, 'en') AS locale, '[]' AS external_images, CAST(len({ingestion._words("coalesce(content, '')")}) AS INTEGER) AS word_count, md5(content) AS content_md5,
 coalesce(epoch_us(CASE WHEN regexp_matches(published_date, '(?i)^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}(\.\d{{1,6}})?(Z|[+\-]\d{{2}}:\d{{2}})$') THEN try_cast(upper(published_date) AS TIMESTAMPTZ)
 WHEN regexp_matches(published_date, '(?i)^\d{{4}}-\d{{2}}-\d{{2}}([T ]\d{{2}}:\d{{2}}:\d{{2}})?$') THEN try_cast(upper(published_date) || CASE WHEN length(published_date) = 10 THEN ' 00:00:00' ELSE '' END || '+00:00' AS TIMESTAMPTZ) END), -1) AS published_micros FROM a WHERE original_url IS NOT NULL""")
def page_sink_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of scraped pages for the sink, from what was scraped of them."""
    own = table(spark, folder, CONTENT).where(_valid("attributes") & F.col("attributes").startswith("{"))
    articles = own.select("source", "locale", *[F.get_json_object("attributes", f"$.{f}").alias(f) for f in _FIELDS]).where("original_url IS NOT NULL").withColumn("url", F.col("original_url")).distinct()
    rows = sink.page_rows(articles, _now())
    return rows.select(
        "id", "source", "content_type", "title", "slug", "locale", "external_images", F.get_json_object("attributes", "$.word_count").cast("int").alias("word_count"),
        F.md5(F.get_json_object("attributes", "$.content")).alias("content_md5"), F.coalesce(F.unix_micros("published_at"), F.lit(-1)).alias("published_micros"),  # -1: not given in a form the feed may use
    ).distinct()


@query(f"SELECT DISTINCT source, content_type, id, array_to_string(list_sort(list_filter(json_keys(attributes), lambda k: NOT regexp_matches(k, '({'|'.join(jsonattrs.SYSTEM_SUFFIXES)})$'))), ' ') AS kept FROM {CMS} WHERE attributes IS NOT NULL AND {_OBJECT}")
def kept_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of CMS records that are no system fields."""
    rows = table(spark, folder, CMS).where(_valid("attributes") & F.ltrim("attributes").startswith("{"))
    keys = F.array_sort(jsonattrs.kept_keys(F.json_object_keys("attributes")))
    return rows.select("source", "content_type", "id", F.array_join(keys, " ").alias("kept")).distinct()


_SEO = {k: f"json_extract_string(attributes, '$.seo.{k}')" for k in jsonattrs.SEO_KEYS}


@query(f"""SELECT DISTINCT source AS stored_source, content_type, id, {", ".join(f"nullif({x if k == 'canonicalURL' else _collapse(f"regexp_replace({x}, '<.*?>', '', 'g')")}, '') AS \"{k}\"" for k, x in _SEO.items())}
 FROM {CMS} WHERE {_PROBLEM} IS NULL""")
def cms_seo(spark: SparkSession, folder: str) -> DataFrame:
    """What CMS records tell search engines."""
    rows = table(spark, folder, CMS).select(F.col("source").alias("stored_source"), "content_type", "id", "attributes")
    done = jsonattrs.structured(rows).where("problem IS NULL")
    return done.select("stored_source", "content_type", "id", *[F.nullif(F.get_json_object("flat_json", f"$.seo.{k}"), F.lit("")).alias(k) for k in jsonattrs.SEO_KEYS]).distinct()


# --- sources and enrichment


@query(f"""WITH p AS (SELECT content_type, CAST(length(coalesce(id, '')) % 3 + 1 AS INTEGER) AS page FROM {CMS})
SELECT content_type AS response_key, 3 AS page_count, CAST(max(total) AS BIGINT) AS total_available, count(*) FILTER (page <> 2) AS pages_read, CAST(coalesce(sum(n) FILTER (page <> 2), 0) AS BIGINT) AS fetched, coalesce(max(CASE WHEN page = 2 THEN '2' END), '') AS failed
 FROM (SELECT content_type, page, count(*) AS n, sum(count(*)) OVER (PARTITION BY content_type) AS total FROM p GROUP BY content_type, page) GROUP BY content_type""")
def page_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Pages and records read and to be had per collection, of pages made of the CMS table, the second of each lost."""
    rows = table(spark, folder, CMS).select("content_type", (F.length(F.coalesce("id", F.lit(""))) % 3 + 1).alias("page"), "id")
    # The table is small beside a collection's pages, and only ids go into a page's body.
    pages = rows.groupBy("content_type", "page").agg(F.to_json(F.struct(F.collect_list(F.struct("id")).alias("data"))).alias("body"), F.count("*").alias("n"))
    total = pages.groupBy(F.col("content_type").alias("c")).agg(F.sum("n").cast("int").alias("total"))
    lost = F.col("page") == 2
    made = pages.join(total, F.col("content_type") == F.col("c")).select(
        F.col("content_type").alias("response_key"), "page", F.lit(3).alias("page_count"), "total", F.when(lost, F.lit("no answer")).alias("problem"), F.when(~lost, F.col("body")).alias("body")
    )
    found = cms.page_stats(made)
    return found.select("response_key", "page_count", F.col("total_available").cast("long").alias("total_available"), "pages_read", "fetched", F.array_join("failed_pages", ",").alias("failed"))


@query(f"SELECT count(*) FILTER (external_images IS NOT NULL AND json_valid(external_images) AND json_type(external_images) = 'ARRAY' AND json_array_length(external_images) > 0) AS enriched FROM {CONTENT}")
def enriched_count(spark: SparkSession, folder: str) -> DataFrame:
    """Records with images from outside."""
    return stats.enriched_count(table(spark, folder, CONTENT).select(F.from_json("external_images", "array<string>").alias("external_images")))


_SEARCHES = [("mill", 1, 1), ("mill", 2, 2), ("mill", 3, 3), ("tram", 1, 2), ("lost", 1, 9), ("plan", 1, 4), ("plan", 2, 1)]
_PAGES = [(1, "Old mill", "w/1", "t/1", "o/1"), (2, "Tram", "w/2", None, "o/2"), (3, "Third", "w/3", "t/3", "o/3"), (4, "Plan", "w/4", "t/4", None)]
_PAGE_FILES = [(1, 1, "File:Logo of it.png"), (1, 2, "File:Mill.jpg"), (1, 3, "File:Wheel.jpg"), (2, 1, "File:Tram.jpg"), (2, 2, "Tram2.jpg"), (4, 1, "File:Flag.svg"), (4, 2, "File:Plan.jpg"), (4, 3, "File:Mill.jpg")]
_FILES = [
    ("File:Mill.jpg", "i/m", "f/m", 800, 200, "cc-by-4.0", "Ann", "<b>A mill</b>"), ("File:Wheel.jpg", "i/w", "f/w", 500, 599, "CC0", None, ""), ("File:Tram.jpg", "i/t", "f/t", None, 700, None, None, None),
    ("File:Logo of it.png", "i/l", "f/l", 900, 900, "odd", "Bob", "x"), ("File:Plan.jpg", "i/p", "f/p", 600, 10, "public domain", "", "Plan"), ("Tram2.jpg", "i/2", "f/2", 990, 990, "CC BY", None, "two"),
]
_ASKED = [("a", 0, "mill"), ("a", 1, "plan"), ("b", 0, "lost"), ("b", 1, "tram"), ("c", 0, "none"), ("d", 1, "plan")]
_LOOKUPS = {
    "asked": ("key, step, query", "key string, step int, query string", _ASKED), "searches": ("query, rank, page_id", "query string, rank int, page_id int", _SEARCHES),
    "pages": ("page_id, page_title, page_url, thumb_url, original_url", "page_id int, page_title string, page_url string, thumb_url string, original_url string", _PAGES),
    "page_files": ("page_id, rank, file", "page_id int, rank int, file string", _PAGE_FILES),
    "files": ("file, image_url, full_url, width, height, license, author, description", "file string, image_url string, full_url string, width int, height int, license string, author string, description string", _FILES),
}
_TABLES = "WITH " + ", ".join(_values(n, c, r) for n, (c, _, r) in _LOOKUPS.items())


def _lookups(spark: SparkSession) -> dict[str, DataFrame]:
    return {n: spark.createDataFrame(rows, schema) for n, (_, schema, rows) in _LOOKUPS.items()}


def _listed(images: DataFrame, columns: list[str]) -> DataFrame:
    return images.select("key", F.posexplode("images").alias("at", "i")).select("key", "at", *[F.col(f"i.{c}").alias(c) for c in columns])


_LABEL = "CASE lower(license) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in enrich.LICENSES.items()) + " ELSE coalesce(license, 'Unknown') END"


@query(f"""{_TABLES}, met AS (SELECT key, step, rank AS page_rank, page_id FROM asked JOIN searches USING (query)),
first AS (SELECT * FROM met QUALIFY step = min(step) OVER (PARTITION BY key)), top AS (SELECT * FROM first QUALIFY row_number() OVER (PARTITION BY key ORDER BY page_rank, page_id) <= 2),
tp AS (SELECT * FROM top JOIN pages USING (page_id)),
own AS (SELECT key, step, page_rank, 0 AS place, '' AS file, coalesce(thumb_url, original_url) AS image_url, original_url AS full_url, 'Wikipedia' AS license, page_title AS title, 'Image from Wikipedia article: ' || page_title AS description, page_url AS article_url FROM tp WHERE original_url IS NOT NULL),
named AS (SELECT * FROM (SELECT * FROM page_files QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY rank, file) <= {enrich.PAGE_FILES}) WHERE NOT regexp_matches(lower(file), '{"|".join(enrich.NO_SUBJECT)}')),
shown AS (SELECT key, step, page_rank, n.rank + 1 AS place, file, image_url, full_url, {_LABEL} AS license, replace(file, 'File:', '') AS title, coalesce(nullif(left(regexp_replace(coalesce(description, ''), '<[^>]+>', '', 'g'), 200), ''), 'Image from Wikipedia') AS description, page_url AS article_url FROM tp JOIN named n USING (page_id) JOIN files USING (file)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY step, page_rank, place, file) AS k FROM (SELECT * FROM own UNION ALL SELECT * FROM shown))
SELECT key, CAST(k - 1 AS INTEGER) AS at, image_url, full_url, license, title, description, article_url FROM ranked WHERE k <= 2""")
def enrich_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Images of the first pages that a search found, over small lookup tables."""
    t = _lookups(spark)
    found = enrich.page_images(t["asked"], t["searches"], t["pages"], t["page_files"], t["files"])
    return _listed(found, ["image_url", "full_url", "license", "title", "description", "article_url"])


@query(f"""{_TABLES}, met AS (SELECT key, step, s.rank AS page_rank, page_id, p.rank AS place, file, image_url, width, height, license, author FROM asked JOIN searches s USING (query) JOIN page_files p USING (page_id) JOIN files USING (file)
 WHERE starts_with(file, 'File:') AND coalesce(greatest(width, height), 0) >= {enrich.LEAST_SIDE}),
best AS (SELECT * FROM met QUALIFY (page_rank, page_id) = min((page_rank, page_id)) OVER (PARTITION BY key, step)), once AS (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY key, file ORDER BY step, page_rank, place) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY step, page_rank, place, file) AS k FROM once)
SELECT key, CAST(k - 1 AS INTEGER) AS at, file AS file_name, image_url, coalesce(width, -1) AS width, coalesce(height, -1) AS height, coalesce(license, 'Unknown') AS license, coalesce(author, 'Unknown') AS author FROM ranked WHERE k <= 7""")
def enrich_large(spark: SparkSession, folder: str) -> DataFrame:
    """Large files of the pages that searches found, over small lookup tables."""
    t = _lookups(spark)
    found = _listed(enrich.large_images(t["asked"], t["searches"], t["page_files"], t["files"]), ["file_name", "image_url", "width", "height", "license", "author"])
    return found.fillna(-1, ["width", "height"])


@query(f"SELECT *, {_LABEL} AS label FROM (SELECT DISTINCT unnest(['cc-by-sa-4.0', 'CC0', 'Public Domain', 'odd', NULL, c_mktsegment]) AS license FROM customer)")
def license_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of licence codes, known, unknown and missing."""
    codes = F.array(*[F.lit(x).cast("string") for x in ("cc-by-sa-4.0", "CC0", "Public Domain", "odd", None)], F.col("c_mktsegment"))
    return table(spark, folder, "customer").select(F.explode(codes).alias("license")).distinct().withColumn("label", enrich.license_label(F.col("license")))


_TITLES = f"SELECT DISTINCT id, title, slug FROM {CONTENT} WHERE id IS NOT NULL"


@query(f"""WITH r AS ({_TITLES}), q AS (SELECT id AS key, 0 AS step, title AS query FROM r UNION ALL SELECT id, 1, {_capital("translate(coalesce(slug, ''), '-_', '  ')")} FROM r WHERE slug <> coalesce(title, ''))
SELECT key, query, min(step) AS step FROM q WHERE trim(query, ' ') <> '' GROUP BY key, query""")
def title_queries(spark: SparkSession, folder: str) -> DataFrame:
    """What an enrichment asks by title and slug, the first of equal questions."""
    records = table(spark, folder, CONTENT).where("id IS NOT NULL").select("id", "title", "slug").distinct()
    return enrich.title_queries(records, "id", "title", "slug").select("key", "query", "step")


@query(f"""WITH r AS ({_TITLES}), q AS (SELECT id AS key, 0 AS step, title AS query FROM r UNION ALL SELECT id, 1, title || ' ' || CASE lower(split_part(slug, '-', 1)) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in enrich.TYPE_WORDS.items())} END FROM r)
SELECT key, query, min(step) AS step FROM q WHERE trim(query, ' ') <> '' GROUP BY key, query""")
def entity_queries(spark: SparkSession, folder: str) -> DataFrame:
    """What an enrichment asks for an entity: its name, then with its type's word; the type is here the slug's first word."""
    records = table(spark, folder, CONTENT).where("id IS NOT NULL").select("id", "title", "slug").distinct().withColumn("kind", F.substring_index("slug", "-", 1))
    return enrich.entity_queries(records, "id", "title", "kind").select("key", "query", "step")
