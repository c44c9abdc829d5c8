"""Queries of the general training-data operators (problems 2, 3 and 4) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.instants import ABBREVIATIONS, MONTHS
from sluice.operators import instants, nested, snapshots
from sluice.session import table

CMS_KEY = ["source", "content_type", "id"]
CMS_FIELDS = ["attributes", "external_images"]
IMAGE_COLUMNS = {"role": "role", "image_source": "source", "image_url": "image_url", "image_title": "title", "license": "license"}


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every object inside an array of the CMS records' JSON, with the path of the one that holds it."""
    records = table(spark, folder, "unified_cms_content_combined")
    links = nested.linked(nested.element_nodes(records, CMS_KEY, CMS_FIELDS, rows=False))
    return links.select(*CMS_KEY, "field", "path", "parent_path").distinct()


def p2_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The flat tables that the records give: name (field, schema path), distinct rows, rows with a parent."""
    records = table(spark, folder, "unified_cms_content_combined")
    links = nested.linked(nested.element_nodes(records, CMS_KEY, CMS_FIELDS, rows=False))
    once = links.select(*CMS_KEY, "field", "schema_path", "path", "parent_path").distinct()
    return once.groupBy("field", "schema_path").agg(F.count("*").alias("n_rows"), F.count_if(F.col("parent_path") != "").alias("n_nested"))


def p2_images(spark: SparkSession, folder: str) -> DataFrame:
    """One flat table: the objects of external_images, with their scalar columns."""
    records = table(spark, folder, "unified_cms_content_combined")
    links = nested.linked(nested.element_nodes(records, CMS_KEY, ["external_images"]))
    return nested.flat_table(links, CMS_KEY, "external_images", "*", IMAGE_COLUMNS)


def dated_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(field, record_key, snapshot_date, source, text): the three columns with dates as text; repeats merged."""
    content = table(spark, folder, "unified_all_cms_content")
    urls = table(spark, folder, "aidna_wp_scraped_urls")
    stacked = content.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("published_at", "updated_at")])).alias("v"),
        F.col("id").alias("record_key"), F.lit("").alias("snapshot_date"), "source",
    ).select("v.field", "record_key", "snapshot_date", "source", "v.text")
    modified = urls.select(F.lit("last_modified").alias("field"), F.col("url").alias("record_key"), F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"), "source", F.col("last_modified").alias("text"))
    return stacked.unionByName(modified).where("text IS NOT NULL AND record_key IS NOT NULL")


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    settings = table(spark, folder, "site_settings").select("source", "time_zone", (F.col("date_order") != "mdy").alias("day_first"))
    # A site's settings are one row per site: small, but their size isn't fixed, so Spark decides on a broadcast.
    return dated_texts(spark, folder).join(settings, "source", "left")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """One UTC instant for each published_at, updated_at and last_modified that names one."""
    found = instants.to_utc(_placed(spark, folder), "text", "time_zone", "day_first")
    return found.select("field", "record_key", "snapshot_date", "utc_micros").distinct()


def p3_unread(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of those columns that are not blank and name no instant, and how many values have each."""
    left = instants.unread(_placed(spark, folder), "text", "day_first")
    return left.groupBy("field", "text").agg(F.count("*").alias("n"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """URLs added, removed, or listed by another sitemap, from each snapshot to the next."""
    urls = table(spark, folder, "aidna_wp_scraped_urls")
    found = snapshots.changes(urls, snapshots.canonical_url(F.col("url")), snapshots.canonical_url(F.col("sitemap_url")), "snapshot_date")
    return found.select(F.date_format("snapshot", "yyyy-MM-dd").alias("snapshot_date"), F.col("key").alias("url"), "change")


def p4_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """The validity intervals: from which to which snapshot a URL stood in a sitemap."""
    urls = table(spark, folder, "aidna_wp_scraped_urls")
    spans = snapshots.validity_intervals(urls, snapshots.canonical_url(F.col("url")), snapshots.canonical_url(F.col("sitemap_url")), "snapshot_date")
    return spans.select(F.col("key").alias("url"), F.col("state").alias("sitemap_url"), F.col("first_n").cast("long"), F.col("last_n").cast("long"))


QUERIES = {
    "p2_found": p2_found,
    "p2_tables": p2_tables,
    "p2_images": p2_images,
    "p3_found": p3_found,
    "p3_unread": p3_unread,
    "p4_found": p4_found,
    "p4_intervals": p4_intervals,
}

_CANON = r"""CASE WHEN regexp_matches({c}, '^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//') THEN
 'https://' || lower(regexp_extract({c}, '^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1))
 || rtrim(regexp_extract({c}, '^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*([^?#]*)', 1), '/')
 || regexp_extract({c}, '^[^?#]*(\?[^#]+)', 1) ELSE trim({c}) END"""

_STATES = f"""
WITH seen AS (SELECT DISTINCT snapshot_date AS d, {_CANON.format(c="url")} AS url, {_CANON.format(c="sitemap_url")} AS sitemap FROM aidna_wp_scraped_urls WHERE url IS NOT NULL),
once AS (SELECT d, url, max(sitemap) AS sitemap FROM seen GROUP BY d, url),
days AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS n FROM (SELECT DISTINCT snapshot_date AS d FROM aidna_wp_scraped_urls)),
state AS (SELECT n, days.d, url, sitemap FROM once JOIN days USING (d))"""



def _unwrapped(x: str) -> str:
    """JSON text within a JSON string, twice over, as what it stands for."""

    def once(x: str) -> str:
        inner = f"CAST({x} ->> '$' AS JSON)"
        return f"CASE WHEN json_type({x}) = 'VARCHAR' AND json_valid({x} ->> '$') AND json_type({inner}) IN ('OBJECT', 'ARRAY', 'VARCHAR') THEN {inner} ELSE {x} END"

    return once(f"({once(x)})")


_NODES = f"""WITH RECURSIVE fields AS (SELECT DISTINCT source, content_type, id, 'attributes' AS field, attributes AS t FROM unified_cms_content_combined
 UNION SELECT DISTINCT source, content_type, id, 'external_images', external_images FROM unified_cms_content_combined),
top AS (SELECT source, content_type, id, field, CAST(t AS JSON) AS v FROM fields WHERE json_valid(t)),
nodes AS (
 SELECT source, content_type, id, field, '' AS path, '' AS named, '' AS parent, FALSE AS element, {_unwrapped("v")} AS v FROM top
 UNION ALL
 SELECT n.source, n.content_type, n.id, n.field, ltrim(n.path || '/' || e.key, '/'), ltrim(n.named || '/' || CASE WHEN json_type(n.v) = 'ARRAY' THEN '*' ELSE e.key END, '/'),
  CASE WHEN n.element AND json_type(n.v) = 'OBJECT' THEN n.path ELSE n.parent END, json_type(n.v) = 'ARRAY', {_unwrapped("e.value")}
 FROM nodes n, LATERAL (SELECT
   unnest(CASE json_type(n.v) WHEN 'OBJECT' THEN json_keys(n.v) ELSE list_transform(range(0, CAST(json_array_length(n.v) AS BIGINT)), lambda i: CAST(i AS VARCHAR)) END) AS key,
   unnest(CASE json_type(n.v) WHEN 'OBJECT' THEN list_transform(json_keys(n.v), lambda k: json_extract(n.v, '$."' || k || '"')) ELSE json_extract(n.v, '$[*]') END) AS value) e
 WHERE json_type(n.v) IN ('OBJECT', 'ARRAY')),
found AS (SELECT DISTINCT source, content_type, id, field, path, named, parent FROM nodes WHERE element AND json_type(v) = 'OBJECT')
"""

def _scalar(column: str, key: str) -> str:
    value = _unwrapped(f"json_extract(v, '$.{key}')")
    return f"CASE WHEN json_type({value}) NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN v ->> '$.{key}' END AS {column}"


def _instants_sql() -> str:
    """Each notation as a pattern with named parts; clock times by the database's own time zones, the earlier of two."""
    months = ", ".join(f"('{n}', {m})" for n, m in MONTHS.items())
    abbreviations = ", ".join(f"('{a}', {m})" for a, m in ABBREVIATIONS.items())
    half = r"(?: ?([apAP])\.?[mM]\.?)?"
    shapes = [
        (r"^(\d{4})-(\d{2})-(\d{2})(?:[Tt ](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?)? ?([A-Za-z]{1,4})?([+\-]\d{2}:?(?:\d{2})?)?(?: ?\[?([A-Z][A-Za-z]+/[A-Za-z_]+)\]?)?$", "y m d h mi s f ab off zone"),
        (r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})(Z)?$", "y m d h mi s ab"),
        (r"^(\d{1,2})[./](\d{1,2})[./](\d{4}) (\d{1,2}):(\d{2})" + half + "$", "p q y h mi half"),
        (r"^(?:[A-Za-z]+, )?(\d{1,2})\.? (?:de )?([^\W\d]+|[^ \d]+) (?:de )?(\d{4}),?(?: à)? (\d{1,2})[:h](\d{2})(?::(\d{2}))?(?: Uhr)?(?: ([A-Z]{3,4}))?(?: ?([+\-]\d{4}))?$", "d name y h mi s ab off"),
        (r"^([^ \d]+) (\d{1,2}), (\d{4}),? (\d{1,2}):(\d{2})" + half + "$", "name d y h mi half"),
        (r"^[A-Za-z]{3} ([A-Za-z]{3}) (\d{2}) (\d{2}):(\d{2}):(\d{2}) (\d{4})$", "name d h mi s y"),
    ]
    fields = "y m d p q name h mi s f half ab off zone".split()
    parts = []
    for pattern, names in shapes:
        own = names.split()
        listed = "[" + ", ".join(f"'{n}'" for n in own) + "]"
        picked = ", ".join(f"nullif(g.{n}, '') AS {n}" if n in own else f"CAST(NULL AS VARCHAR) AS {n}" for n in fields)
        parts.append(f"SELECT field, record_key, snapshot_date, time_zone, date_order, {picked} FROM (SELECT *, regexp_extract(t, '{pattern}', {listed}) AS g FROM v WHERE regexp_matches(t, '{pattern}'))")
    return f"""WITH raw AS (SELECT 'published_at' AS field, id AS record_key, '' AS snapshot_date, source, published_at AS text FROM unified_all_cms_content
 UNION SELECT 'updated_at', id, '', source, updated_at FROM unified_all_cms_content
 UNION SELECT 'last_modified', url, strftime(snapshot_date, '%Y-%m-%d'), source, last_modified FROM aidna_wp_scraped_urls),
v AS (SELECT field, record_key, snapshot_date, time_zone, date_order, trim(regexp_replace(text, '[\\s\\x{{a0}}\\x{{202f}}]+', ' ', 'g')) AS t FROM raw LEFT JOIN site_settings USING (source) WHERE text IS NOT NULL),
months(name, number) AS (VALUES {months}),
abbreviations(ab, minutes) AS (VALUES {abbreviations}),
parts AS ({" UNION ALL ".join(parts)}),
clock AS (SELECT parts.*, minutes, try_cast(format('{{:04d}}-{{:02d}}-{{:02d}} {{:02d}}:{{:02d}}:{{:02d}}.{{}}', CAST(y AS INTEGER),
  CAST(coalesce(CAST(number AS VARCHAR), m, CASE WHEN date_order = 'mdy' THEN p ELSE q END) AS INTEGER), CAST(coalesce(d, CASE WHEN date_order = 'mdy' THEN q ELSE p END) AS INTEGER),
  CASE WHEN half IS NULL THEN CAST(coalesce(h, '0') AS INTEGER) ELSE CAST(h AS INTEGER) % 12 + CASE WHEN lower(half) = 'p' THEN 12 ELSE 0 END END,
  CAST(coalesce(mi, '0') AS INTEGER), CAST(coalesce(s, '0') AS INTEGER), left(rpad(coalesce(f, '0'), 6, '0'), 6)) AS TIMESTAMP) AS local
 FROM parts LEFT JOIN months ON months.name = lower(rtrim(parts.name, '.')) LEFT JOIN abbreviations ON abbreviations.ab = upper(parts.ab)
 WHERE (parts.name IS NULL OR number IS NOT NULL) AND (parts.ab IS NULL OR minutes IS NOT NULL) AND CAST(y AS INTEGER) > 1000),
shifted AS (SELECT *, CASE WHEN off IS NOT NULL THEN (CASE left(off, 1) WHEN '-' THEN -1 ELSE 1 END) * (CAST(off[2:3] AS INTEGER) * 60 + CAST(coalesce(nullif(replace(off[4:], ':', ''), ''), '0') AS INTEGER)) ELSE minutes END AS east,
 coalesce(zone, time_zone, 'UTC') AS z FROM clock WHERE local IS NOT NULL),
zoned AS (SELECT *, CASE WHEN east IS NULL THEN epoch_us(timezone(z, local)) END AS late FROM shifted),
named AS (SELECT field, record_key, snapshot_date, CASE WHEN east IS NOT NULL THEN epoch_us(local) - CAST(east AS BIGINT) * 60000000
  WHEN timezone(z, make_timestamptz(late - 3600000000)) = local THEN late - 3600000000 ELSE late END AS utc_micros FROM zoned)
SELECT DISTINCT field, record_key, snapshot_date, CAST(utc_micros AS BIGINT) AS utc_micros FROM named
UNION SELECT field, record_key, snapshot_date, CASE length(split_part(t, '.', 1)) WHEN 10 THEN CAST(split_part(t, '.', 1) AS BIGINT) * 1000000 + CAST(left(rpad(split_part(t, '.', 2), 6, '0'), 6) AS BIGINT)
  WHEN 13 THEN CAST(t AS BIGINT) * 1000 ELSE CAST(t AS BIGINT) END FROM v WHERE regexp_matches(t, '^(\\d{{10}}(\\.\\d+)?|\\d{{13}}|\\d{{16}})$')"""


SQL = {
    "p2_found": _NODES + "SELECT DISTINCT source, content_type, id, field, path, parent AS parent_path FROM found",
    "p2_tables": _NODES + "SELECT field, named AS schema_path, count(*) AS n_rows, CAST(count(*) FILTER (parent <> '') AS BIGINT) AS n_nested FROM found GROUP BY field, named",
    "p2_images": _NODES
    + "SELECT DISTINCT source, content_type, id, path, parent AS parent_path, "
    + ", ".join(_scalar(c, k) for c, k in IMAGE_COLUMNS.items())
    + " FROM nodes WHERE field = 'external_images' AND named = '*' AND element AND json_type(v) = 'OBJECT'",
    "p3_found": _instants_sql(),
    "p4_found": f"""{_STATES},
pairs AS (SELECT coalesce(b.url, a.url) AS url, coalesce(b.n, a.n + 1) AS n, a.url IS NOT NULL AS was, b.url IS NOT NULL AS now_is, a.sitemap IS DISTINCT FROM b.sitemap AS other
 FROM state a FULL JOIN state b ON a.url = b.url AND b.n = a.n + 1)
SELECT strftime(days.d, '%Y-%m-%d') AS snapshot_date, url, CASE WHEN NOT was THEN 'added' WHEN NOT now_is THEN 'removed' ELSE 'changed' END AS change
FROM pairs JOIN days USING (n) WHERE n > 0 AND (NOT was OR NOT now_is OR other)""",
    "p4_intervals": f"""{_STATES},
marked AS (SELECT *, CASE WHEN lag(n) OVER w = n - 1 AND lag(sitemap) OVER w IS NOT DISTINCT FROM sitemap THEN 0 ELSE 1 END AS starts FROM state WINDOW w AS (PARTITION BY url ORDER BY n)),
islands AS (SELECT *, sum(starts) OVER (PARTITION BY url ORDER BY n) AS island FROM marked)
SELECT url, any_value(sitemap) AS sitemap_url, CAST(min(n) AS BIGINT) AS first_n, CAST(max(n) AS BIGINT) AS last_n FROM islands GROUP BY url, island""",
}
