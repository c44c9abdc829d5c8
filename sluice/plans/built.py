"""Queries over pages and records that are made of the star schema's rows, so that what must come out of them is known.

Page and record are made by one expression that Spark and the SQL share; the SQL gives the expected result without reading it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import jsonattrs, markup
from sluice.plans.ingestion import Query
from sluice.session import spread, table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: A page: titles and dates in either of their places, images with small, unreadable and no sizes, repeated and shared links.
HTML = """concat('<html><head><title>Page ', c_custkey, '</title>',
 CASE WHEN c_custkey % 3 > 0 THEN concat('<meta property="og:title" content=" ', c_name, ' of ', c_mktsegment, ' ">') ELSE '' END,
 '<meta name="description" content=" About ', c_name, '">',
 CASE WHEN c_custkey % 2 = 0 THEN concat('<meta property="article:published_time" content="2024-01-0', 1 + c_custkey % 9, '">') ELSE concat('<time class="x entry-date" datetime="2023-02-0', 1 + c_custkey % 9, '">then</time>') END,
 CASE WHEN c_custkey % 5 = 0 THEN '<meta property="og:locale" content="DE_de"><meta property="og:image" content="/f.png">' ELSE '' END,
 '</head><body><div class="menu">Menu</div><span class="byline">By <a href="/a">Author ', c_custkey % 11, '</a></span><article><h1>Head of ', c_name, '</h1><p>', c_mktsegment, ' &amp; more ',
 CASE WHEN c_custkey % 7 > 0 THEN 'words that make the article long enough to be one, since short ones are left out, and so on' ELSE '' END, ' .....</p><script>var x = "<p>no</p>";</script><div class="share-box share">Share</div>',
 '<img src="/i/', c_custkey, '.jpg" alt=" pic " width="', c_custkey % 250, '" height="', 100 + c_custkey % 50, '"><img src="/i/', c_custkey, '.jpg"><img data-src="https://cdn.example/x.png" width="50px" height="50">',
 '<a href="https://out.example/', c_custkey, '">Out ', c_custkey, '</a><a href="https://out.example/', c_custkey, '">again</a><a href="https://facebook.com/sharer?u=1">f</a><a href="/local">local</a><a href="https://bare.example/"></a>',
 '<a rel="category tag">Cat ', c_mktsegment, '</a><a rel="tag">Tag ', c_custkey % 7, '</a><a rel="tag">Tag ', c_custkey % 7, '</a></article></body></html>')"""

_TITLE = "CASE WHEN c_custkey % 3 > 0 THEN concat(c_name, ' of ', c_mktsegment) ELSE concat('Page ', c_custkey) END"
_TEXT = """concat('Head of ', c_name, ' ', c_mktsegment, ' & more ', CASE WHEN c_custkey % 7 > 0 THEN 'words that make the article long enough to be one, since short ones are left out, and so on' ELSE '' END,
 CASE WHEN c_custkey % 7 > 0 THEN ' ' ELSE '' END, '... Out ', c_custkey, ' again f local Cat ', c_mktsegment, ' Tag ', c_custkey % 7, ' Tag ', c_custkey % 7)"""


def query(sql: str):  # noqa: ANN201
    def register(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def _articles(spark: SparkSession, folder: str, *fields: str) -> DataFrame:
    """What is named of each page; the rows are dealt to all cores before pages are made of them."""
    pages = spread(table(spark, folder, "customer")).select(F.expr("concat('https://site.example/p/', c_custkey)").alias("url"), F.expr(HTML).alias("html"))
    return markup.articles(pages, only=fields).where("ok")


@query(f"""SELECT concat('https://site.example/p/', c_custkey) AS url, {_TITLE} AS title, concat('About ', c_name) AS description, concat(CASE WHEN c_custkey % 2 = 0 THEN '2024-01-0' ELSE '2023-02-0' END, 1 + c_custkey % 9) AS published_date,
 concat('Author ', c_custkey % 11) AS author, CASE WHEN c_custkey % 5 = 0 THEN 'de' ELSE 'en' END AS locale, CASE WHEN c_custkey % 5 = 0 THEN concat('https://site.example/f.png|', {_TITLE}) ELSE '' END AS feature_image FROM customer""")
def built_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Titles, descriptions, dates, authors, languages and feature images of pages."""
    a = F.col("article")
    feature = F.concat_ws("|", a["feature_image"]["url"], a["feature_image"]["alt"])
    shown = ("title", "description", "published_date", "author", "locale")
    return _articles(spark, folder, *shown, "feature_image").select("url", *[a[c].alias(c) for c in shown], feature.alias("feature_image"))


@query(f"""SELECT concat('https://site.example/p/', c_custkey) AS url, CASE WHEN length(t) >= {markup.LEAST} THEN t ELSE '' END AS content, md5({HTML}) AS content_hash FROM (SELECT *, {_TEXT} AS t FROM customer)""")
def built_content(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of pages without scripts and furniture, and the pages' hashes."""
    return _articles(spark, folder, "content", "content_hash").select("url", F.col("article.content").alias("content"), F.col("article.content_hash").alias("content_hash"))


@query("""SELECT concat('https://site.example/p/', c_custkey) AS url, concat(CASE WHEN c_custkey % 250 < 100 THEN '' ELSE concat('https://site.example/i/', c_custkey, '.jpg=pic ') END, 'https://cdn.example/x.png=') AS images,
 concat('Cat ', c_mktsegment) AS categories, concat('Tag ', c_custkey % 7) AS tags, concat('Out ', c_custkey, '=https://out.example/', c_custkey, ' https://bare.example/=https://bare.example/') AS sources FROM customer""")
def built_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Images, categories, tags and external links of pages, each once."""
    a = F.col("article")
    pairs = lambda column, x, y: F.array_join(F.transform(a[column], lambda i: F.concat(i[x], F.lit("="), i[y])), " ").alias(column)
    return _articles(spark, folder, "images", "categories", "tags", "sources").select("url", pairs("images", "url", "alt"), F.array_join(a["categories"], ",").alias("categories"), F.array_join(a["tags"], ",").alias("tags"), pairs("sources", "text", "url"))


@query("""SELECT doc_id, CASE WHEN length(t) <= 500 THEN t ELSE regexp_replace(left(t, 500), ' [^ ]*$', '') || '...' END AS about
 FROM (SELECT p_partkey AS doc_id, trim(repeat(concat(p_name, ' ', p_type, ' '), CAST(p_partkey % 40 AS INTEGER)), ' ') AS t FROM part)""")
def built_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    """Descriptions without tags, entities resolved, cut at a word."""
    marked = F.expr("repeat(concat('<b>', p_name, '</b>&nbsp;<i class=\"x\">', p_type, '</i>\n '), int(p_partkey % 40))")
    return table(spark, folder, "part").select(F.col("p_partkey").alias("doc_id"), markup.short(marked).alias("about"))


#: A record: media, relations, links, SEO, system fields, empty and nested values.
RECORD = r"""concat('{"title":" <b>', c_name, '</b>  x ","slug":"s-', c_custkey, '","locale":"de","createdAt":"2024","user_id":4,"featured":false,"tags":[],"x":{"a":1},"none":null,"empty":"<p></p>","website":"https://w.example/', c_custkey,
 '","description":"<p>About <a href=\"https://l.example/', c_custkey, '\">L ', c_custkey, '</a><a href=\"https://w.example/', c_custkey, '\"></a></p>","feature_image":{"data":{"attributes":{"url":"/u/', c_custkey, '.png","alternativeText":"","caption":"<i>Cap</i> ', c_custkey, '","width":', c_custkey % 3, ',"height":null}}},',
 '"categories":{"data":[{"id":1,"attributes":{"title":"C', c_custkey % 5, '","slug":null,"other":1}},{"id":2}]},"author":{"data":{"attributes":{"name":"N"}}},"seo":{"metaTitle":"<b>M</b> ', c_custkey, '","metaDescription":"","canonicalURL":"https://c/', c_custkey, '"},"applications":{"data":[',
 CASE WHEN c_custkey % 6 = 5 THEN '{"id":8},' ELSE '' END, '{"id":', c_custkey % 4, '}]}}')"""


@query("""SELECT c_custkey, CASE WHEN c_custkey % 6 = 5 THEN CASE WHEN c_custkey % 4 = 0 THEN '8' ELSE concat('[8, ', c_custkey % 4, ']') END ELSE concat(c_custkey % 4, '') END AS app_source, concat(c_name, ' x') AS clean_title, 'de' AS clean_locale, 2 AS n_sources,
 concat('{"title": "', c_name, ' x", "slug": "s-', c_custkey, '", "featured": false, "tags": [], "website": "https://w.example/', c_custkey, '", "description": "About L ', c_custkey, '", "feature_image": {"url": "/u/', c_custkey, '.png", "caption": "Cap ', c_custkey, '"',
 CASE WHEN c_custkey % 3 > 0 THEN concat(', "width": ', c_custkey % 3) ELSE '' END, '}, "categories": [{"title": "C', c_custkey % 5, '", "slug": null}], "author": [{"name": "N"}], "seo": {"metaTitle": "M ', c_custkey, '", "canonicalURL": "https://c/', c_custkey,
 '"}, "sources": [{"text": "L ', c_custkey, '", "url": "https://l.example/', c_custkey, '"}, {"text": "https://w.example/', c_custkey, '", "url": "https://w.example/', c_custkey, '"}]}') AS flat_json FROM customer""")
def built_records(spark: SparkSession, folder: str) -> DataFrame:
    """CMS records flattened: all that is kept of them, as JSON."""
    rows = table(spark, folder, "customer").select("c_custkey", F.expr(RECORD.replace("\\", "\\\\")).alias("attributes"))
    return jsonattrs.structured(rows).select("c_custkey", "app_source", "clean_title", "clean_locale", "n_sources", "flat_json")
