"""Image enrichment as joins with lookup tables instead of calls per record.

Lookup tables, one row per thing that was looked up:
searches (query, rank, page_id), pages (page_id, page_title, page_url, thumb_url, original_url),
page_files (page_id, rank, file), files (file, image_url, full_url, width, height, license, author, description).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import text

# What the names of files that show no subject contain.
NO_SUBJECT = ["icon", "logo", "commons-logo", "wiki", "symbol", "flag", "edit", "portal"]
# Labels of licence codes.
LICENSES = {
    "cc-by-sa-4.0": "CC BY-SA 4.0", "cc-by-4.0": "CC BY 4.0", "cc-by-sa-3.0": "CC BY-SA 3.0", "cc-by-3.0": "CC BY 3.0", "cc0": "CC0 1.0", "public domain": "Public Domain",
}
# The word that is added to an entity's name, by its type.
TYPE_WORDS = {
    "city": "city", "company": "logo", "education": "university", "athlete": "player", "team": "team", "stadium": "stadium", "influencer": "portrait", "place": "landmark",
    "investor": "building", "federation": "logo",
}
LEAST_SIDE, PAGE_FILES = 600, 5

_FOUND = ["key", "step", "page_rank", "place", "file", "image"]


def shows_subject(file: Column) -> Column:
    return ~F.lower(file).rlike("|".join(NO_SUBJECT))


def large_enough(width: Column, height: Column, least: int = LEAST_SIDE) -> Column:
    """Whether the longer side is long enough; unknown sizes are not."""
    return F.coalesce(F.greatest(width, height) >= least, F.lit(False))


def license_label(code: Column) -> Column:
    """The label of a licence code; other codes stay, null is `Unknown`."""
    known = F.create_map(*[F.lit(x) for pair in LICENSES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(code)), code, F.lit("Unknown"))


def _steps(records: DataFrame, key: str, queries: list[Column]) -> DataFrame:
    """(key, step, query): the queries that are not blank, the first of equal ones."""
    tried = F.array(*[F.struct(F.lit(i).alias("step"), q.alias("query")) for i, q in enumerate(queries)])
    rows = records.select(F.col(key).alias("key"), F.explode(tried).alias("q")).select("key", "q.step", "q.query").where("trim(query) <> ''")
    return rows.groupBy("key", "query").agg(F.min("step").alias("step")).select("key", "step", "query")


def title_queries(records: DataFrame, key: str, title: str, slug: str) -> DataFrame:
    """A record's title, then its slug as a title if the slug is another text."""
    other = F.when(F.col(slug) != F.coalesce(F.col(title), F.lit("")), text.slug_query(F.col(slug)))
    return _steps(records, key, [F.col(title), other])


def keyword_queries(records: DataFrame, key: str, title: str, categories: str) -> DataFrame:
    """Four keywords of title and first category, then two."""
    first = F.get(F.col(categories), F.lit(0))
    return _steps(records, key, [text.search_query(F.col(title), first), text.fallback_query(F.col(title), first)])


def entity_queries(records: DataFrame, key: str, title: str, kind: str) -> DataFrame:
    """An entity's name, then the name with its type's word if the type has one."""
    word = F.try_element_at(F.create_map(*[F.lit(x) for pair in TYPE_WORDS.items() for x in pair]), F.lower(kind))
    return _steps(records, key, [F.col(title), F.concat(F.col(title), F.lit(" "), word)])


def first_n(df: DataFrame, key: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows per key; the order columns should make it total."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("__n") <= n).drop("__n")


def _met(queries: DataFrame, searches: DataFrame) -> DataFrame:
    """Each distinct query is looked up once: what a cache of calls would save."""
    asked = queries.select("query").distinct().join(searches, "query").withColumnRenamed("rank", "page_rank")
    return queries.join(asked, "query")


def _pack(found: DataFrame, n: int) -> DataFrame:
    """(key, images): the first n per key, in order; so few per group."""
    order = ["step", "page_rank", "place", "file"]
    kept = first_n(found, ["key"], order, n).select("key", F.struct(*order, "image").alias("x"))
    return kept.groupBy("key").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["image"]).alias("images"))


def page_images(queries: DataFrame, searches: DataFrame, pages: DataFrame, page_files: DataFrame, files: DataFrame, n: int = 2, most_pages: int = 2) -> DataFrame:
    """(key, images) from the first pages of the first query that finds any: of each page its own image, then, of its first
    files, those that show a subject."""
    met = _met(queries, searches)
    first = met.withColumn("__first", F.min("step").over(Window.partitionBy("key"))).where("step = __first").drop("__first")
    top = first_n(first, ["key"], ["page_rank", "page_id"], most_pages).join(pages, "page_id")
    image = lambda url, full, license_, title, about: F.struct(
        F.lit("augment").alias("role"), F.lit("wikipedia").alias("source"), url.alias("image_url"), full.alias("full_url"), license_.alias("license"), title.alias("title"), about.alias("description"),
        F.col("page_url").alias("article_url"),
    )
    about_page = F.concat(F.lit("Image from Wikipedia article: "), "page_title")
    own = top.where("original_url IS NOT NULL").withColumns({"place": F.lit(0), "file": F.lit("")})
    own = own.withColumn("image", image(F.coalesce("thumb_url", "original_url"), F.col("original_url"), F.lit("Wikipedia"), F.col("page_title"), about_page)).select(*_FOUND)
    named = first_n(page_files, ["page_id"], ["rank", "file"], PAGE_FILES).where(shows_subject(F.col("file"))).withColumnRenamed("rank", "place")
    shown = top.join(named, "page_id").join(files, "file")
    about_file = text.short_description(F.col("description"), F.lit("Image from Wikipedia"))
    shown = shown.withColumn("image", image(F.col("image_url"), F.col("full_url"), F.coalesce(license_label(F.col("license")), F.lit("Wikipedia")), text.without_prefix(F.col("file")), about_file)).select(*_FOUND)
    return _pack(own.unionByName(shown.withColumn("place", F.col("place") + 1)), n)


def large_images(queries: DataFrame, searches: DataFrame, page_files: DataFrame, files: DataFrame, n: int = 7, least: int = LEAST_SIDE) -> DataFrame:
    """(key, images) of all queries: of each the large files of the first page that has any; one image per file."""
    named = page_files.where(F.col("file").startswith("File:")).withColumnRenamed("rank", "place")
    met = _met(queries, searches).join(named, "page_id").join(files, "file").where(large_enough(F.col("width"), F.col("height"), least))
    best = met.withColumn("__best", F.min(F.struct("page_rank", "page_id")).over(Window.partitionBy("key", "step"))).where(F.struct("page_rank", "page_id") == F.col("__best"))
    once = first_n(best, ["key", "file"], ["step", "page_rank", "place"], 1)
    image = F.struct(
        F.col("file").alias("file_name"), "image_url", "width", "height", F.coalesce("license", F.lit("Unknown")).alias("license"), F.coalesce("author", F.lit("Unknown")).alias("author"), "description"
    )
    return _pack(once.withColumn("image", image).select(*_FOUND), n)


def with_images(records: DataFrame, key: str, images: DataFrame, skipped: Column | None = None, name: str = "external_images") -> DataFrame:
    """The records with their images in place of any they had; an empty list where there are none or the record is skipped."""
    own = images.select(F.col("key").alias("__key"), F.col("images").alias("__images"))
    joined = records.drop(name).join(own, F.col(key) == F.col("__key"), "left").drop("__key")
    empty = F.array().cast(own.schema["__images"].dataType)
    found = F.coalesce(F.col("__images"), empty)
    return joined.withColumn(name, F.when(skipped, empty).otherwise(found) if skipped is not None else found).drop("__images")
