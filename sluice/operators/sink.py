"""The unified content table: rows of twelve columns, two of them JSON."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.functions import dates, text, urls
from sluice.operators.state import first_by
from sluice.schemas import SINK

ATTRIBUTES = [
    "title", "slug", "description", "content", "published_date", "modified_date", "author", "categories", "tags", "feature_image", "images", "sources",
    "word_count", "reading_time", "original_url",
]
TITLE, SLUG = 500, 200
WITH_NULLS = {"ignoreNullFields": "false"}


def page_rows(articles: DataFrame, now: Column) -> DataFrame:
    """Sink rows of scraped pages.  Needs source, url and the article's columns; external_images is optional.

    `now` is the time of the run.  Dates that can't be read become null; `dates.unread` finds them.
    """
    images = F.to_json("external_images", WITH_NULLS) if "external_images" in articles.columns else F.lit("[]")
    full = articles.withColumn("original_url", F.col("url")).withColumn("slug", urls.slug(F.col("url")))
    full = full.withColumn("word_count", text.word_count(F.col("content"))).withColumn("reading_time", text.reading_minutes(F.col("word_count")))
    return full.select(
        urls.record_id(F.col("source"), F.col("url")).alias("id"), "source", F.lit("post").alias("content_type"),
        F.to_json(F.struct(*ATTRIBUTES), WITH_NULLS).alias("attributes"), images.alias("external_images"),
        F.left("title", F.lit(TITLE)).alias("title"), F.left("slug", F.lit(SLUG)).alias("slug"), F.coalesce("locale", F.lit("en")).alias("locale"),
        dates.feed_instant(F.col("published_date")).alias("published_at"), dates.feed_instant(F.col("modified_date")).alias("updated_at"), now.alias("created_at"), now.alias("processing_timestamp"),
    )


def cms_rows(records: DataFrame, now: Column) -> DataFrame:
    """Sink rows of structured CMS records (see `functions.jsonattrs.structured`), those with a problem left out."""
    images = F.to_json("external_images", WITH_NULLS) if "external_images" in records.columns else F.lit("[]")
    instant = lambda key: dates.iso_instant(F.get_json_object("attributes", f"$.{key}"))
    return records.where("problem IS NULL AND id IS NOT NULL").select(
        F.col("id").cast("string").alias("id"), F.col("app_source").alias("source"), F.col("collection").alias("content_type"), F.col("flat_json").alias("attributes"), images.alias("external_images"),
        F.col("clean_title").alias("title"), F.col("clean_slug").alias("slug"), F.col("clean_locale").alias("locale"),
        instant("publishedAt").alias("published_at"), instant("updatedAt").alias("updated_at"), instant("createdAt").alias("created_at"), now.alias("processing_timestamp"),
    )


def not_yet_stored(rows: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """One row per key, the least, that the sink does not hold: makes appends safe to repeat.  A null in a key equals a null."""
    known = stored.select(*[F.col(k).alias(f"__{k}") for k in key])
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return first_by(rows.join(known, same, "left_anti"), key, [])


def ensure(spark: SparkSession, path: str) -> bool:
    """Makes an empty table where there is none; True if it did.  An existing table's schema is left alone."""
    try:
        spark.read.parquet(path).schema
    except AnalysisException:
        spark.createDataFrame([], SINK).withColumn("day", F.to_date("created_at")).write.mode("ignore").parquet(path)
        return True
    return False


def append(rows: DataFrame, path: str) -> None:
    """Appends to the table, a folder per day of creation."""
    rows.withColumn("day", F.to_date("created_at")).write.mode("append").partitionBy("day").parquet(path)


def dry_run(rows: DataFrame) -> int:
    """Computes every row, stores none, returns how many there are."""
    seen = Observation()
    rows.observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    return seen.get["n"]
