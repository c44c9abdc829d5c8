"""Schemas of state tables, sink and inputs, and the value domains that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ["pending", "success", "failed", "skipped"]
CHECKPOINT_STATUSES = ["running", "completed", "failed", "cancelled"]
TERMINAL = ["completed", "failed", "cancelled"]

CMS_STATE = (
    "record_id string, source string, cms_key string, collection string, strapi_id string, title string, published_at timestamp, "
    "first_seen timestamp, last_scraped timestamp, scrape_status string, content_hash string, bigquery_id string, error_message string"
)
URL_STATE = (
    "url string, source string, sitemap_url string, first_seen timestamp, last_scraped timestamp, scrape_status string, "
    "content_hash string, last_modified timestamp, scrape_count int, error_message string, bigquery_id string"
)
CHECKPOINTS = (
    "crawl_id string, pipeline string, source string, mode string, start_time timestamp, end_time timestamp, total_items int, "
    "processed_items int, successful_items int, failed_items int, status string, last_item_id string"
)
RUN_STATE = (
    "pipeline string, last_started_at timestamp, last_completed_at timestamp, last_mode string, last_result string, last_message string, "
    "shutdown_requested boolean, updated_at timestamp"
)
SINK = (
    "id string, source string, content_type string, attributes string, external_images string, title string, slug string, locale string, "
    "published_at timestamp, updated_at timestamp, created_at timestamp, processing_timestamp timestamp"
)
SITEMAP_ENTRY = "url string, lastmod string"
IMAGE = "role string, source string, image_url string, full_url string, license string, title string, description string, article_url string"


def checked(df: DataFrame, domain: dict[str, list[str]], required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy the constraints, rows that don't): values in their domains, required columns not null.

    A null passes a domain, as in SQL.  Both results are lazy; nothing is thrown away silently.
    """
    good: Column = F.lit(True)
    for column, values in domain.items():
        good = good & (F.col(column).isNull() | F.col(column).isin(values))
    for column in required:
        good = good & F.col(column).isNotNull()
    return df.where(good), df.where(~good)
