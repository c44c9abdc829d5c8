"""Statistics over tracking state and sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.schemas import STATUSES


def _count_if(status: str, column: str) -> Column:
    return F.count_if(F.col(column) == status)


def totals(state: DataFrame, status: str = "scrape_status", last: str = "last_scraped") -> DataFrame:
    """One row, also for an empty state: total, rows per status, newest time (null if none)."""
    return state.agg(F.count("*").alias("total"), *[_count_if(s, status).alias(s) for s in STATUSES], F.max(last).alias("last_scraped"))


def breakdown(state: DataFrame, by: list[str], status: str = "scrape_status", last: str = "last_scraped") -> DataFrame:
    """Total, successes, pending, failures and newest time per group."""
    return state.groupBy(*by).agg(F.count("*").alias("total"), *[_count_if(s, status).alias(s) for s in ("success", "pending", "failed")], F.max(last).alias("last_scraped"))


def breakdown_json(state: DataFrame, by: list[str]) -> DataFrame:
    """One row: the breakdown as a JSON object by group, `{}` for an empty state.  Groups are sources and collections: few."""
    groups = breakdown(state, by)
    entry = F.struct(F.concat_ws("/", *by).alias("key"), F.struct(*([*by] if len(by) > 1 else []), "total", "success", "pending", "failed", "last_scraped").alias("value"))
    packed = groups.agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return packed.select(F.to_json(F.map_from_entries("entries"), {"ignoreNullFields": "false"}).alias("breakdown"))


def source_stats(sink: DataFrame) -> DataFrame:
    """Records, first and last publication and newest processing per source, most records first."""
    grouped = sink.groupBy("source").agg(
        F.count("*").alias("total_records"), F.min("published_at").alias("earliest"), F.max("published_at").alias("latest"), F.max("processing_timestamp").alias("last_processed")
    )
    return grouped.orderBy(F.desc("total_records"), "source")


def success_rate(successes: Column, total: Column) -> Column:
    """Percent with one digit; 0 of nothing."""
    return F.when(total > 0, F.round(successes / total * 100, 1)).otherwise(F.lit(0.0))


def run_totals(runs: DataFrame, by: list[str], counts: list[str]) -> DataFrame:
    """Sums of counts per group and over all, where the group is null.  Null counts are 0."""
    return runs.rollup(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])


def new_estimate(listed: DataFrame, tracked: DataFrame, by: list[str]) -> DataFrame:
    """Per group what a source lists (`total`) against what is tracked: new = total - tracked + pending, 0 at least."""
    joined = listed.join(tracked.select(*by, F.col("total").alias("tracked"), "pending"), by, "left")
    filled = joined.fillna(0, ["tracked", "pending"])
    return filled.withColumn("new_estimate", F.greatest(F.lit(0), F.col("total") - F.col("tracked") + F.col("pending")))


def enriched_count(df: DataFrame, images: str = "external_images") -> DataFrame:
    return df.agg(F.count_if(F.size(images) > 0).alias("enriched"))
