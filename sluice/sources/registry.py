"""Which collections and sites are read: a small table, given by the user, not built in."""

from __future__ import annotations

import json

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources import cms

#: `fields`: the collection's field list, as it is asked of the API; null: `id attributes`.
COLLECTIONS = "cms_key string, collection string, response_key string, source string, fields string"
SITES = "site string, source string, sitemap_url string"


def load(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A registry from a JSON file: a list of objects with the schema's fields."""
    with open(path, encoding="utf-8") as file:
        return spark.createDataFrame(json.load(file), schema)


def check(registry: DataFrame, key: str, value: str) -> None:
    """ValueError for a name that the registry (a few rows) does not have."""
    names = sorted(r[0] for r in registry.select(key).distinct().collect())
    if value not in names:
        raise ValueError(f"unknown {key} {value!r}; known: {', '.join(names)}")


def read_pages(spark: SparkSession, collections: DataFrame, endpoint: str, **options: str) -> DataFrame:
    """The pages of all collections of a registry, one lazy read each; see `cms.CmsPages`."""
    spark.dataSource.register(cms.CmsPages)
    entries = collections.select("response_key", "fields").distinct().orderBy("response_key").collect()  # a few rows
    asked = lambda e: {"endpoint": endpoint, "response_key": e["response_key"], **({"fields": e["fields"]} if e["fields"] else {}), **options}
    reads = [spark.read.format("cms_pages").options(**asked(e)).load() for e in entries]
    return reduce(DataFrame.unionByName, reads, spark.createDataFrame([], cms.PAGES))


def records(pages: DataFrame, collections: DataFrame) -> DataFrame:
    """(cms_key, collection, source, id, attributes) of the records on the pages."""
    named = F.broadcast(collections.select("response_key", "cms_key", "collection", "source"))  # a registry
    return cms.records(pages).join(named, "response_key").select("cms_key", "collection", "source", "id", "attributes")
