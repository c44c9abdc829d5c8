"""URL functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What in a URL tells that the page is no article.
NO_ARTICLE = r"(?i)/tag/|/list-tags/|/category/|/author/|/page/\d+|\?|/feed/?$|/wp-json/|/wp-admin/|/wp-content/|/wp-includes/"


def path(url: Column) -> Column:
    """The path, without query and fragment; '' if there is none or the text is no URL."""
    return F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1)


def host(url: Column) -> Column:
    """Host with port and user, as spelled."""
    return F.regexp_extract(url, r"^[^:]+://([^/?#]*)", 1)


def bare_path(url: Column) -> Column:
    return F.regexp_replace(path(url), "^/+|/+$", "")


def is_skipped(url: Column) -> Column:
    """Whether the URL is of a list, feed, file or system page, or has a query."""
    return url.rlike(NO_ARTICLE)


def is_content(url: Column) -> Column:
    """Whether the URL may be of an article: not skipped and not the home page.  Null: not."""
    return F.coalesce(~is_skipped(url) & (bare_path(url) != ""), F.lit(False))


def slug(url: Column) -> Column:
    """The path's last segment; '' for a home page."""
    return F.element_at(F.split(bare_path(url), "/"), -1)


def record_id(source: Column, url: Column) -> Column:
    """The source's last part and twelve digits of the URL's MD5: the same page always has the same id."""
    return F.concat(F.substring_index(source, "/", -1), F.lit("_"), F.substring(F.md5(url), 1, 12))
