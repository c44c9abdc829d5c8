"""Text functions as Column expressions: tags, white space, titles, excerpts, counts, keywords.

Null text gives the empty value stated for each function.  Lengths count code points.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Code points of the characters that count as white space.
WHITE_POINTS = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The same as a character class of Java: classes are several times faster than a list of points.
WHITE = r"\s\x1c-\x1f\x85\p{Z}"
# Code points of the characters without width that are deleted.
ZERO_WIDTH = "".join(f"\\x{{{point:x}}}" for point in (0x200B, 0x200C, 0x200D, 0xFEFF))
_RUN = f"[{WHITE}]+"

# Words that say nothing about a title's subject.
STOPWORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by", "from", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "do", "does", "did", "will", "would", "could", "should", "can", "may", "might", "this", "that", "these", "those", "it", "its",
    "how", "why", "what", "when", "where", "who", "which", "new", "top",
]


def _text(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def strip_white(x: Column) -> Column:
    return F.regexp_replace(x, f"^{_RUN}|{_RUN}$", "")


def strip_tags(x: Column) -> Column:
    """Tags within a line become nothing; tags that span a line feed stay, as do entities.  Null: ''."""
    return F.regexp_replace(_text(x), "(?d)<.*?>", "")


def collapse_white(x: Column) -> Column:
    """Runs of white space become one space, none at the ends.  Null: ''."""
    return F.trim(F.regexp_replace(_text(x), _RUN, " "))


def clean(x: Column) -> Column:
    """`strip_tags`, then `collapse_white`."""
    return collapse_white(strip_tags(x))


@F.pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """HTML entities as characters, for which Spark has no function; Arrow batches."""
    return texts.map(lambda t: html.unescape(t) if t is not None and "&" in t else t)


def normalise(x: Column, entities: bool = True) -> Column:
    """Entities resolved (once more, if the text was decoded before), white space collapsed, zero-width characters
    deleted after that, runs of dots and of hyphens cut to three.  `entities=False` leaves entities and stays in the JVM."""
    decoded = unescape(_text(x)) if entities else _text(x)
    spaced = F.regexp_replace(decoded, _RUN, " ")
    bare = F.regexp_replace(spaced, f"[{ZERO_WIDTH}]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"[.]{3,}", "..."), r"[-]{3,}", "---"))


def clean_title(x: Column, entities: bool = True) -> Column:
    """The title without its last part behind a hyphen, dash or bar, spaces around it or not."""
    decoded = unescape(_text(x)) if entities else _text(x)
    return collapse_white(F.regexp_replace(decoded, f"[{WHITE}]*[-|–—][{WHITE}]*[^-|–—]+$", ""))


def truncate_words(x: Column, limit: int) -> Column:
    """Text longer than `limit` is cut at the last space within it, if any, and gets three dots."""
    cut = F.concat(F.regexp_replace(F.left(x, F.lit(limit)), " [^ ]*$", ""), F.lit("..."))
    return F.when(F.length(x) > limit, cut).otherwise(x)


def excerpt(x: Column, limit: int = 300) -> Column:
    """Up to the last sentence end within `limit`, if that is past its half; else cut at a word.  Null: ''."""
    window = F.left(_text(x), F.lit(2 * limit))
    head = F.left(window, F.lit(limit))
    ended = F.regexp_extract(head, r"(?s)^(.*[.!?]) ", 1)
    past_half = F.length(ended) > limit // 2 + 1
    return strip_white(F.when(past_half, ended).otherwise(truncate_words(window, limit)))


def words(x: Column) -> Column:
    """The text's parts between white space.  Null: none."""
    return F.filter(F.split(_text(x), _RUN), lambda w: w != "")


def word_count(x: Column) -> Column:
    return F.size(words(x))


def reading_minutes(count: Column, per_minute: int = 200) -> Column:
    """Words over speed, halves to the even minute, at least 1."""
    return F.greatest(F.lit(1), F.bround(count / F.lit(float(per_minute))).cast("int"))


def keywords(title: Column, n: int = 5) -> Column:
    """The first n words of a title that are longer than two letters and no stopwords; repeats stay."""
    bare = F.regexp_replace(F.lower(_text(title)), r"(?U)[^\w\s]", " ")
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    return F.slice(F.filter(words(bare), lambda w: (F.length(w) > 2) & ~F.array_contains(stop, w)), 1, n)


def search_query(title: Column, category: Column) -> Column:
    """The query for a title: its keywords and two of its first category, the first four of both."""
    return F.array_join(F.slice(F.concat(keywords(title), keywords(category, 2)), 1, 4), " ")


def fallback_query(title: Column, category: Column) -> Column:
    """The wider query, of two keywords."""
    return F.array_join(F.slice(F.concat(keywords(title), keywords(category, 2)), 1, 2), " ")


def slug_query(slug: Column) -> Column:
    """A slug as a title: hyphens and underscores to spaces, first letters capital."""
    return F.initcap(F.translate(_text(slug), "-_", "  "))


def locale(x: Column) -> Column:
    """The language of a locale: its first two letters, `en` if there is none."""
    return F.coalesce(F.lower(F.left(F.nullif(x, F.lit("")), F.lit(2))), F.lit("en"))


def display_name(field: Column) -> Column:
    """A link field's name for display, without `url`."""
    return F.initcap(F.trim(F.replace(F.replace(field, F.lit("_"), F.lit(" ")), F.lit("url"), F.lit(""))))


def short_description(x: Column, default: Column, limit: int = 200) -> Column:
    """Description without tags, also those that span lines, cut hard; `default` if nothing is left."""
    bare = F.left(F.regexp_replace(_text(x), "<[^>]+>", ""), F.lit(limit))
    return F.when(bare == "", default).otherwise(bare)


def without_prefix(x: Column, prefix: str = "File:") -> Column:
    return F.replace(x, F.lit(prefix), F.lit(""))


def joined_id(*parts: Column) -> Column:
    return F.concat_ws("_", *parts)
