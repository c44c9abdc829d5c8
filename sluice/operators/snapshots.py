"""Changes between full snapshots, by gaps and islands.

Each snapshot brings every known key.  Consecutive snapshots in which a key
shows the same state form an island; an island is a validity interval.  Where
an interval starts, ends, or touches the next one of its key, something changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_URL = r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)([^?#]*)(\?[^#]*)?"


def canonical_url(url: Column) -> Column:
    """`https://`, host in lower case, path without slashes at its end, query; no fragment.

    A bare `?` is no query.  Text that is no absolute URL is kept, trimmed; null stays null.
    """
    query = F.regexp_extract(url, _URL, 3)
    built = F.concat(
        F.lit("https://"),
        F.lower(F.regexp_extract(url, _URL, 1)),
        F.regexp_replace(F.regexp_extract(url, _URL, 2), "/+$", ""),
        F.when(query == "?", "").otherwise(query),
    )
    return F.when(url.rlike(_URL), built).otherwise(F.trim(url))


def snapshot_numbers(rows: DataFrame, snapshot: str) -> DataFrame:
    """The distinct snapshots and their numbers 0, 1, ...: one row a snapshot, so few."""
    dates = rows.select(F.col(snapshot).alias("snapshot")).where("snapshot IS NOT NULL").distinct()
    return dates.withColumn("n", F.row_number().over(Window.orderBy("snapshot")) - 1)


def validity_intervals(rows: DataFrame, key: Column, state: Column, snapshot: str) -> DataFrame:
    """(key, state, first_n, last_n, previous_last, next_first, newest): the islands of each key.

    `rows` may repeat a key within a snapshot and come in any order; rows without
    key or snapshot are left out.  Of several states of one key in one snapshot the greatest holds,
    a state that is not null before null.  Null is a state of its own.  The neighbours are null at
    a key's ends.
    """
    numbers = snapshot_numbers(rows, snapshot)
    slim = rows.select(key.alias("key"), state.alias("state"), F.col(snapshot).alias("snapshot"))
    slim = slim.where("key IS NOT NULL AND snapshot IS NOT NULL")
    once = slim.groupBy("key", "snapshot").agg(F.max("state").alias("state"))
    numbered = once.join(F.broadcast(numbers), "snapshot")  # one row per snapshot date: days, not data
    by_key = Window.partitionBy("key").orderBy("n")
    # The hash stands for the state in comparisons of neighbours; null has a hash of its own.
    hashed = numbered.withColumn("hash", F.when(F.col("state").isNull(), F.lit("")).otherwise(F.md5("state")))
    starts = (F.lag("n").over(by_key).isNull()) | (F.lag("n").over(by_key) != F.col("n") - 1) | (F.lag("hash").over(by_key) != F.col("hash"))
    islands = hashed.withColumn("starts", starts.cast("int")).withColumn("island", F.sum("starts").over(by_key))
    spans = islands.groupBy("key", "island").agg(F.min("n").alias("first_n"), F.max("n").alias("last_n"), F.first("state", ignorenulls=False).alias("state"))
    order = Window.partitionBy("key").orderBy("first_n")
    spans = spans.withColumn("previous_last", F.lag("last_n").over(order)).withColumn("next_first", F.lead("first_n").over(order))
    return spans.withColumn("newest", numbers.agg(F.max("n")).scalar()).drop("island")


def changes(rows: DataFrame, key: Column, state: Column, snapshot: str) -> DataFrame:
    """(snapshot, key, change): `added`, `removed` or `changed` at each snapshot but the first.

    An interval that starts after the first snapshot is a change if it touches the one before it,
    else an addition; one that ends before the last is a removal at the next snapshot unless
    another touches it.  An empty table, or one snapshot, gives no rows.
    """
    spans = validity_intervals(rows, key, state, snapshot)
    touches_before = F.col("previous_last") == F.col("first_n") - 1
    touches_after = F.col("next_first") == F.col("last_n") + 1
    begun = F.when(F.col("first_n") > 0, F.struct(F.col("first_n").alias("n"), F.when(F.coalesce(touches_before, F.lit(False)), "changed").otherwise("added").alias("change")))
    ended = F.when((F.col("last_n") < F.col("newest")) & ~F.coalesce(touches_after, F.lit(False)), F.struct((F.col("last_n") + 1).alias("n"), F.lit("removed").alias("change")))
    events = spans.select("key", F.explode(F.filter(F.array(begun, ended), lambda e: e.isNotNull())).alias("event"))
    numbers = snapshot_numbers(rows, snapshot)
    dated = events.select("key", "event.n", "event.change").join(F.broadcast(numbers), "n")
    return dated.select("snapshot", "key", "change")
