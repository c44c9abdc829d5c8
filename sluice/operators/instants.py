"""Text in many notations to one UTC instant.

Each text is read into a clock time and what it says about the clock.  Clock
times without an offset meet the zone's offset intervals in an as-of join: the
intervals, in local time, are exploded to the years they touch and gathered by
(zone, year), so the join is an equi-join with a small table and moves no rows.
Two matching intervals mean an ambiguous time, none a nonexistent one, one gives
the offset.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from functools import lru_cache
from zoneinfo import ZoneInfo, available_timezones

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.instants import read_instant

MICROS = 1_000_000
#: Years with their own buckets.  Before, zones keep their first offset; after, rules repeat every 400 years.
FIRST_YEAR, LAST_YEAR = 1800, 2450
READING = "__micros long, __offset int, __zone string"


@lru_cache(maxsize=1000)
def offset_intervals(zone: str) -> tuple[tuple[int, int, int], ...]:
    """(from, to, offset): UTC seconds from which to which a zone keeps an offset, FIRST_YEAR to LAST_YEAR and open at both ends."""
    tz = ZoneInfo(zone)
    at = lambda s: int((datetime(1970, 1, 1, tzinfo=UTC) + timedelta(seconds=s)).astimezone(tz).utcoffset().total_seconds())
    start = int((datetime(FIRST_YEAR, 1, 1, tzinfo=UTC) - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds())
    end = int((datetime(LAST_YEAR + 1, 1, 1, tzinfo=UTC) - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds())
    out, since, now = [], -(1 << 40), at(start)
    step = 7 * 86400
    for s in range(start + step, end + step, step):
        if at(s) == now:
            continue
        low, high = s - step, s
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if at(mid) == now else (low, mid)
        out.append((since, high, now))
        since, now = high, at(high)
        if now != at(s):  # two changes within the step
            low, high = since, s
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if at(mid) == now else (low, mid)
            out.append((since, high, now))
            since, now = high, at(high)
    return (*out, (since, 1 << 40, now))


def _year(seconds: int) -> int:
    return (datetime(1970, 1, 1) + timedelta(seconds=max(min(seconds, 16_000_000_000), -6_000_000_000))).year


def zone_table(spark: SparkSession, zones: list[str]) -> DataFrame:
    """(__z, __y, __spans): per zone and local year the intervals that touch it, in local seconds.

    A span is (from, to, until, offset); `until` is where the next interval starts if the clock
    skips from `to` to there, else `to`.  Some 600 rows of one to a few spans a zone, and zones are
    as many as the time zone database has: a few hundred at most.
    """
    rows = []
    for zone in zones:
        spans = [(a + o, b + o, o) for a, b, o in offset_intervals(zone)]
        by_year: dict[int, list] = {y: [] for y in range(FIRST_YEAR, LAST_YEAR + 1)}
        for i, (a, b, o) in enumerate(spans):
            until = max(b, spans[i + 1][0]) if i + 1 < len(spans) else b
            for y in range(max(FIRST_YEAR, _year(a)), min(LAST_YEAR, _year(until)) + 1):
                by_year[y].append((a, b, until, o))
        rows += [(zone, y, x) for y, x in by_year.items()]
    return spark.createDataFrame(rows, "__z string, __y int, __spans array<struct<a: long, b: long, until: long, offset: int>>")


def _known(zone: str) -> bool:
    try:
        ZoneInfo(zone)
    except Exception:  # the database raises several kinds for malformed names
        return False
    return True


def zones_of(values: DataFrame, text: str, zone: str) -> list[str]:
    """The zones that rows have or their texts name, as far as the time zone database knows them: no more than it has, a few hundred."""
    named = F.regexp_extract(text, r"([A-Z][A-Za-z_+\-]+(?:/[A-Za-z0-9_+\-]+)+)", 1)
    found = values.select(F.explode(F.array(F.col(zone), named)).alias("zone"))
    return [r[0] for r in found.where(F.col("zone").isin(sorted(available_timezones()))).distinct().collect()]


def with_reading(values: DataFrame, text: str, day_first: str) -> DataFrame:
    """Adds __micros, __offset, __zone (see `functions.instants`); null where the text names no instant."""
    columns = values.columns

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [None if t is None else read_instant(t, first is not False) for t, first in zip(batch.column(text).to_pylist(), batch.column(day_first).to_pylist(), strict=True)]
            keep = [i for i, r in enumerate(got) if r is not None]
            some = [got[i] for i in keep]
            new = [pa.array([r[k] for r in some], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(keep, pa.int32())).columns, *new], [*columns, "__micros", "__offset", "__zone"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in values.schema) + ", " + READING
    return values.mapInArrow(read, schema)


def unread(values: DataFrame, text: str, day_first: str) -> DataFrame:
    """The rows whose text is not blank and names no instant: given back, so that nothing vanishes."""

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = zip(batch.column(text).to_pylist(), batch.column(day_first).to_pylist(), strict=True)
            yield batch.filter(pa.array([t is not None and bool(t.strip()) and read_instant(t, first is not False) is None for t, first in of], pa.bool_()))

    return values.mapInArrow(rest, values.schema)


def to_utc(values: DataFrame, text: str, zone: str, day_first: str) -> DataFrame:
    """Adds utc_micros and clock (`offset`, `once`, `twice` or `skipped`); rows that name no instant are left out.

    An offset in the text holds, then a zone in the text, then the row's `zone` (UTC if null or
    unknown).  A time that occurs twice is the earlier; a skipped one is read with the offset before
    the change.  A null order of day and month puts the day first.
    """
    spark = values.sparkSession
    read = with_reading(values, text, day_first)
    known = sorted({z for z in zones_of(values, text, zone) if _known(z)} | {"UTC"})
    table = F.broadcast(zone_table(spark, known))  # bounded by the time zone database, not the data
    seconds = F.floor(F.col("__micros") / MICROS)
    year = F.year(F.timestamp_seconds(seconds))
    # Rules of later years repeat with the calendar's 400 years.
    cycles = F.greatest(F.lit(0), F.ceil((year - LAST_YEAR) / 400))
    shifted = (seconds - cycles * F.lit(146_097 * 86_400)).cast("long")
    named = F.coalesce(F.when(F.col("__zone").isin(known), F.col("__zone")), F.when(F.col(zone).isin(known), F.col(zone)), F.lit("UTC"))
    keyed = read.withColumn("__at", shifted).withColumn("__named", F.when(F.col("__offset").isNull(), named))
    keyed = keyed.withColumn("__bucket", F.greatest(F.lit(FIRST_YEAR), F.least(F.lit(LAST_YEAR), F.year(F.timestamp_seconds("__at")))))
    joined = keyed.join(table, (F.col("__named") == F.col("__z")) & (F.col("__bucket") == F.col("__y")), "left")
    match = joined.withColumn("__in", F.filter("__spans", lambda s: (s["a"] <= F.col("__at")) & (F.col("__at") < s["b"])))
    match = match.withColumn("__skip", F.filter("__spans", lambda s: (s["b"] <= F.col("__at")) & (F.col("__at") < s["until"])))
    chosen = (
        F.when(F.col("__offset").isNotNull(), F.col("__offset"))
        .when(F.size("__in") > 0, F.array_max(F.transform("__in", lambda s: s["offset"])))
        .otherwise(F.get("__skip", F.lit(0))["offset"])
    )
    clock = F.when(F.col("__offset").isNotNull(), "offset").when(F.size("__in") > 1, "twice").when(F.size("__in") == 1, "once").otherwise("skipped")
    out = match.withColumn("utc_micros", F.col("__micros") - chosen.cast("long") * MICROS).withColumn("clock", clock)
    return out.select(*values.columns, "utc_micros", "clock")
