"""Ingestion as a stream that runs until its input is used up: each file is taken exactly once.

The sink's rows of a micro-batch go to a folder with its number; the state's new version notes the number in the
same step.  A batch repeated after a failure either finds its number noted and does nothing, or finds the state
as it was, and writes the same rows again in their place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from sluice.operators.state import StateStore, first_by
from sluice.session import materialise


def run_available(
    spark: SparkSession, folder: str, schema: str, sink_path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], key: list[str], store: StateStore
) -> StreamingQuery:
    """Takes the Parquet files that are new in `folder`, inserts rows with keys the state lacks, appends `transform` of those to the sink."""

    def one(batch: DataFrame, number: int) -> None:
        if int(store.note() or -1) >= number:
            return
        known = store.read()
        # Of the state only keys are read, and only new rows are written.
        new = batch.dropna(subset=key).join(known.select(*key), key, "left_anti")
        fresh = materialise(first_by(new, key, []).select(*batch.columns), "fresh")
        transform(fresh).write.mode("overwrite").parquet(f"{sink_path}/batch={number}")
        own = [F.col(f.name) if f.name in fresh.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in known.schema]
        store.append(fresh.select(*own), str(number))

    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(one).start()


def status_counts(events: DataFrame, time: str, status: str, lateness: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Counts per window and status of a stream or table of state events; events later than `lateness` are dropped from a stream."""
    marked = events.withWatermark(time, lateness) if events.isStreaming else events
    return marked.groupBy(F.window(time, window).alias("window"), F.col(status).alias("status")).agg(F.count("*").alias("n"))
