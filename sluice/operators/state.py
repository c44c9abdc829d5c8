"""Tracking state as a table: keyed inserts, partial updates, semi- and anti-joins against it.

Parquet tables can't be updated in place, so an operation gives the whole new
state; `StateStore` writes it beside the old one and then moves a pointer.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def equals(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Rows whose columns have the wanted values; None (or '') means any."""
    for column, value in wanted.items():
        if value:
            df = df.where(F.col(column) == value)
    return df


def first_by(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the order.  Ties are broken by the whole row, so the result is fixed.

    Without an order the least row is found with map-side combine, so that a key of very many rows is no burden.
    """
    if not order:
        rest = [c for c in df.columns if c not in key]
        if not rest:
            return df.distinct()
        least = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__least"))
        return least.select(*[F.col(c) if c in key else F.col("__least")[c].alias(c) for c in df.columns])
    packed = F.struct(*df.columns)
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order, packed)))
    return ranked.where("__rank = 1").drop("__rank")


def insert_absent(state: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The state and, of keys it lacks, the first new row each.  Rows that exist are never changed; new rows without key are left out."""
    keyed = new.dropna(subset=list(key)).join(state.select(*key), list(key), "left_anti")
    fresh = first_by(keyed, key, order).select(*new.columns)
    return state.unionByName(fresh, allowMissingColumns=True)


def absent(new: DataFrame, state: DataFrame, key: Sequence[str]) -> DataFrame:
    """The new rows whose key the state lacks, with their repeats."""
    return new.join(state.select(*key).distinct(), list(key), "left_anti")


def present(new: DataFrame, state: DataFrame, key: Sequence[str]) -> DataFrame:
    """The new rows whose key the state has, with their repeats."""
    return new.join(state.select(*key).distinct(), list(key), "left_semi")


def without_absent(state: DataFrame, listed: DataFrame, key: Sequence[str], scope: Column) -> tuple[DataFrame, DataFrame]:
    """(state without the rows in scope whose key is not listed, those rows)."""
    inside, outside = state.where(scope), state.where(~F.coalesce(scope, F.lit(False)))
    keys = listed.select(*key).distinct()
    return outside.unionByName(inside.join(keys, list(key), "left_semi")), inside.join(keys, list(key), "left_anti")


def delete_keys(state: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    return state.join(keys.select(*key).distinct(), list(key), "left_anti")


def apply_events(
    state: DataFrame,
    events: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    overwrite: dict[str, str],
    keep_old: dict[str, str] | None = None,
    count: str | None = None,
) -> DataFrame:
    """The state after a batch of events, each a partial update of one key's row; events of unknown keys change nothing.

    `overwrite`: state column -> event column, of the key's last event.  `keep_old`: the same, but the
    last value that is not null, and if there is none the old one.  `count`: a state column to which the
    number of events is added.  Last by the `order` columns, ties by the event's values.  Several
    events of a key are merged with map-side combine before anything is joined.
    """
    named = overwrite | (keep_old or {})
    rank = F.struct(*[F.col(o).alias(f"r{i}") for i, o in enumerate(order)], *[F.col(v).alias(f"v{i}") for i, v in enumerate(named.values())])
    merged = events.groupBy(*key).agg(
        F.count("*").alias("__n"),
        *[F.max_by(F.col(v), rank).alias(f"__new_{k}") for k, v in overwrite.items()],
        *[F.max_by(F.col(v), F.when(F.col(v).isNotNull(), rank)).alias(f"__new_{k}") for k, v in (keep_old or {}).items()],
    )
    joined = state.join(merged, list(key), "left")
    hit = F.col("__n").isNotNull()
    columns = []
    for c in state.columns:
        if c in overwrite:
            columns.append(F.when(hit, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c))
        elif c in (keep_old or {}):
            columns.append(F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c))
        elif c == count:
            columns.append(F.when(hit, F.coalesce(F.col(c), F.lit(0)) + F.col("__n")).otherwise(F.col(c)).cast(state.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(c))
    return joined.select(*columns)


def reset(state: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    """The state with new values in the rows that satisfy a condition."""
    return state.withColumns({c: F.when(where, v).otherwise(F.col(c)) for c, v in values.items()})


def newest(df: DataFrame, by: str, n: int, nulls_first: bool = False, key: str | None = None) -> DataFrame:
    """The n newest rows; nulls come first or (by default) last, equal times in the order of `key`."""
    column = F.col(by).desc_nulls_first() if nulls_first else F.col(by).desc_nulls_last()
    return df.orderBy(column, *([F.col(key)] if key else [])).limit(n)


#: So many appended parts are read beside the last whole version before they are made one with it.
PARTS = 20


class StateStore:
    """Versions of a state table in a folder that all executors share; a pointer names the folders of the current one.

    A version is written before the pointer moves, by a rename, so readers see the old or the
    new state and a job that dies leaves the old one.  `write` replaces the state; `append` adds rows of new keys and
    writes only those, whatever the state's size.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str) -> None:
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):  # noqa: ANN202
        return self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.folder, name))

    def _current(self) -> str | None:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(""))] if self._fs.exists(self._path("")) else []
        pointers = sorted(n for n in names if n.startswith("current-"))
        return pointers[-1] if pointers else None

    def read(self) -> DataFrame:
        """The current state; empty before the first write."""
        pointer = self._current()
        if pointer is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[os.path.join(self.folder, v) for v in self._pointed(pointer)["versions"]])

    def _pointed(self, pointer: str) -> dict:
        return json.loads(self.spark.read.text(os.path.join(self.folder, pointer)).first()[0])

    def note(self) -> str | None:
        """What the last write noted beside the state, in the same step."""
        pointer = self._current()
        return self._pointed(pointer)["note"] if pointer else None

    def write(self, state: DataFrame, note: str | None = None) -> None:
        """The state as a whole."""
        self._move(state, [], note)

    def append(self, rows: DataFrame, note: str | None = None) -> None:
        """Rows whose keys the state lacks.  Every PARTS times the state is written whole."""
        pointer = self._current()
        parts = self._pointed(pointer)["versions"] if pointer else []
        if len(parts) < PARTS:
            self._move(rows, parts, note)
        else:
            self._move(self.read().unionByName(rows), [], note)

    def _move(self, rows: DataFrame, parts: list[str], note: str | None) -> None:
        before = self._current()
        number = int(before.split("-")[1]) + 1 if before else 1
        version = f"version-{number:012d}-{uuid.uuid4().hex}"
        rows.write.parquet(os.path.join(self.folder, version))
        temporary = self._path(f".tmp-{uuid.uuid4().hex}")
        stream = self._fs.create(temporary)
        stream.write(bytearray(json.dumps({"versions": [*parts, version], "note": note}).encode()))
        stream.close()
        if not self._fs.rename(temporary, self._path(f"current-{number:012d}")):
            raise RuntimeError("another writer has moved the state on")
