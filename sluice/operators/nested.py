"""Deeply nested JSON into flat, linked tables by Dewey labels.

A node's label is the list of its ancestors' ordinals: the position of a value
among an object's keys or an array's elements.  A parent's label is a
truncation of its child's, and so is its path; what groups the nodes into
tables is the schema path, the path without positions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from json.decoder import scanstring
from json.scanner import NUMBER_RE
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODES = "field string, steps array<string>, kinds string, label array<int>, scalars string"

_ITEM = pa.struct([
    ("field", pa.string()), ("steps", pa.list_(pa.string())), ("kinds", pa.string()),
    ("label", pa.list_(pa.int32())), ("scalars", pa.string()),
])


def _reject(name: str) -> Any:
    raise ValueError(f"{name} is not JSON")


_WHITE = re.compile(r"[ \t\n\r]*")
_CONSTANTS = {"t": ("true", True), "f": ("false", False), "n": ("null", None)}


def read_json(text: str | None) -> Any:
    """The value of JSON text, however deep; ValueError for anything else and for NaN."""
    if text is None:
        raise ValueError("null")
    try:
        return json.loads(text, parse_constant=_reject)
    except RecursionError:
        return read_deep(text)


def read_deep(text: str) -> Any:
    """As `json.loads`, with a stack of its own: for nesting that the parser can't hold."""
    skip = lambda i: _WHITE.match(text, i).end()
    open_: list[Any] = []
    keys: list[str] = []  # of each open object

    def key(i: int) -> int:
        if text[i : i + 1] != '"':
            raise ValueError(f"no key at {i}")
        name, i = scanstring(text, i + 1, True)
        i = skip(i)
        if text[i : i + 1] != ":":
            raise ValueError(f"no colon at {i}")
        keys.append(name)
        return skip(i + 1)

    i = skip(0)
    while True:
        first = text[i : i + 1]
        if first == '"':
            value, i = scanstring(text, i + 1, True)
        elif first in ("{", "["):
            value, i = {} if first == "{" else [], skip(i + 1)
            if text[i : i + 1] != ("}" if first == "{" else "]"):
                open_.append(value)
                i = key(i) if first == "{" else i
                continue
            i += 1
        elif first in _CONSTANTS and text.startswith(_CONSTANTS[first][0], i):
            name, value = _CONSTANTS[first]
            i += len(name)
        elif number := NUMBER_RE.match(text, i):
            whole, fraction, exponent = number.groups()
            value, i = float(number[0]) if fraction or exponent else int(whole), number.end()
        else:
            raise ValueError(f"no value at {i}")
        while True:
            i = skip(i)
            if not open_:
                if i < len(text):
                    raise ValueError(f"more text at {i}")
                return value
            top, mark = open_[-1], text[i : i + 1]
            if isinstance(top, dict):
                top[keys.pop()] = value
            else:
                top.append(value)
            if mark == ",":
                i = skip(i + 1)
                i = key(i) if isinstance(top, dict) else i
                break
            if mark != ("}" if isinstance(top, dict) else "]"):
                raise ValueError(f"not closed at {i}")
            value, i = open_.pop(), i + 1


def sound(text: str) -> str:
    """The text with `?` for halves of surrogate pairs, which JSON may hold and UTF-8 can't."""
    return text if text.isascii() else text.encode("utf-8", "replace").decode()


def unwrap(value: Any) -> Any:
    """A string that is the JSON text of an object or array is read as that, any number of times over."""
    while isinstance(value, str) and value.lstrip(" \t\r\n")[:1] in ("{", "[", '"'):
        try:
            inner = read_json(value)
        except ValueError:
            return value
        if isinstance(inner, (dict, list)):
            return inner
        if not isinstance(inner, str) or not isinstance(unwrap(inner), (dict, list)):
            return value
        value = inner
    return value


def element_objects(text: str | None) -> Iterator[tuple[list[str], str, list[int], dict]]:
    """(steps, kinds, label, object) of each object that is an array element, at any depth.

    `kinds` has a letter per step: k a value under a key, o an object in an array, a anything else
    in an array.  Invalid JSON yields nothing.
    """
    try:
        top = unwrap(read_json(text))
    except ValueError:
        return
    stack: list[tuple[Any, tuple | None]] = [(top, None)]  # values, and (parent's place, step, kind, ordinal)
    while stack:
        value, place = stack.pop()
        if isinstance(value, dict):
            if place and place[2] == "o":
                yield _labels(place) + (value,)
            below = [(sound(key), "k", x) for key, x in value.items()]
        elif isinstance(value, list):
            below = [(str(i), "", x) for i, x in enumerate(value)]
        else:
            continue
        for i, (step, kind, x) in enumerate(below):
            x = unwrap(x)
            if isinstance(x, (dict, list)):
                stack.append((x, (place, step, kind or ("o" if isinstance(x, dict) else "a"), i)))


def _labels(place: tuple | None) -> tuple[list[str], str, list[int]]:
    steps, kinds, label = [], [], []
    while place:
        place, step, kind, i = place
        steps.append(step)
        kinds.append(kind)
        label.append(i)
    return steps[::-1], "".join(kinds[::-1]), label[::-1]


def _scalars(value: dict) -> str:
    """The object's own scalar values, as JSON with sorted keys: the row of its table."""
    return sound(json.dumps({k: v for k, v in value.items() if not isinstance(unwrap(v), (dict, list))}, ensure_ascii=False, sort_keys=True))


def element_nodes(records: DataFrame, key: list[str], fields: list[str], rows: bool = True) -> DataFrame:
    """One row per element object of the JSON text columns `fields`: the key columns, field, steps, kinds, label, scalars.

    Other columns of `records` are not read.  Null, empty and cut-off JSON gives no rows; a
    record delivered several times gives its rows as many times.  `scalars` is null unless `rows`.
    """
    if clash := {"field", "steps", "kinds", "label", "scalars"} & set(key):
        raise ValueError(f"key columns named like results: {sorted(clash)}")
    slim = records.select(*[F.col(f"`{k}`").alias(k) for k in key], *[F.col(f"`{f}`").alias(f"__f{i}") for i, f in enumerate(fields)])
    schema = ", ".join(f"`{k}` {slim.schema[k].dataType.simpleString()}" for k in key) + ", " + NODES

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [batch.column(len(key) + i).to_pylist() for i in range(len(fields))]
            at: list[int] = []
            out: list[dict] = []
            cells = 0
            for row in range(batch.num_rows):
                for field, column in zip(fields, texts, strict=True):
                    for steps, kinds, label, value in element_objects(column[row]):
                        at.append(row)
                        out.append({"field": field, "steps": steps, "kinds": kinds, "label": label, "scalars": _scalars(value) if rows else None})
                        cells += len(label)
                        if len(at) >= 20_000 or cells >= 1_000_000:  # one record may hold very long or deep arrays
                            yield _batch(batch, key, at, out)
                            at, out, cells = [], [], 0
            if at:
                yield _batch(batch, key, at, out)

    return slim.mapInArrow(nodes, schema)


def _batch(batch: pa.RecordBatch, key: list[str], at: list[int], out: list[dict]) -> pa.RecordBatch:
    taken = batch.select(list(range(len(key)))).take(pa.array(at, pa.int32()))
    flat = pa.array(out, _ITEM).flatten()
    return pa.RecordBatch.from_arrays([*taken.columns, *flat], [*key, *[f.name for f in _ITEM]])


def path(steps: Column) -> Column:
    return F.array_join(steps, "/")


def parent_depth(kinds: Column) -> Column:
    """Length of the parent's label: up to the last element object above the node; 0 if there is none."""
    above = F.substring(kinds, F.lit(1), F.length(kinds) - 1)
    return F.length(F.regexp_extract(above, "^(.*o)[^o]*$", 1))


def schema_path(steps: Column, kinds: Column) -> Column:
    """The path with `*` for each array position: the name of the node's table."""
    return F.array_join(F.transform(steps, lambda s, i: F.when(F.substring(kinds, i + 1, F.lit(1)) == "k", s).otherwise("*")), "/")


def linked(nodes: DataFrame) -> DataFrame:
    """Adds path, parent_path, parent_label and schema_path to `element_nodes`; the parent's by truncation."""
    depth = parent_depth(F.col("kinds"))
    return nodes.select(
        "*",
        path(F.col("steps")).alias("path"),
        path(F.slice("steps", F.lit(1), depth)).alias("parent_path"),
        F.slice("label", F.lit(1), depth).alias("parent_label"),
        schema_path(F.col("steps"), F.col("kinds")).alias("schema_path"),
    )


def flat_table(links: DataFrame, key: list[str], field: str, table: str, columns: dict[str, str]) -> DataFrame:
    """One of the flat tables: record key, path, parent_path, and scalar values as text, by column name and JSON key.

    Records delivered again give equal rows, which appear once.
    """
    own = links.where((F.col("field") == field) & (F.col("schema_path") == table))
    values = [F.get_json_object("scalars", "$['" + k.replace("'", "") + "']").alias(c) for c, k in columns.items()]
    return own.select(*key, "path", "parent_path", *values).distinct()
