"""Nested records, instants and snapshot changes: brute force, edge cases, properties."""

import json
import random
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.instants import read_instant
from sluice.operators import instants, nested, ordinals, snapshots

EPOCH = datetime(1970, 1, 1)


# --- nested records


def brute(value, steps=(), parent="", out=None):
    out = set() if out is None else out
    value = nested.unwrap(value)
    if isinstance(value, dict):
        for k, v in value.items():
            brute(v, (*steps, k), parent, out)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            here = (*steps, str(i))
            if isinstance(nested.unwrap(v), dict):
                out.add(("/".join(here), parent))
                brute(v, here, "/".join(here), out)
            else:
                brute(v, here, parent, out)
    return out


JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.text("ab{[\"/", max_size=3),
    lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text("ab/0", max_size=2), x, max_size=3) | x.map(json.dumps),
    max_leaves=15,
)


@settings(max_examples=200, deadline=None)
@given(JSON)
def test_elements_are_all_found(value):
    got = set()
    for steps, kinds, label, own in nested.element_objects(json.dumps(value)):
        assert len(steps) == len(kinds) == len(label) and isinstance(own, dict)
        depth = len(kinds[:-1].rpartition("o")[0]) + 1 if "o" in kinds[:-1] else 0
        got.add(("/".join(steps), "/".join(steps[:depth])))
    assert got == brute(value)


NESTED = [
    ("s", "t", "1", '{"a": [{"b": {"c": [null, {"d": 1}, [{"e": 2}]]}}, 3, {"f": "[{\\"g\\": 1}]"}]}', '[{"x": 1}]'),
    ("s", "t", "1", '{"a":[{"b":{"c":[null,{"d":1},[{"e":2}]]}},3,{"f":"[{\\"g\\":1}]"}]}', "[]"),  # delivered again
    ("s", "t", "2", '{"a": [{', None), ("s", "t", "3", "", "NaN"), (None, None, None, None, '{"y": [{}]}'), ("s", "t", "4", json.dumps(json.dumps({"z": [{}]})), "3"),
    ("s", "t", "5", "[" * 100_000, '[{"\\ud800": [{}]}]'),
]


def test_nested_table(spark, rows):
    df = spark.createDataFrame(NESTED, "source string, content_type string, id string, attributes string, external_images string").withColumn("path", F.lit("clash"))
    links = nested.linked(nested.element_nodes(df, ["source", "content_type", "id"], ["attributes", "external_images"]))
    got = {tuple(r) for r in links.select("id", "field", "path", "parent_path").collect()}
    assert got == {
        ("1", "attributes", "a/0", ""), ("1", "attributes", "a/0/b/c/1", "a/0"), ("1", "attributes", "a/0/b/c/2/0", "a/0"), ("1", "attributes", "a/2", ""),
        ("1", "attributes", "a/2/f/0", "a/2"), ("1", "external_images", "0", ""), (None, "external_images", "y/0", ""), ("4", "attributes", "z/0", ""),
        ("5", "external_images", "0", ""), ("5", "external_images", "0/?/0", "0"),
    }
    tables = {r[0] for r in links.where("id = '1'").select("schema_path").collect()}
    assert tables == {"a/*", "a/*/b/c/*", "a/*/b/c/*/*", "a/*/f/*", "*"}
    assert rows(nested.flat_table(links, ["id"], "external_images", "*", {"x": "x"}).where("id = '1'")) == [("1", "0", "", "1")]


def test_parent_label_is_truncated(spark):
    df = spark.createDataFrame([("1", '{"z": 1, "a": [{"b": [{}]}]}')], "id string, attributes string")
    got = nested.linked(nested.element_nodes(df, ["id"], ["attributes"])).orderBy(F.size("label")).select("label", "parent_label").collect()
    assert [tuple(r) for r in got] == [([1, 0], []), ([1, 0, 0, 0], [1, 0])]


def test_nested_empty(spark):
    df = spark.createDataFrame([], "id string, attributes string")
    assert nested.linked(nested.element_nodes(df, ["id"], ["attributes"])).count() == 0


# --- instants


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2023-06-21T16:41:26.688702912Z", ("2023-06-21 16:41:26.688702", 0, None)),
        (" 2020-07-27t05:14:32z ", ("2020-07-27 05:14:32", 0, None)),
        ("2023-08-21T12:42:56+0100", ("2023-08-21 12:42:56", 3600, None)),
        ("2023-11-01 13:46:48+00", ("2023-11-01 13:46:48", 0, None)),
        ("2023-08-07T14:03:34+02:00[Europe/Berlin]", ("2023-08-07 14:03:34", 7200, None)),
        ("2021-12-20 12:25:08 Europe/Berlin", ("2021-12-20 12:25:08", None, "Europe/Berlin")),
        ("2022-05-02 23:03:06 BST", ("2022-05-02 23:03:06", 3600, None)),
        ("20220723031518", ("2022-07-23 03:15:18", None, None)),
        ("20221229T062459Z", ("2022-12-29 06:24:59", 0, None)),
        ("1652978220", (1652978220_000000, 0, None)),
        ("1681686403373", (1681686403_373000, 0, None)),
        ("1601903824212636", (1601903824_212636, 0, None)),
        ("1673396040.625", (1673396040_625000, 0, None)),
        ("Wed, 20 Oct 2021 20:00:33 +1100", ("2021-10-20 20:00:33", 39600, None)),
        ("Sun, 19 Nov 2023 02:19:55 GMT", ("2023-11-19 02:19:55", 0, None)),
        ("Fri Oct 06 08:27:45 2023", ("2023-10-06 08:27:45", None, None)),
        ("June 19, 2023 6:05" + chr(0x202F) + "p.m.", ("2023-06-19 18:05:00", None, None)),
        ("12/1/2023 12:05 AM", ("2023-01-12 00:05:00", None, None)),
        ("11. April 2024, 18:27 Uhr", ("2024-04-11 18:27:00", None, None)),
        ("13 juin 2023 à 11h16", ("2023-06-13 11:16:00", None, None)),
        ("30 de abril de 2022 15:26", ("2022-04-30 15:26:00", None, None)),
        ("Jul 18, 2022, 23:50", ("2022-07-18 23:50:00", None, None)),
        ("2023-10-09", ("2023-10-09 00:00:00", None, None)),
        *[(x, None) for x in ("", "n/a", "draft", "2023", "2021-06", "31/02/2023 11:00", "0000-00-00 00:00:00", "-0001-11-30T00:00:00+00:00", "0999-01-01", "2022-13-05T08:00:00Z",
                              "2022-01-05T24:00:00Z", "13/13/2022", "12345", "2022-01-05 10:00 XYZZY", "Foo 12, 2022", "yesterday", "13:00 PM 1/1/2022")],
    ],
)
def test_read(text, expected):
    got = read_instant(text)
    if expected is None:
        assert got is None
    else:
        micros = expected[0] if isinstance(expected[0], int) else (datetime.fromisoformat(expected[0]) - EPOCH) // timedelta(microseconds=1)
        assert got == (micros, *expected[1:])


def test_date_order():
    assert read_instant("05/06/2021", True) != read_instant("05/06/2021", False)
    assert read_instant("10/22/2021", True) is None and read_instant("10/22/2021", False)


def model(local: datetime, zone: str) -> int:
    """PEP 495: fold 0 is the earlier of two, and the offset before the change of a skipped time."""
    return (local.replace(tzinfo=ZoneInfo(zone), fold=0).astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


def test_zones(spark):
    random.seed(5)
    zones = ["Europe/London", "America/New_York", "Australia/Sydney", "America/Bogota", "Asia/Kolkata", "Europe/Berlin"]
    texts = []
    for zone in zones:
        spans = instants.offset_intervals(zone)
        around = [b + o for (a, b, o) in spans if 0 < b < 2_000_000_000]
        for at in random.sample(around, min(25, len(around))):
            texts += [(zone, EPOCH + timedelta(seconds=at + d)) for d in (-7200, -3600, -1, 0, 1, 1800, 3599, 3600, 7200)]
        texts += [(zone, datetime(y, m, 5, 12, 30)) for y in (1066, 1849, 1900, 2030, 2200, 2449, 2450, 2451, 9999) for m in (1, 7)]
    rows = [(i, t.strftime("%Y-%m-%d %H:%M:%S") if t.year > 999 else "", z, True) for i, (z, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, text string, zone string, first boolean")
    got = {r["i"]: (r["utc_micros"], r["clock"]) for r in instants.to_utc(df, "text", "zone", "first").collect()}
    assert len(got) == len(texts)
    for i, (zone, local) in enumerate(texts):
        try:
            expected = model(local, zone)
        except OverflowError:
            continue
        assert got[i][0] == expected, (zone, local, got[i])
    assert {c for _, c in got.values()} == {"once", "twice", "skipped"}


def test_instants_edges(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00", None, None), (2, None, "Europe/Paris", True), (3, "2024-01-01 00:00 Asia/Tokyo", "Europe/Paris", True), (4, "2024-01-01 00:00:00", "No/Zone", False), (4, "2024-01-01 00:00:00", "No/Zone", False)],
        "bucket int, text string, zone string, first boolean",
    )
    got = rows(instants.to_utc(df, "text", "zone", "first").select("bucket", "utc_micros"))
    base = 1_704_067_200_000_000
    assert got == [(1, base), (3, base - 9 * 3600 * 10**6), (4, base), (4, base)]
    assert instants.to_utc(df.limit(0), "text", "zone", "first").count() == 0


# --- snapshots


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("HTTP://WWW.Host.Example/A/b//#x", "https://www.host.example/A/b"), ("https://h/?q=1/", "https://h?q=1/"), ("https://h", "https://h"), ("https://h/?", "https://h"),
        ("//H/x", "https://h/x"), (" not a url ", "not a url"), (None, None), ("", ""),
    ],
)
def test_canonical(spark, url, expected):
    assert spark.createDataFrame([(url,)], "u string").select(snapshots.canonical_url(F.col("u"))).first()[0] == expected


def test_changes_brute_force(spark):
    random.seed(2)
    days = [f"2024-01-{d:02d}" for d in (1, 8, 9, 20, 31)]
    data, seen = [], {}
    for n, day in enumerate(days):
        for key in range(40):
            if random.random() < 0.7:
                state = random.choice([None, "a", "b"])
                seen[n, key] = state
                data += [(day, f"k{key}", state, n)] * random.choice([1, 1, 2])
    random.shuffle(data)
    expected = set()
    for n in range(1, len(days)):
        for key in range(40):
            before, now = (n - 1, key) in seen, (n, key) in seen
            kind = "added" if now and not before else "removed" if before and not now else "changed" if now and seen[n, key] != seen[n - 1, key] else None
            if kind:
                expected.add((days[n], f"k{key}", kind))
    df = spark.createDataFrame(data, "snapshot string, key string, state string, n int")
    got = [tuple(r) for r in snapshots.changes(df, F.col("key"), F.col("state"), "snapshot").collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_changes_edges(spark):
    schema = "day string, k string, s string"
    empty = spark.createDataFrame([], schema)
    assert snapshots.changes(empty, F.col("k"), F.col("s"), "day").count() == 0
    single = spark.createDataFrame([("1", "a", None), (None, "b", None), ("1", None, "x")], schema)
    assert snapshots.changes(single, F.col("k"), F.col("s"), "day").count() == 0


# --- positions


def test_prefix_sums(spark):
    random.seed(3)
    data = [("g" if random.random() < 0.6 else random.choice(["h", None]), i, random.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(data, "g string, i int, w int")
    got = ordinals.with_prefix(df, "g", [F.col("i")], buckets=7).collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append(r["before"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and sum(map(len, by.values())) == 500
    weighted = sorted((r for r in ordinals.with_prefix(df, "g", [F.col("i")], F.col("w"), buckets=7).collect() if r["g"] == "g"), key=lambda r: (r["before"], r["w"]))
    total = 0
    for r in weighted:
        assert r["before"] == total
        total += r["w"]
