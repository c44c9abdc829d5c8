"""Texts that name no instant are given back; short forms are read."""

import pytest
from pyspark.sql import functions as F

from sluice.functions.instants import read_instant
from sluice.operators import instants


@pytest.mark.parametrize(
    ("short", "whole"),
    [("2024-06-01T10", "2024-06-01T10:00"), ("2024-06-01T10Z", "2024-06-01T10:00Z"), ("2024-06-01t10+05:30", "2024-06-01t10:00+05:30"), ("2024-06-01 10:00 UTC+2", "2024-06-01 10:00 UTC+02"), ("2024-06-01 10:00 GMT-3:30", "2024-06-01 10:00 GMT-03:30")],
)
def test_short_forms(short, whole):
    assert read_instant(short) == read_instant(whole) is not None


@pytest.mark.parametrize("text", ["2024-06-01T25", "2024-06-01T1", "24-06-01", "1717236000000000000", "soon", "2024-06", "2024-02-30T10"])
def test_no_instants(text):
    assert read_instant(text) is None


def test_unread(spark):
    rows = [("a", "2024-06-01", True), ("b", "soon", None), ("c", " ", True), ("d", None, False), ("e", "13/13/2024", False), ("f", "soon", True)]
    df = spark.createDataFrame(rows, "k string, text string, first boolean").withColumn("__micros", F.lit(1))
    assert sorted(r["k"] for r in instants.unread(df, "text", "first").collect()) == ["b", "e", "f"]
    assert instants.unread(df.limit(0), "text", "first").count() == 0
    read = instants.to_utc(df.drop("__micros").withColumn("zone", F.lit("UTC")), "text", "zone", "first")
    assert sorted(r["k"] for r in read.collect()) == ["a"]
