"""Column functions, with the edge cases of the messages."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from msgmart.functions import jsontext, maps, timeparse


def one(spark, column, value, ddl="string"):
    return spark.createDataFrame([(value,)], f"v {ddl}").select(column(F.col("v")).alias("r")).first().r


def at(*parts):
    return dt.datetime(*parts)


@pytest.fixture(autouse=True)
def _utc(spark, monkeypatch):
    monkeypatch.setenv("TZ", "UTC")
    import time

    time.tzset()


def test_stamp14(spark):
    assert one(spark, timeparse.stamp14, "20190624094654") == at(2019, 6, 24, 9, 46, 54)
    for bad in ("20190624", "", "x", None, "20191324094654"):
        assert one(spark, timeparse.stamp14, bad) is None


def test_iso_millis_needs_three_digits(spark):
    plain = lambda c: timeparse.iso_millis(c, None)
    assert one(spark, plain, "2019-06-24T09:46:54.123Z") == at(2019, 6, 24, 9, 46, 54, 123000)
    for bad in ("2019-06-24T09:46:54Z", "2019-06-24T09:46:54.123456Z", "2019-06-24", None):
        assert one(spark, plain, bad) is None


@pytest.mark.parametrize(
    "text, utc",
    [
        ("2020-07-01T12:00:00.000Z", at(2020, 7, 1, 10)),
        ("2020-01-01T12:00:00.000Z", at(2020, 1, 1, 11)),
        ("2020-03-29T02:30:00.000Z", at(2020, 3, 29, 1, 30)),  # in the spring gap
        ("2020-10-25T02:30:00.000Z", at(2020, 10, 25, 0, 30)),  # twice in autumn: the earlier
    ],
)
def test_berlin_to_utc(spark, text, utc):
    assert one(spark, timeparse.iso_millis, text) == utc


def test_iso_seconds_ignores_the_rest(spark):
    for tail in ("", "Z", ".123Z", ".123456+02:00"):
        assert one(spark, timeparse.iso_seconds, "2020-07-01T12:00:00" + tail) == at(2020, 7, 1, 10)
    assert one(spark, timeparse.iso_seconds, "2020-07-01") is None


def test_epoch_millis(spark):
    assert one(spark, timeparse.epoch_millis_text, "1579174772080") == "2020-01-16 11:39:32"
    assert one(spark, timeparse.epoch_millis_text, 1579174772080, "bigint") == "2020-01-16 11:39:32"
    assert one(spark, timeparse.epoch_millis_text, "999999999999") == "2001-09-09 01:46:39"  # 12 digits
    assert one(spark, timeparse.epoch_millis_text, "-1") == "1969-12-31 23:59:59"
    assert one(spark, timeparse.epoch_millis_text, "soon") is None
    assert one(spark, timeparse.epoch_millis_text, None) is None


ITEM = "struct<id:string,name:string>"


@pytest.mark.parametrize(
    "text, first",
    [
        ('[{"id":"a","name":"x"},{"id":"b","name":"y"}]', "a"),
        ('[{"id":"a","name":"[x]"}]', "a"),
        ("[]", None),
        (None, None),
    ],
)
def test_first_object_two_ways(spark, text, first):
    for function in (jsontext.first_object, jsontext.first_object_stripped):
        assert one(spark, lambda c: function(c, ITEM)["id"], text) == first


def test_strip_brackets_takes_one_of_each_end(spark):
    assert one(spark, jsontext.strip_brackets, "[[1],[2]]") == "[1],[2]"
    assert one(spark, jsontext.strip_brackets, '{"a":[1]}') == '{"a":[1]}'


HARBOURS = [
    ("p-1", "quay", (12, "north")),
    ("p-2", "depot", (7, "east")),
    ("p-3", "quay", (0, "north")),
]


@pytest.fixture
def harbours(spark):
    return spark.createDataFrame(HARBOURS, "id string, place string, properties struct<berths:int,side:string>")


def test_map_of_literal_keys_and_its_rows(harbours):
    entries = maps.map_of(
        {"berths": F.col("properties.berths").cast("string"), "side": F.col("properties.side")}
    )
    rows = maps.map_rows(harbours.select("id", "place", entries.alias("m")), ["id", "place"], "m").collect()
    want = []
    for id_, place, (berths, side) in HARBOURS:
        want += [(id_, place, "berths", str(berths)), (id_, place, "side", side)]
    assert [tuple(r) for r in rows] == want


def test_map_of_matching_columns(harbours):
    rows = maps.map_rows(
        harbours.select("id", maps.map_of_matching(harbours, "properties").alias("m")), ["id"], "m"
    ).collect()
    assert [(r.id, r.key, tuple(r.value)) for r in rows] == [(i, "properties", p) for i, _, p in HARBOURS]
