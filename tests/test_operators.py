"""Arrays, latest version, increments and envelope filters on tiny frames."""

from __future__ import annotations

from itertools import product

import pytest
from pyspark.sql import functions as F

from msgmart.session import setting
from msgmart.operators import arrays, increments, latest
from msgmart.sources import envelope

PAIRS = "array<struct<name:string,value:string>>"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def checks(spark):
    data = [
        ("1", [("A", "a1"), ("B", "b1"), ("A", "a2"), ("B", "b2"), ("C", None)]),
        ("2", [("B", "b"), (None, "x")]),
        ("3", []),
        ("4", None),
        ("5", [("Z", "z")]),
    ]
    return spark.createDataFrame(data, f"id string, pairs {PAIRS}")


def brute_attributes(frame, names):
    """Chained left joins on the id, by hand."""
    data = [(r.id, r.pairs or []) for r in frame.collect()]
    out = []
    for id_, _ in data:
        values = []
        for name in names:
            hits = [p.value for other, pairs in data if other == id_ for p in pairs if p.name == name]
            values.append(hits or [None])
        out += [(id_, *combination) for combination in product(*values)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["array", "join"])
def test_attributes(checks, how):
    got = arrays.attributes(checks, "id", "pairs", {"a": "A", "b": "B", "c": "C"}, how=how)
    assert got.columns == ["id", "a", "b", "c"]
    assert rows(got) == brute_attributes(checks, ["A", "B", "C"])


def test_attributes_of_repeated_ids_need_the_join(spark, checks):
    twice = checks.unionByName(spark.createDataFrame([("1", [("A", "late")])], checks.schema))
    found = increments.measure(twice.withColumn("acl_dop", F.lit("1")), key="id")
    assert (found.rows, found.repeated) == (6, 1)
    joined = arrays.attributes(twice, "id", "pairs", {"a": "A", "b": "B"}, how="join")
    assert rows(joined) == brute_attributes(twice, ["A", "B"])


def test_attribute_conversion(checks):
    got = arrays.attributes(checks, "id", "pairs", {"a": "A"}, {"a": F.upper})
    assert [r for r in rows(got) if r[0] == "1"] == [("1", "A1"), ("1", "A2")]


def _busy(n_hot, hits):
    """One id with many messages, of which few have elements; ids of their own; repeated rows; no id."""
    pairs = lambda k: [("A", f"a{k}"), ("B", f"b{k}"), ("A", f"c{k}")] if k % hits == 0 else [("B", "only")] if k == 1 else []
    data = [("hot", pairs(k)) for k in range(n_hot)]
    data += [(f"k{k % 40}", pairs(k)) for k in range(60)] + [("twice", [("A", "x")])] * 2 + [(None, [("A", "y")])] * 3 + [("idle", None)] * 30
    return data


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_busy_ids_meet_in_blocks(spark, block):
    frame = spark.createDataFrame(_busy(60, 20), "id string, pairs array<struct<name:string,value:string>>").repartition(4)
    got = arrays.attributes(frame, "id", "pairs", {"a": "A", "b": "B"}, {"a": F.upper}, how="join", block=block)
    named = frame.where("id IS NOT NULL")
    want = [(i, a and a.upper(), b) for i, a, b in brute_attributes(named, ["A", "B"])] + [(None, None, None)] * 3
    assert rows(got) == sorted(want, key=repr)
    child = arrays.matching_child(frame, "id", "pairs", lambda e: e["name"] == "A", {"a": lambda e: e["value"]}, "join", block)
    assert rows(child) == sorted(brute_attributes(named, ["A"]) + [(None, None)] * 3, key=repr)


def test_a_busy_id_runs_in_many_tasks(spark):
    """50,000 messages of one id; each part of them is a task's, and no task has all."""
    data = spark.range(50_000).selectExpr("'hot' AS id", "CASE WHEN id % 10000 = 0 THEN array(struct('A' AS name, string(id) AS value)) END AS pairs")
    with setting(spark, "spark.sql.adaptive.enabled", "false"), setting(spark, "spark.sql.shuffle.partitions", "64"), setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        got = arrays.attributes(data, "id", "pairs", {"a": "A"}, how="join")
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 250_000 and len(sizes) > 20 and max(sizes) < 50_000


@pytest.mark.parametrize("how", ["array", "join"])
def test_matching_child_keeps_parents_and_multiplies(spark, how):
    item = "struct<id:string,service:struct<name:string>>"
    data = [
        ("1", [("x", ("hit",)), ("y", ("hit",)), ("z", ("miss",))]),
        ("2", [("x", ("miss",)), ("n", None)]),
        ("3", []),
        ("4", None),
    ]
    parents = spark.createDataFrame(data, f"id string, items array<{item}>")
    got = arrays.matching_child(
        parents, "id", "items", lambda e: e["service"]["name"] == "hit", {"child": lambda e: e["id"]}, how
    )
    assert rows(got) == [("1", "x"), ("1", "y"), ("2", None), ("3", None), ("4", None)]


def test_child_rows_drop_empty_parents_but_keep_null_elements(spark):
    frame = spark.createDataFrame(
        [(7, "north", [40, None, 41]), (8, "south", []), (9, "east", None)], "depot int, side string, loads array<int>"
    )
    got = arrays.child_rows(frame, "loads", ["depot", "side"], [F.col(arrays.ELEMENT).alias("v")])
    assert [tuple(r) for r in got.collect()] == [(7, "north", 40), (7, "north", None), (7, "north", 41)]


def test_unknown_form(checks):
    with pytest.raises(ValueError):
        arrays.attributes(checks, "id", "pairs", {"a": "A"}, how="pivot")


VERSIONS = [
    ("k1", "2020-01-01 00:00:00", "1", "a"),
    ("k1", "2020-01-02 00:00:00", "2", "b"),
    ("k1", "2020-01-02 00:00:00", "3", "c"),  # same time: greater id
    ("k2", None, "9", "d"),
    ("k2", "2019-01-01 00:00:00", "1", "e"),  # null time is oldest
    ("k3", None, None, "f"),
    (None, "2020-01-01 00:00:00", "1", "g"),  # a null key is a group of its own
    (None, "2020-01-03 00:00:00", "1", "h"),
]


@pytest.mark.parametrize("form", [latest.latest_by_rank, latest.latest_by_max])
def test_latest_version(spark, form):
    frame = spark.createDataFrame(VERSIONS, "k string, t string, id string, v string")
    got = form(frame.withColumn("t", F.col("t").cast("timestamp")), "k", ["t", "id"])
    assert got.columns == ["k", "t", "id", "v", "rnk"]
    assert sorted((r.k or "", r.v, r.rnk) for r in got.collect()) == [
        ("", "h", 1),
        ("k1", "c", 1),
        ("k2", "e", 1),
        ("k3", "f", 1),
    ]


def test_latest_forms_agree_on_a_hot_key(spark):
    """A third of all rows share one key."""
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.pmod(F.hash("id"), F.lit(1000)).alias("t"),
        F.col("id").alias("v"),
    )
    a = latest.latest_by_rank(frame, "k", ["t", "v"])
    b = latest.latest_by_max(frame, "k", ["t", "v"])
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    assert b.count() == 20_001


MESSAGES = [
    ("1", "20190531235959", 1, "T1", "1", "{}", None, None, None),
    ("2", "20190601000000", 1, "T1", "2", "{}", None, None, None),
    ("3", "20190601000001", 1, "T2", "1", "{}", None, None, None),
    ("4", "20190701000000", 1, "T1", "3", "{}", None, None, None),
    ("5", "20190801000000", 1, None, "1", "{}", None, None, None),
]


@pytest.fixture
def lake(spark):
    return spark.createDataFrame(MESSAGES, envelope.ENVELOPE)


def ids(df):
    return sorted(r.acl_id for r in df.collect())


def test_filters(lake):
    assert ids(envelope.of_kind(lake, ["T1"], ["1", "2"])) == ["1", "2"]
    assert ids(envelope.of_kind(lake, ["T1", "T2"], ["1"])) == ["1", "3"]
    assert ids(envelope.of_ids(lake, ["2", "5", "7"])) == ["2", "5"]
    assert ids(envelope.before(lake, "20190601000000")) == ["1"]


def test_bounds_are_open_below_and_closed_above(lake):
    assert ids(envelope.between_marks(lake, "20190601000000", "20190701000000")) == ["3", "4"]
    assert ids(envelope.between_marks(lake, None, "20190601000000")) == ["1", "2"]
    assert ids(envelope.between_marks(lake, "20190701000000")) == ["5"]


def test_month_bounds_change_nothing_but_the_files_read(lake):
    monthly = lake.withColumn(envelope.MONTH, F.when(F.col("acl_id") != "4", F.substring("acl_dop", 1, 6)))
    assert ids(envelope.between_marks(monthly, "20190601000000", "20190701000000", months=True)) == ["3", "4"]


def test_measure(lake):
    assert increments.measure(lake) == increments.Increment(5, "20190801000000")
    assert increments.measure(lake.limit(0)) == increments.Increment(0, None)
    assert increments.measure(lake, key="acl_id") == increments.Increment(5, "20190801000000", 0, 1)
    assert increments.measure(lake.limit(0), key="acl_id") == increments.Increment(0, None, 0, None)


def test_a_missing_id_counts_as_repeated(lake):
    nameless = lake.withColumn("acl_id", F.when(F.col("acl_id") != "5", F.col("acl_id")))
    assert increments.measure(nameless, key="acl_id").repeated == 1
    assert [r.acl_id for r in increments.repeated_ids(nameless, "acl_id").collect()] == [None]


def test_measure_many_in_one_scan(lake):
    tests = {
        "a": (F.col("messagetype") == "T1") & (F.col("acl_dop") > "20190531235959"),
        "b": (F.col("messagetype") == "T2") & (F.col("acl_dop") > "20200101000000"),
    }
    assert increments.measure_many(lake, tests) == {
        "a": increments.Increment(2, "20190701000000"),
        "b": increments.Increment(0, None),
    }
    assert increments.measure_many(lake, {}) == {}


def test_messages_without_id_meet_nothing(spark):
    frame = spark.createDataFrame(
        [("1", [("A", "a1")]), ("1", [("A", "a2")]), *[(None, [("A", "x")])] * 50],
        "id string, pairs array<struct<name:string,value:string>>",
    )
    joined = arrays.attributes(frame, "id", "pairs", {"a": "A"}, how="join")
    got = sorted((r.id or "", r.a or "") for r in joined.collect())
    assert got == [("", "")] * 50 + [("1", "a1"), ("1", "a1"), ("1", "a2"), ("1", "a2")]
    none = arrays.attributes(frame, "id", "pairs", {"a": "A"}, how="none")
    assert {r.a for r in none.collect()} == {None}
