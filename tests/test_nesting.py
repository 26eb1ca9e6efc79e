import random
import time

from pyspark.sql import functions as F

from msgmart.operators.nesting import nest
from msgmart.sources.schema import seen_schema


def _rows(n=3000):
    rng = random.Random(3)
    # one key has two thirds of all rows, one is null; order values repeat and are null
    return [(rng.choice(["hot", "hot", None, f"k{rng.randint(0, 200)}"]), rng.choice([None, *range(40)]), rng.randint(0, 9)) for _ in range(n)]


def _want(rows):
    out = {}
    for k, at, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        out.setdefault(k, []).append((at, v))
    return out


def test_all_children_in_order(spark, tmp_path):
    frame = spark.createDataFrame(_rows(), "k string, at int, value int").repartition(5)
    for parts in (1, 13):
        got = nest(frame, ["k"], ["at"], F.struct("at", "value"), "items", f"{tmp_path}/{parts}", parts)
        assert got.columns == ["k", "items"]
        assert {r.k: [tuple(x) for x in r["items"]] for r in got.collect()} == _want(_rows())


def test_a_hot_key_is_sorted_in_sections(spark, tmp_path):
    frame = spark.createDataFrame(_rows(), "k string, at int, value int")
    nest(frame, ["k"], ["at", "value"], F.col("value"), "items", f"{tmp_path}/a", 13)
    sections = spark.read.parquet(f"{tmp_path}/a").where("k = 'hot'").groupBy("part").count().collect()
    assert len(sections) >= 5 and max(r["count"] for r in sections) < 1000


def test_names_and_no_children(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2, "b", 3), (1, 1, "a", 4), (1, 2, "b", 3)], "`at` int, part int, value string, `a.b` int")
    got = nest(frame, ["at"], ["part", "a.b"], F.struct("value", F.col("`a.b`").alias("n")), "part", f"{tmp_path}/a", 2).collect()
    assert [(r["at"], [tuple(x) for x in r["part"]]) for r in got] == [(1, [("a", 4), ("b", 3), ("b", 3)])]
    assert nest(frame.limit(0), ["at"], ["part"], F.col("value"), "items", f"{tmp_path}/b").collect() == []


def test_only_busy_keys_are_dealt_by_ranges(spark, tmp_path):
    """Other rows move once, without the element, and nothing is written for them."""
    few = spark.range(4000).selectExpr("id % 900 AS k", "id AS at", "string(id) AS value")
    got = nest(few, ["k"], ["at"], F.concat("value", F.lit("-built")), "items", f"{tmp_path}/few")
    plan = got._jdf.queryExecution().executedPlan().toString()
    moved = plan[plan.index("Exchange") :]
    assert plan.count("Exchange") == 1 and "-built" in plan and "-built" not in moved
    assert not (tmp_path / "few").exists()
    assert got.where("k = 7").first()["items"] == [f"{i}-built" for i in range(7, 4000, 900)]
    busy = few.unionByName(spark.range(1500).selectExpr("cast(null as long) AS k", "id AS at", "'x' AS value"))
    got = nest(busy, ["k"], ["at"], F.col("value"), "items", f"{tmp_path}/busy", 8)
    assert got.count() == 901 and len(got.where("k IS NULL").first()["items"]) == 1500
    assert spark.read.parquet(f"{tmp_path}/busy").select("k").distinct().collect() == [(None,)]


def test_a_pass_for_an_answer_leaves_no_shuffle_files(spark):
    files = lambda: {f.getName() for f in _java_list(spark._jvm, spark.sparkContext._jsc.sc()) if "shuffle" in f.getName()}
    before = files()
    rows = spark.range(5000).repartition(7, "id").selectExpr("to_json(struct(id)) AS jsonstruct")
    assert seen_schema(rows).simpleString() == "struct<id:bigint>"
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before


def _java_list(jvm, context):
    found = jvm.scala.jdk.javaapi.CollectionConverters.asJava(context.env().blockManager().diskBlockManager().getAllFiles())
    return list(found)
