import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from msgmart.operators.ranks import dealt, numbered, running


def _rows(n=3000):
    rng = random.Random(5)
    # one key has two thirds of all rows, one is null
    return [(rng.choice(["hot", "hot", None, f"k{rng.randint(0, 200)}"]), rng.randint(0, 50), k, rng.randint(0, 9)) for k in range(n)]


def test_every_rank(spark, tmp_path):
    frame = spark.createDataFrame(_rows(), "k string, at int, id int, v int")
    order = [F.col("at").desc(), F.col("id").asc()]
    got = numbered(frame, ["k"], order, f"{tmp_path}/a", partitions=13)
    want = frame.withColumn("rnk", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("long"))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_no_part_has_a_whole_hot_key(spark, tmp_path):
    frame = spark.createDataFrame(_rows(), "k string, at int, id int, v int")
    rows, part = dealt(frame, ["k"], [F.col("at"), F.col("id")], f"{tmp_path}/a", 13)
    sizes = {r["k"]: (r["n"], r["parts"]) for r in rows.groupBy("k").agg(F.count("*").alias("n"), F.countDistinct(part).alias("parts")).collect()}
    assert sizes["hot"][0] > 1000 and sizes["hot"][1] >= 5
    assert max(r["n"] for r in rows.groupBy(part).agg(F.count("*").alias("n")).collect()) < 3 * 3000 / 13


def test_no_window_by_the_key_alone(spark, tmp_path):
    frame = spark.createDataFrame(_rows(50), "k string, at int, id int, v int")
    plan = numbered(frame, ["k"], [F.col("at")], f"{tmp_path}/a", partitions=3)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window " in line and "specifiedwindowframe(RowFrame, unboundedpreceding$(), currentrow$())" in line]
    assert windows and all("part#" in line.split("],")[1] for line in windows)


def test_running_values_without_a_key(spark, tmp_path):
    frame = spark.createDataFrame(_rows(500), "part string, at int, id int, v int")
    measures = {"total": ("sum", F.col("v").cast("long")), "mixed": ("xor", F.col("v").cast("long")), "most": ("max", F.col("v"))}
    got = running(frame, [], [F.col("id")], measures, f"{tmp_path}/a", partitions=7).orderBy("id").collect()
    total = mixed = most = 0
    for r, (part, at, k, v) in zip(got, sorted(_rows(500), key=lambda x: x[2]), strict=True):
        total, mixed, most = total + v, mixed ^ v, max(most, v)
        assert tuple(r) == (part, at, k, v, total, mixed, most)


def test_empty(spark, tmp_path):
    frame = spark.createDataFrame([], "k string, at int")
    got = numbered(frame, ["k"], [F.col("at")], f"{tmp_path}/a")
    assert got.columns == ["k", "at", "rnk"] and got.collect() == []
