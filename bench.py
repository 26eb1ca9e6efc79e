"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of cores. Every query is
run to completion without collecting its rows; the better of two runs counts, so that start-up
and code generation do not.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from msgmart.session import local_session  # noqa: E402
from msgmart.workloads import QUERIES  # noqa: E402

HEADLINES = (
    # filters, increments, marks
    "type_version_filter",
    "increment_bounded",
    "increment_measure",
    "tracking_latest_mark",
    # schema and payload
    "nested_flatten",
    "array_head",
    "layout_merge",
    "event_time_fallback",
    # arrays
    "explode_items",
    "explode_pairs",
    "attribute_pick",
    "filtered_child_left",
    "filtered_child_array",
    "attributes_join",
    "attributes_array",
    # latest version
    "latest_version",
    "latest_maxby",
    "ranked_versions",
    # jobs
    "job_c01",
    "job_c03",
    "job_c04",
    "job_c04_inferred",
    "job_c05",
    "job_c06",
    "job_c07",
    "job_c08",
    "job_c09",
    "job_c09_joined",
    "job_c10",
    "job_c10_items",
    "job_c10_history",
    "job_c11",
    "job_c12",
    # whole runs, tables included
    "multi_output",
    "full_recompute",
    "merge_refresh",
    "daily_run",
)


# Whole runs write many tables; one run of each is enough.
ONCE = {"multi_output", "full_recompute", "merge_refresh", "daily_run"}


def finished(frame) -> float:
    begun = time.perf_counter()
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def timed(spark, name: str, folder: str) -> float:
    begun = time.perf_counter()
    finished(QUERIES[name](spark, folder))
    return time.perf_counter() - begun


def shapes(spark, folder: str) -> None:
    """Plans in the shape of a straightforward job against ours, on stored messages."""
    from pyspark.sql import functions as F

    from msgmart.operators import increments
    from msgmart.plans import jobs
    from msgmart.session import scratch_folder
    from msgmart.sources.schema import infer_schema
    from msgmart.sources.tables import Tables
    from msgmart.workloads import lake

    tables = Tables(spark, root=scratch_folder(spark, "shapes"))
    tables.append(lake.availability_v2(spark, folder), "availability")
    tables.append(lake.presales(spark, folder), "presales")
    checks = jobs.AVAILABILITY_V2.messages(tables.read("availability"))
    orders = jobs.PRESALES.messages(tables.read("presales"))

    def seconds(run) -> float:
        times = []
        for _ in range(3):
            begun = time.perf_counter()
            run()
            times.append(time.perf_counter() - begun)
        return round(min(times), 2)

    def three_parses():
        for frame in jobs.PRESALES.outputs(orders).values():
            finished(frame)

    def one_parse():
        main = jobs.PRESALES.main(orders).persist()
        finished(main)
        for frame in jobs.PRESALES.children_of(main).values():
            finished(frame)
        main.unpersist(blocking=True)

    def two_scans():
        orders.count()
        orders.agg(F.max("acl_dop")).collect()

    pairs = {
        "schema: rows through Python, JSON reader": lambda: spark.read.json(
            orders.rdd.map(lambda row: row.jsonstruct)
        ).schema,
        "schema: one aggregate": lambda: infer_schema(orders),
        "attributes: five chained joins": lambda: finished(jobs.AVAILABILITY_V2.main(checks, how="join")),
        "attributes: inside the row": lambda: finished(jobs.AVAILABILITY_V2.main(checks)),
        "three outputs: one parse each": three_parses,
        "three outputs: one parse": one_parse,
        "increment: count, then max": two_scans,
        "increment: one aggregate": lambda: increments.measure(orders),
    }
    for name, run in pairs.items():
        print(f"{name:42s} {seconds(run):7.2f}", flush=True)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, memory="16g")
    only = sys.argv[1:]
    if only == ["--shapes"]:
        shapes(spark, folder)
        return
    seconds = {}
    for name in HEADLINES:
        if only and name not in only:
            continue
        seconds[name] = round(min(timed(spark, name, folder) for _ in range(1 if name in ONCE else 2)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
