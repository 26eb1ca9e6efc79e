"""Queries that write tables and read them back: sinks, control tables, whole runs.

They write below the shared scratch folder, each into a folder or database of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparse import epoch_millis_text, stamp14
from ..operators.payload import parse
from ..plans import jobs
from ..plans.control import LOG, TRACKING, Control, mark_row
from ..plans.jobs.common import AVAILABILITY_MESSAGES, MESSAGES
from ..plans.runner import BUCKET, Options, Runner, copy_table
from ..session import scratch_folder
from ..sources.schema import infer_schema
from ..sources.tables import Tables
from . import lake
from .job_queries import C09
from .registry import SQL, as_text, query

FIRST_STAMP = "00000000000000"


def _folder_tables(spark: SparkSession, label: str) -> Tables:
    return Tables(spark, root=scratch_folder(spark, label))


def _database_tables(spark: SparkSession, label: str) -> Tables:
    name = f"{label}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_folder(spark, label)}'")
    return Tables(spark, database=name)


def _start_marks(tables: Tables, specs) -> None:
    control = Control(tables)
    for spec in specs:
        control.advance(spec.process, spec.source, FIRST_STAMP)


def _land(tables: Tables, messages: DataFrame, name: str) -> None:
    """Messages into a message table kept by type, so that a job scans its own type only."""
    tables.append(messages, name, ["messagetype"])


# -- sinks -------------------------------------------------------------------------------------


@query(
    "append_roundtrip",
    """SELECT event_type, count(*) AS n, sum(user_id) AS users FROM events
       WHERE event_type IN ('click', 'view') GROUP BY event_type""",
)
def append_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends to one table, read back; columns are matched by name."""
    tables = _folder_tables(spark, "append")
    events = lake.table(spark, folder, "events")
    tables.append(events.filter("event_type = 'click'").select("user_id", "event_type"), "t")
    tables.append(events.filter("event_type = 'view'").select("event_type", "user_id"), "t")
    return tables.read("t").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users")
    )


@query("overwrite_roundtrip", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def overwrite_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A full overwrite leaves the second content only."""
    tables = _folder_tables(spark, "overwrite")
    orders = lake.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    tables.overwrite(orders, "t")
    tables.overwrite(orders.filter("o_orderstatus = 'F'"), "t")
    return tables.read("t")


@query(
    "partition_overwrite",
    """SELECT event_type, CASE WHEN event_type = 'click' THEN sum(user_id) ELSE sum(value_cents) END AS total
       FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS value_cents FROM events) GROUP BY event_type""",
)
def partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Replacing one partition keeps the others."""
    tables = _folder_tables(spark, "partition")
    events = lake.table(spark, folder, "events")
    cents = F.round(F.col("value") * 100).cast("bigint")
    tables.append(events.select(cents.alias("amount"), "event_type"), "t", ["event_type"])
    clicks = events.filter("event_type = 'click'")
    tables.replace_partitions(
        clicks.select(F.col("user_id").alias("amount"), "event_type"), "t", ["event_type"]
    )
    return tables.read("t").groupBy("event_type").agg(F.sum("amount").alias("total"))


@query(
    "insert_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def insert_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Inserts into a catalog table, columns given in another order, one of them missing."""
    tables = _database_tables(spark, "inserted")
    spark.sql(f"CREATE TABLE {tables.full_name('t')} (id BIGINT, name STRING, segment STRING) USING parquet")
    customers = lake.table(spark, folder, "customer")
    suppliers = lake.table(spark, folder, "supplier")
    tables.insert(
        customers.select(
            F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"), F.col("c_custkey").alias("id")
        ),
        "t",
        overwrite=True,
    )
    tables.insert(suppliers.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")), "t")
    return tables.read("t")


@query(
    "catalog_roundtrip",
    "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
)
def catalog_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Saved as a catalog table, scanned by SQL."""
    tables = _database_tables(spark, "saved")
    tables.append(lake.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), "t")
    return tables.sql("t", "SELECT o_orderstatus, count(*) AS n FROM {table} GROUP BY o_orderstatus")


COPIED = (
    ("acl_id", "acl_id"),
    ("acl_dop_ISO", "acl_dop_ISO"),
    ("vvmareaNumber", "number"),
    ("vvmareaName", "name"),
    ("creationDate_ISO", "creationDate"),
    ("modificationDate_ISO", "modificationDate"),
    ("areaType", "areaType"),
    ("rolloutDate_ISO", "rolloutDate"),
    ("areaStatus", "areaStatus"),
    ("plannedArea", "plannedArea"),
    ("plannedFrom_ISO", "plannedFrom"),
    ("plannedTo_ISO", "plannedTo"),
)


@query(
    "copy_job",
    f"""SELECT acl_id_int AS acl_id, "acl_dop_ISO", number AS "vvmareaNumber", name AS "vvmareaName", "creationDate_ISO",
               "modificationDate_ISO", "areaType", "rolloutDate" AS "rolloutDate_ISO", "areaStatus", "plannedArea",
               "plannedFrom_ISO", "plannedTo_ISO" FROM ({SQL["job_c01"]})""",
)
def copy_job(spark: SparkSession, folder: str) -> DataFrame:
    """Message table to catalog table: filter, infer, parse, project, insert over what was there."""
    tables = _database_tables(spark, "copied")
    spec = jobs.VVM_AREA
    listed = ", ".join(f"`{name}` {'TIMESTAMP' if name == 'acl_dop_ISO' else 'STRING'}" for name, _ in COPIED)
    spark.sql(f"CREATE TABLE {tables.full_name('target')} ({listed}) USING parquet")

    def build(messages: DataFrame) -> DataFrame:
        frame, data = parse(messages, infer_schema(messages), inferred=True)
        columns = []
        for name, field in COPIED:
            if field == "acl_dop_ISO":
                column = stamp14(F.col("acl_dop"))
            elif name.endswith("_ISO"):
                column = epoch_millis_text(data.value(field))
            else:
                column = F.col(field) if field == "acl_id" else data.value(field).cast("string")
            columns.append(column.alias(name))
        return frame.select(*columns)

    for _ in range(2):
        copy_table(spec.messages(lake.vvm_area(spark, folder)), build, tables, "target")
    return as_text(tables.read("target"))


# -- control tables ----------------------------------------------------------------------------


@query(
    "tracking_advance",
    """SELECT event_type AS etl_process_name, 'messages' AS table_name,
              max(strftime(ts, '%Y%m%d%H%M%S')) AS max_tracking_value, 'acl_dop' AS col_name
       FROM events WHERE event_type <> 'error' GROUP BY event_type
       UNION ALL SELECT 'error', 'messages', '00000000000000', 'acl_dop'""",
)
def tracking_advance(spark: SparkSession, folder: str) -> DataFrame:
    """Every process moves its own mark; an empty value leaves the old one."""
    tables = _folder_tables(spark, "tracking")
    control = Control(tables)
    events = lake.table(spark, folder, "events")
    found = events.groupBy("event_type").agg(F.max(F.date_format("ts", "yyyyMMddHHmmss")).alias("high"))
    for row in found.collect():  # one row per message type
        control.advance(row["event_type"], "messages", FIRST_STAMP)
        control.advance(row["event_type"], "messages", None if row["event_type"] == "error" else row["high"])
    return tables.read(TRACKING).select("etl_process_name", "table_name", "max_tracking_value", "col_name")


@query(
    "run_log",
    """SELECT 'al2cl' AS workflow, 'proc_f_vvmarea' AS process, 'INFO' AS log_type, entry AS log_entry, entry2 AS log_entry2,
              'DigiOSS - vvmArea' AS log_entry3
       FROM (SELECT 'logic of process started' AS entry,
                    'current_tracked_value=00000000000000, max_acl_dop=' || max(dop) || ', new_records_count=' || count(*) AS entry2
             FROM (SELECT strftime(TIMESTAMP '2020-01-01' + CAST(c_custkey % 3650 AS INTEGER) * INTERVAL 1 DAY, '%Y%m%d%H%M%S') AS dop FROM customer)
             UNION ALL SELECT 'end of process', 'insert table=cl_f_vvmarea_mt ,doing_Insert=true')""",
)
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log rows of one run."""
    tables = _folder_tables(spark, "log")
    _land(tables, lake.vvm_area(spark, folder), MESSAGES)
    _start_marks(tables, [jobs.VVM_AREA])
    Runner(tables, tables).run(jobs.VVM_AREA)
    log = tables.read(LOG)
    return log.select(
        "workflow",
        "process",
        "log_type",
        "log_entry",
        F.regexp_replace("log_entry2", "doing_Insert=True", "doing_Insert=true").alias("log_entry2"),
        "log_entry3",
    )


def _log_of(spark: SparkSession, folder: str, label: str, spec, build) -> DataFrame:
    tables = _folder_tables(spark, label)
    _land(tables, build(spark, folder), MESSAGES)
    _start_marks(tables, [spec])
    Runner(tables, tables).run(spec)
    return tables.read(LOG).select("process", "log_entry", "log_entry2", "log_entry3")


def _log_rows(process: str, kind: str, *rows: tuple[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{process}' AS process, '{entry}' AS log_entry, {entry2} AS log_entry2, '{kind}' AS log_entry3"
        for entry, entry2 in rows
    )


NEW_ROWS = """(SELECT 'current_tracked_value=00000000000000, max_acl_dop=' || max(strftime(o_orderdate, '%Y%m%d%H%M%S'))
    || ', new_records_count=' || count(*) FROM orders)"""


@query(
    "run_log_presales",
    _log_rows(
        "proc_f_presalesorder",
        "VVM - PreSalesOrder",
        ("logic of process started", NEW_ROWS),
        ("logic() finished", "'next step insert, table=cl_f_presalesorder_mt '"),
        ("end of process", "'insert table=cl_f_presalesorder_mt ,doing_Insert=True'"),
        ("end of process-insert 2.", "'insert table=cl_f_presalesorder_orderitem_mt , '"),
        ("end of process-insert 3.", "'insert table=cl_f_presalesorder_history_mt , '"),
    ),
)
def run_log_presales(spark: SparkSession, folder: str) -> DataFrame:
    """The log rows of a job with child tables."""
    return _log_of(spark, folder, "log-presales", jobs.PRESALES, lake.presales)


@query(
    "run_log_latest",
    _log_rows(
        "proc_f_pso_latestversion",
        "VVM - PreSalesOrder",
        ("logic of process started", "(SELECT 'all_PSO_records_count=' || count(*) FROM events)"),
        ("end of process", "'insert table=cl_f_presalesorder_latestversion_mt ,overwrite'"),
    ),
)
def run_log_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The log rows of a full recompute."""
    return _log_of(spark, folder, "log-latest", jobs.LATEST_PRESALES, lake.presales_versions)


@query(
    "run_log_service_order",
    _log_rows(
        "proc_f_serviceorder_event",
        "DigiOSS - ServiceOrderEvent",
        ("logic of process started", NEW_ROWS),
        ("end of process", "'insert table=cl_f_soevent_mt ,doing_Insert=True'"),
    ),
)
def run_log_service_order(spark: SparkSession, folder: str) -> DataFrame:
    """The log rows of a job of two message types: the first one is named."""
    return _log_of(spark, folder, "log-orders", jobs.SERVICE_ORDER, lake.service_order)


# -- runs --------------------------------------------------------------------------------------


@query("incremental_runs", SQL["job_c04"])
def incremental_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Two increments and an idle run give every message once."""
    tables = _folder_tables(spark, "runs")
    spec = jobs.KLS_EVENT
    messages = lake.kls_event(spark, folder)
    _land(tables, messages, MESSAGES)
    _start_marks(tables, [spec])
    runner = Runner(tables, tables)
    runner.run(spec, upto="20240115000000")
    runner.run(spec)
    runner.run(spec)
    return as_text(tables.read(spec.target))


@query("incremental_runs_inferred", SQL["job_c04"])
def incremental_runs_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a stored schema that each run widens."""
    tables = _folder_tables(spark, "widened")
    spec = jobs.KLS_EVENT
    _land(tables, lake.kls_event(spark, folder), MESSAGES)
    _start_marks(tables, [spec])
    runner = Runner(tables, tables, Options(schema="merged"))
    runner.run(spec, upto="20240115000000")
    runner.run(spec)
    return as_text(tables.read(spec.target))


N = "(CAST(o_orderpriority[1] AS INTEGER) - 1)"


@query(
    "multi_output",
    f"""SELECT 'cl_f_presalesorder_mt' AS target, count(*) AS n FROM orders
        UNION ALL SELECT 'cl_f_presalesorder_orderitem_mt', sum({N}) FROM orders
        UNION ALL SELECT 'cl_f_presalesorder_history_mt', sum(({N} + 1) // 2) FROM orders""",
)
def multi_output(spark: SparkSession, folder: str) -> DataFrame:
    """One message type into a parent and two child tables from one parse."""
    tables = _folder_tables(spark, "multi")
    _land(tables, lake.presales(spark, folder), MESSAGES)
    _start_marks(tables, [jobs.PRESALES])
    written = Runner(tables, tables).run(jobs.PRESALES).written
    return _row_counts(tables, written)


def _row_counts(tables: Tables, names) -> DataFrame:
    counts = [
        tables.read(name).select(F.lit(name).alias("target")).groupBy("target").agg(F.count(F.lit(1)).alias("n"))
        for name in names
    ]
    total = counts[0]
    for more in counts[1:]:
        total = total.unionByName(more)
    return total


def _latest_run(spark: SparkSession, folder: str, refresh: str) -> DataFrame:
    tables = _folder_tables(spark, f"latest-{refresh}")
    spec = jobs.LATEST_PRESALES
    _land(tables, lake.presales_versions(spark, folder), MESSAGES)
    runner = Runner(tables, tables, Options(refresh=refresh))
    runner.run(spec, upto="20240115000000")
    runner.run(spec)
    return as_text(tables.read(spec.target).drop(BUCKET))


@query("full_recompute", SQL["job_c11"])
def full_recompute(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot overwritten from all messages, twice."""
    return _latest_run(spark, folder, "full")


@query("merge_refresh", SQL["job_c11"])
def merge_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot brought up to date with the new messages only."""
    return _latest_run(spark, folder, "merge")


@query("availability_run", C09)
def availability_run(spark: SparkSession, folder: str) -> DataFrame:
    """A run in which both availability versions append to one table; version 2 read back."""
    tables = _folder_tables(spark, "availability")
    _land(tables, lake.availability_v1(spark, folder), AVAILABILITY_MESSAGES)
    _land(tables, lake.availability_v2(spark, folder), AVAILABILITY_MESSAGES)
    specs = [jobs.AVAILABILITY_V1, jobs.AVAILABILITY_V2]
    _start_marks(tables, specs)
    Runner(tables, tables).run_all(specs)
    return as_text(tables.read(specs[0].target).filter("messageversion = '2'"))


@query(
    "daily_run",
    f"""SELECT 'cl_f_presalesorder_latestversion_mt' AS target, count(*) AS n FROM orders
        UNION ALL SELECT 'cl_f_vvmarea_mt', count(*) FROM customer
        UNION ALL SELECT 'cl_f_fiberavailabilitycheck_mt',
                         sum(CASE WHEN {N} = 4 THEN 2 ELSE 1 END) + sum(CASE WHEN {N} >= 4 THEN 2 ELSE 1 END) FROM orders
        UNION ALL SELECT 'cl_f_soevent_mt', sum(greatest(1, CASE WHEN o_orderstatus <> 'O' THEN 0 ELSE
                         CASE WHEN (o_custkey + 1) % 2 = 0 THEN ({N} + 1) // 2 ELSE 0 END END)) FROM orders
        UNION ALL SELECT 'cl_f_cio_mt', count(*) FROM events
        UNION ALL SELECT 'cl_f_nvtarea_mt', count(*) FROM supplier
        UNION ALL SELECT 'cl_f_klsevent_mt', count(*) FROM events
        UNION ALL SELECT 'cl_f_fiberonlocation_mt', count(*) FROM part
        UNION ALL SELECT 'cl_f_workorderevent_mt', count(*) FROM events
        UNION ALL SELECT 'cl_f_presalesorder_mt', count(*) FROM orders
        UNION ALL SELECT 'cl_f_presalesorder_orderitem_mt', sum({N}) FROM orders
        UNION ALL SELECT 'cl_f_presalesorder_history_mt', sum(({N} + 1) // 2) FROM orders""",
)
def daily_run(spark: SparkSession, folder: str) -> DataFrame:
    """All jobs in order over two message tables; rows per target."""
    tables = _folder_tables(spark, "daily")
    builders = (
        lake.vvm_area,
        lake.nvt_area,
        lake.fiber_on_location,
        lake.kls_event,
        lake.installation_order,
        lake.work_order,
        lake.service_order,
        lake.presales,
    )
    for build in builders:
        _land(tables, build(spark, folder), MESSAGES)
    for build in (lake.availability_v1, lake.availability_v2):
        _land(tables, build(spark, folder), AVAILABILITY_MESSAGES)
    _start_marks(tables, jobs.DAILY)
    results = Runner(tables, tables).run_all(jobs.DAILY)
    names = dict.fromkeys(name for result in results for name in result.written)
    return _row_counts(tables, names)


@query(
    "tracking_row",
    """SELECT 'al_gigabit_message_mt' AS table_name, max(strftime(ts, '%Y%m%d%H%M%S')) AS max_tracking_value,
              'acl_dop' AS col_name, 'proc_f_cio' AS etl_process_name FROM events""",
)
def tracking_row(spark: SparkSession, folder: str) -> DataFrame:
    """The tracking row a run would write for the newest event."""
    high = lake.events_lake(spark, folder).agg(F.max("acl_dop").alias("high")).first()["high"]
    row = mark_row(spark, "proc_f_cio", MESSAGES, high)
    return row.select("table_name", "max_tracking_value", "col_name", "etl_process_name")
