"""Queries over messages that are spelled, repeated, late or of changing shape, and over whole targets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import jobs
from ..plans.control import Control
from ..plans.jobs.common import AVAILABILITY_MESSAGES, MESSAGES
from ..plans.runner import MissingMark, Options, Runner
from ..plans.spec import JobSpec
from ..sources.envelope import of_ids
from ..sources.tables import Tables
from . import job_queries as jq
from . import lake
from .registry import SQL, as_text, query
from .table_queries import FIRST_STAMP, _folder_tables, _land, _start_marks

_DONE: dict[tuple[str, str, str], Tables] = {}


def _once(spark: SparkSession, folder: str, label: str, build: Callable[[Tables], None]) -> Tables:
    """The tables of a run, made once per session and folder for all queries that read them."""
    place = (spark.sparkContext.applicationId, folder, label)
    if place not in _DONE:
        tables = _folder_tables(spark, label)
        build(tables)
        _DONE[place] = tables
    return _DONE[place]


# -- spellings ---------------------------------------------------------------------------------


def _spelled(messages: DataFrame, *names: str) -> DataFrame:
    """A third of the messages spells the fields as given, a third in lower, a third in upper case."""
    third = F.pmod(F.crc32(F.col("acl_id")), F.lit(3))
    text: Column = F.col("jsonstruct")
    for name in names:
        other = F.when(third == 1, F.lit(f'"{name.lower()}":')).when(third == 2, F.lit(f'"{name.upper()}":'))
        text = F.replace(text, F.lit(f'"{name}":'), F.coalesce(other, F.lit(f'"{name}":')))
    return messages.withColumn("jsonstruct", text)


@query("job_c03_spelling", SQL["job_c03"])
def job_c03_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Fields are found however a message spells them."""
    names = ("klsId", "vvmArea", "number", "controltraceabilitymanual", "creationDate", "we")
    return jq.job_frame(spark, folder, jobs.FIBER_ON_LOCATION, lambda s, f: _spelled(lake.fiber_on_location(s, f), *names))


@query("job_c06_spelling", SQL["job_c06"])
def job_c06_spelling(spark: SparkSession, folder: str) -> DataFrame:
    names = ("eventId", "eventPayload", "workOrderId", "completionDate", "homeId")
    return jq.job_frame(spark, folder, jobs.WORK_ORDER, lambda s, f: _spelled(lake.work_order(s, f), *names))


@query("job_c09_spelling", SQL["job_c09"])
def job_c09_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Spellings above and inside an array of name and value pairs."""
    names = ("eventPayload", "serviceCharacteristic", "partyId", "name", "value")
    return jq.job_frame(spark, folder, jobs.AVAILABILITY_V2, lambda s, f: _spelled(lake.availability_v2(s, f), *names))


@query("job_c10_items_spelling", SQL["job_c10_items"])
def job_c10_items_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Spellings of an array and of the fields of its elements."""
    names = ("items", "lineNumber", "productMaterialId", "itemType")
    build = lambda s, f: _spelled(lake.presales(s, f), *names)
    return jq.job_frame(spark, folder, jobs.PRESALES, build, "cl_f_presalesorder_orderitem_mt")


# -- schemas that change from run to run -------------------------------------------------------


@query(
    "merged_null_then_struct",
    f"""SELECT * REPLACE (CASE WHEN vvmareanumber IS NULL THEN '2020-01-01 00:00:00.000'
                               ELSE '2020-01-02 00:00:00.000' END AS "acl_dop_ISO")
        FROM ({SQL["job_c02"]})""",
)
def merged_null_then_struct(spark: SparkSession, folder: str) -> DataFrame:
    """A field that is null in all messages of the first run and a struct in those of the second."""
    spec = jobs.NVT_AREA

    def build(tables: Tables) -> None:
        messages = lake.nvt_area(spark, folder)
        null = F.get_json_object("jsonstruct", "$.vvmArea").isNull()
        opened = F.regexp_replace("jsonstruct", r"^\{", '{"vvmArea":null,')
        messages = messages.withColumns(
            {
                "acl_dop": F.when(null, "20200101000000").otherwise("20200102000000"),
                "jsonstruct": F.when(null, opened).otherwise(F.col("jsonstruct")),
            }
        )
        _land(tables, messages, MESSAGES)
        _start_marks(tables, [spec])
        runner = Runner(tables, tables, Options(schema="merged"))
        runner.run(spec, upto="20200101000000")
        runner.run(spec)

    return as_text(_once(spark, folder, "null-then-struct", build).read(spec.target))


def _empty_then_items(spark: SparkSession, folder: str, table: str) -> DataFrame:
    spec = jobs.PRESALES

    def build(tables: Tables) -> None:
        # the first run has all messages without items: empty arrays and no history
        early = F.size(F.from_json(F.get_json_object("jsonstruct", "$.items"), "array<string>")) == 0
        messages = lake.presales(spark, folder).withColumn("early", early)
        for part in (messages.filter("early"), messages.filter("not early")):
            high = part.agg(F.max("acl_dop").alias("high")).first()["high"]
            if high is None:
                continue
            _land(tables, part.drop("early"), MESSAGES)
            Control(tables).advance(spec.process, spec.source, FIRST_STAMP)
            Runner(tables, tables, Options(schema="merged")).run(spec, since=FIRST_STAMP)

    return _once(spark, folder, "empty-then-items", build).read(table)


@query("merged_empty_then_items", SQL["job_c10_items"])
def merged_empty_then_items(spark: SparkSession, folder: str) -> DataFrame:
    """Arrays that are empty in all messages of the first run: the item rows of both runs."""
    return as_text(_empty_then_items(spark, folder, "cl_f_presalesorder_orderitem_mt"))


@query("merged_empty_then_history", SQL["job_c10_history"])
def merged_empty_then_history(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(_empty_then_items(spark, folder, "cl_f_presalesorder_history_mt"))


@query(
    "inferred_type_conflict",
    """SELECT CAST(s_suppkey AS VARCHAR) AS acl_id_int,
              CASE WHEN s_suppkey % 2 = 1 THEN 'B-' ELSE '' END || s_suppkey AS nvtareabusinessid FROM supplier""",
)
def inferred_type_conflict(spark: SparkSession, folder: str) -> DataFrame:
    """A field with numbers in the first run and texts in the second."""
    spec = jobs.NVT_AREA

    def build(tables: Tables) -> None:
        odd = F.pmod(F.col("acl_id").cast("bigint"), F.lit(2)) == 1
        text = F.regexp_replace("jsonstruct", r'"businessId":(\d+)', '"businessId":"B-$1"')
        messages = lake.nvt_area(spark, folder).withColumns(
            {
                "acl_dop": F.when(odd, "20200102000000").otherwise("20200101000000"),
                "jsonstruct": F.when(odd, text).otherwise(F.col("jsonstruct")),
            }
        )
        _start_marks(tables, [spec])
        runner = Runner(tables, tables, Options(schema="inferred"))
        for late in (False, True):
            _land(tables, messages.filter(odd if late else ~odd), MESSAGES)
            runner.run(spec)

    done = _once(spark, folder, "conflict", build).read(spec.target)
    return as_text(done.select("acl_id_int", "nvtareabusinessid"))


# -- late messages and broken runs -------------------------------------------------------------


@query("lookback_shared_target", SQL["job_c08"])
def lookback_shared_target(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of version 1 that come after version 2 has written rows of the same ids and stamps."""
    one, two = jobs.AVAILABILITY_V1, jobs.AVAILABILITY_V2

    def build(tables: Tables) -> None:
        first = lake.availability_v1(spark, folder)
        late = F.pmod(F.col("acl_id").cast("bigint"), F.lit(2)) == 0
        _land(tables, first.filter(~late), AVAILABILITY_MESSAGES)
        _land(tables, lake.availability_v2(spark, folder), AVAILABILITY_MESSAGES)
        _start_marks(tables, [one, two])
        runner = Runner(tables, tables)
        runner.run_all([one, two])
        _land(tables, first.filter(late), AVAILABILITY_MESSAGES)
        runner.run(one, since=FIRST_STAMP)
        runner.run(one, since=FIRST_STAMP)

    done = _once(spark, folder, "shared-target", build).read(one.target)
    return as_text(done.filter("messageversion = '1'"))


@query(
    "lookback_equal_stamp",
    """SELECT CAST(event_id // 4 AS VARCHAR) AS acl_id_int, event_type AS "eventType", CAST(user_id AS VARCHAR) AS klsid_ps
       FROM events""",
)
def lookback_equal_stamp(spark: SparkSession, folder: str) -> DataFrame:
    """Late messages with the id and the stamp of others, some of them equal in all columns."""
    spec = jobs.KLS_EVENT

    def build(tables: Tables) -> None:
        number = F.col("acl_id").cast("bigint")
        same = lake.kls_event(spark, folder).withColumns({"acl_dop": F.lit("20240101000000"), "number": number})
        same = same.withColumn("acl_id", F.floor(number / 4).cast("string"))
        _start_marks(tables, [spec])
        runner = Runner(tables, tables)
        for k in range(2):
            _land(tables, same.filter(F.pmod("number", F.lit(2)) == k).drop("number"), MESSAGES)
            runner.run(spec, since=FIRST_STAMP)

    done = _once(spark, folder, "equal-stamp", build).read(spec.target)
    return as_text(done.select("acl_id_int", "eventType", "klsid_ps"))


@query(
    "resume_other_column",
    """SELECT CAST(event_id AS VARCHAR) AS acl_id_int, event_type AS "eventType" FROM events""",
)
def resume_other_column(spark: SparkSession, folder: str) -> DataFrame:
    """A run that tracks another column, broken off after its rows were written, and run again."""
    spec = jobs.KLS_EVENT

    def build(tables: Tables) -> None:
        stamp = F.lpad((F.col("acl_id").cast("bigint") + 1).cast("string"), 14, "0")
        _land(tables, lake.kls_event(spark, folder).withColumn("bdmp_loadstamp", stamp), MESSAGES)
        control = Control(tables)
        control.advance(spec.process, spec.source, FIRST_STAMP, "bdmp_loadstamp")
        runner = Runner(tables, tables)
        runner.run(spec)
        # as a run leaves it that ended before its mark was moved
        control.advance(spec.process, spec.source, FIRST_STAMP, "bdmp_loadstamp")
        control.begin(spec.process, FIRST_STAMP)
        runner.run(spec)

    done = _once(spark, folder, "other-column", build).read(spec.target)
    return as_text(done.select("acl_id_int", "eventType"))


@query(
    "missing_mark",
    """SELECT 'proc_f_vvmarea' AS process, true AS refused, 0 AS targets""",
)
def missing_mark(spark: SparkSession, folder: str) -> DataFrame:
    """A job without a row in the tracking table is refused before it reads or writes anything."""
    tables = _folder_tables(spark, "no-mark")
    spec = jobs.VVM_AREA
    _land(tables, lake.vvm_area(spark, folder), MESSAGES)
    try:
        Runner(tables, tables).run(spec)
        refused = False
    except MissingMark:
        refused = True
    there = F.lit(int(tables.exists(spec.target)))
    return spark.range(1).select(F.lit(spec.process).alias("process"), F.lit(refused).alias("refused"), there.alias("targets"))


# -- picks -------------------------------------------------------------------------------------


@query(
    "business_key_pick",
    """SELECT CAST(event_id AS VARCHAR) AS acl_id_int, CAST(user_id AS VARCHAR) AS presalesorderid_ps
       FROM events WHERE user_id = 7""",
)
def business_key_pick(spark: SparkSession, folder: str) -> DataFrame:
    """All versions of one business key, which stands in the payload."""
    spec = jobs.LATEST_PRESALES
    messages = spec.messages(lake.presales_versions(spark, folder))
    picked = messages.filter(F.get_json_object("jsonstruct", "$.id") == "7")
    return picked.select(F.col("acl_id").alias("acl_id_int"), F.get_json_object("jsonstruct", "$.id").alias("presalesorderid_ps"))


# -- ids that repeat ---------------------------------------------------------------------------

GROUP = "CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey - o_orderkey % 8 ELSE o_orderkey END"


def _grouped(messages: DataFrame) -> DataFrame:
    """Orders whose key is a multiple of four share their id with a neighbour, where there is one."""
    key = F.col("acl_id").cast("bigint")
    shared = F.when(F.pmod(key, F.lit(4)) == 0, key - F.pmod(key, F.lit(8))).otherwise(key)
    return messages.withColumn("acl_id", shared.cast("string"))


N = jq.N
SIDES = {
    "a": ("o_orderstatus || v.position", f"JOIN (VALUES (1), (4)) v(position) ON position <= {N}"),
    "b": (jq._utc("o_orderdate"), f"JOIN (VALUES (2)) v(position) ON position <= {N}"),
    "e": (jq._utc("o_orderdate + INTERVAL 1 DAY"), f"JOIN (VALUES (3)) v(position) ON position <= {N}"),
}
SIDES_2 = {
    "a": ("o_orderstatus", ""),
    "b": (jq._utc("o_orderdate"), ""),
    "e": (jq._utc("o_orderdate + INTERVAL 1 DAY"), f"JOIN (VALUES (3)) v(least) ON least <= {N}"),
    "k": ("o_orderpriority", f"JOIN (VALUES (1)) v(least) ON least <= {N}"),
    "t": ("technology", f"JOIN (VALUES (2, 'FTTH'), (4, 'FTTB')) v(least, technology) ON least <= {N}"),
}


def _chained(columns: dict[str, str], sides: dict[str, tuple[str, str]]) -> str:
    """A statement of chained left joins on the shared id."""
    joins = "\n".join(
        f"LEFT JOIN (SELECT gid, {value} AS v FROM grouped {more}) {name} ON {name}.gid = o.gid"
        for name, (value, more) in sides.items()
    )
    return f"WITH grouped AS (SELECT *, {GROUP} AS gid FROM orders)\n" + jq._select(columns, f"FROM grouped o\n{joins}")


def _columns_of(sql: dict[str, str], **changed: str) -> dict[str, str]:
    return {**sql, "acl_id_int": "CAST(o.gid AS VARCHAR)", **changed}


@query(
    "job_c08_repeated",
    _chained(_columns_of(jq.C08_COLUMNS, ausbaustandgf="a.v", planbeginngfausbau="b.v", planendegfausbau="e.v"), SIDES),
)
def job_c08_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that share an id meet each other's attributes, all others only their own."""
    return jq.job_frame(spark, folder, jobs.AVAILABILITY_V1, lambda s, f: _grouped(lake.availability_v1(s, f)))


@query(
    "job_c09_repeated",
    _chained(
        _columns_of(
            jq.C09_COLUMNS,
            ausbaustandgf="a.v",
            planbeginngfausbau="b.v",
            planendegfausbau="e.v",
            kooperationspartner="k.v",
            technologie="t.v",
        ),
        SIDES_2,
    ),
)
def job_c09_repeated(spark: SparkSession, folder: str) -> DataFrame:
    return jq.job_frame(spark, folder, jobs.AVAILABILITY_V2, lambda s, f: _grouped(lake.availability_v2(s, f)))


@query(
    "job_c07_repeated",
    f"WITH grouped AS (SELECT *, {GROUP} AS gid FROM orders)\n"
    + jq._select(
        _columns_of(jq.C07_COLUMNS),
        f"""FROM grouped o LEFT JOIN (
              SELECT gid, o_orderkey || '-' || i AS oi_id, o_orderstatus AS oi_state, 'add' AS oi_action,
                     's' || i AS s_id, 'GigaAnschluss' AS s_name, 'active' AS s_state
              FROM grouped g, LATERAL (SELECT unnest(range(1, {N} + 1)) AS i) u
              WHERE i % 2 = 1 AND (o_custkey + i) % 2 = 0 AND o_orderstatus = 'O') c
            ON c.gid = o.gid""",
    ),
)
def job_c07_repeated(spark: SparkSession, folder: str) -> DataFrame:
    return jq.job_frame(spark, folder, jobs.SERVICE_ORDER, lambda s, f: _grouped(lake.service_order(s, f)))


# -- whole targets -----------------------------------------------------------------------------

BUILDERS = (
    lake.vvm_area,
    lake.nvt_area,
    lake.fiber_on_location,
    lake.kls_event,
    lake.installation_order,
    lake.work_order,
    lake.service_order,
    lake.presales,
)


def _daily(spark: SparkSession, folder: str) -> Tables:
    def build(tables: Tables) -> None:
        for make in BUILDERS:
            _land(tables, make(spark, folder), MESSAGES)
        for make in (lake.availability_v1, lake.availability_v2):
            _land(tables, make(spark, folder), AVAILABILITY_MESSAGES)
        _start_marks(tables, jobs.DAILY)
        Runner(tables, tables).run_all(jobs.DAILY)

    return _once(spark, folder, "daily-contents", build)


def _content(name: str, spec: JobSpec, table: str | None = None, only: str = "true") -> None:
    """A query for all rows and columns that the daily run has written to a target."""

    @query(f"daily_{name}", SQL[f"job_{name}"])
    def content(spark: SparkSession, folder: str) -> DataFrame:
        return as_text(_daily(spark, folder).read(table or spec.target).filter(only))


_content("c01", jobs.VVM_AREA)
_content("c02", jobs.NVT_AREA)
_content("c03", jobs.FIBER_ON_LOCATION)
_content("c04", jobs.KLS_EVENT)
_content("c05", jobs.INSTALLATION_ORDER)
_content("c06", jobs.WORK_ORDER)
_content("c07", jobs.SERVICE_ORDER)
_content("c08", jobs.AVAILABILITY_V1, only="messageversion = '1'")
_content("c09", jobs.AVAILABILITY_V2, only="messageversion = '2'")
_content("c10", jobs.PRESALES)
_content("c10_items", jobs.PRESALES, "cl_f_presalesorder_orderitem_mt")
_content("c10_history", jobs.PRESALES, "cl_f_presalesorder_history_mt")
