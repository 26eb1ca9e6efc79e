"""The jobs over payloads in their own shape, and the SQL that gives the same rows directly."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import increments
from ..plans import jobs
from ..plans.spec import JobSpec
from . import lake
from .registry import as_text, query

MILLIS = "'%Y-%m-%d %H:%M:%S.%g'"
FIRST_DAY = "TIMESTAMP '2020-01-01'"


def job_frame(
    spark: SparkSession,
    folder: str,
    spec: JobSpec,
    build: Callable[[SparkSession, str], DataFrame],
    table: str | None = None,
    inferred: bool = False,
) -> DataFrame:
    """One output of a job over a lake, in the form the runner takes."""
    messages = spec.messages(build(spark, folder))
    schema = spec.inferred(messages) if inferred else None
    seen = None if inferred else spec.seen(messages)
    ids = increments.per_id(messages, "acl_id", "acl_dop")
    found = increments.measure_ids(ids, "acl_id") if spec.spread is not None else None
    if found is not None and found.repeated:
        repeated = increments.repeated_of(ids, "acl_id")
        return as_text(spec.main_split(messages, repeated, schema, seen, found.most))
    return as_text(spec.outputs(messages, schema, seen=seen)[table or spec.target])


def _text(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR)"


def _time(expression: str) -> str:
    return f"strftime({expression}, {MILLIS})"


def _utc(expression: str) -> str:
    """Berlin wall clock to UTC, as text."""
    return _time(f"timezone('UTC', timezone('Europe/Berlin', {expression}))")


def _select(columns: dict[str, str], rest: str) -> str:
    listed = ",\n       ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"SELECT {listed}\n{rest}"


NULL = "CAST(NULL AS VARCHAR)"
AUDIT = {"bdmp_loadstamp": "'20200101'", "bdmp_id": "'id'", "bdmp_area_id": "'area'"}
NO_AUDIT = dict.fromkeys(AUDIT, NULL)


def _lead(key: str, time: str, version: str = "'1'") -> dict[str, str]:
    return {"acl_id_int": _text(key), "acl_dop_ISO": _time(f"date_trunc('second', {time})"), "messageversion": version}


def _day(key: str) -> str:
    return f"({FIRST_DAY} + CAST({key} % 3650 AS INTEGER) * INTERVAL 1 DAY)"


def _epoch(key: str, shift: int) -> str:
    return f"strftime({_day(key)} + INTERVAL {shift} SECOND, '%Y-%m-%d %H:%M:%S')"


# -- areas -------------------------------------------------------------------------------------


@query(
    "job_c01",
    _select(
        {
            **_lead("c_custkey", _day("c_custkey")),
            "number": _text("c_custkey"),
            "name": "c_name",
            "is_reporting_relevant": NULL,
            "creationDate_ISO": _epoch("c_custkey", 0),
            "modificationDate_ISO": _epoch("c_custkey", 1),
            "areaType": "c_mktsegment",
            "rolloutDate": f"CASE WHEN c_nationkey > 5 THEN {_epoch('c_custkey', 2)} END",
            "areaStatus": f"CASE WHEN c_nationkey < 20 THEN {_text('c_nationkey')} END",
            "plannedArea": _text("c_acctbal > 0"),
            "plannedFrom_ISO": _epoch("c_custkey", 3),
            "plannedTo_ISO": _epoch("c_custkey", 4),
            "threshold": _text("c_nationkey"),
            "orderscountinvvm": _text("c_nationkey + 1"),
            "additionalorderscountinvvm": _text("c_nationkey + 2"),
            **AUDIT,
        },
        "FROM customer",
    ),
)
def job_c01(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.VVM_AREA, lake.vvm_area)


@query(
    "job_c02",
    _select(
        {
            **_lead("s_suppkey", _day("s_suppkey")),
            "nvtareabusinessid": _text("s_suppkey"),
            "nvtareaname": "s_name",
            "vvmareanumber": f"CASE WHEN s_nationkey > 3 THEN {_text('s_nationkey')} END",
            "creationDate_ISO": _epoch("s_suppkey", 0),
            "modificationDate_ISO": _epoch("s_suppkey", 1),
            "nvtDescriptor": _text("s_nationkey + 1"),
            "onkz": _text("s_nationkey + 2"),
            "asb": _text("s_nationkey + 3"),
            "pti": _text("s_nationkey + 4"),
            "subsidiary": _text("s_nationkey + 5"),
            "guid": _text("s_nationkey + 6"),
            "nvtKlsId_ps": _text("s_nationkey + 7"),
            **AUDIT,
        },
        "FROM supplier",
    ),
)
def job_c02(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.NVT_AREA, lake.nvt_area)


@query(
    "job_c03",
    _select(
        {
            **_lead("p_partkey", _day("p_partkey"), "CASE WHEN p_partkey % 2 = 0 THEN '1' ELSE '2' END"),
            "klsid_ps": _text("p_partkey"),
            "vvmareanumber": _text("p_size"),
            "nvtareabusinessid": "p_brand",
            "modificationDate_ISO": _epoch("p_partkey", 1),
            "creationDate_ISO": _epoch("p_partkey", 0),
            "controltraceabilitymanual": _text("p_size > 10"),
            "installationStatus": "p_type",
            "demandCarrier": "p_brand",
            "areaType": "p_name",
            "initiative": f"CASE WHEN p_size > 20 THEN {_text('p_size')} END",
            "reasonForNoConstruction": f"CASE WHEN p_size <= 20 THEN {_text('p_size')} END",
            "technology": "'FTTH'",
            "rolloutSponsor": "p_brand",
            "installationDate_ISO": _epoch("p_partkey", 2),
            "plannedInstallationBegin_ISO": _epoch("p_partkey", 3),
            "plannedInstallationEnd_ISO": f"CASE WHEN p_size > 30 THEN {_epoch('p_partkey', 4)} END",
            "we": _text("p_size"),
            "ge": _text("p_size + 1"),
            "sl": _text("p_size + 2"),
            **AUDIT,
        },
        "FROM part",
    ),
)
def job_c03(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.FIBER_ON_LOCATION, lake.fiber_on_location)


# -- events ------------------------------------------------------------------------------------

EVENT_MS = "date_trunc('milliseconds', ts)"
USER_VERSION = "CASE WHEN user_id % 2 = 0 THEN '1' ELSE '2' END"

C04 = _select(
    {
        **_lead("event_id", "ts", USER_VERSION),
        "eventType": "event_type",
        "eventDateTime_iso": _utc(EVENT_MS),
        "eventweek": NULL,
        "modificationDate_iso": (
            f"CASE WHEN user_id < 50 THEN {_utc(EVENT_MS)} ELSE {_utc(EVENT_MS + ' + INTERVAL 1 DAY')} END"
        ),
        "modificationweek": NULL,
        "klsid_ps": _text("user_id"),
        "datetype": "event_type",
        "partyId": _text("user_id"),
        "buildupdecision": "'yes'",
        "reasoncomment": "event_type",
        "communicationchannel": "CASE WHEN user_id > 50 THEN 'mail' END",
        **AUDIT,
    },
    "FROM events",
)


@query("job_c04", C04)
def job_c04(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.KLS_EVENT, lake.kls_event)


@query("job_c04_inferred", C04)
def job_c04_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the schema inferred from all messages of the type."""
    return job_frame(spark, folder, jobs.KLS_EVENT, lake.kls_event, inferred=True)


@query(
    "job_c05",
    _select(
        {
            **_lead("event_id", "ts", USER_VERSION),
            "eventType": "event_type",
            "eventDateTime": _utc(EVENT_MS),
            "eventTime": f"CASE WHEN event_id % 2 = 1 THEN {_utc(EVENT_MS)} END",
            "ciobid_ps": _text("event_id"),
            "psoid_ps": NULL,
            "klsId_ps": _text("user_id"),
            "projectBid": _text("user_id + 1"),
            "homeId_ps": _text("user_id + 2"),
            "lasteventType": NULL,
            "creationdate": NULL,
            "cancelationdate": NULL,
            "completeddate": NULL,
            "cioStatus": "event_type",
            "carrierId": _text("user_id + 3"),
            "cancellationReason": "CASE WHEN event_type = 'error' THEN 'failed' END",
            "sourceType": "'web'",
            "partyID": _text("user_id"),
            "externalOrderId_ps": _text("user_id + 4"),
            **AUDIT,
        },
        "FROM events",
    ),
)
def job_c05(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.INSTALLATION_ORDER, lake.installation_order)


@query(
    "job_c06",
    _select(
        {
            **_lead("event_id", "ts"),
            "eventid": _text("event_id"),
            "eventsource": "'crew'",
            "eventstream": "'main'",
            "eventdatetime": _utc(EVENT_MS),
            "eventtype": "event_type",
            "eventmetadata": NULL,
            "eventversion": "'1'",
            "externalreference": _text("user_id"),
            "workorderid": _text("event_id"),
            "workordertype": "event_type",
            "taskresolutioncode": _text("user_id + 1"),
            "taskresolutionstatus": _text("user_id + 2"),
            "taskresolutioncomment": _text("user_id + 3"),
            "klsid": _text("user_id + 4"),
            "cplid": _text("user_id + 5"),
            "ciobid": _text("user_id + 6"),
            "completiondate": f"CASE WHEN user_id > 20 THEN {_utc(EVENT_MS)} END",
            "explorationprotocolbid": _text("user_id + 7"),
            "buildupdecision": "'no'",
            "posignaturetimestamp": f"CASE WHEN user_id < 80 THEN {_utc(EVENT_MS)} END",
            "numberaccommodationunits": _text("user_id + 8"),
            "numberbusinessunits": _text("user_id + 9"),
            "homeid": _text("user_id + 10"),
            **AUDIT,
        },
        "FROM events",
    ),
)
def job_c06(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.WORK_ORDER, lake.work_order)


# -- service orders ----------------------------------------------------------------------------

N = "(CAST(o_orderpriority[1] AS INTEGER) - 1)"


def _order_lead(version: str | None = "'1'") -> dict[str, str]:
    lead = _lead("o.o_orderkey", "o.o_orderdate", version or "''")
    if version is None:
        del lead["messageversion"]
    return lead


def _later(days: int) -> str:
    return f"o.o_orderdate + INTERVAL {days} DAY"


C07_COLUMNS = {
    **_order_lead(None),
    "SO_ID": _text("o.o_orderkey"),
    "externalid_ps": _text("o.o_custkey"),
    "priority": "o.o_orderpriority",
    "description": "'fibre'",
    "category": "'new'",
    "state": "o.o_orderstatus",
    "orderDate_iso": _time("o.o_orderdate"),
    "completionDate_iso": f"CASE WHEN o.o_orderstatus = 'F' THEN {_time(_later(1))} END",
    "requestedStartDate_iso": _time(_later(2)),
    "requestedCompletionDate_iso": _time(_later(3)),
    "expectedCompletionDate_iso": _time(_later(4)),
    "startDate_iso": NULL,
    "oi_id": "c.oi_id",
    "oi_state": "c.oi_state",
    "oi_action": "c.oi_action",
    "s_id": "c.s_id",
    "s_name": "c.s_name",
    "s_state": "c.s_state",
    "newpseudo": NULL,
    "oldpseudo": NULL,
    "so_auftragsid": NULL,
    **AUDIT,
}


@query(
    "job_c07",
    _select(
        C07_COLUMNS,
        f"""FROM orders o LEFT JOIN (
              SELECT o_orderkey, o_orderkey || '-' || i AS oi_id, o_orderstatus AS oi_state, 'add' AS oi_action,
                     's' || i AS s_id, 'GigaAnschluss' AS s_name, 'active' AS s_state
              FROM orders o, LATERAL (SELECT unnest(range(1, {N} + 1)) AS i) u
              WHERE i % 2 = 1 AND (o_custkey + i) % 2 = 0 AND o_orderstatus = 'O') c
            ON c.o_orderkey = o.o_orderkey""",
    ),
)
def job_c07(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.SERVICE_ORDER, lake.service_order)


# -- availability ------------------------------------------------------------------------------

C08_COLUMNS = {
    **_order_lead(),
    "klsid_ps": _text("o_custkey"),
    "eventid": _text("o_orderkey"),
    "requesttime_ISO": _utc("o_orderdate"),
    "partyid": NULL,
    "errormessage": NULL,
    "eligibilityUnavailabilityReasonCode": (
        f"""CASE WHEN {N} > 1 THEN '{{"code":"R' || o_orderstatus || '","label":"no fibre"}}' END"""
    ),
    "eligibilityUnavailabilityReasonLabel": NULL,
    "address_type": NULL,
    "ausbaustandgf": "o_orderstatus || position",
    "planbeginngfausbau": f"CASE WHEN {N} >= 2 THEN {_utc('o_orderdate')} END",
    "planendegfausbau": f"CASE WHEN {N} >= 3 THEN {_utc('o_orderdate + INTERVAL 1 DAY')} END",
    "kooperationspartner": NULL,
    "technologie": NULL,
    "servicecharacteristic_array": NULL,
    **AUDIT,
}
C08 = _select(
    C08_COLUMNS,
    f"FROM orders o LEFT JOIN (VALUES (1), (4)) v(position) ON position <= {N}",
)


@query("job_c08", C08)
def job_c08(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.AVAILABILITY_V1, lake.availability_v1)


C09_COLUMNS = {
    **_order_lead("'2'"),
    "klsid_ps": _text("o_custkey"),
    "eventid": _text("o_orderkey"),
    "requesttime_ISO": _utc("o_orderdate"),
    "partyid": _text("o_custkey"),
    "errormessage": NULL,
    "eligibilityUnavailabilityReasonCode": f"CASE WHEN {N} > 1 THEN 'R' || o_orderstatus END",
    "eligibilityUnavailabilityReasonLabel": f"CASE WHEN {N} > 1 THEN 'no fibre' END",
    "address_type": """'{"id":"' || o_custkey || '","street":"Hauptweg"}'""",
    "ausbaustandgf": "o_orderstatus",
    "planbeginngfausbau": _utc("o_orderdate"),
    "planendegfausbau": f"CASE WHEN {N} >= 3 THEN {_utc('o_orderdate + INTERVAL 1 DAY')} END",
    "kooperationspartner": f"CASE WHEN {N} >= 1 THEN o_orderpriority END",
    "technologie": "technology",
    "servicecharacteristic_array": NULL,
    **AUDIT,
}
C09 = _select(
    C09_COLUMNS,
    f"FROM orders o LEFT JOIN (VALUES (2, 'FTTH'), (4, 'FTTB')) v(least, technology) ON least <= {N}",
)


@query("job_c09", C09)
def job_c09(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.AVAILABILITY_V2, lake.availability_v2)


@query("job_c09_inferred", C09)
def job_c09_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the schema inferred: the address stays a struct."""
    return job_frame(spark, folder, jobs.AVAILABILITY_V2, lake.availability_v2, inferred=True)


@query("job_c09_joined", C09)
def job_c09_joined(spark: SparkSession, folder: str) -> DataFrame:
    """The same by chained joins on the message id."""
    spec = jobs.AVAILABILITY_V2
    messages = spec.messages(lake.availability_v2(spark, folder))
    return as_text(spec.outputs(messages, how="join")[spec.target])


# -- presales ----------------------------------------------------------------------------------

IS_NEW = "o_orderdate >= TIMESTAMP '1998-01-01'"


def _new(expression: str) -> str:
    return f"CASE WHEN {IS_NEW} THEN {expression} END"


def _either(old: str, new: str) -> str:
    return f"CASE WHEN {IS_NEW} THEN {new} ELSE {old} END"


def _presales_columns(old_layout: bool) -> dict[str, str]:
    def merged(old: str, new: str) -> str:
        return _either(old, new) if old_layout else _new(new)

    company = f"CASE WHEN {IS_NEW} AND o_orderstatus = 'F' THEN {{}} END"
    return {
        "acl_id_int": _text("o_orderkey"),
        "acl_dop_ISO": _time("o_orderdate"),
        "acl_loadnumber_int": _text("month(o_orderdate)"),
        "messageversion": "'1'",
        "presalesorderid_ps": _text("o_orderkey"),
        "state": "o_orderstatus",
        "customerlandlordrole": "'tenant'",
        "connectiononly": _text("o_orderstatus = 'O'"),
        "createdat_iso": _utc("o_orderdate"),
        "lastmodifiedat_iso": _utc("o_orderdate"),
        "interimproductwish": NULL,
        "tcomcustid": _text("o_custkey"),
        "telekomkundennummer_ps": _text("o_custkey + 1"),
        "buildingtype": merged("'single'", "'multi'"),
        "accommunit": _new(_text("o_custkey")),
        "flooramount": _new("'3'"),
        "businessunitamount": NULL,
        "klsid_ps": merged(_text("o_custkey"), _text("o_custkey")),
        "kls_validated": merged(_text("o_custkey > 5"), _text("o_custkey > 5")),
        "street": merged("'Hauptweg'", "'Hauptweg'"),
        "city": merged("o_orderpriority", "o_orderpriority"),
        "zip_code": merged("lpad(CAST(o_custkey AS VARCHAR), 8, '0')", "lpad(CAST(o_custkey AS VARCHAR), 8, '0')"),
        "country": _new("'DE'"),
        "saleschannel": merged("'shop'", "'web'"),
        "salespartner": _new(_text("o_custkey + 4")),
        "salescampaign": NULL,
        "salespointid": merged(_text("o_custkey"), _text("o_custkey + 3")),
        "salesorganisationid": merged(_text("o_custkey + 2"), _text("o_custkey + 5")),
        "portingallnumbers": "'true'",
        "carriername": "'carrier'",
        "carriercode": "'17'",
        "presalescontactallowed": NULL,
        "businesscase": NULL,
        "customerinstallationdate": NULL,
        "customerinstallationorderid": NULL,
        "landlordiscompany": _text(f"{IS_NEW} AND o_orderstatus = 'F'"),
        "companyname": company.format("'Wohnbau'"),
        "legalform": company.format("'AG'"),
        "legalentity": company.format("o_orderstatus"),
        "wishdate": "'2020-03-17'",
        "wishtype": "'asap'",
    }


# Elements as JSON: what the child tables read, and fields that no job names.
ITEM_JSON = """json_object('id', o_orderkey || '-' || i, 'lineNumber', i, 'productMaterialId', o_custkey + i,
    'name', o_orderpriority, 'itemType', CASE WHEN i = 1 THEN 'service' ELSE 'router' END,
    'color', o_orderstatus, 'conditions', json_array(json_object('price', i)))"""
CHANGE_JSON = """json_object('id', o_orderkey || '/' || i, 'itemType', CASE WHEN i % 2 = 1 THEN 'state_transition' ELSE 'note' END,
    'createdAt', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || 'Z', 'author', o_custkey,
    'payload', json_object('data', json_object('from', 'draft', 'to', o_orderstatus), 'comment', 'c' || i))"""


def _elements(element: str, empty: str) -> dict[str, str]:
    """The array of JSON texts, as text itself, and the JSON text of the array."""
    listed = f"(SELECT list(CAST({element} AS VARCHAR) ORDER BY i) FROM range(1, {N} + 1) t(i))"
    none = f"CASE WHEN {N} = 0 THEN {empty}"
    return {
        "array": f"{none} ELSE CAST(to_json({listed}) AS VARCHAR) END",
        "json": f"{none} ELSE '[' || array_to_string({listed}, ',') || ']' END",
    }


_ITEMS, _CHANGES = _elements(ITEM_JSON, "'[]'"), _elements(CHANGE_JSON, "NULL")


@query(
    "job_c10",
    _select(
        {
            **_presales_columns(old_layout=True),
            "orderitems_array": _ITEMS["array"],
            "orderitems_json": _ITEMS["json"],
            "history_array": _CHANGES["array"],
            "history_json": _CHANGES["json"],
            **AUDIT,
        },
        "FROM orders",
    ),
)
def job_c10(spark: SparkSession, folder: str) -> DataFrame:
    """The main table with its arrays, whole elements, as arrays and as text."""
    return job_frame(spark, folder, jobs.PRESALES, lake.presales)


UNNESTED = f"FROM orders o, LATERAL (SELECT unnest(range(1, {N} + 1)) AS i) u"
CHILD = {
    "acl_id_int": _text("o_orderkey"),
    "acl_dop_ISO": _time("o_orderdate"),
    "acl_loadnumber_int": _text("month(o_orderdate)"),
    "presalesorderid_ps": _text("o_orderkey"),
}


@query(
    "job_c10_items",
    _select(
        {
            **CHILD,
            "orderitemid_ps": "o_orderkey || '-' || i",
            "lineNumber": _text("i"),
            "productMaterialId": _text("o_custkey + i"),
            "productname": "o_orderpriority",
            "orderitemtype": "CASE WHEN i = 1 THEN 'service' ELSE 'router' END",
            **NO_AUDIT,
        },
        UNNESTED,
    ),
)
def job_c10_items(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.PRESALES, lake.presales, "cl_f_presalesorder_orderitem_mt")


@query(
    "job_c10_history",
    _select(
        {
            **CHILD,
            "historyid_ps": "o_orderkey || '/' || i",
            "itemtype": "'state_transition'",
            "historyTimestamp_ISO": _utc("o_orderdate"),
            "oldstate": "'draft'",
            "newstate": "o_orderstatus",
            "item_json": NULL,
            "jsonstruct": NULL,
            **NO_AUDIT,
        },
        f"{UNNESTED} WHERE i % 2 = 1",
    ),
)
def job_c10_history(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.PRESALES, lake.presales, "cl_f_presalesorder_history_mt")


LINES = "FROM orders JOIN lineitem ON l_orderkey = o_orderkey"


@query(
    "job_c10_items_lines",
    _select(
        {
            **CHILD,
            "orderitemid_ps": "l_orderkey || '-' || l_linenumber || '-' || l_partkey",
            "lineNumber": _text("l_linenumber"),
            "productMaterialId": _text("l_partkey"),
            "productname": "l_returnflag",
            "orderitemtype": "CASE WHEN l_linestatus = 'F' THEN 'service' ELSE 'router' END",
            **NO_AUDIT,
        },
        LINES,
    ),
)
def job_c10_items_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The item table, from orders with all their lines."""
    return job_frame(spark, folder, jobs.PRESALES, lake.presales_lines, "cl_f_presalesorder_orderitem_mt")


@query(
    "job_c10_history_lines",
    _select(
        {
            **CHILD,
            "historyid_ps": "l_orderkey || '/' || l_linenumber || '/' || l_partkey",
            "itemtype": "'state_transition'",
            "historyTimestamp_ISO": _utc("l_shipdate"),
            "oldstate": "l_returnflag",
            "newstate": "l_linestatus",
            "item_json": NULL,
            "jsonstruct": NULL,
            **NO_AUDIT,
        },
        f"{LINES} WHERE l_returnflag <> 'N'",
    ),
)
def job_c10_history_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The history table, from orders with a change for each of their lines."""
    return job_frame(spark, folder, jobs.PRESALES, lake.presales_lines, "cl_f_presalesorder_history_mt")


@query(
    "job_c11",
    _select(
        {
            "acl_id_int": _text("event_id"),
            "acl_dop": "strftime(ts, '%Y%m%d%H%M%S')",
            "acl_dop_ISO": _time("date_trunc('second', ts)"),
            "acl_loadnumber_int": "'1'",
            "messagetype": "'VVM - PreSalesOrder'",
            "messageversion": "'1'",
            "presalesorderid_ps": _text("user_id"),
            "modification_date": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'",
            "lastmodifiedat_iso": _utc("date_trunc('second', ts)"),
            "jsonstruct": NULL,
            "rnk": "'1'",
            **NO_AUDIT,
        },
        """FROM (SELECT *, row_number() OVER (
                   PARTITION BY user_id
                   ORDER BY date_trunc('second', ts) DESC, CAST(event_id AS VARCHAR) DESC) AS place
                 FROM events) WHERE place = 1""",
    ),
)
def job_c11(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.LATEST_PRESALES, lake.presales_versions)


@query("job_c12", _select({**_presales_columns(old_layout=False), **AUDIT}, "FROM orders"))
def job_c12(spark: SparkSession, folder: str) -> DataFrame:
    return job_frame(spark, folder, jobs.PRESALES_NEW_LAYOUT, lake.presales)
