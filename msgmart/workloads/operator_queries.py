"""One query per operator, over the lakes made from orders, events and order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsontext, maps, timeparse
from ..operators import arrays, increments, latest, payload, ranks
from ..plans.control import mark_of, marks
from ..session import scratch_folder
from ..sources import envelope, schema
from . import lake
from .registry import query, time_text

N = "(CAST(o_orderpriority[1] AS INTEGER) - 1)"
ITEMS = f"""orders o, LATERAL (SELECT unnest(range(1, {N} + 1)) AS i) u"""
DOP = "strftime(o_orderdate, '%Y%m%d%H%M%S')"
VERSION = "CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END"
BERLIN_TO_UTC = "timezone('UTC', timezone('Europe/Berlin', {}))"
MILLIS = "'%Y-%m-%d %H:%M:%S.%g'"
ITEM_TYPE = "CASE (o_orderkey + i) % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'R' ELSE 'N' END"
ITEM = "struct<id:string,lineNumber:int,amount:bigint,itemType:string,service:struct<id:int,name:string>>"


# -- filters and increments --------------------------------------------------------------------


@query(
    "type_version_filter",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS acl_id_int, {VERSION} AS messageversion,
               strftime(o_orderdate, {MILLIS}) AS acl_dop_iso
        FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus IN ('F', 'O')""",
)
def type_version_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Two versions of one type, envelope columns renamed."""
    picked = envelope.of_kind(lake.orders_lake(spark, folder), ["1-URGENT"], ["1", "2"])
    return picked.select(
        F.col("acl_id").alias("acl_id_int"),
        "messageversion",
        time_text(timeparse.stamp14(F.col("acl_dop"))).alias("acl_dop_iso"),
    )


@query(
    "single_version_filter",
    "SELECT CAST(o_orderkey AS VARCHAR) AS acl_id FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'",
)
def single_version_filter(spark: SparkSession, folder: str) -> DataFrame:
    return envelope.of_kind(lake.orders_lake(spark, folder), ["2-HIGH"], ["1"]).select("acl_id")


@query(
    "multi_type_filter",
    "SELECT CAST(event_id AS VARCHAR) AS acl_id, event_type AS messagetype FROM events WHERE event_type IN ('click', 'view')",
)
def multi_type_filter(spark: SparkSession, folder: str) -> DataFrame:
    picked = envelope.of_kind(lake.events_lake(spark, folder), ["click", "view"], ["1"])
    return picked.select("acl_id", "messagetype")


@query(
    "id_pick",
    """SELECT CAST(event_id AS VARCHAR) AS acl_id, event_type AS messagetype FROM events
       WHERE event_id IN (3, 17, 4711)""",
)
def id_pick(spark: SparkSession, folder: str) -> DataFrame:
    """Messages with one of several ids."""
    events = lake.events_lake(spark, folder)
    return envelope.of_ids(events, ["3", "17", "4711"]).select("acl_id", "messagetype")


@query(
    "loadstamp_text_range",
    f"SELECT CAST(o_orderkey AS VARCHAR) AS acl_id, {DOP} AS acl_dop FROM orders WHERE {DOP} < '19980101000000'",
)
def loadstamp_text_range(spark: SparkSession, folder: str) -> DataFrame:
    return envelope.before(lake.orders_lake(spark, folder), "19980101000000").select("acl_id", "acl_dop")


@query(
    "increment_bounded",
    f"""SELECT messagetype, count(*) AS new_records, max(dop) AS max_acl_dop
        FROM (SELECT o_orderpriority AS messagetype, {DOP} AS dop FROM orders)
        WHERE dop > '19970101000000' AND dop <= '20000101000000' GROUP BY messagetype""",
)
def increment_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """Between two marks: count and new mark per type."""
    new = envelope.between_marks(
        lake.orders_lake(spark, folder), "19970101000000", "20000101000000"
    )
    return new.groupBy("messagetype").agg(
        F.count(F.lit(1)).alias("new_records"), F.max("acl_dop").alias("max_acl_dop")
    )


@query(
    "increment_measure",
    f"""SELECT count(*) AS new_records, max({DOP}) AS max_acl_dop FROM orders
        WHERE {DOP} > '19990101000000' AND o_orderpriority = '5-LOW'""",
)
def increment_measure(spark: SparkSession, folder: str) -> DataFrame:
    """Count and new mark of one increment, as one aggregate."""
    picked = envelope.of_kind(lake.orders_lake(spark, folder), ["5-LOW"], ["1", "2", "3"])
    found = increments.measure(envelope.between_marks(picked, "19990101000000"))
    return spark.createDataFrame([(found.rows, found.high)], "new_records bigint, max_acl_dop string")


def _tracking(spark: SparkSession, folder: str) -> DataFrame:
    """A tracking table with one row per event: process = type, table = even or odd user."""
    events = lake.table(spark, folder, "events")
    return events.select(
        F.when(F.pmod("user_id", F.lit(2)) == 0, "even").otherwise("odd").alias("table_name"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("max_tracking_value"),
        F.lit("acl_dop").alias("col_name"),
        F.col("event_type").alias("etl_process_name"),
    )


@query(
    "tracking_latest_mark",
    """SELECT event_type AS etl_process_name,
              CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS table_name,
              max(strftime(ts, '%Y%m%d%H%M%S')) AS max_tracking_value, 'acl_dop' AS col_name
       FROM events GROUP BY ALL""",
)
def tracking_latest_mark(spark: SparkSession, folder: str) -> DataFrame:
    """The mark of every process and table."""
    return marks(_tracking(spark, folder))


@query(
    "tracking_lookup",
    """SELECT max(strftime(ts, '%Y%m%d%H%M%S')) AS max_tracking_value, 'acl_dop' AS col_name
       FROM events WHERE event_type = 'click' AND user_id % 2 = 1""",
)
def tracking_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The mark of one process on one table."""
    mark = mark_of(_tracking(spark, folder), "click", "odd")
    return spark.createDataFrame([(mark.value, mark.column)], "max_tracking_value string, col_name string")


# -- payload -----------------------------------------------------------------------------------


@query(
    "nested_flatten",
    """SELECT o_orderkey AS id, o_orderstatus AS state,
              CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_totalprice END AS old_total,
              CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice END AS new_total
       FROM orders""",
)
def nested_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Schema inferred from all messages; paths of two and three levels."""
    messages = lake.orders_lake(spark, folder)
    inferred = schema.infer_schema(messages)
    wanted = ["id", "state", "location.total", "installationLocation.address.total"]
    frame, data = payload.parse(messages, schema.pruned(inferred, wanted), inferred=True)
    return frame.select(
        data.value("id").alias("id"),
        data.value("state").alias("state"),
        data.value("location.total").alias("old_total"),
        data.value("installationLocation.address.total").alias("new_total"),
    )


@query(
    "unknown_path",
    "SELECT CAST(o_orderkey AS VARCHAR) AS acl_id, CAST(NULL AS VARCHAR) AS nowhere FROM orders",
)
def unknown_path(spark: SparkSession, folder: str) -> DataFrame:
    """A path no message has is a typed null."""
    messages = lake.orders_lake(spark, folder)
    frame, data = payload.parse(messages, schema.declared_schema({"id": "string"}))
    return frame.select("acl_id", data.value("no.such.path").alias("nowhere"))


@query(
    "array_head",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS acl_id,
               CASE WHEN {N} > 0 THEN o_orderkey || '-1' END AS first_id,
               CASE WHEN {N} > 0 THEN o_orderstatus END AS first_service
        FROM orders""",
)
def array_head(spark: SparkSession, folder: str) -> DataFrame:
    """First element by path; empty and missing arrays give null."""
    messages = lake.orders_lake(spark, folder)
    paths = {"items[0].id": "string", "items[0].service.name": "string"}
    frame, data = payload.parse(messages, schema.declared_schema(paths))
    return frame.select(
        "acl_id",
        data.value("items[0].id").alias("first_id"),
        data.value("items[0].service.name").alias("first_service"),
    )


@query(
    "layout_merge",
    "SELECT CAST(o_orderkey AS VARCHAR) AS acl_id, o_totalprice AS total FROM orders",
)
def layout_merge(spark: SparkSession, folder: str) -> DataFrame:
    """One column from the older or the newer place of a field."""
    paths = {"location.total": "double", "installationLocation.address.total": "double"}
    frame, data = payload.parse(lake.orders_lake(spark, folder), schema.declared_schema(paths))
    return frame.select("acl_id", data.value(*paths, ddl="double").alias("total"))


@query(
    "event_time_fallback",
    f"""SELECT CAST(event_id AS VARCHAR) AS acl_id,
               strftime({BERLIN_TO_UTC.format("date_trunc('milliseconds', ts)")}, {MILLIS}) AS event_time
        FROM events""",
)
def event_time_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """The first readable of two time fields, Berlin wall clock to UTC."""
    paths = {"eventDateTime": "string", "eventTime": "string"}
    frame, data = payload.parse(lake.events_lake(spark, folder), schema.declared_schema(paths))
    time = F.coalesce(
        timeparse.iso_millis(data.value("eventDateTime")), timeparse.iso_millis(data.value("eventTime"))
    )
    return frame.select("acl_id", time_text(time).alias("event_time"))


@query(
    "presence_flag",
    """SELECT CAST(o_orderkey AS VARCHAR) AS acl_id, o_orderdate >= TIMESTAMP '1998-01-01' AS is_new
       FROM orders""",
)
def presence_flag(spark: SparkSession, folder: str) -> DataFrame:
    paths = {"installationLocation.address.total": "double"}
    frame, data = payload.parse(lake.orders_lake(spark, folder), schema.declared_schema(paths))
    return frame.select("acl_id", data.value("installationLocation").isNotNull().alias("is_new"))


@query(
    "typed_nulls",
    """SELECT CAST(event_id AS VARCHAR) AS acl_id, CAST(NULL AS BOOLEAN) AS flag,
              CAST(NULL AS VARCHAR) AS note FROM events""",
)
def typed_nulls(spark: SparkSession, folder: str) -> DataFrame:
    messages = lake.events_lake(spark, folder)
    return messages.select(
        "acl_id", F.lit(None).cast("boolean").alias("flag"), F.lit(None).cast("string").alias("note")
    )


@query(
    "raw_fragment",
    """SELECT event_id, json_extract_string(props, '$.k') AS k FROM events""",
)
def raw_fragment(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON path of a text column, as text."""
    events = lake.table(spark, folder, "events")
    return events.select("event_id", jsontext.fragment(F.col("props"), "$.k").alias("k"))


@query(
    "nested_kept",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS acl_id,
               CASE WHEN {N} = 0 AND o_orderstatus <> 'F' THEN NULL ELSE {N} END AS kept_items,
               CASE WHEN {N} > 0 THEN o_orderkey || '-1' END AS text_first
        FROM orders""",
)
def nested_kept(spark: SparkSession, folder: str) -> DataFrame:
    """An array kept as a column, and the same part kept as JSON text."""
    messages = lake.orders_lake(spark, folder)
    frame, data = payload.parse(messages, schema.declared_schema({"items": f"array<{ITEM}>"}))
    kept = frame.select(
        "acl_id",
        data.value("items").alias("items_array"),
        jsontext.fragment(F.col("jsonstruct"), "$.items").alias("items_json"),
    )
    return kept.select(
        "acl_id",
        F.when(F.col("items_array").isNotNull(), F.size("items_array")).alias("kept_items"),
        jsontext.fragment(F.col("items_json"), "$[0].id").alias("text_first"),
    )


@query(
    "star_expand",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def star_expand(spark: SparkSession, folder: str) -> DataFrame:
    """All inferred top-level fields as columns."""
    events = lake.table(spark, folder, "events").select("event_id", F.col("props").alias("jsonstruct"))
    frame, _ = payload.parse(events, schema.infer_schema(events))
    return frame.select("event_id", "json_data.*")


# -- arrays ------------------------------------------------------------------------------------


def _orders_with_items(spark: SparkSession, folder: str) -> DataFrame:
    messages = lake.orders_lake(spark, folder)
    frame, data = payload.parse(messages, schema.declared_schema({"items": f"array<{ITEM}>"}))
    return frame.select("acl_id", "acl_loadnumber", data.value("items").alias("items"))


@query(
    "explode_items",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS acl_id, o_orderkey || '-' || i AS item_id,
               CAST(i AS INTEGER) AS line_number, o_custkey + i AS amount, {ITEM_TYPE} AS item_type,
               o_orderstatus AS service_name
        FROM {ITEMS}""",
)
def explode_items(spark: SparkSession, folder: str) -> DataFrame:
    """Array of nested structs to child rows."""
    item = F.col(arrays.ELEMENT)
    fields = [
        item["id"].alias("item_id"),
        item["lineNumber"].alias("line_number"),
        item["amount"].alias("amount"),
        item["itemType"].alias("item_type"),
        item["service"]["name"].alias("service_name"),
    ]
    return arrays.child_rows(_orders_with_items(spark, folder), "items", ["acl_id"], fields)


LINES = "orders o JOIN lineitem ON l_orderkey = o_orderkey"
LINE_ID = "l_orderkey || '-' || l_linenumber || '-' || l_partkey"


@query(
    "explode_order_lines",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS acl_id,
               CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY {", ".join(lake.LINE_ORDER)}) AS INTEGER) AS place,
               {LINE_ID} AS item_id, l_linenumber AS line_number, CAST(l_quantity AS BIGINT) AS amount,
               l_returnflag AS item_type, l_linestatus AS service_name
        FROM {LINES}""",
)
def explode_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All lines of every order, as they are in the array of its message, with their places there."""
    frame, data = payload.parse(lake.order_lines_lake(spark, folder), schema.declared_schema({"items": f"array<{ITEM}>"}))
    item = F.col(f"{arrays.ELEMENT}.item")
    numbered = F.transform(data.value("items"), lambda x, i: F.struct((i + 1).alias("place"), x.alias("item")))
    fields = [
        F.col(f"{arrays.ELEMENT}.place").alias("place"),
        item["id"].alias("item_id"),
        item["lineNumber"].alias("line_number"),
        item["amount"].alias("amount"),
        item["itemType"].alias("item_type"),
        item["service"]["name"].alias("service_name"),
    ]
    return arrays.child_rows(frame.withColumn("items", numbered), "items", ["acl_id"], fields)


@query(
    "order_lines_head",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS acl_id, first_id, first_service FROM orders LEFT JOIN (
          SELECT l_orderkey, {LINE_ID} AS first_id, l_linestatus AS first_service,
                 row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(lake.LINE_ORDER)}) AS place FROM lineitem)
        ON l_orderkey = o_orderkey AND place = 1""",
)
def order_lines_head(spark: SparkSession, folder: str) -> DataFrame:
    """First line of every order by path; null for orders without lines."""
    paths = {"items[0].id": "string", "items[0].service.name": "string"}
    frame, data = payload.parse(lake.order_lines_lake(spark, folder), schema.declared_schema(paths))
    heads = [data.value("items[0].id").alias("first_id"), data.value("items[0].service.name").alias("first_service")]
    return frame.select("acl_id", *heads)


@query(
    "order_lines_child",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS acl_id, item_id, line_number FROM orders LEFT JOIN (
          SELECT l_orderkey, {LINE_ID} AS item_id, l_linenumber AS line_number FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F')
        ON l_orderkey = o_orderkey""",
)
def order_lines_child(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their lines of one kind; an order without such lines stays."""
    frame, data = payload.parse(lake.order_lines_lake(spark, folder), schema.declared_schema({"items": f"array<{ITEM}>"}))
    return arrays.matching_child(
        frame.select("acl_id", data.value("items").alias("items")),
        "acl_id",
        "items",
        lambda item: (item["itemType"] == "R") & (item["service"]["name"] == "F"),
        {"item_id": lambda item: item["id"], "line_number": lambda item: item["lineNumber"]},
        "array",
    )


@query(
    "explode_filtered_history",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS acl_id, o_orderkey || '-' || i AS item_id
        FROM {ITEMS} WHERE {ITEM_TYPE} = 'R'""",
)
def explode_filtered_history(spark: SparkSession, folder: str) -> DataFrame:
    """Child rows of one kind."""
    item = F.col(arrays.ELEMENT)
    fields = [item["id"].alias("item_id"), item["itemType"].alias("item_type")]
    rows = arrays.child_rows(_orders_with_items(spark, folder), "items", ["acl_id"], fields)
    return rows.filter(F.col("item_type") == "R").drop("item_type")


PAIRS = "array<struct<name:string,value:string>>"


@query(
    "explode_pairs",
    """SELECT CAST(l_orderkey AS VARCHAR) AS acl_id, name, value FROM (
         SELECT l_orderkey, 'part' AS name, CAST(l_partkey AS VARCHAR) AS value FROM lineitem
         UNION ALL SELECT l_orderkey, 'supplier', CAST(l_suppkey AS VARCHAR) FROM lineitem
         UNION ALL SELECT l_orderkey, 'quantity', CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) FROM lineitem
         UNION ALL SELECT l_orderkey, 'shipped', strftime(l_shipdate, '%Y-%m-%d') FROM lineitem)""",
)
def explode_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Name/value characteristics to rows."""
    messages = lake.lines_lake(spark, folder)
    frame, data = payload.parse(messages, schema.declared_schema({"characteristic": PAIRS}))
    pair = F.col(arrays.ELEMENT)
    return arrays.child_rows(
        frame.withColumn("pairs", data.value("characteristic")),
        "pairs",
        ["acl_id"],
        [pair["name"].alias("name"), pair["value"].alias("value")],
    )


@query(
    "explode_primitives",
    f"""SELECT o_orderkey, CAST(i AS INTEGER) AS number FROM {ITEMS}""",
)
def explode_primitives(spark: SparkSession, folder: str) -> DataFrame:
    """An array of numbers beside its row."""
    orders = lake.table(spark, folder, "orders")
    rows = orders.select("o_orderkey", lake.numbers(lake.item_count()).alias("numbers"))
    element = F.col(arrays.ELEMENT).alias("number")
    return arrays.child_rows(rows, "numbers", ["o_orderkey"], [element])


CHILD_SQL = f"""
    SELECT CAST(o.o_orderkey AS VARCHAR) AS acl_id, c.item_id, c.line_number
    FROM orders o LEFT JOIN (
      SELECT o_orderkey, o_orderkey || '-' || i AS item_id, CAST(i AS INTEGER) AS line_number
      FROM {ITEMS} WHERE {ITEM_TYPE} = 'R' AND o_orderstatus = 'O') c
    ON o.o_orderkey = c.o_orderkey"""


def _filtered_child(spark: SparkSession, folder: str, how: str) -> DataFrame:
    parents = _orders_with_items(spark, folder).select("acl_id", "items")
    return arrays.matching_child(
        parents,
        "acl_id",
        "items",
        lambda item: (item["itemType"] == "R") & (item["service"]["name"] == "O"),
        {"item_id": lambda item: item["id"], "line_number": lambda item: item["lineNumber"]},
        how,
    )


@query("filtered_child_left", CHILD_SQL)
def filtered_child_left(spark: SparkSession, folder: str) -> DataFrame:
    """Parents with their matching elements, by a left join on the message id."""
    return _filtered_child(spark, folder, "join")


@query("filtered_child_array", CHILD_SQL)
def filtered_child_array(spark: SparkSession, folder: str) -> DataFrame:
    """The same inside the row."""
    return _filtered_child(spark, folder, "array")


def attribute_sql(names: list[tuple[str, str]]) -> str:
    """Chained left joins, one per attribute; a line's type is the attribute's name."""
    joins = " ".join(
        f"LEFT JOIN pairs p{i} ON p{i}.o_orderkey = o.o_orderkey AND p{i}.name = '{name}'"
        for i, (_, name) in enumerate(names)
    )
    columns = ", ".join(f"p{i}.value AS {column}" for i, (column, _) in enumerate(names))
    return f"""WITH pairs AS (
          SELECT o_orderkey, {ITEM_TYPE} AS name, o_orderkey || '-' || i AS value FROM {ITEMS})
        SELECT CAST(o.o_orderkey AS VARCHAR) AS acl_id, {columns} FROM orders o {joins}"""


ATTRIBUTES = [("added", "A"), ("returned", "R"), ("neutral", "N")]


def _attributes(spark: SparkSession, folder: str, how: str) -> DataFrame:
    items = _orders_with_items(spark, folder)
    pairs = F.transform(
        "items", lambda item: F.struct(item["itemType"].alias("name"), item["id"].alias("value"))
    )
    return arrays.attributes(
        items.select("acl_id", pairs.alias("pairs")), "acl_id", "pairs", dict(ATTRIBUTES), how=how
    )


@query("attributes_join", attribute_sql(ATTRIBUTES))
def attributes_join(spark: SparkSession, folder: str) -> DataFrame:
    """Name/value pairs to columns by chained left joins; names repeat within a message."""
    return _attributes(spark, folder, "join")


@query("attributes_array", attribute_sql(ATTRIBUTES))
def attributes_array(spark: SparkSession, folder: str) -> DataFrame:
    """The same inside the row."""
    return _attributes(spark, folder, "array")


HOT = "CASE WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE CAST(o_orderkey AS VARCHAR) END"


@query(
    "attributes_hot_id",
    f"""WITH m AS (SELECT {HOT} AS acl_id, o_orderkey % 3 <> 0 OR o_orderkey < 10 AS told, o_custkey, o_orderstatus, o_orderkey FROM orders),
        customer AS (SELECT acl_id, CAST(o_custkey AS VARCHAR) AS customer FROM m WHERE told), status AS (SELECT acl_id, o_orderstatus FROM m WHERE told AND o_orderkey % 2 = 0)
        SELECT m.acl_id, c.customer, s.o_orderstatus AS status
        FROM m LEFT JOIN customer c ON c.acl_id = m.acl_id LEFT JOIN status s ON s.acl_id = m.acl_id""",
)
def attributes_hot_id(spark: SparkSession, folder: str) -> DataFrame:
    """A third of all messages share one id and meet the attributes that some of them have."""
    key = F.col("o_orderkey")
    told = (key % 3 != 0) | (key < 10)
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), F.col(value).cast("string").alias("value"))
    pairs = F.when(told & (key % 2 == 0), F.array(pair("customer", "o_custkey"), pair("status", "o_orderstatus")))
    pairs = pairs.when(told, F.array(pair("customer", "o_custkey")))
    ids = F.when(key % 3 == 0, "hot").otherwise(key.cast("string"))
    orders = lake.table(spark, folder, "orders").select(ids.alias("acl_id"), pairs.alias("pairs"))
    return arrays.attributes(orders, "acl_id", "pairs", {"customer": "customer", "status": "status"}, how="join")


@query(
    "attribute_pick",
    """SELECT CAST(l_orderkey AS VARCHAR) AS acl_id, CAST(l_suppkey AS VARCHAR) AS supplier FROM lineitem""",
)
def attribute_pick(spark: SparkSession, folder: str) -> DataFrame:
    """One attribute of every message."""
    messages = lake.lines_lake(spark, folder)
    frame, data = payload.parse(messages, schema.declared_schema({"characteristic": PAIRS}))
    parents = frame.select("acl_id", data.value("characteristic").alias("pairs"))
    return arrays.attributes(parents, "acl_id", "pairs", {"supplier": "supplier"})


# -- latest version ----------------------------------------------------------------------------

LATEST_SQL = """
    SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts_text, rnk FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rnk
      FROM events) WHERE rnk = 1"""


def _versions(spark: SparkSession, folder: str) -> DataFrame:
    return lake.table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")


def _latest_text(picked: DataFrame) -> DataFrame:
    return picked.select("user_id", "event_id", "event_type", time_text(F.col("ts")).alias("ts_text"), "rnk")


@query("latest_version", LATEST_SQL)
def latest_version(spark: SparkSession, folder: str) -> DataFrame:
    """Newest event of every user by rank."""
    return _latest_text(latest.latest_by_rank(_versions(spark, folder), "user_id", ["ts", "event_id"]))


@query("latest_maxby", LATEST_SQL)
def latest_maxby(spark: SparkSession, folder: str) -> DataFrame:
    """The same as one aggregate."""
    return _latest_text(latest.latest_by_max(_versions(spark, folder), "user_id", ["ts", "event_id"]))


@query(
    "ranked_versions",
    """SELECT l_orderkey, l_shipdate_text, l_partkey, rnk FROM (
         SELECT l_orderkey, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate_text, l_partkey,
                CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC) AS INTEGER) AS rnk
         FROM lineitem) WHERE rnk = 1""",
)
def ranked_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Newest line of every order, many small groups."""
    lines = lake.table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate", "l_partkey")
    picked = latest.latest_by_max(lines, "l_orderkey", ["l_shipdate", "l_partkey"])
    return picked.select(
        "l_orderkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate_text"), "l_partkey", "rnk"
    )


ALL_RANKS_SQL = """
    SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts_text,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rnk FROM events"""


@query("all_ranks", ALL_RANKS_SQL)
def all_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Every event of every user with its rank, newest first."""
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    versions = _versions(spark, folder)
    return _latest_text(ranks.numbered(versions, ["user_id"], order, scratch_folder(spark, "ranks")))


# -- scalar functions --------------------------------------------------------------------------


@query(
    "stamp14_time",
    f"SELECT CAST(event_id AS VARCHAR) AS acl_id, strftime(date_trunc('second', ts), {MILLIS}) AS acl_dop_iso FROM events",
)
def stamp14_time(spark: SparkSession, folder: str) -> DataFrame:
    events = lake.events_lake(spark, folder)
    return events.select("acl_id", time_text(timeparse.stamp14(F.col("acl_dop"))).alias("acl_dop_iso"))


@query(
    "ms_epoch_text",
    """SELECT CAST(o_orderkey AS VARCHAR) AS acl_id,
              strftime(TIMESTAMP '2020-01-01' + CAST(o_orderkey % 3650 AS INTEGER) * INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS created
       FROM orders""",
)
def ms_epoch_text(spark: SparkSession, folder: str) -> DataFrame:
    frame, data = payload.parse(
        lake.orders_lake(spark, folder), schema.declared_schema({"createdAtMs": "string"})
    )
    return frame.select("acl_id", timeparse.epoch_millis_text(data.value("createdAtMs")).alias("created"))


@query(
    "iso19_utc",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS acl_id,
               strftime({BERLIN_TO_UTC.format("o_orderdate")}, {MILLIS}) AS created FROM orders""",
)
def iso19_utc(spark: SparkSession, folder: str) -> DataFrame:
    """Berlin wall clock to UTC, summer and winter."""
    frame, data = payload.parse(
        lake.orders_lake(spark, folder), schema.declared_schema({"createdAt": "string"})
    )
    return frame.select("acl_id", time_text(timeparse.iso_seconds(data.value("createdAt"))).alias("created"))


@query(
    "iso_ms_noshift",
    f"""SELECT CAST(event_id AS VARCHAR) AS acl_id,
               strftime(date_trunc('milliseconds', ts), {MILLIS}) AS event_time FROM events""",
)
def iso_ms_noshift(spark: SparkSession, folder: str) -> DataFrame:
    frame, data = payload.parse(
        lake.events_lake(spark, folder), schema.declared_schema({"eventTime": "string"})
    )
    return frame.select(
        "acl_id", time_text(timeparse.iso_millis(data.value("eventTime"), zone=None)).alias("event_time")
    )


@query(
    "bracket_strip_first",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS acl_id,
               CASE WHEN {N} > 0 THEN o_orderkey || '-1' END AS stripped_id,
               CASE WHEN {N} > 0 THEN o_orderkey || '-1' END AS first_id
        FROM orders""",
)
def bracket_strip_first(spark: SparkSession, folder: str) -> DataFrame:
    """First object of an array text: by stripping brackets, and as an array's head."""
    text = jsontext.fragment(F.col("jsonstruct"), "$.items")
    return lake.orders_lake(spark, folder).select(
        "acl_id",
        jsontext.first_object_stripped(text, "struct<id:string>")["id"].alias("stripped_id"),
        jsontext.first_object(text, "struct<id:string>")["id"].alias("first_id"),
    )


@query(
    "map_build_explode",
    """SELECT c_custkey, 'key_name' AS key, c_name AS value FROM customer
       UNION ALL SELECT c_custkey, 'key_segment', c_mktsegment FROM customer""",
)
def map_build_explode(spark: SparkSession, folder: str) -> DataFrame:
    """Map with literal keys, then one row per entry."""
    customers = lake.table(spark, folder, "customer")
    entries = maps.map_of({"key_name": F.col("c_name"), "key_segment": F.col("c_mktsegment")})
    return maps.map_rows(customers.select("c_custkey", entries.alias("m")), ["c_custkey"], "m")


@query(
    "map_matching_columns",
    """SELECT l_orderkey, 'l_returnflag' AS key, l_returnflag AS value FROM lineitem""",
)
def map_matching_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Map of all columns whose name contains a text, then one row per entry."""
    lines = lake.table(spark, folder, "lineitem")
    matching = maps.map_of_matching(lines, "flag")
    return maps.map_rows(lines.select("l_orderkey", matching.alias("m")), ["l_orderkey"], "m")


# -- whole tables ------------------------------------------------------------------------------


@query(
    "two_feeds_one_table",
    """SELECT CAST(o_orderkey AS VARCHAR) AS acl_id, o_orderstatus AS label, 'orders' AS feed FROM orders
       UNION ALL SELECT CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), 'events' FROM events""",
)
def two_feeds_one_table(spark: SparkSession, folder: str) -> DataFrame:
    """Two payload shapes in one table."""
    orders, order = payload.parse(
        lake.orders_lake(spark, folder), schema.declared_schema({"state": "string"})
    )
    events, event = payload.parse(
        lake.events_lake(spark, folder), schema.declared_schema({"userId": "string"})
    )
    left = orders.select("acl_id", order.value("state").alias("label"), F.lit("orders").alias("feed"))
    right = events.select("acl_id", event.value("userId").alias("label"), F.lit("events").alias("feed"))
    return left.unionByName(right)


@query(
    "era_report",
    """SELECT * FROM (VALUES ('createdAt', 'string', NULL), ('createdAtMs', 'bigint', NULL),
         ('id', 'bigint', NULL), ('state', 'string', NULL), ('location', 'struct<total:double>', NULL),
         ('installationAddress', 'struct<klsId:bigint>', 'old'),
         ('installationLocation', 'struct<address:struct<total:double>>', 'new'),
         ('items', 'array<struct<amount:bigint,id:string,itemType:string,lineNumber:bigint,service:struct<id:bigint,name:string>>>', NULL)
       ) AS t(field, type, layout)""",
)
def era_report(spark: SparkSession, folder: str) -> DataFrame:
    """Top-level fields of the messages and the layout they mark."""
    return schema.field_report(spark, schema.infer_schema(lake.orders_lake(spark, folder)))


@query(
    "minmax_by_era",
    f"""SELECT min({DOP}) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS old_first,
               max({DOP}) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS old_last,
               min({DOP}) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS new_first,
               max({DOP}) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS new_last,
               count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS old_rows,
               count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS new_rows
        FROM orders""",
)
def minmax_by_era(spark: SparkSession, folder: str) -> DataFrame:
    """First and last load stamp where the marker field of a layout is not null."""
    paths = {"installationAddress.klsId": "string", "installationLocation.address.total": "string"}
    frame, data = payload.parse(lake.orders_lake(spark, folder), schema.declared_schema(paths))
    stamps = frame.select(
        "acl_dop",
        data.value("installationAddress").isNotNull().alias("old"),
        data.value("installationLocation").isNotNull().alias("new"),
    )
    aggregates = []
    for era in ("old", "new"):
        stamp = F.when(F.col(era), F.col("acl_dop"))
        aggregates += [
            F.min(stamp).alias(f"{era}_first"),
            F.max(stamp).alias(f"{era}_last"),
            F.count_if(F.col(era)).alias(f"{era}_rows"),
        ]
    return stamps.agg(*aggregates)


@query("table_count", "SELECT count(*) AS n FROM lineitem")
def table_count(spark: SparkSession, folder: str) -> DataFrame:
    """A count in SQL."""
    return spark.sql("SELECT count(*) AS n FROM {lines}", lines=lake.table(spark, folder, "lineitem"))


@query("malformed_messages", "SELECT event_id FROM events WHERE event_type = 'error'")
def malformed_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages whose text is cut short: the parser gives nulls for them, this finds them."""
    text = F.col("props")
    cut = F.when(F.col("event_type") == "error", F.substring(text, F.lit(1), F.length(text) - 1))
    events = lake.table(spark, folder, "events")
    texts = events.select("event_id", cut.otherwise(text).alias("jsonstruct"))
    return payload.malformed(texts).select("event_id")
