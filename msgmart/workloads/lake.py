"""Message lakes made from the supplied tables, one message per row, without a shuffle.

Every message is derived from one row, so that building a lake is a map over the table and the
queries above it show their own cost only. The lakes with lines are the exception: all lines of an order are
gathered into its message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.nesting import nest
from ..session import scratch_folder

#: What orders the lines of an order; line numbers repeat.
LINE_ORDER = ["l_linenumber", "l_extendedprice", "l_quantity", "l_partkey", "l_suppkey", "l_shipdate"]

DAY_MILLIS = 86_400_000
FIRST_MILLIS = 1_577_836_800_000  # 2020-01-01 UTC
NEW_LAYOUT_FROM = "1998-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A supplied table. Where the scan has fewer tasks than the session has cores, its rows are
    spread over all of them; a large table has enough splits and is left alone."""
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def messages(
    rows: DataFrame,
    key: Column,
    time: Column,
    kind: Column | str,
    version: Column | str,
    payload: Column,
    load_number: Column | None = None,
) -> DataFrame:
    """The envelope around a payload struct."""
    return rows.select(
        key.cast("string").alias("acl_id"),
        F.date_format(time, "yyyyMMddHHmmss").alias("acl_dop"),
        (load_number if load_number is not None else F.lit(1)).cast("int").alias("acl_loadnumber"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("messagetype"),
        (F.lit(version) if isinstance(version, str) else version).alias("messageversion"),
        F.to_json(payload).alias("jsonstruct"),
        F.lit("20200101").alias("bdmp_loadstamp"),
        F.lit("id").alias("bdmp_id"),
        F.lit("area").alias("bdmp_area_id"),
    )


def iso_z(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def item_count() -> Column:
    """Number of items of an order, 0 to 4: its priority digit less one."""
    return F.substring("o_orderpriority", 1, 1).cast("int") - 1


def numbers(upto: Column, most: int = 4) -> Column:
    """``[1, ..., upto]``, empty for zero."""
    return F.slice(F.array(*[F.lit(i) for i in range(1, most + 1)]), F.lit(1), upto)


def order_version() -> Column:
    status = F.col("o_orderstatus")
    return F.when(status == "F", "1").when(status == "O", "2").otherwise("3")


def is_new_layout() -> Column:
    return F.col("o_orderdate") >= F.to_timestamp_ntz(F.lit(NEW_LAYOUT_FROM))


def orders_lake(spark: SparkSession, folder: str) -> DataFrame:
    """One message per order: nested fields in two layouts, an array of items, some absent."""
    n = item_count()
    key = F.col("o_orderkey")

    def item(i: Column) -> Column:
        return F.struct(
            F.concat_ws("-", key, i).alias("id"),
            i.alias("lineNumber"),
            (F.col("o_custkey") + i).alias("amount"),
            F.element_at(
                F.array(F.lit("A"), F.lit("R"), F.lit("N")), (F.pmod(key + i, F.lit(3)) + 1).cast("int")
            ).alias("itemType"),
            F.struct(i.alias("id"), F.col("o_orderstatus").alias("name")).alias("service"),
        )

    items = F.transform(numbers(n), lambda i: item(i))
    no_items = (n == 0) & (F.col("o_orderstatus") != "F")
    payload = F.struct(
        key.alias("id"),
        F.col("o_orderstatus").alias("state"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("createdAt"),
        (F.lit(FIRST_MILLIS) + F.pmod(key, F.lit(3650)) * DAY_MILLIS).alias("createdAtMs"),
        F.when(~is_new_layout(), F.struct(F.col("o_totalprice").alias("total"))).alias("location"),
        F.when(
            is_new_layout(),
            F.struct(F.struct(F.col("o_totalprice").alias("total")).alias("address")),
        ).alias("installationLocation"),
        F.when(~is_new_layout(), F.struct(F.col("o_custkey").alias("klsId"))).alias(
            "installationAddress"
        ),
        F.when(no_items, F.lit(None)).otherwise(items).alias("items"),
    )
    return messages(
        table(spark, folder, "orders"),
        key,
        F.col("o_orderdate"),
        F.col("o_orderpriority"),
        order_version(),
        payload,
        F.month("o_orderdate"),
    )


def orders_with_lines(spark: SparkSession, folder: str, **arrays: Column) -> DataFrame:
    """The orders with arrays of all of their lines, in order; null where an order has none."""
    lines = table(spark, folder, "lineitem")
    items = nest(lines, ["l_orderkey"], LINE_ORDER, F.struct(*[c.alias(x) for x, c in arrays.items()]), "lines", scratch_folder(spark, "lines"))
    joined = table(spark, folder, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("*", *[F.col(f"lines.{x}").alias(x) for x in arrays]).drop("l_orderkey", "lines")


def _line_id(mark: str) -> Column:
    return F.concat_ws(mark, "l_orderkey", "l_linenumber", "l_partkey")


def order_lines_lake(spark: SparkSession, folder: str) -> DataFrame:
    """One message per order, its items those of lineitem: any number, with repeated line numbers, some orders without."""
    item = F.struct(
        _line_id("-").alias("id"),
        F.col("l_linenumber").alias("lineNumber"),
        F.col("l_quantity").cast("long").alias("amount"),
        F.col("l_returnflag").alias("itemType"),
        F.struct(F.col("l_suppkey").alias("id"), F.col("l_linestatus").alias("name")).alias("service"),
    )
    rows = orders_with_lines(spark, folder, items=item)
    payload = F.struct(F.col("o_orderkey").alias("id"), F.col("items"))
    return messages(rows, F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderpriority"), order_version(), payload)


def events_lake(spark: SparkSession, folder: str) -> DataFrame:
    """One message per event; even ids carry a second time field."""
    even = F.pmod("event_id", F.lit(2)) == 0
    payload = F.struct(
        F.col("user_id").alias("userId"),
        F.col("value"),
        iso_z(F.col("ts")).alias("eventTime"),
        F.when(even, iso_z(F.col("ts"))).alias("eventDateTime"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    return messages(
        table(spark, folder, "events"),
        F.col("event_id"),
        F.col("ts"),
        F.col("event_type"),
        "1",
        payload,
    )


def lines_lake(spark: SparkSession, folder: str) -> DataFrame:
    """One message per order line with name/value characteristics; ids repeat."""

    def pair(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))

    payload = F.struct(
        F.col("l_linenumber").alias("line"),
        F.array(
            pair("part", F.col("l_partkey")),
            pair("supplier", F.col("l_suppkey")),
            pair("quantity", F.col("l_quantity").cast("int")),
            pair("shipped", F.date_format("l_shipdate", "yyyy-MM-dd")),
        ).alias("characteristic"),
    )
    return messages(
        table(spark, folder, "lineitem"),
        F.col("l_orderkey"),
        F.col("l_shipdate"),
        F.concat(F.lit("line "), F.col("l_returnflag")),
        "1",
        payload,
    )


# -- payloads in the shape of the jobs ---------------------------------------------------------


def _day(key: Column, shift: int = 0) -> Column:
    return F.lit(FIRST_MILLIS + shift * 1000) + F.pmod(key, F.lit(3650)) * DAY_MILLIS


def vvm_area(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    payload = F.struct(
        key.alias("number"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("areaType"),
        F.when(F.col("c_nationkey") < 20, F.col("c_nationkey")).alias("areaStatus"),
        (F.col("c_acctbal") > 0).alias("plannedArea"),
        _day(key).alias("creationDate"),
        _day(key, 1).cast("string").alias("modificationDate"),
        F.when(F.col("c_nationkey") > 5, _day(key, 2)).alias("rolloutDate"),
        _day(key, 3).alias("plannedFrom"),
        _day(key, 4).alias("plannedTo"),
        F.struct(
            F.col("c_nationkey").alias("threshold"),
            (F.col("c_nationkey") + 1).alias("ordersCountInVVM"),
            (F.col("c_nationkey") + 2).alias("additionalOrdersCountInVVM"),
        ).alias("thresholdData"),
    )
    time = F.timestamp_millis(_day(key))
    return messages(table(spark, folder, "customer"), key, time, "DigiOSS - vvmArea", "1", payload)


def nvt_area(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    nation = F.col("s_nationkey")
    payload = F.struct(
        key.alias("businessId"),
        F.col("s_name").alias("name"),
        F.when(nation > 3, F.struct(nation.alias("number"))).alias("vvmArea"),
        _day(key).alias("creationDate"),
        _day(key, 1).alias("modificationDate"),
        (nation + 1).alias("nvtDescriptor"),
        (nation + 2).alias("onkz"),
        (nation + 3).alias("asb"),
        (nation + 4).alias("pti"),
        (nation + 5).alias("subsidiary"),
        (nation + 6).alias("guid"),
        (nation + 7).alias("nvtKlsId"),
    )
    time = F.timestamp_millis(_day(key))
    return messages(table(spark, folder, "supplier"), key, time, "DigiOSS - NvtArea", "1", payload)


def fiber_on_location(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    size = F.col("p_size")
    payload = F.struct(
        key.alias("klsId"),
        F.struct(size.alias("number")).alias("vvmArea"),
        F.struct(F.col("p_brand").alias("businessId")).alias("nvtArea"),
        _day(key, 1).alias("modificationDate"),
        _day(key).alias("creationDate"),
        (size > 10).alias("controltraceabilitymanual"),
        F.col("p_type").alias("installationStatus"),
        F.col("p_brand").alias("demandCarrier"),
        F.col("p_name").alias("areaType"),
        F.when(size > 20, size).alias("initiative"),
        F.when(size <= 20, size).alias("reasonForNoConstruction"),
        F.lit("FTTH").alias("technology"),
        F.col("p_brand").alias("rolloutSponsor"),
        _day(key, 2).alias("installationDate"),
        _day(key, 3).alias("plannedInstallationBegin"),
        F.when(size > 30, _day(key, 4)).alias("plannedInstallationEnd"),
        size.alias("we"),
        (size + 1).alias("ge"),
        (size + 2).alias("sl"),
    )
    version = F.when(F.pmod(key, F.lit(2)) == 0, "1").otherwise("2")
    time = F.timestamp_millis(_day(key))
    return messages(
        table(spark, folder, "part"), key, time, "DigiOSS - FibreOnLocation", version, payload
    )


def _event_times() -> list[Column]:
    even = F.pmod("event_id", F.lit(2)) == 0
    time = iso_z(F.col("ts"))
    return [
        F.when(even, time).alias("eventDateTime"),
        F.when(~even, time).alias("eventTime"),
    ]


def kls_event(spark: SparkSession, folder: str) -> DataFrame:
    payload = F.struct(
        F.col("event_type").alias("eventType"),
        *_event_times(),
        F.col("user_id").alias("partyId"),
        F.struct(
            F.col("user_id").alias("klsId"),
            F.when(F.col("user_id") < 50, iso_z(F.col("ts"))).alias("modificationDate"),
            F.struct(
                iso_z(F.col("ts") + F.expr("interval 1 day")).alias("date"),
                F.col("event_type").alias("dateType"),
            ).alias("dateInformation"),
            F.lit("yes").alias("buildUpDecision"),
            F.col("event_type").alias("reasonComment"),
            F.when(F.col("user_id") > 50, F.lit("mail")).alias("communicationChannel"),
        ).alias("eventPayload"),
    )
    version = F.when(F.pmod("user_id", F.lit(2)) == 0, "1").otherwise("2")
    rows = table(spark, folder, "events")
    return messages(rows, F.col("event_id"), F.col("ts"), "IBT - KLSEvent", version, payload)


def installation_order(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id")
    payload = F.struct(
        F.col("event_type").alias("eventType"),
        *_event_times(),
        user.alias("partyId"),
        F.struct(
            F.col("event_id").alias("cioBid"),
            user.alias("klsId"),
            (user + 1).alias("projectBid"),
            (user + 2).alias("homeId"),
            F.col("event_type").alias("cioStatus"),
            (user + 3).alias("carrierId"),
            F.when(F.col("event_type") == "error", F.lit("failed")).alias("cancellationReason"),
            F.lit("web").alias("sourceType"),
            (user + 4).alias("externalOrderId"),
        ).alias("eventPayload"),
    )
    version = F.when(F.pmod("user_id", F.lit(2)) == 0, "1").otherwise("2")
    rows = table(spark, folder, "events")
    kind = "IBT - CustomerInstallationOrderEvent"
    return messages(rows, F.col("event_id"), F.col("ts"), kind, version, payload)


def work_order(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id")
    payload = F.struct(
        F.col("event_id").alias("eventId"),
        F.lit("crew").alias("eventSource"),
        F.lit("main").alias("eventStream"),
        iso_z(F.col("ts")).alias("eventDateTime"),
        F.col("event_type").alias("eventType"),
        F.lit(1).alias("eventVersion"),
        F.struct(
            user.alias("externalReference"),
            F.col("event_id").alias("workOrderId"),
            F.col("event_type").alias("workOrderType"),
            (user + 1).alias("taskResolutionCode"),
            (user + 2).alias("taskResolutionStatus"),
            (user + 3).alias("taskResolutionComment"),
            (user + 4).alias("klsId"),
            (user + 5).alias("cplId"),
            (user + 6).alias("cioBid"),
            F.when(user > 20, iso_z(F.col("ts"))).alias("completionDate"),
            (user + 7).alias("explorationProtocolBid"),
            F.lit("no").alias("buildUpDecision"),
            F.when(user < 80, iso_z(F.col("ts"))).alias("poSignatureTimestamp"),
            (user + 8).alias("numberAccommodationUnits"),
            (user + 9).alias("numberBusinessUnits"),
            (user + 10).alias("homeId"),
        ).alias("eventPayload"),
    )
    rows = table(spark, folder, "events")
    return messages(rows, F.col("event_id"), F.col("ts"), "DigiOSS - WorkOrderEvent", "1", payload)


def service_order(spark: SparkSession, folder: str) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")

    def item(i: Column) -> Column:
        return F.struct(
            F.concat_ws("-", key, i).alias("id"),
            status.alias("state"),
            F.when(F.pmod(F.col("o_custkey") + i, F.lit(2)) == 0, "add").otherwise("remove").alias("action"),
            F.struct(
                F.concat(F.lit("s"), i.cast("string")).alias("id"),
                F.when(F.pmod(i, F.lit(2)) == 1, "GigaAnschluss").otherwise("Telefon").alias("name"),
                F.when(status == "O", "active").otherwise("planned").alias("serviceState"),
            ).alias("service"),
        )

    day = F.col("o_orderdate")
    order = F.struct(
        key.alias("id"),
        F.col("o_custkey").alias("externalId"),
        F.col("o_orderpriority").alias("priority"),
        F.lit("fibre").alias("description"),
        F.lit("new").alias("category"),
        status.alias("state"),
        iso_z(day).alias("orderDate"),
        F.when(status == "F", iso_z(day + F.expr("interval 1 day"))).alias("completionDate"),
        iso_z(day + F.expr("interval 2 days")).alias("requestedStartDate"),
        iso_z(day + F.expr("interval 3 days")).alias("requestedCompletionDate"),
        iso_z(day + F.expr("interval 4 days")).alias("expectedCompletionDate"),
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("startDate"),
        F.transform(numbers(item_count()), lambda i: item(i)).alias("orderItem"),
    )
    payload = F.struct(F.struct(order.alias("ServiceOrder")).alias("event"))
    kind = F.when(status == "P", "SOSI - ServiceOrderEvents").otherwise("DigiOSS - ServiceOrderEvent")
    return messages(table(spark, folder, "orders"), key, day, kind, "1", payload)


def _pair(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.alias("value"))


def _reasons() -> Column:
    reason = F.struct(
        F.concat(F.lit("R"), F.col("o_orderstatus")).alias("code"), F.lit("no fibre").alias("label")
    )
    return F.when(item_count() > 1, F.array(reason))


def _place() -> Column:
    return F.array(F.struct(F.col("o_custkey").cast("string").alias("id"), F.lit("Hauptweg").alias("street")))


def availability_v1(spark: SparkSession, folder: str) -> DataFrame:
    """Up to four characteristics, the last one repeats the name of the first."""
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    pairs = F.array(
        _pair("Ausbaustand Glasfaser", F.concat(status, F.lit("1"))),
        _pair("Geplanter Beginn Glasfaser-Ausbau", iso_z(day)),
        _pair("Geplantes Ende Glasfaser-Ausbau", iso_z(day + F.expr("interval 1 day"))),
        _pair("Ausbaustand Glasfaser", F.concat(status, F.lit("4"))),
    )
    service = F.struct(
        _place().alias("place"), F.slice(pairs, F.lit(1), item_count()).alias("characteristic")
    )
    item = F.struct(_reasons().alias("eligibilityUnavailabilityReason"), service.alias("service"))
    payload = F.struct(
        F.col("o_orderkey").alias("eventId"),
        F.struct(
            iso_z(day).alias("requestTime"),
            F.struct(F.array(item).alias("serviceQualificationItem")).alias("serviceQualification"),
        ).alias("eventPayload"),
    )
    kind = "DigiOSS - FiberAvailabilityEvent"
    return messages(table(spark, folder, "orders"), F.col("o_orderkey"), day, kind, "1", payload)


def availability_v2(spark: SparkSession, folder: str) -> DataFrame:
    """Two to six characteristics, the sixth repeats the name of the fourth."""
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    pairs = F.array(
        _pair("Ausbaustand Glasfaser", status),
        _pair("DatumVon", iso_z(day)),
        _pair("Kooperationspartner", F.col("o_orderpriority")),
        _pair("Technologie", F.lit("FTTH")),
        _pair("DatumBis", iso_z(day + F.expr("interval 1 day"))),
        _pair("Technologie", F.lit("FTTB")),
    )
    service = F.struct(
        _place().alias("place"),
        F.slice(pairs, F.lit(1), item_count() + 2).alias("serviceCharacteristic"),
    )
    item = F.struct(_reasons().alias("eligibilityUnavailabilityReason"), service.alias("service"))
    event = F.struct(
        F.col("o_orderkey").alias("eventId"),
        iso_z(day).alias("eventTime"),
        F.col("o_custkey").alias("partyId"),
        F.struct(
            F.struct(F.array(item).alias("serviceQualificationItem")).alias("serviceQualification")
        ).alias("eventPayload"),
    )
    payload = F.struct(event.alias("availabilityCheckCalledEvent"))
    kind = "DigiOSS - FiberAvailabilityEvent V2"
    return messages(table(spark, folder, "orders"), F.col("o_orderkey"), day, kind, "2", payload)


def presales(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> DataFrame:
    """Old layout before 1998, new layout from then on; items and history made from the order, or columns of `rows`."""
    key, cust, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    status, new = F.col("o_orderstatus"), is_new_layout()
    stamp = F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")

    def item(i: Column) -> Column:
        return F.struct(
            F.concat_ws("-", key, i).alias("id"),
            i.alias("lineNumber"),
            (cust + i).alias("productMaterialId"),
            F.col("o_orderpriority").alias("name"),
            F.when(i == 1, "service").otherwise("router").alias("itemType"),
            status.alias("color"),
            F.array(F.struct(i.alias("price"))).alias("conditions"),
        )

    def change(i: Column) -> Column:
        return F.struct(
            F.concat_ws("/", key, i).alias("id"),
            F.when(F.pmod(i, F.lit(2)) == 1, "state_transition").otherwise("note").alias("itemType"),
            stamp.alias("createdAt"),
            cust.alias("author"),
            F.struct(
                F.struct(F.lit("draft").alias("from"), status.alias("to")).alias("data"),
                F.concat(F.lit("c"), i.cast("string")).alias("comment"),
            ).alias("payload"),
        )

    address = [
        cust.alias("klsId"),
        (cust > 5).alias("klsValidated"),
        F.lit("Hauptweg").alias("street"),
        F.col("o_orderpriority").alias("city"),
        F.lpad(cust.cast("string"), 8, "0").alias("zip"),
    ]
    company = F.struct(F.lit("Wohnbau").alias("name"), F.lit("AG").alias("legalForm"), status.alias("legalEntity"))
    new_place = F.struct(
        F.struct(*address, F.lit("DE").alias("country")).alias("address"),
        F.struct(
            F.lit("multi").alias("type"),
            cust.alias("accommodationUnitAmount"),
            F.lit(3).alias("floorAmount"),
        ).alias("buildingDetails"),
        F.when(status == "F", company).alias("landlordCompany"),
    )
    payload = F.struct(
        key.alias("id"),
        status.alias("state"),
        F.lit("tenant").alias("customerLandlordRole"),
        (status == "O").alias("connectionOnly"),
        stamp.alias("createdAt"),
        stamp.alias("lastModifiedAt"),
        F.struct(cust.alias("customerId"), (cust + 1).alias("telekomCustomerId")).alias("customerDetails"),
        F.when(~new, F.struct(F.struct(F.lit("single").alias("type")).alias("buildingDetails"))).alias("location"),
        F.when(~new, F.struct(*address)).alias("installationAddress"),
        F.when(new, new_place).alias("installationLocation"),
        F.when(
            ~new,
            F.struct(
                F.lit("shop").alias("channel"),
                cust.alias("salesPointId"),
                (cust + 2).alias("organisationId"),
            ),
        ).alias("salesDetails"),
        F.when(
            new,
            F.struct(
                F.lit("web").alias("channel"),
                (cust + 3).alias("salesPointId"),
                F.struct((cust + 4).alias("partnerCode"), (cust + 5).alias("organisationId")).alias("salesPartner"),
            ),
        ).alias("provisionData"),
        F.struct(
            F.lit(True).alias("portingAllNumbers"),
            F.lit("carrier").alias("carrierName"),
            F.lit(17).alias("carrierCode"),
        ).alias("providerChange"),
        F.struct(F.lit("2020-03-17").alias("wishDate"), F.lit("asap").alias("wishType")).alias("provisioningDetails"),
        *(
            (F.col("items"), F.col("history"))
            if rows is not None
            else (
                F.transform(numbers(item_count()), lambda i: item(i)).alias("items"),
                F.when(item_count() > 0, F.transform(numbers(item_count()), lambda i: change(i))).alias("history"),
            )
        ),
    )
    rows = table(spark, folder, "orders") if rows is None else rows
    return messages(rows, key, day, "VVM - PreSalesOrder", "1", payload, F.month(day))


def presales_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Presales orders whose items and history are those of lineitem."""
    item = F.struct(
        _line_id("-").alias("id"),
        F.col("l_linenumber").alias("lineNumber"),
        F.col("l_partkey").alias("productMaterialId"),
        F.col("l_returnflag").alias("name"),
        F.when(F.col("l_linestatus") == "F", "service").otherwise("router").alias("itemType"),
    )
    change = F.struct(
        _line_id("/").alias("id"),
        F.when(F.col("l_returnflag") != "N", "state_transition").otherwise("note").alias("itemType"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("createdAt"),
        F.struct(F.struct(F.col("l_returnflag").alias("from"), F.col("l_linestatus").alias("to")).alias("data")).alias("payload"),
    )
    return presales(spark, folder, orders_with_lines(spark, folder, items=item, history=change))


def presales_versions(spark: SparkSession, folder: str) -> DataFrame:
    """One version of a presales order per event; the business key is the user."""
    payload = F.struct(
        F.col("user_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("lastModifiedAt"),
    )
    rows = table(spark, folder, "events")
    return messages(rows, F.col("event_id"), F.col("ts"), "VVM - PreSalesOrder", "1", payload)
