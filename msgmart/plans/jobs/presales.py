"""Presales orders: two payload layouts, two child tables, and the latest version per order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..columns import (
    Out,
    array_and_text,
    audit,
    empty,
    envelope,
    iso19,
    load_time,
    no_audit,
    present,
    value,
    values,
)
from ..spec import Child, JobSpec, Latest
from .common import MESSAGES, lead

PRESALES_TYPE = ("VVM - PreSalesOrder",)

NEW_PLACE = "installationLocation"
NEW_ADDRESS = f"{NEW_PLACE}.address"
OLD_ADDRESS = "installationAddress"

# What the child tables read of an element; the parent keeps all of it.
ITEMS = (
    "array<struct<id:string,itemType:string,name:string,lineNumber:string,productMaterialId:string>>"
)
HISTORY = (
    "array<struct<id:string,itemType:string,createdAt:string,"
    "payload:struct<data:struct<`from`:string,`to`:string>>>>"
)


def _columns(old_layout: bool) -> tuple[Out, ...]:
    """Columns up to the two provisioning wishes; ``old_layout`` adds the older paths."""

    def merged(name: str, old: str, new: str) -> Out:
        return value(name, old, new) if old_layout else value(name, new)

    def address(name: str, field: str) -> Out:
        return merged(name, f"{OLD_ADDRESS}.{field}", f"{NEW_ADDRESS}.{field}")

    return (
        *lead(load_number=True),
        value("presalesorderid_ps", "id"),
        value("state"),
        value("customerlandlordrole", "customerLandlordRole"),
        value("connectiononly", "connectionOnly"),
        iso19("createdat_iso", "createdAt"),
        iso19("lastmodifiedat_iso", "lastModifiedAt"),
        value("interimproductwish", "interimProductWish"),
        value("tcomcustid", "customerDetails.customerId"),
        value("telekomkundennummer_ps", "customerDetails.telekomCustomerId"),
        merged("buildingtype", "location.buildingDetails.type", f"{NEW_PLACE}.buildingDetails.type"),
        value("accommunit", f"{NEW_PLACE}.buildingDetails.accommodationUnitAmount"),
        value("flooramount", f"{NEW_PLACE}.buildingDetails.floorAmount"),
        empty("businessunitamount"),
        address("klsid_ps", "klsId"),
        address("kls_validated", "klsValidated"),
        address("street", "street"),
        address("city", "city"),
        address("zip_code", "zip"),
        value("country", f"{NEW_ADDRESS}.country"),
        merged("saleschannel", "salesDetails.channel", "provisionData.channel"),
        value("salespartner", "provisionData.salesPartner.partnerCode"),
        empty("salescampaign"),
        merged("salespointid", "salesDetails.salesPointId", "provisionData.salesPointId"),
        merged(
            "salesorganisationid",
            "salesDetails.organisationId",
            "provisionData.salesPartner.organisationId",
        ),
        value("portingallnumbers", "providerChange.portingAllNumbers"),
        value("carriername", "providerChange.carrierName"),
        value("carriercode", "providerChange.carrierCode"),
        value("presalescontactallowed", "presalesContactAllowed"),
        value("businesscase"),
        value("customerinstallationdate", "customerInstallationDate"),
        value("customerinstallationorderid", "customerInstallationOrderId"),
        present("landlordiscompany", f"{NEW_PLACE}.landlordCompany"),
        value("companyname", f"{NEW_PLACE}.landlordCompany.name"),
        value("legalform", f"{NEW_PLACE}.landlordCompany.legalForm"),
        value("legalentity", f"{NEW_PLACE}.landlordCompany.legalEntity"),
        value("wishdate", "provisioningDetails.wishDate"),
        value("wishtype", "provisioningDetails.wishType"),
    )


CHILD_LEAD = ("acl_id_int", "acl_dop_ISO", "acl_loadnumber_int", "presalesorderid_ps")

PRESALES = JobSpec(
    process="proc_f_presalesorder",
    source=MESSAGES,
    types=PRESALES_TYPE,
    versions=("1",),
    target="cl_f_presalesorder_mt",
    columns=(
        *_columns(old_layout=True),
        *array_and_text("orderitems_array", "orderitems_json", "items"),
        *array_and_text("history_array", "history_json", "history"),
        *audit(),
    ),
    children=(
        Child(
            target="cl_f_presalesorder_orderitem_mt",
            array="orderitems_array",
            path="items",
            ddl=ITEMS,
            keep=CHILD_LEAD,
            columns=(
                value("orderitemid_ps", "id"),
                *values("", "lineNumber", "productMaterialId"),
                value("productname", "name"),
                value("orderitemtype", "itemType"),
                *no_audit(),
            ),
        ),
        Child(
            target="cl_f_presalesorder_history_mt",
            array="history_array",
            path="history",
            ddl=HISTORY,
            keep=CHILD_LEAD,
            columns=(
                value("historyid_ps", "id"),
                value("itemtype", "itemType"),
                iso19("historyTimestamp_ISO", "createdAt"),
                value("oldstate", "payload.data.from"),
                value("newstate", "payload.data.to"),
                empty("item_json"),
                empty("jsonstruct"),
                *no_audit(),
            ),
            keep_if=lambda: F.col("itemtype") == "state_transition",
        ),
    ),
)

# The earlier form of the job: the new layout only, no arrays, no child tables.
PRESALES_NEW_LAYOUT = JobSpec(
    process="proc_f_presalesorder",
    source=MESSAGES,
    types=PRESALES_TYPE,
    versions=("1",),
    target="cl_f_presalesorder_mt",
    columns=(*_columns(old_layout=False), *audit()),
)

LATEST_PRESALES = JobSpec(
    process="proc_f_pso_latestversion",
    source=MESSAGES,
    types=PRESALES_TYPE,
    versions=("1",),
    target="cl_f_presalesorder_latestversion_mt",
    columns=(
        envelope("acl_id", "acl_id_int"),
        envelope("acl_dop"),
        load_time(),
        envelope("acl_loadnumber", "acl_loadnumber_int"),
        envelope("messagetype"),
        envelope("messageversion"),
        value("presalesorderid_ps", "id"),
        value("modification_date", "lastModifiedAt"),
        iso19("lastmodifiedat_iso", "lastModifiedAt"),
        empty("jsonstruct"),
        *no_audit(),
    ),
    latest=Latest("presalesorderid_ps", ("lastmodifiedat_iso", "acl_id_int", "acl_dop")),
    order=(
        "acl_id_int",
        "acl_dop",
        "acl_dop_ISO",
        "acl_loadnumber_int",
        "messagetype",
        "messageversion",
        "presalesorderid_ps",
        "modification_date",
        "lastmodifiedat_iso",
        "jsonstruct",
        "rnk",
        "bdmp_loadstamp",
        "bdmp_id",
        "bdmp_area_id",
    ),
)
