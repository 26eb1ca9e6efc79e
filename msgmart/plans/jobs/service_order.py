"""Service orders of two systems, with the active added connection of each order."""

from __future__ import annotations

from pyspark.sql import Column

from ..columns import audit, empty, value, values, zulu
from ..spec import JobSpec, Match
from .common import MESSAGES, lead

ORDER = "event.ServiceOrder"


def _added_active_connection(item: Column) -> Column:
    service = item["service"]
    return (
        (service["name"] == "GigaAnschluss")
        & (service["serviceState"] == "active")
        & (item["action"] == "add")
    )


SERVICE_ORDER = JobSpec(
    process="proc_f_serviceorder_event",
    source=MESSAGES,
    types=("DigiOSS - ServiceOrderEvent", "SOSI - ServiceOrderEvents"),
    versions=("1",),
    target="cl_f_soevent_mt",
    columns=(
        *lead(version=False),
        value("SO_ID", f"{ORDER}.id"),
        value("externalid_ps", f"{ORDER}.externalId"),
        *values(ORDER, "priority", "description", "category", "state"),
        zulu("orderDate_iso", f"{ORDER}.orderDate", zone=None),
        zulu("completionDate_iso", f"{ORDER}.completionDate", zone=None),
        zulu("requestedStartDate_iso", f"{ORDER}.requestedStartDate", zone=None),
        zulu("requestedCompletionDate_iso", f"{ORDER}.requestedCompletionDate", zone=None),
        zulu("expectedCompletionDate_iso", f"{ORDER}.expectedCompletionDate", zone=None),
        zulu("startDate_iso", f"{ORDER}.startDate", zone=None),
        *map(empty, ("newpseudo", "oldpseudo", "so_auftragsid")),
        *audit(),
    ),
    spread=Match(
        path=f"{ORDER}.orderItem",
        element=(
            "struct<id:string,state:string,action:string,"
            "service:struct<id:string,name:string,serviceState:string>>"
        ),
        test=_added_active_connection,
        fields={
            "oi_id": lambda item: item["id"],
            "oi_state": lambda item: item["state"],
            "oi_action": lambda item: item["action"],
            "s_id": lambda item: item["service"]["id"],
            "s_name": lambda item: item["service"]["name"],
            "s_state": lambda item: item["service"]["serviceState"],
        },
    ),
    order=(
        "acl_id_int",
        "acl_dop_ISO",
        "SO_ID",
        "externalid_ps",
        "priority",
        "description",
        "category",
        "state",
        "orderDate_iso",
        "completionDate_iso",
        "requestedStartDate_iso",
        "requestedCompletionDate_iso",
        "expectedCompletionDate_iso",
        "startDate_iso",
        "oi_id",
        "oi_state",
        "oi_action",
        "s_id",
        "s_name",
        "s_state",
        "newpseudo",
        "oldpseudo",
        "so_auftragsid",
        "bdmp_loadstamp",
        "bdmp_id",
        "bdmp_area_id",
    ),
)
