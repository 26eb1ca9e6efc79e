"""Availability checks of two versions, appended to one table."""

from __future__ import annotations

from ...functions.timeparse import iso_millis
from ..columns import audit, empty, inside, node, node_text, value, zulu
from ..spec import Attributes, JobSpec
from .common import AVAILABILITY_MESSAGES, lead

TARGET = "cl_f_fiberavailabilitycheck_mt"
ITEM_V1 = "eventPayload.serviceQualification.serviceQualificationItem[0]"
ITEM_V2 = f"availabilityCheckCalledEvent.{ITEM_V1}"

ORDER = (
    "acl_id_int",
    "acl_dop_ISO",
    "messageversion",
    "klsid_ps",
    "eventid",
    "requesttime_ISO",
    "partyid",
    "errormessage",
    "eligibilityUnavailabilityReasonCode",
    "eligibilityUnavailabilityReasonLabel",
    "address_type",
    "ausbaustandgf",
    "planbeginngfausbau",
    "planendegfausbau",
    "kooperationspartner",
    "technologie",
    "servicecharacteristic_array",
    "bdmp_loadstamp",
    "bdmp_id",
    "bdmp_area_id",
)

AVAILABILITY_V1 = JobSpec(
    process="proc_f_fiberavailabilitycheck_v1",
    source=AVAILABILITY_MESSAGES,
    types=("DigiOSS - FiberAvailabilityEvent",),
    versions=("1",),
    target=TARGET,
    columns=(
        *lead(),
        value("klsid_ps", f"{ITEM_V1}.service.place[0].id"),
        value("eventid", "eventId"),
        zulu("requesttime_ISO", "eventPayload.requestTime"),
        empty("partyid"),
        empty("errormessage"),
        # The whole first reason, not its code.
        node_text(
            "eligibilityUnavailabilityReasonCode", f"{ITEM_V1}.eligibilityUnavailabilityReason[0]"
        ),
        empty("eligibilityUnavailabilityReasonLabel"),
        empty("address_type"),
        empty("kooperationspartner"),
        empty("technologie"),
        empty("servicecharacteristic_array"),
        *audit(),
    ),
    spread=Attributes(
        path=f"{ITEM_V1}.service.characteristic",
        wanted={
            "ausbaustandgf": "Ausbaustand Glasfaser",
            "planbeginngfausbau": "Geplanter Beginn Glasfaser-Ausbau",
            "planendegfausbau": "Geplantes Ende Glasfaser-Ausbau",
        },
        convert={"planbeginngfausbau": iso_millis, "planendegfausbau": iso_millis},
    ),
    order=ORDER,
)

AVAILABILITY_V2 = JobSpec(
    process="proc_f_fiberavailabilitycheck_v2",
    source=AVAILABILITY_MESSAGES,
    types=("DigiOSS - FiberAvailabilityEvent V2",),
    versions=("2",),
    target=TARGET,
    columns=(
        *lead(),
        inside("klsid_ps", f"{ITEM_V2}.service.place[0]", "id"),
        value("eventid", "availabilityCheckCalledEvent.eventId"),
        zulu("requesttime_ISO", "availabilityCheckCalledEvent.eventTime"),
        value("partyid", "availabilityCheckCalledEvent.partyId"),
        empty("errormessage"),
        value(
            "eligibilityUnavailabilityReasonCode",
            f"{ITEM_V2}.eligibilityUnavailabilityReason[0].code",
        ),
        value(
            "eligibilityUnavailabilityReasonLabel",
            f"{ITEM_V2}.eligibilityUnavailabilityReason[0].label",
        ),
        node("address_type", f"{ITEM_V2}.service.place[0]"),
        empty("servicecharacteristic_array"),
        *audit(),
    ),
    spread=Attributes(
        path=f"{ITEM_V2}.service.serviceCharacteristic",
        wanted={
            "ausbaustandgf": "Ausbaustand Glasfaser",
            "kooperationspartner": "Kooperationspartner",
            "technologie": "Technologie",
            "planbeginngfausbau": "DatumVon",
            "planendegfausbau": "DatumBis",
        },
        convert={"planbeginngfausbau": iso_millis, "planendegfausbau": iso_millis},
    ),
    order=ORDER,
)
