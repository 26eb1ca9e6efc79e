"""Business events: ISO times with a fallback between time fields, one level of nesting."""

from __future__ import annotations

from ..columns import audit, empty, value, zulu
from ..spec import JobSpec
from .common import MESSAGES, lead

KLS_EVENT = JobSpec(
    process="proc_f_kls_event",
    source=MESSAGES,
    types=("IBT - KLSEvent",),
    versions=("1", "2"),
    target="cl_f_klsevent_mt",
    columns=(
        *lead(),
        value("eventType"),
        zulu("eventDateTime_iso", "eventDateTime", "eventTime"),
        empty("eventweek"),
        zulu(
            "modificationDate_iso",
            "eventPayload.modificationDate",
            "eventPayload.dateInformation.date",
        ),
        empty("modificationweek"),
        value("klsid_ps", "eventPayload.klsId"),
        value("datetype", "eventPayload.dateInformation.dateType"),
        value("partyId"),
        value("buildupdecision", "eventPayload.buildUpDecision"),
        value("reasoncomment", "eventPayload.reasonComment"),
        value("communicationchannel", "eventPayload.communicationChannel"),
        *audit(),
    ),
)

INSTALLATION_ORDER = JobSpec(
    process="proc_f_cio",
    source=MESSAGES,
    types=("IBT - CustomerInstallationOrderEvent",),
    versions=("1", "2"),
    target="cl_f_cio_mt",
    columns=(
        *lead(),
        value("eventType"),
        zulu("eventDateTime", "eventDateTime", "eventTime"),
        zulu("eventTime"),
        value("ciobid_ps", "eventPayload.cioBid"),
        empty("psoid_ps"),
        value("klsId_ps", "eventPayload.klsId"),
        value("projectBid", "eventPayload.projectBid"),
        value("homeId_ps", "eventPayload.homeId"),
        *map(empty, ("lasteventType", "creationdate", "cancelationdate", "completeddate")),
        value("cioStatus", "eventPayload.cioStatus"),
        value("carrierId", "eventPayload.carrierId"),
        value("cancellationReason", "eventPayload.cancellationReason"),
        value("sourceType", "eventPayload.sourceType"),
        value("partyID", "partyId"),
        value("externalOrderId_ps", "eventPayload.externalOrderId"),
        *audit(),
    ),
)

# The target names are lower case, the payload may spell its fields either way.
WORK_ORDER = JobSpec(
    process="proc_f_workorderevent",
    source=MESSAGES,
    types=("DigiOSS - WorkOrderEvent",),
    versions=("1",),
    target="cl_f_workorderevent_mt",
    columns=(
        *lead(),
        value("eventid", "eventId"),
        value("eventsource", "eventSource"),
        value("eventstream", "eventStream"),
        zulu("eventdatetime", "eventDateTime"),
        value("eventtype", "eventType"),
        empty("eventmetadata"),
        value("eventversion", "eventVersion"),
        value("externalreference", "eventPayload.externalReference"),
        value("workorderid", "eventPayload.workOrderId"),
        value("workordertype", "eventPayload.workOrderType"),
        value("taskresolutioncode", "eventPayload.taskResolutionCode"),
        value("taskresolutionstatus", "eventPayload.taskResolutionStatus"),
        value("taskresolutioncomment", "eventPayload.taskResolutionComment"),
        value("klsid", "eventPayload.klsId"),
        value("cplid", "eventPayload.cplId"),
        value("ciobid", "eventPayload.cioBid"),
        zulu(
            "completiondate",
            "eventPayload.completionDate"),
        value("explorationprotocolbid", "eventPayload.explorationProtocolBid"),
        value("buildupdecision", "eventPayload.buildUpDecision"),
        zulu(
            "posignaturetimestamp",
            "eventPayload.poSignatureTimestamp"),
        value("numberaccommodationunits", "eventPayload.numberAccommodationUnits"),
        value("numberbusinessunits", "eventPayload.numberBusinessUnits"),
        value("homeid", "eventPayload.homeId"),
        *audit(),
    ),
)
