"""Planning areas and fibre locations: flat payloads with epoch dates."""

from __future__ import annotations

from ..columns import audit, empty, epoch, value, values
from ..spec import JobSpec
from .common import MESSAGES, lead

VVM_AREA = JobSpec(
    process="proc_f_vvmarea",
    source=MESSAGES,
    types=("DigiOSS - vvmArea",),
    versions=("1",),
    target="cl_f_vvmarea_mt",
    columns=(
        *lead(),
        *values("", "number", "name"),
        empty("is_reporting_relevant", "boolean"),
        epoch("creationDate_ISO", "creationDate"),
        epoch("modificationDate_ISO", "modificationDate"),
        value("areaType"),
        epoch("rolloutDate", "rolloutDate"),
        *values("", "areaStatus", "plannedArea"),
        epoch("plannedFrom_ISO", "plannedFrom"),
        epoch("plannedTo_ISO", "plannedTo"),
        value("threshold", "thresholdData.threshold"),
        value("orderscountinvvm", "thresholdData.ordersCountInVVM"),
        value("additionalorderscountinvvm", "thresholdData.additionalOrdersCountInVVM"),
        *audit(),
    ),
)

NVT_AREA = JobSpec(
    process="proc_f_nvtarea",
    source=MESSAGES,
    types=("DigiOSS - NvtArea",),
    versions=("1",),
    target="cl_f_nvtarea_mt",
    columns=(
        *lead(),
        value("nvtareabusinessid", "businessId"),
        value("nvtareaname", "name"),
        value("vvmareanumber", "vvmArea.number"),
        epoch("creationDate_ISO", "creationDate"),
        epoch("modificationDate_ISO", "modificationDate"),
        *values("", "nvtDescriptor", "onkz", "asb", "pti", "subsidiary", "guid"),
        value("nvtKlsId_ps", "nvtKlsId"),
        *audit(),
    ),
)

FIBER_ON_LOCATION = JobSpec(
    process="proc_f_fiberonlocation",
    source=MESSAGES,
    types=("DigiOSS - FibreOnLocation",),
    versions=("1", "2"),
    target="cl_f_fiberonlocation_mt",
    columns=(
        *lead(),
        value("klsid_ps", "klsId"),
        value("vvmareanumber", "vvmArea.number"),
        value("nvtareabusinessid", "nvtArea.businessId"),
        epoch("modificationDate_ISO", "modificationDate"),
        epoch("creationDate_ISO", "creationDate"),
        *values(
            "",
            "controltraceabilitymanual",
            "installationStatus",
            "demandCarrier",
            "areaType",
            "initiative",
            "reasonForNoConstruction",
            "technology",
            "rolloutSponsor",
        ),
        epoch("installationDate_ISO", "installationDate"),
        epoch("plannedInstallationBegin_ISO", "plannedInstallationBegin"),
        epoch("plannedInstallationEnd_ISO", "plannedInstallationEnd"),
        *values("", "we", "ge", "sl"),
        *audit(),
    ),
)
