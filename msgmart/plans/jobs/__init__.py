"""The jobs, and the order in which a daily run executes them.

Message types, versions, process and table names, payload fields, attribute names and target
columns are fixed values: messages and existing tables prescribe them.
"""

from __future__ import annotations

from ..spec import JobSpec
from .areas import FIBER_ON_LOCATION, NVT_AREA, VVM_AREA
from .availability import AVAILABILITY_V1, AVAILABILITY_V2
from .events import INSTALLATION_ORDER, KLS_EVENT, WORK_ORDER
from .presales import LATEST_PRESALES, PRESALES, PRESALES_NEW_LAYOUT
from .service_order import SERVICE_ORDER

DAILY: tuple[JobSpec, ...] = (
    LATEST_PRESALES,
    VVM_AREA,
    AVAILABILITY_V1,
    AVAILABILITY_V2,
    SERVICE_ORDER,
    INSTALLATION_ORDER,
    NVT_AREA,
    KLS_EVENT,
    FIBER_ON_LOCATION,
    WORK_ORDER,
    PRESALES,
)

__all__ = [
    "AVAILABILITY_V1",
    "AVAILABILITY_V2",
    "DAILY",
    "FIBER_ON_LOCATION",
    "INSTALLATION_ORDER",
    "KLS_EVENT",
    "LATEST_PRESALES",
    "NVT_AREA",
    "PRESALES",
    "PRESALES_NEW_LAYOUT",
    "SERVICE_ORDER",
    "VVM_AREA",
    "WORK_ORDER",
]
