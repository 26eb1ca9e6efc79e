"""Fixed values shared by the jobs: names of the message tables and leading columns."""

from __future__ import annotations

from ..columns import Out, envelope, load_time

MESSAGES = "al_gigabit_message_mt"
AVAILABILITY_MESSAGES = "al_gigabit_message_fac_mt"


def lead(*, load_number: bool = False, version: bool = True) -> tuple[Out, ...]:
    """Message id and load time, then load number and version where the target has them."""
    out = [envelope("acl_id", "acl_id_int"), load_time()]
    if load_number:
        out.append(envelope("acl_loadnumber", "acl_loadnumber_int"))
    if version:
        out.append(envelope("messageversion"))
    return tuple(out)
