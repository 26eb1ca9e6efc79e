"""The message envelope: its columns, its filters, its renamed form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENVELOPE = (
    "acl_id string, acl_dop string, acl_loadnumber int, messagetype string, messageversion string, "
    "jsonstruct string, bdmp_loadstamp string, bdmp_id string, bdmp_area_id string"
)
AUDIT = ("bdmp_loadstamp", "bdmp_id", "bdmp_area_id")
MONTH = "acl_dop_yyyymm"


def _any_of(column: str, wanted: Sequence[str]) -> Column:
    if len(wanted) == 1:
        return F.col(column) == F.lit(wanted[0])
    return F.col(column).isin(*wanted)


def of_kind(messages: DataFrame, types: Sequence[str], versions: Sequence[str]) -> DataFrame:
    """Messages of the given types and versions. Plain comparisons, so they reach the scan."""
    return messages.filter(_any_of("messagetype", types) & _any_of("messageversion", versions))


def of_ids(messages: DataFrame, ids: Sequence[str]) -> DataFrame:
    return messages.filter(F.col("acl_id").cast("string").isin(*ids))


def before(messages: DataFrame, stamp: str, column: str = "acl_dop") -> DataFrame:
    """Text comparison on the load stamp; fixed width makes text order time order."""
    return messages.filter(F.col(column) < F.lit(stamp))


def between_marks(
    messages: DataFrame,
    low: str | None,
    high: str | None = None,
    column: str = "acl_dop",
    months: bool = False,
) -> DataFrame:
    """Rows with ``low < column <= high``; an open end is not tested.

    ``months`` states that ``acl_dop_yyyymm`` holds the first six digits of each load stamp. The
    same bounds are then repeated on it, so that a table partitioned by month is pruned.
    """
    has_month = months and column == "acl_dop" and MONTH in messages.columns
    if low is not None:
        messages = messages.filter(F.col(column) > F.lit(low))
        if has_month:
            messages = messages.filter(F.col(MONTH).isNull() | (F.col(MONTH) >= F.lit(low[:6])))
    if high is not None:
        messages = messages.filter(F.col(column) <= F.lit(high))
        if has_month:
            messages = messages.filter(F.col(MONTH).isNull() | (F.col(MONTH) <= F.lit(high[:6])))
    return messages
