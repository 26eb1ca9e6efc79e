"""Joins of many rows to few groups, one of which may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A group with more than 1/SHARE of all rows is hot. There can't be SHARE such groups, so their list is small whatever the input.
SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """`rows` joined ("inner" or "left") with `groups`, one row per key whose column `size` counts its rows.

    Hot groups, fewer than SHARE of them, are sent to the rows; all others are joined by a
    shuffle in which no key has more than 1/SHARE of the rows. `total`: an upper bound or the
    number of rows.
    """
    hot = F.broadcast(groups.where(F.col(size) * SHARE > F.lit(total)))
    cold = groups.where(F.col(size) * SHARE <= F.lit(total))
    there = rows.join(hot, keys, "inner")
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys, how)
    return there.unionByName(rest)
