"""The latest version per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(versions: DataFrame, key: str, newest_first: Sequence[str], rank: str = "rnk") -> DataFrame:
    """Number the versions of every key, newest first; nulls count as oldest."""
    order: list[Column] = [F.col(c).desc() for c in newest_first]
    window = Window.partitionBy(key).orderBy(*order)
    return versions.withColumn(rank, F.row_number().over(window))


def latest_by_rank(
    versions: DataFrame, key: str, newest_first: Sequence[str], rank: str = "rnk"
) -> DataFrame:
    """Rank and keep number one; the planner limits every group before the shuffle."""
    return ranked(versions, key, newest_first, rank).filter(F.col(rank) == F.lit(1))


def latest_by_max(
    versions: DataFrame, key: str, newest_first: Sequence[str], rank: str = "rnk"
) -> DataFrame:
    """The same as one aggregate: each task reduces a key to one row before the shuffle.

    However many versions a key has, at most one row per key and task is moved.
    """
    rest = [c for c in versions.columns if c != key and c not in newest_first]
    best = F.max(F.struct(*newest_first, F.struct(*rest).alias("rest")))
    picked = versions.groupBy(key).agg(best.alias("best"))
    column = {
        key: F.col(key),
        **{c: F.col("best")[c].alias(c) for c in newest_first},
        **{c: F.col("best")["rest"][c].alias(c) for c in rest},
    }
    return picked.select(*[column[c] for c in versions.columns], F.lit(1).alias(rank))
