"""What is new since the last run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Increment:
    """Number of new messages and their greatest stamp, null when there are none.

    ``repeated`` is the number of ids that occur more than once and ``most`` how often the most
    frequent of them does, null where that was not asked for.
    """

    rows: int
    high: str | None
    repeated: int | None = None
    most: int | None = None


def per_id(messages: DataFrame, key: str, tracked: str) -> DataFrame:
    """Count and greatest stamp of every id. Each task counts its own rows first, so that only
    ids with their counts are shuffled."""
    return messages.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(tracked).alias("high"))


def _is_repeated(key: str) -> Column:
    """A missing id counts as repeated: a join never finds it."""
    return (F.col("n") > 1) | F.col(key).isNull()


def measure(messages: DataFrame, tracked: str = "acl_dop", key: str | None = None) -> Increment:
    """Count and greatest stamp in one aggregate that reads no payload.

    With ``key`` the same scan also counts the repeated ids.
    """
    if key is None:
        row = messages.agg(F.count(F.lit(1)).alias("n"), F.max(tracked).alias("high")).first()
        return Increment(row["n"], row["high"])
    return measure_ids(per_id(messages, key, tracked), key)


def measure_ids(ids: DataFrame, key: str) -> Increment:
    """The same from the ids already counted by :func:`per_id`."""
    row = ids.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.max("high").alias("high"),
        F.count_if(_is_repeated(key)).alias("repeated"),
        F.max(F.when(F.col(key).isNotNull(), F.col("n"))).alias("most"),
    ).first()
    return Increment(row["n"], row["high"], row["repeated"], row["most"])


def repeated_of(ids: DataFrame, key: str) -> DataFrame:
    """The ids counted more than once, as a column ``repeated_id``."""
    return ids.filter(_is_repeated(key)).select(F.col(key).alias("repeated_id"))


def repeated_ids(messages: DataFrame, key: str, tracked: str = "acl_dop") -> DataFrame:
    """The ids that occur more than once."""
    return repeated_of(per_id(messages, key, tracked), key).withColumnRenamed("repeated_id", key)


def measure_many(
    messages: DataFrame, tests: Mapping[str, Column], tracked: str = "acl_dop"
) -> dict[str, Increment]:
    """The same for several jobs in one scan, ``{name: filter}``."""
    if not tests:
        return {}
    names = list(tests)
    some = tests[names[0]]
    for name in names[1:]:
        some = some | tests[name]
    aggregates = []
    for i, name in enumerate(names):
        aggregates.append(F.count_if(tests[name]).alias(f"n{i}"))
        aggregates.append(F.max(F.when(tests[name], F.col(tracked))).alias(f"high{i}"))
    row = messages.filter(some).agg(*aggregates).first()
    return {name: Increment(row[f"n{i}"], row[f"high{i}"]) for i, name in enumerate(names)}
