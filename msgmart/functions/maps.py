"""Maps from columns, and rows from maps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_of(entries: Mapping[str, Column]) -> Column:
    """Map with literal keys and column values."""
    return F.create_map(*[part for key, value in entries.items() for part in (F.lit(key), value)])


def map_of_matching(df: DataFrame, needle: str) -> Column:
    """Map from the name to the value of every column whose name contains ``needle``."""
    return map_of({name: F.col(f"`{name}`") for name in df.columns if needle in name})


def map_rows(df: DataFrame, keep: Iterable[str], map_column: str) -> DataFrame:
    """One row ``(*keep, key, value)`` per map entry."""
    return df.select(*keep, F.explode(map_column).alias("key", "value"))
