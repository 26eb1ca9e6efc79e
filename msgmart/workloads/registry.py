"""Register of queries: a name, a function ``(spark, folder) -> DataFrame``, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, TimestampNTZType, TimestampType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def in_utc(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, folder)

        QUERIES[name] = in_utc
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def time_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS")


def as_text(frame: DataFrame) -> DataFrame:
    """Every column as text: times with milliseconds, nested values as JSON."""
    columns = []
    for f in frame.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            column = time_text(column)
        elif isinstance(f.dataType, (StructType, ArrayType, MapType)):
            column = F.to_json(column)
        columns.append(column.cast("string").alias(f.name))
    return frame.select(*columns)
