"""The two control tables: high-water marks and the run log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparse import run_time, run_time_text
from ..sources.tables import Tables

# Names of the control tables and of the workflow.
TRACKING = "cl_m_process_tracking_mt"
LOG = "cl_m_process_log_mt"
WORKFLOW = "al2cl"

TRACKING_COLUMNS = (
    "table_name string, max_tracking_value string, col_name string, bdmp_loadstamp string, "
    "bdmp_id string, bdmp_area_id string, etl_process_name string"
)
LOG_COLUMNS = (
    "workflow string, process string, log_type string, log_time timestamp, "
    "log_entry string, log_entry2 string, log_entry3 string"
)
# One row per process: where its latest increment starts.
STATE = "process_state"
STATE_COLUMNS = "token string, since timestamp, etl_process_name string"

# Log texts that readers of the log expect.
STARTED = "logic of process started"
ENDED = "end of process"


@dataclass(frozen=True)
class Mark:
    value: str | None
    column: str = ""


def mark_of(tracking: DataFrame, process: str, table: str) -> Mark:
    """The greatest mark of a process on a table, by value, then by column name."""
    row = (
        tracking.filter((F.col("etl_process_name") == process) & (F.col("table_name") == table))
        .agg(F.max(F.struct("max_tracking_value", "col_name")).alias("top"))
        .first()
    )
    top = row["top"]
    return Mark(top["max_tracking_value"], top["col_name"]) if top else Mark(None)


def marks(tracking: DataFrame) -> DataFrame:
    """The greatest mark of every process and table."""
    best = F.max(F.struct("max_tracking_value", "col_name")).alias("top")
    return tracking.groupBy("etl_process_name", "table_name").agg(best).select(
        "etl_process_name", "table_name", "top.max_tracking_value", "top.col_name"
    )


def one_row(spark: SparkSession, **values: str | Column) -> DataFrame:
    """A single row of text literals or given columns, made without leaving the JVM."""
    columns = [
        (value if isinstance(value, Column) else F.lit(value)).alias(name)
        for name, value in values.items()
    ]
    return spark.range(0, 1, 1, numPartitions=1).select(*columns)


def mark_row(
    spark: SparkSession, process: str, table: str, value: str, column: str = "acl_dop"
) -> DataFrame:
    return one_row(
        spark,
        table_name=table,
        max_tracking_value=value,
        col_name=column,
        bdmp_loadstamp=run_time_text(),
        bdmp_id="",
        bdmp_area_id="",
        etl_process_name=process,
    )


class Control:
    """Marks and log kept in ``tables``."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.spark = tables.spark

    def mark(self, process: str, table: str) -> Mark:
        tracking = self.tables.find(TRACKING, TRACKING_COLUMNS)
        return Mark(None) if tracking is None else mark_of(tracking, process, table)

    def advance(self, process: str, table: str, value: str | None, column: str = "acl_dop") -> bool:
        """Replace the partition of the process by one new row; nothing to do without a value."""
        if not value:
            return False
        row = mark_row(self.spark, process, table, value, column)
        self.tables.replace_partitions(row, TRACKING, ["etl_process_name"])
        return True

    def log(
        self, process: str, entry: str, entry2: str = "", entry3: str = "", kind: str = "INFO"
    ) -> bool:
        """Append one log row; an empty entry writes nothing."""
        if not entry:
            return False
        row = one_row(
            self.spark,
            workflow=WORKFLOW,
            process=process,
            log_type=kind,
            log_time=run_time(),
            log_entry=entry,
            log_entry2=entry2,
            log_entry3=entry3,
        )
        self.tables.append(row, LOG)
        return True

    def begin(self, process: str, token: str) -> None:
        """Note that the writes of an increment begin; ``token`` names where it starts."""
        row = one_row(self.spark, token=token, since=run_time(), etl_process_name=process)
        self.tables.replace_partitions(row, STATE, ["etl_process_name"])

    def finish(self, process: str) -> None:
        """Note that the writes of the process have ended."""
        self.begin(process, "-")

    def begun(self, process: str, token: str) -> bool:
        """Whether writes from this start have begun and not ended."""
        state = self.tables.find(STATE, STATE_COLUMNS)
        if state is None:
            return False
        mine = state.filter((F.col("etl_process_name") == process) & (F.col("token") == token))
        return mine.select(F.lit(1)).first() is not None
