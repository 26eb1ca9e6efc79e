"""Message lakes derived from the supplied tables, the queries over them and their SQL."""

from . import job_queries, operator_queries, run_queries, table_queries  # noqa: F401
from .registry import QUERIES
from .registry import SQL as ORACLE

__all__ = ["ORACLE", "QUERIES"]
