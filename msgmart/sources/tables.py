"""Reading and writing tables, in a catalog database or as parquet folders below a root."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import setting


def aligned(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns by name in the order and types of ``schema``; missing ones are null.

    A column the target does not have is an error rather than silently lost.
    """
    have = {c.lower(): c for c in df.columns}
    unknown = set(have) - {f.name.lower() for f in schema.fields}
    if unknown:
        raise ValueError(f"columns unknown to the target: {sorted(unknown)}")
    columns = []
    for f in schema.fields:
        source = have.get(f.name.lower())
        column = F.col(f"`{source}`") if source else F.lit(None)
        columns.append(column.cast(f.dataType).alias(f.name))
    return df.select(*columns)


class Tables:
    """Tables by name. Exactly one of ``database`` and ``root`` is given."""

    def __init__(self, spark: SparkSession, database: str | None = None, root: str | None = None):
        if (database is None) == (root is None):
            raise ValueError("give either a database or a root folder")
        self.spark = spark
        self.database = database
        self.root = root.rstrip("/") if root else None

    def on(self, spark: SparkSession) -> Tables:
        """The same tables through another session, such as that of a micro-batch."""
        return Tables(spark, self.database, self.root)

    def full_name(self, name: str) -> str:
        return f"`{self.database}`.`{name}`" if self.database else f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return self.find(name, "any string") is not None

    def find(self, name: str, schema: str | None = None) -> DataFrame | None:
        """The table, or nothing if it is not there.

        A known ``schema`` saves looking into the files of a folder.
        """
        if self.database:
            there = self.spark.catalog.tableExists(f"{self.database}.{name}")
            return self.read(name) if there else None
        try:
            return self.read(name, schema)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        if self.database:
            return self.spark.table(self.full_name(name))
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(self.full_name(name))

    def sql(self, name: str, template: str = "SELECT * FROM {table}") -> DataFrame:
        """A SQL statement over one table, which it names ``{table}``."""
        return self.spark.sql(template, table=self.read(name))

    def append(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
        target = self.find(name)
        if target is not None:
            df = aligned(df, target.schema)
        self._save(df.write.mode("append").partitionBy(*partition_by), name)

    def overwrite(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
        self._save(df.write.mode("overwrite").partitionBy(*partition_by), name)

    def replace_partitions(self, df: DataFrame, name: str, partition_by: Sequence[str]) -> None:
        """Overwrite only the partitions that occur in ``df``."""
        target = self.find(name)
        if target is None:
            self._save(df.write.mode("append").partitionBy(*partition_by), name)
            return
        df = aligned(df, target.schema)
        if self.database:
            with setting(self.spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                df.write.insertInto(self.full_name(name), overwrite=True)
            return
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        self._save(writer.partitionBy(*partition_by), name)

    def insert(self, df: DataFrame, name: str, overwrite: bool = False) -> None:
        """Insert into an existing catalog table. The insert goes by position, so columns are
        first put into the order of the table by name."""
        if not self.database:
            raise ValueError("inserts need a catalog table")
        df = aligned(df, self.read(name).schema)
        df.write.insertInto(self.full_name(name), overwrite=overwrite)

    def count(self, name: str) -> int:
        return self.read(name).agg(F.count(F.lit(1)).alias("n")).first()["n"]

    def _save(self, writer, name: str) -> None:
        if self.database:
            writer.format("parquet").saveAsTable(self.full_name(name))
        else:
            writer.parquet(self.full_name(name))
