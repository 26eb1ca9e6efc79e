"""Tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; the warehouse where none is set."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


class Scratch:
    """One run's tables below the shared folder.

    `keep` writes a frame and reads it back, so that a lost executor repeats the reading and not
    the work before it. `drop` deletes a table that no later step reads. What a returned frame
    still reads has to stay; `clear` deletes everything once the caller has written the result.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/msgmart-{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        frame.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.path(name))

    def clear(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
