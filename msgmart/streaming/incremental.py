"""An incremental job that follows a growing message folder.

The same specification runs over the files that arrived since the last call. The checkpoint of
the query takes the place of the mark: it remembers files, not stamps, so that a message is taken
whenever it arrives, however old its stamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import timeparse
from ..operators import increments
from ..plans.runner import Options, Runner
from ..plans.spec import JobSpec
from ..sources.envelope import ENVELOPE
from ..sources.tables import Tables


def _just_before(batch: DataFrame) -> str:
    """A stamp one second older than the oldest of the batch; empty if that is no time."""
    oldest = timeparse.stamp14(F.min("acl_dop")) - F.expr("INTERVAL 1 SECOND")
    return batch.agg(F.date_format(oldest, timeparse.STAMP14).alias("low")).first()["low"] or ""


def follow(
    spark: SparkSession,
    folder: str,
    spec: JobSpec,
    core: Tables,
    checkpoint: str,
    options: Options | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start a query that takes all files not seen yet, in batches, and then stops.

    ``checkpoint`` is a folder that survives the session. A batch that was cut off is repeated
    by the next query with the same files; what it had written already is left out then.
    """
    if spec.full_recompute:
        raise ValueError(f"{spec.process} recomputes its target and cannot follow a folder")
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    messages = spec.messages(reader.parquet(folder))

    def take(batch: DataFrame, number: int) -> None:
        tables = core.on(batch.sparkSession)
        runner = Runner(tables, tables, options)
        token = f"batch {number}"
        key = runner.key(spec)
        found = increments.measure(batch, key=key)
        runner.log_start(spec, found, None)
        written: tuple[str, ...] = ()
        if found.rows:
            again = runner.control.begun(spec.process, token)
            resume_from = _just_before(batch) if again else None
            runner.control.begin(spec.process, token)
            schema, seen = runner.schema(spec, batch, batch)
            ids = increments.per_id(batch, key or "acl_id", "acl_dop")
            repeated = increments.repeated_of(ids, key) if found.repeated else None
            written = runner.write(spec, batch, schema, seen, repeated, resume_from, most=found.most)
            runner.control.finish(spec.process)
        runner.log_end(spec, written)

    return (
        messages.writeStream.queryName(spec.process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )
