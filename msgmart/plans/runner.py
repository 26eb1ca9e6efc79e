"""Running jobs: increment, parse, write, mark, log, in an order that survives a crash."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StructType

from ..functions.timeparse import stamp14
from ..operators import increments
from ..operators.increments import Increment
from ..operators.latest import latest_by_max
from ..sources.envelope import between_marks
from ..sources.schema import merge_schemas, readable, seen_schema
from ..sources.tables import Tables, aligned
from .control import ENDED, STARTED, Control, Mark, one_row
from .spec import JobSpec

SCHEMAS = "payload_schemas"
BUCKET = "key_bucket"
#: Noted in place of a mark while a whole snapshot is written.
WHOLE = "whole"


class MissingMark(RuntimeError):
    """An incremental job has no row in the tracking table."""


@dataclass(frozen=True)
class Result:
    process: str
    rows: int
    low: str | None
    high: str | None
    written: tuple[str, ...]


@dataclass(frozen=True)
class Options:
    """How to run.

    ``schema``   ``declared`` reads the fields the job names, with fixed types and in all spellings
                 the new messages have. ``inferred`` takes names and types from all messages of the
                 type, ``merged`` from the new messages and a stored schema that grows with every run.
    ``how``      form of the array operators: ``array`` inside the row, ``join`` by message id.
                 ``auto`` gives the rows of the join with the work of the array form, except for
                 messages whose id is repeated.
    ``refresh``  ``full`` recomputes a snapshot from all messages, ``merge`` brings the stored
                 snapshot up to date with the new ones. It is then partitioned by ``key_bucket``, a
                 hash of the key, and a run reads and writes the buckets of the new keys only.
    ``buckets``  how many buckets a merged snapshot has.
    ``rebalance`` evens out the sizes of the written files at the price of a shuffle.
    ``months``   the message table has the month of each load stamp as ``acl_dop_yyyymm``.
    """

    schema: str = "declared"
    how: str = "auto"
    refresh: str = "full"
    buckets: int = 64
    rebalance: bool = False
    months: bool = False


class Runner:
    """Runs jobs that read messages from ``source`` and keep results and control tables in ``core``."""

    def __init__(self, source: Tables, core: Tables, options: Options | None = None):
        self.source = source
        self.core = core
        self.control = Control(core)
        self.options = options or Options()
        self.spark = core.spark

    # -- one job ---------------------------------------------------------------------------

    def run(
        self,
        spec: JobSpec,
        upto: str | None = None,
        since: str | None = None,
        measured: Increment | None = None,
    ) -> Result:
        """One run of one job.

        The upper end of the increment is fixed before anything is written: rows that arrive
        meanwhile belong to the next run. The mark moves after all outputs are written. ``upto``
        lowers the upper end, for a caller that wants to leave the youngest stamps to settle.
        ``since`` looks back below the mark for messages that came late: what the targets already
        hold is left out.
        """
        lake = self.source.read(spec.source)
        messages = spec.messages(lake)
        mark = self._mark(spec)
        tracked = mark.column or "acl_dop"
        # A first snapshot that broke off may be there in part: all of it is made anew. A later merge
        # may be repeated: a bucket holds the old rows or the new ones, and both lead to the same.
        whole = self._whole(spec) or (spec.full_recompute and self.control.begun(spec.process, WHOLE))
        low = None if whole else mark.value
        again = low is not None and self.control.begun(spec.process, low)
        if since is not None and low is not None and since < low:
            low, again = since, True

        arrived = between_marks(messages, low, upto, tracked, self.options.months)
        key = self.key(spec)
        with _kept(increments.per_id(arrived, key or "acl_id", tracked), key is not None) as ids:
            if key is not None:
                found = increments.measure_ids(ids, key)
            else:
                found = measured or increments.measure(arrived, tracked)
            self.log_start(spec, found, mark.value)
            if found.rows == 0:
                self.log_end(spec, ())
                return Result(spec.process, 0, low, None, ())
            new = between_marks(messages, low, found.high, tracked, self.options.months)
            schema, seen = self.schema(spec, messages, new)
            if spec.full_recompute:
                self.control.begin(spec.process, WHOLE if whole else mark.value)
                written = self._write_snapshot(spec, new, schema, seen, whole)
            else:
                repeated = increments.repeated_of(ids, key) if found.repeated else None
                self.control.begin(spec.process, mark.value)
                written = self.write(spec, new, schema, seen, repeated, low if again else None, tracked, found.most)
        if mark.value is None or found.high > mark.value:
            self.control.advance(spec.process, spec.source, found.high, tracked)
        self.control.finish(spec.process)
        self.log_end(spec, written)
        return Result(spec.process, found.rows, low, found.high, written)

    def run_all(self, specs: Sequence[JobSpec], upto: str | None = None) -> list[Result]:
        """The jobs in order; the first failure ends the run.

        The increments of the jobs on one message table are measured in one scan of its envelope,
        except where a job needs to know about repeated ids and has to scan them anyway.
        """
        plain = [s for s in specs if not self._whole(s) and self.key(s) is None]
        measured = self._measure_all(plain, upto)
        return [self.run(spec, upto, measured=measured.get(spec.process)) for spec in specs]

    # -- steps -----------------------------------------------------------------------------

    def _whole(self, spec: JobSpec) -> bool:
        """Whether the run reads all messages: a full refresh, or a first merge without a snapshot."""
        if not spec.full_recompute:
            return False
        if self.options.refresh == "full":
            return True
        stored = self.core.find(spec.target)
        if stored is None or BUCKET not in stored.columns:
            return True
        row = stored.select(BUCKET).first()
        return row is None or not row[BUCKET].startswith(f"{self.options.buckets}-")

    def _mark(self, spec: JobSpec) -> Mark:
        mark = self.control.mark(spec.process, spec.source)
        if mark.value is None and not self._whole(spec):
            raise MissingMark(f"no mark for process {spec.process} on table {spec.source}")
        return mark

    def _measure_all(self, specs: Sequence[JobSpec], upto: str | None) -> dict[str, Increment]:
        groups: dict[tuple[str, str], dict[str, F.Column]] = {}
        lows: dict[tuple[str, str], list[str]] = {}
        for spec in specs:
            mark = self._mark(spec)
            tracked = mark.column or "acl_dop"
            test = (
                F.col("messagetype").isin(*spec.types)
                & F.col("messageversion").isin(*spec.versions)
                & (F.col(tracked) > F.lit(mark.value))
            )
            if upto is not None:
                test = test & (F.col(tracked) <= F.lit(upto))
            groups.setdefault((spec.source, tracked), {})[spec.process] = test
            lows.setdefault((spec.source, tracked), []).append(mark.value)
        out: dict[str, Increment] = {}
        for (source, tracked), tests in groups.items():
            recent = between_marks(
                self.source.read(source), min(lows[(source, tracked)]), upto, tracked
            )
            out.update(increments.measure_many(recent, tests, tracked))
        return out

    def schema(
        self, spec: JobSpec, messages: DataFrame, new: DataFrame
    ) -> tuple[StructType | None, StructType | None]:
        """The schema to parse with, none for the declared one, and one to take spellings from."""
        if self.options.schema == "declared":
            return None, spec.seen(new)
        if self.options.schema == "inferred":
            schema = spec.inferred(messages)
        elif self.options.schema == "merged":
            schema = spec.reduced(readable(self._grown_schema(spec, new)))
        else:
            raise ValueError(f"unknown schema option {self.options.schema!r}")
        return (schema if schema.fields else None), None

    def _grown_schema(self, spec: JobSpec, new: DataFrame) -> StructType:
        """Stored schema of the process, widened by the new messages and stored again.

        What was always null or empty so far stays open in it, so that a later value decides.
        """
        schema = seen_schema(new)
        schemas = self.core.find(SCHEMAS, "payload_schema string, etl_process_name string")
        if schemas is not None:
            mine = schemas.filter(F.col("etl_process_name") == spec.process)
            stored = mine.select("payload_schema").first()
            if stored:
                known = StructType.fromJson(json.loads(stored["payload_schema"]))
                schema = merge_schemas(known, schema)
        row = one_row(self.spark, payload_schema=schema.json(), etl_process_name=spec.process)
        self.core.replace_partitions(row, SCHEMAS, ["etl_process_name"])
        return schema

    def key(self, spec: JobSpec) -> str | None:
        """The id whose repetition decides the form of the array operators."""
        return "acl_id" if spec.spread is not None and self.options.how == "auto" else None

    @contextmanager
    def _main(
        self,
        spec: JobSpec,
        new: DataFrame,
        schema: StructType | None,
        seen: StructType | None,
        repeated: DataFrame | None,
        most: int | None = None,
    ) -> Iterator[DataFrame]:
        if repeated is not None:
            main = spec.main_split(new, repeated, schema, seen, most)
        else:
            how = "array" if self.options.how == "auto" else self.options.how
            main = spec.main(new, schema, how, seen)
        with _kept(main, bool(spec.children)) as main:
            yield main

    def _write_snapshot(
        self, spec: JobSpec, new: DataFrame, schema: StructType | None, seen: StructType | None, whole: bool
    ) -> tuple[str, ...]:
        frame = self._typed(spec, spec.main(new, schema, seen=seen))
        if self.options.refresh == "full":
            self.core.overwrite(frame, spec.target)
        elif whole:
            self.core.overwrite(self._bucketed(frame, spec).hint("rebalance", BUCKET), spec.target, [BUCKET])
        else:
            with _kept(self._bucketed(frame, spec)) as fresh:
                merged = self.merged(spec, fresh)
                if merged is not None:
                    self.core.replace_partitions(merged.hint("rebalance", BUCKET), spec.target, [BUCKET])
        return (spec.target,)

    def _bucketed(self, frame: DataFrame, spec: JobSpec) -> DataFrame:
        """With the bucket of the key, after the number of buckets: another number is another layout."""
        bucket = F.pmod(F.xxhash64(F.col(spec.latest.key).cast("string")), F.lit(self.options.buckets))
        return frame.withColumn(BUCKET, F.concat(F.lit(f"{self.options.buckets}-"), bucket.cast("string")))

    def merged(self, spec: JobSpec, fresh: DataFrame) -> DataFrame | None:
        """The new rows of the buckets that occur in `fresh`, nothing if there are none.

        There are `Options.buckets` of them at most. The stored rows are read through a filter on the
        partition column. Buckets are replaced when all of them are written, so the target may be read
        meanwhile.
        """
        touched = sorted(r[BUCKET] for r in fresh.select(BUCKET).distinct().collect())
        if not touched:
            return None
        stored = self.core.read(spec.target)
        both = stored.filter(F.col(BUCKET).isin(touched)).unionByName(aligned(fresh, stored.schema))
        latest_rows = latest_by_max(both.drop("rnk", BUCKET), spec.latest.key, spec.latest.newest_first)
        return self._bucketed(latest_rows, spec).select(*stored.columns)

    def write(
        self,
        spec: JobSpec,
        new: DataFrame,
        schema: StructType | None,
        seen: StructType | None,
        repeated: DataFrame | None,
        resume_from: str | None,
        tracked: str = "acl_dop",
        most: int | None = None,
    ) -> tuple[str, ...]:
        """Append the outputs of new messages: the main target, then its children.

        With ``resume_from`` the targets may hold some of them already, from that stamp on.
        """
        written = []
        with self._main(spec, new, schema, seen, repeated, most) as main:
            frames = {
                spec.target: self._typed(spec, main),
                **spec.children_of(main, schema, seen),
            }
            self.log_ready(spec)
            for table, frame in frames.items():
                if resume_from is not None:
                    frame = self._not_yet_written(frame, table, resume_from, tracked)
                if self.options.rebalance:
                    frame = frame.hint("rebalance")
                self.core.append(frame, table)
                written.append(table)
        return tuple(written)

    @staticmethod
    def _typed(spec: JobSpec, frame: DataFrame) -> DataFrame:
        """Single values declared as text are text also where the data has numbers: a later
        message may hold another kind of value, and the target keeps its first types."""
        texts = {o.name for o in spec.columns if o.needs and all(t == "string" for _, t in o.needs)}
        numbers = {
            f.name for f in frame.schema.fields if isinstance(f.dataType, (NumericType, BooleanType))
        }
        return frame.withColumns({c: F.col(f"`{c}`").cast("string") for c in texts & numbers})

    def _not_yet_written(self, frame: DataFrame, table: str, low: str, tracked: str) -> DataFrame:
        """Leave out rows the table already holds, each as often as it holds them.

        Rows are told apart by all their columns: messages may share ids and stamps, and another
        job may write to the same table. Where stamps are tracked, only rows above the lower
        bound are looked at.
        """
        target = self.core.find(table)
        if target is None:
            return frame
        bound = stamp14(F.lit(low))  # a mark that is no time, such as all zeros, bounds nothing
        if tracked == "acl_dop" and "acl_dop_ISO" in target.columns:
            time = F.col("acl_dop_ISO")
            target = target.filter(time.isNull() | bound.isNull() | (time > bound))
        return aligned(frame, target.schema).exceptAll(target)

    # The log texts are fixed values: readers of the log expect them.

    def log_start(self, spec: JobSpec, found: Increment, mark: str | None) -> None:
        if spec.full_recompute:
            entry = f"all_PSO_records_count={found.rows}"
        else:
            entry = f"current_tracked_value={mark}, max_acl_dop={found.high}, new_records_count={found.rows}"
        self.control.log(spec.process, STARTED, entry, spec.types[0])

    def log_ready(self, spec: JobSpec) -> None:
        """A job with child tables notes that its outputs are ready to be written."""
        if spec.children:
            entry = f"next step insert, table={spec.target} "
            self.control.log(spec.process, "logic() finished", entry, spec.types[0])

    def log_end(self, spec: JobSpec, written: Sequence[str]) -> None:
        """One row for the main target, and one for each child table that was written."""
        how = "overwrite" if spec.full_recompute and written else f"doing_Insert={bool(written)}"
        self.control.log(spec.process, ENDED, f"insert table={spec.target} ,{how}", spec.types[0])
        for number, table in enumerate(written[1:], 2):
            entry = f"end of process-insert {number}."
            self.control.log(spec.process, entry, f"insert table={table} , ", spec.types[0])


@contextmanager
def _kept(frame: DataFrame, keep: bool = True) -> Iterator[DataFrame]:
    """Hold a frame that is used several times, so that it is computed once.

    It stays on the executors' disks: it may be as large as the increment, and a lost block is
    computed again.
    """
    if not keep:
        yield frame
        return
    frame = frame.persist(StorageLevel.DISK_ONLY)
    try:
        yield frame
    finally:
        frame.unpersist()


def copy_table(
    source: DataFrame, build: Callable[[DataFrame], DataFrame], target: Tables, name: str
) -> int:
    """Table to table: project the source and overwrite the target. Gives the rows read.

    An existing catalog table keeps its definition and gets the rows by an insert.
    """
    rows = source.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if target.database and target.exists(name):
        target.insert(build(source), name, overwrite=True)
    else:
        target.overwrite(build(source), name)
    return rows
