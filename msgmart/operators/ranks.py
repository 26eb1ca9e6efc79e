"""Ranks and running totals within groups of any size.

A window over a key puts all rows of the key into one task. Here rows are dealt by ranges of (key,
order) instead, so that a key with a third of all rows lies in a third of the tasks. Each part is
numbered by itself; what the earlier parts of a key hold is added afterwards. Only the first key of
a part can have earlier parts, so there are fewer such additions than parts, and they are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How values of a measure join: the aggregate, and the same for two values.
KINDS: dict[str, tuple[Callable[[Column], Column], Callable[[Column, Column], Column]]] = {
    "sum": (F.sum, lambda a, b: a + b),
    "xor": (F.bit_xor, lambda a, b: a.bitwiseXOR(b)),
    "max": (F.max, F.greatest),
}


def free_name(name: str, columns: Sequence[str]) -> str:
    """`name`, with underscores in front until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def dealt(
    frame: DataFrame, keys: Sequence[str], order: Sequence[Column], folder: str, partitions: int | None = None
) -> tuple[DataFrame, str]:
    """The rows dealt by ranges of (keys, order) and written to `folder`, and the name of the
    column with the number of their part.

    They are written because ranges come from a sample: a task that is repeated must find the
    ranges of the first time. Rows equal in keys and order share a part, so a last order column
    that tells rows apart keeps the parts even.
    """
    part = free_name("part", frame.columns)
    count = [] if partitions is None else [partitions]
    ranges = frame.repartitionByRange(*count, *[F.col(f"`{k}`") for k in keys], *order)
    written = ranges.withColumn(part, F.spark_partition_id())
    written.write.option("compression", "zstd").parquet(folder)
    return frame.sparkSession.read.schema(written.schema).parquet(folder), part


def running(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    measures: Mapping[str, tuple[str, Column]],
    folder: str,
    partitions: int | None = None,
) -> DataFrame:
    """`frame` with running values, `{column: (kind, value)}`, of each group up to and with each row.

    ``kind`` is one of `KINDS`; values are never null. Null keys are a group of their own. Rows
    equal in keys and order come in any order. `folder` is new and shared by all executors; the
    returned frame reads it.
    """
    rows, part = dealt(frame, keys, order, folder, partitions)
    quoted = [F.col(f"`{k}`") for k in keys]
    within = Window.partitionBy(part, *quoted).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = rows.groupBy(part, *quoted).agg(*[KINDS[kind][0](value).alias(name) for name, (kind, value) in measures.items()])
    # with no keys there is one row for each part
    before = Window.partitionBy(*(quoted or [F.lit(0)])).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    ahead = {name: free_name(f"ahead_{name}", [*frame.columns, *measures]) for name in measures}
    starts = totals.select(
        F.col(part).alias("at"),
        *[c.alias(f"key{i}") for i, c in enumerate(quoted)],
        *[KINDS[kind][0](name).over(before).alias(ahead[name]) for name, (kind, _) in measures.items()],
    )
    starts = starts.where(F.col(ahead[next(iter(measures))]).isNotNull()).alias("starts")
    numbered_rows = rows.withColumns({name: KINDS[kind][0](value).over(within) for name, (kind, value) in measures.items()}).alias("rows")
    same = [F.col(f"rows.{part}") == F.col("starts.at")]
    same += [F.col(f"rows.`{k}`").eqNullSafe(F.col(f"starts.key{i}")) for i, k in enumerate(keys)]
    both = numbered_rows.join(F.broadcast(starts), reduce(lambda a, b: a & b, same), "left")
    values = []
    for name, (kind, _) in measures.items():
        own, earlier = F.col(f"rows.`{name}`"), F.col(f"starts.{ahead[name]}")
        values.append(F.when(earlier.isNull(), own).otherwise(KINDS[kind][1](earlier, own)).alias(name))
    kept = [c for c in frame.columns if c not in measures]
    return both.select(*[F.col(f"rows.`{c}`") for c in kept], *values)


def numbered(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    folder: str,
    rank: str = "rnk",
    partitions: int | None = None,
) -> DataFrame:
    """`frame` with the place of each row in its group, from 1: row_number for groups of any size."""
    return running(frame, keys, order, {rank: ("sum", F.lit(1).cast("long"))}, folder, partitions)
