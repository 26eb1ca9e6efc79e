"""Child rows gathered into one ordered array per key, the inverse of `arrays.child_rows`.

Rows are dealt by their key once, with the columns that the order and the element are made of and not yet
the element, and gathered where they are. A key with more than `MANY` children is left out of that: these
are dealt by ranges of (key, order), so that it is sorted by many tasks, each a section. Sections are in
order among each other; the last step only appends them. The array itself is one value and has to fit in a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import passing
from .ranks import dealt, free_name

#: Children of a key that one task sorts.
MANY = 1000


def nest(
    children: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    element: Column,
    name: str,
    folder: str,
    partitions: int | None = None,
) -> DataFrame:
    """One row per key, with `name`: the `element` of all its children, ascending by `order`, nulls first.

    Repeated children stay. Children equal in `order` are ordered by the element. Null keys are a
    group of their own; no children give no rows. `folder` is new and shared by all executors; it is
    written, and the returned frame reads it, where a key has more than `MANY` children.
    """
    quoted = [F.col(f"`{k}`") for k in keys]
    at, value = free_name("at", keys), free_name("value", keys)
    sorting = F.struct(*[F.col(f"`{o}`").alias(f"o{i}") for i, o in enumerate(order)]).alias(at)
    gathered = F.array_sort(F.collect_list(F.struct(at, value)))

    def whole(rows: DataFrame) -> DataFrame:
        # dealt without the columns that neither the order nor the element needs
        dealt_rows = rows.repartition(*([] if partitions is None else [partitions]), *quoted)
        return dealt_rows.select(*quoted, sorting, element.alias(value)).groupBy(*quoted).agg(gathered[value].alias(name))

    def sections(rows: DataFrame) -> DataFrame:
        spread, part = dealt(rows.select(*quoted, sorting, element.alias(value)), keys, [F.col(at)], folder, partitions)
        section = spread.groupBy(*quoted, part).agg(gathered.alias(value))
        one = F.struct(F.col(part), F.col(f"{value}.{value}").alias(value))
        return section.groupBy(*quoted).agg(F.flatten(F.array_sort(F.collect_list(one))[value]).alias(name))

    n = free_name("n", keys)
    busy = children.groupBy(*quoted).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > MANY)
    with passing(children.sparkSession):
        few = busy.isEmpty()
    if few:
        return whole(children)
    same = reduce(lambda a, b: a & b, [F.col(f"child.`{k}`").eqNullSafe(F.col(f"busy.`{k}`")) for k in keys])
    split = lambda how: children.alias("child").join(busy.alias("busy"), same, how)
    return whole(split("left_anti")).unionByName(sections(split("left_semi")))
