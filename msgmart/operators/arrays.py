"""Arrays inside a message: child rows, the matching element, name/value pairs as columns.

The last two exist in several forms. ``how="array"`` works inside the row and moves no data.
``how="join"`` gives what joining the elements back to the messages by id would: elements of
messages that share an id meet every message with that id. The wanted elements of an id are united
first, with one aggregate and one join for all attributes; what follows works inside the row again.
An id of more than ``BLOCK`` messages isn't united: its messages and its elements meet in blocks (see
:mod:`msgmart.operators.meeting`); one look at the ids tells whether there are such.
``how="few"`` is the join where that is known not to be so.
``how="none"`` is what it gives for messages without an id. All give the same rows as long as ids are
unique; :func:`msgmart.operators.increments.measure` tells.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .meeting import BLOCK, any_busy, met, of_busy, of_few, salted, sizes_of_busy
from .ranks import free_name

ELEMENT = "element"
FORMS = ("array", "join", "few", "none")


def exploded(parents: DataFrame, array: Column | str, keep: Sequence[str]) -> DataFrame:
    """One row per array element, named ``element``; a null or empty array gives none.

    A plain ``explode`` makes the optimizer add a filter on the array's size below it, and that
    filter would parse the payload a second time. Dropping the rows without a position has the
    same result with one parse.
    """
    frame = parents.select(*keep, F.posexplode_outer(array).alias("position", ELEMENT))
    return frame.filter(F.col("position").isNotNull()).drop("position")


def child_rows(
    parents: DataFrame, array: Column | str, keep: Sequence[str], fields: Sequence[Column]
) -> DataFrame:
    """Child rows: columns of the parent and ``fields``, columns over ``element``."""
    return exploded(parents, array, keep).select(*keep, *fields)


def united(parents: DataFrame, key: str, array: str, test: Callable[[Column], Column]) -> DataFrame:
    """Every message with the wanted elements of all messages that share its id; none without an id."""
    named = parents.where(F.col(key).isNotNull())
    wanted = named.select(F.col(key).alias("of_id"), F.filter(F.col(array), _matching(test)).alias("wanted"))
    wanted = wanted.where(F.size("wanted") > 0).groupBy("of_id").agg(F.flatten(F.collect_list("wanted")).alias("wanted"))
    both = named.join(wanted, F.col(key) == F.col("of_id"), "left")
    rest = [F.col("wanted").alias(c) if c == array else F.col(f"`{c}`") for c in parents.columns]
    return both.select(*rest).unionByName(emptied(parents.where(F.col(key).isNull()), array))


def emptied(parents: DataFrame, array: str) -> DataFrame:
    """Every message without its elements, inside the row."""
    return parents.withColumn(array, F.lit(None).cast(parents.schema[array].dataType))


def _matching(test: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda element: test(element)


def matching_child(
    parents: DataFrame,
    key: str,
    array: str,
    test: Callable[[Column], Column],
    fields: Mapping[str, Callable[[Column], Column]],
    how: str = "array",
    block: int = BLOCK,
) -> DataFrame:
    """Every parent with the fields of its matching elements, or nulls where none matches.

    Several matches multiply the parent. The array column is dropped.
    """
    rest = [c for c in parents.columns if c != array]
    _check(how)

    def inside(frame: DataFrame) -> DataFrame:
        hits = F.filter(F.col(array), _matching(test))
        return shaped(frame.select(*rest, F.explode_outer(hits).alias(ELEMENT)))

    def shaped(frame: DataFrame) -> DataFrame:
        return frame.select(*rest, *[get(F.col(ELEMENT)).alias(name) for name, get in fields.items()])

    def blocks() -> DataFrame:
        found = F.filter(F.col(array), _matching(test))
        salt = free_name("salt", parents.columns)
        sizes, spread = sizes_of_busy(parents, key, block, [found]), salted(parents, salt)
        elements = of_busy(_elements(spread, key, found, ELEMENT, salt), key, sizes)
        rows = of_busy(spread.select(*rest, salt), key, sizes)
        return shaped(met(rows, elements, key, salt, F.col("n"), F.col("n0"), ELEMENT, block))

    if how == "join" and any_busy(parents, key, block):
        few = inside(united(of_few(parents, key, block), key, array, test))
        return few.unionByName(blocks())
    if how in ("join", "few"):
        parents = united(parents, key, array, test)
    if how == "none":
        parents = emptied(parents, array)
    return inside(parents)


def attributes(
    parents: DataFrame,
    key: str,
    array: str,
    wanted: Mapping[str, str],
    convert: Mapping[str, Callable[[Column], Column]] | None = None,
    how: str = "array",
    block: int = BLOCK,
) -> DataFrame:
    """Name/value pairs of an array as columns, ``{column: attribute name}``.

    A missing attribute is null; a repeated one multiplies the row. The array column is dropped.
    """
    convert = convert or {}
    rest = [c for c in parents.columns if c != array]
    names = list(wanted.values())
    _check(how)

    def shaped(column: str, value: Column) -> Column:
        return convert[column](value) if column in convert else value

    def any_wanted(element: Column) -> Column:
        return element["name"].isin(names)

    def inside(frame: DataFrame) -> DataFrame:
        hits = [F.filter(F.col(array), _matching(_named(name))).alias(f"hits_{column}") for column, name in wanted.items()]
        frame = frame.select(*rest, *hits)
        done = list(rest)
        waiting = [f"hits_{column}" for column in wanted]
        for column in wanted:
            hit = waiting.pop(0)
            frame = frame.select(*done, *waiting, F.explode_outer(hit).alias(ELEMENT)).select(
                *done, *waiting, shaped(column, F.col(ELEMENT)["value"]).alias(column)
            )
            done.append(column)
        return frame.select(*rest, *wanted)

    def blocks() -> DataFrame:
        """One join after the other; how many rows an id has before each follows from its counts."""
        hits = [F.filter(F.col(array), _matching(_named(name))) for name in names]
        salt = free_name("salt", parents.columns)
        sizes, spread = sizes_of_busy(parents, key, block, hits), salted(parents, salt)
        frame, n_rows = of_busy(spread.select(*rest, salt), key, sizes), F.col("n")
        for i, (column, found) in enumerate(zip(wanted, hits, strict=True)):
            elements = of_busy(_elements(spread, key, found, ELEMENT, salt), key, sizes)
            frame = met(frame, elements, key, salt, n_rows, F.col(f"n{i}"), ELEMENT, block)
            frame = frame.withColumn(column, shaped(column, F.col(ELEMENT)["value"])).drop(ELEMENT)
            n_rows = n_rows * F.greatest(F.col(f"n{i}"), F.lit(1))
        return frame.select(*rest, *wanted)

    if how == "join" and any_busy(parents, key, block):
        few = inside(united(of_few(parents, key, block), key, array, any_wanted))
        return few.unionByName(blocks())
    if how in ("join", "few"):
        parents = united(parents, key, array, any_wanted)
    if how == "none":
        parents = emptied(parents, array)
    return inside(parents)


def _check(how: str) -> None:
    if how not in FORMS:
        raise ValueError(f"unknown form {how!r}")


def _elements(frame: DataFrame, key: str, hits: Column, name: str, salt: str) -> DataFrame:
    """Elements as rows, each with a salt of its own."""
    each = frame.select(key, F.posexplode(hits).alias("at", name), salt)
    return each.select(key, name, F.xxhash64(salt, "at").alias(salt))


def _named(name: str) -> Callable[[Column], Column]:
    return lambda element: element["name"] == F.lit(name)
