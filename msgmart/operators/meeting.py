"""Rows that meet all elements of their id, for ids of any size.

An id with few messages is united: its elements become one array, which its messages take up. An id with
many would make that array, and one task, as large as itself. Its messages are dealt to parts and its
elements to blocks instead; every part meets every block, each pair in a task of its own, and the result streams
out of the join. A part or a block has about `BLOCK` rows, so the copies that are moved are small beside
the result, which has a row for each pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import free_name

#: Messages of an id that are united in one array, and rows of a part or block beyond that.
BLOCK = 1000


def any_busy(parents: DataFrame, key: str, block: int) -> bool:
    """Whether an id has more than `block` messages: one aggregate that reads the ids only."""
    counts = parents.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (counts.agg(F.max("n").alias("most")).first()["most"] or 0) > block


def of_few(parents: DataFrame, key: str, block: int) -> DataFrame:
    """The messages whose id is on no more than `block` of them; each task counts its own rows first."""
    busy = parents.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col(key).isNotNull() & (F.col("n") > block))
    return parents.join(busy.select(F.col(key).alias("busy_id")), F.col(key) == F.col("busy_id"), "left_anti")


def sizes_of_busy(parents: DataFrame, key: str, block: int, hits: Sequence[Column]) -> DataFrame:
    """``busy_id``, ``n`` messages and ``n0``, ``n1``, ... elements of each kind, of ids with more than `block` messages."""
    counted = [F.sum(F.coalesce(F.array_size(h), F.lit(0))).cast("double").alias(f"n{i}") for i, h in enumerate(hits)]
    sizes = parents.groupBy(F.col(key).alias("busy_id")).agg(F.count(F.lit(1)).cast("double").alias("n"), *counted)
    return sizes.where(F.col("busy_id").isNotNull() & (F.col("n") > block))


def of_busy(frame: DataFrame, key: str, sizes: DataFrame) -> DataFrame:
    """The rows of busy ids, with their sizes.

    Joined without a hint: the sizes are sent to every task if they turn out to be small, else
    rows are shuffled and skewed partitions split.
    """
    return frame.join(sizes, F.col(key) == F.col("busy_id")).drop("busy_id")


def salted(frame: DataFrame, salt: str) -> DataFrame:
    """With a number that tells rows apart and is the same if a task is repeated: its place in the scan."""
    return frame.withColumn(salt, F.xxhash64(F.monotonically_increasing_id()))


def met(
    rows: DataFrame, others: DataFrame, key: str, salt: str, n_rows: Column, n_others: Column, add: str, block: int = BLOCK
) -> DataFrame:
    """`rows` left-joined with the column `add` of `others` on `key`; of both, `salt` spreads the rows of a key.

    `n_rows` and `n_others` tell, over columns that both have, how many rows of the key there are. Rows
    get a new salt.
    """
    taken = [*rows.columns, *others.columns]
    part, piece, pieces, other_salt = (free_name(n, taken) for n in ("part", "piece", "pieces", "other_salt"))
    dealt = lambda n: F.greatest(F.ceil(n / F.lit(block)), F.lit(1)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = rows.withColumn(part, F.pmod(F.col(salt), dealt(n_rows)).cast("int")).withColumn(pieces, dealt(n_others)).withColumn(piece, each(F.col(pieces)))
    right = others.select(key, add, F.col(salt).alias(other_salt), F.pmod(F.col(salt), dealt(n_others)).cast("int").alias(piece), each(dealt(n_rows)).alias(part))
    # a row meets each block; where there are several, one of them has an element for it
    pairs = left.join(right, [key, part, piece], "left").where(F.col(other_salt).isNotNull() | (F.col(pieces) == 1))
    pairs = pairs.withColumn(salt, F.when(F.col(other_salt).isNull(), F.col(salt)).otherwise(F.xxhash64(salt, other_salt)))
    return pairs.drop(part, piece, pieces, other_salt)
