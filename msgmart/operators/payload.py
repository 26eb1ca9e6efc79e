"""Parsing the payload column and reading paths from it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from ..sources.schema import ORIGINAL_NAME, distinct_names, merge_types, respelled, steps

PARSED = "json_data"


@dataclass(frozen=True)
class Payload:
    """A parsed payload column with its schema; ``inferred`` tells where the schema came from.

    ``seen`` is the schema of the data, where a declared schema took its spellings from it.
    """

    schema: DataType
    root: Column
    text: Column
    inferred: bool = False
    seen: DataType | None = None

    def find(self, path: str) -> list[tuple[Column, DataType]]:
        """All columns the path names. Field names match without case, array heads give null."""
        found: list[tuple[Column, DataType]] = [(self.root, self.schema)]
        for name, index in steps(path):
            deeper = []
            for column, kind in found:
                for f in kind.fields if isinstance(kind, StructType) else ():
                    original = f.metadata.get(ORIGINAL_NAME, f.name)
                    if original.lower() != name.lower():
                        continue
                    child, child_type = column.getField(f.name), f.dataType
                    if index is not None:
                        if not isinstance(child_type, ArrayType):
                            continue
                        child, child_type = F.get(child, F.lit(index)), child_type.elementType
                    deeper.append((child, child_type))
            found = deeper
        return found

    def value(self, *paths: str, ddl: str = "string") -> Column:
        """First non-null of the paths; a path the schema does not know is a null of type ``ddl``."""
        found = [hit for path in paths for hit in self.find(path)]
        if not found:
            return F.lit(None).cast(ddl)
        if len({kind.simpleString() for _, kind in found}) > 1:
            found = [(column.cast("string"), kind) for column, kind in found]
        columns = [column for column, _ in found]
        return columns[0] if len(columns) == 1 else F.coalesce(*columns)

    def element(self, column: Column, array_path: str, ddl: str | None = None) -> Payload:
        """The payload of one exploded element of the array at ``array_path``.

        Where the schema knows the array as text only, or not at all, elements are JSON texts, of
        which the fields in ``ddl``, the type of the array, are parsed.
        """
        found = self.find(array_path)
        kind = found[0][1] if found else None
        if isinstance(kind, ArrayType):
            return Payload(kind.elementType, column, self.text, self.inferred)
        if ddl is None:
            return Payload(StructType([]), column, self.text, self.inferred)
        kind = distinct_names(self.element_type(array_path, ddl))
        return Payload(kind, column, self.text, self.inferred)

    def element_type(self, array_path: str, ddl: str) -> StructType:
        """The declared element of an array, in the spellings of the data."""
        seen = Payload(self.seen, self.root, self.text).find(array_path) if self.seen else []
        kind = reduce(merge_types, [t for _, t in seen]) if seen else None
        return respelled(DataType.fromDDL(ddl), kind).elementType

    def holds_texts(self, array_path: str) -> bool:
        """Whether the elements of the array are JSON texts still to be parsed."""
        found = self.find(array_path)
        return not (found and isinstance(found[0][1], ArrayType))


def parse(
    messages: DataFrame,
    schema: StructType,
    column: str = "jsonstruct",
    inferred: bool = False,
    seen: StructType | None = None,
) -> tuple[DataFrame, Payload]:
    """Add the struct column ``json_data``. Text that is no valid JSON gives nulls in all fields."""
    if not schema.fields:
        raise ValueError("the payload schema has no fields")
    frame = messages.withColumn(PARSED, parsed_text(F.col(column), schema))
    return frame, Payload(distinct_names(schema), F.col(PARSED), F.col(column), inferred, seen)


def parsed_text(text: Column, schema: StructType) -> Column:
    """JSON text as a struct whose field names differ by more than case."""
    unique = distinct_names(schema)
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE"})
    return parsed.cast(unique) if unique.simpleString() != schema.simpleString() else parsed


def star(messages: DataFrame, schema: StructType, column: str = "jsonstruct") -> DataFrame:
    """Every top-level field of the payload as a column."""
    frame, _ = parse(messages, schema, column)
    return frame.select(f"{PARSED}.*")


def malformed(messages: DataFrame, column: str = "jsonstruct") -> DataFrame:
    """Messages whose text is not valid JSON."""
    return messages.filter(F.col(column).isNotNull() & F.try_parse_json(F.col(column)).isNull())
