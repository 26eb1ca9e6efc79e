"""Payload schemas: inferred from messages, declared by paths, merged, compared, reported."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from ..session import passing, setting

ORIGINAL_NAME = "payload_name"
_QUOTED_OR_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT<")

# The top-level fields that tell the two presales layouts apart.
OLD_LAYOUT_FIELD = "installationAddress"
NEW_LAYOUT_FIELD = "installationLocation"


# -- inference ---------------------------------------------------------------------------------


def infer_schema(messages: DataFrame, column: str = "jsonstruct") -> StructType:
    """Schema of all JSON objects in ``column``, as a parser takes it."""
    return readable(seen_schema(messages, column))


def seen_schema(messages: DataFrame, column: str = "jsonstruct") -> StructType:
    """Schema of all JSON objects in ``column``, in which what was always null or empty stays open.

    A field of type ``void`` merges with any other; :func:`readable` turns what is left into text.

    One distributed aggregate: every task merges the schemas of its rows and only the merged
    schemas are shuffled. Malformed rows and rows that are no object do not take part. Merging is
    done with case, or of two spellings of a field only one would be found.
    """
    text = F.col(column)
    is_object = F.ltrim(text).startswith("{")
    parsed = F.try_parse_json(F.when(is_object, text))
    shapes = messages.select(F.schema_of_variant_agg(parsed).alias("s"))
    with setting(messages.sparkSession, "spark.sql.caseSensitive", "true"), passing(messages.sparkSession):
        merged = shapes.first()["s"]
    if merged is None or not merged.startswith("OBJECT<"):
        return StructType([])
    ddl = _QUOTED_OR_OBJECT.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], merged)
    return _settled(DataType.fromDDL(ddl))


def _settled(kind: DataType) -> DataType:
    """Types as a JSON reader gives them: conflicts are text, fractions are doubles."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _settled(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_settled(kind.elementType))
    if isinstance(kind, VariantType):
        return StringType()
    if isinstance(kind, DecimalType) and kind.scale > 0:
        return DoubleType()
    return kind


def readable(schema: StructType) -> StructType:
    """A schema for the parser: what is still open is text, structs without fields are left out."""
    return _readable(schema) or StructType([])


def _readable(kind: DataType) -> DataType | None:
    if isinstance(kind, StructType):
        fields = [(f.name, _readable(f.dataType)) for f in kind.fields]
        kept = [StructField(name, t) for name, t in fields if t is not None]
        return StructType(kept) if kept else None
    if isinstance(kind, ArrayType):
        element = _readable(kind.elementType)
        return ArrayType(element) if element is not None else None
    return StringType() if isinstance(kind, NullType) else kind


def merge_types(left: DataType, right: DataType) -> DataType:
    """Smallest type that reads values of both; conflicting shapes become text."""
    if left == right or isinstance(right, NullType):
        return left
    if isinstance(left, NullType):
        return right
    if isinstance(left, StructType) and isinstance(right, StructType):
        return merge_schemas(left, right)
    if isinstance(left, ArrayType) and isinstance(right, ArrayType):
        return ArrayType(merge_types(left.elementType, right.elementType))
    numbers = (LongType, DoubleType, DecimalType)
    if isinstance(left, numbers) and isinstance(right, numbers):
        if isinstance(left, DoubleType) or isinstance(right, DoubleType):
            return DoubleType()
        digits = [t.precision if isinstance(t, DecimalType) else 20 for t in (left, right)]
        return DecimalType(max(digits), 0)
    return StringType()


def merge_schemas(left: StructType, right: StructType) -> StructType:
    """Union of the fields of two schemas: a stored one and that of an increment."""
    fields = {f.name: f.dataType for f in left.fields}
    for f in right.fields:
        fields[f.name] = merge_types(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return StructType([StructField(name, fields[name]) for name in sorted(fields)])


# -- paths -------------------------------------------------------------------------------------


def steps(path: str) -> list[tuple[str, int | None]]:
    """``a.b[0].c`` to ``[(a, None), (b, 0), (c, None)]``."""
    out = []
    for part in path.split("."):
        name, bracket, index = part.partition("[")
        out.append((name, int(index[:-1]) if bracket else None))
    return out


def declared_schema(paths: Mapping[str, str]) -> StructType:
    """Schema with exactly the wanted paths, ``{path: ddl type}``.

    The parser skips every field that is not part of it.
    """
    tree: dict = {}
    for path, ddl in paths.items():
        node = tree
        for name, index in steps(path):
            entry = node.setdefault(name, {"array": False, "ddl": None, "fields": {}})
            entry["array"] |= index is not None
            node = entry["fields"]
        entry["ddl"] = ddl
    return _tree_type(tree)


def respelled(kind: DataType, seen: DataType | None) -> DataType:
    """A declared type with every spelling of its field names that the data has; types stay."""
    if isinstance(kind, ArrayType):
        inner = seen.elementType if isinstance(seen, ArrayType) else None
        return ArrayType(respelled(kind.elementType, inner))
    if not isinstance(kind, StructType):
        return kind
    there = seen.fields if isinstance(seen, StructType) else []
    fields: dict[str, StructField] = {}
    for f in kind.fields:
        same = [g for g in there if g.name.lower() == f.name.lower()]
        for name, inner in [(g.name, g.dataType) for g in same] or [(f.name, None)]:
            fields[name] = StructField(name, respelled(f.dataType, inner))
    return StructType(list(fields.values()))


def _tree_type(tree: dict) -> StructType:
    fields = []
    for name, entry in tree.items():
        if entry["fields"]:
            kind: DataType = _tree_type(entry["fields"])
        else:
            kind = DataType.fromDDL(entry["ddl"])
        fields.append(StructField(name, ArrayType(kind) if entry["array"] else kind))
    return StructType(fields)


def pruned(schema: StructType, paths: Iterable[str]) -> StructType:
    """The part of an inferred schema that the paths reach; names match without case."""
    wanted: dict = {}
    for path in paths:
        node = wanted
        for name, _ in steps(path):
            node = node.setdefault(name.lower(), {})
        node[""] = {}
    return _prune(schema, wanted)


def _prune(kind: DataType, wanted: dict) -> DataType:
    if "" in wanted:
        return kind
    if isinstance(kind, ArrayType):
        return ArrayType(_prune(kind.elementType, wanted))
    if isinstance(kind, StructType):
        return StructType(
            [
                StructField(f.name, _prune(f.dataType, wanted[f.name.lower()]))
                for f in kind.fields
                if f.name.lower() in wanted
            ]
        )
    return kind


def distinct_names(kind: DataType) -> DataType:
    """Rename fields that differ only by case; the original name goes to the field's metadata."""
    if isinstance(kind, ArrayType):
        return ArrayType(distinct_names(kind.elementType))
    if not isinstance(kind, StructType):
        return kind
    used: set[str] = set()
    fields = []
    for f in kind.fields:
        name, number = f.name, 1
        while name.lower() in used:
            name, number = f"{f.name}__{number}", number + 1
        used.add(name.lower())
        fields.append(StructField(name, distinct_names(f.dataType), True, {ORIGINAL_NAME: f.name}))
    return StructType(fields)


# -- reports -----------------------------------------------------------------------------------


def layout_of(field: str) -> str | None:
    """Which of the two layouts a top-level field marks."""
    return {OLD_LAYOUT_FIELD: "old", NEW_LAYOUT_FIELD: "new"}.get(field)


def field_report(spark: SparkSession, schema: StructType) -> DataFrame:
    """Rows ``(field, type, layout)`` for the top level of a schema; its size is that of the schema."""
    rows = [(f.name, f.dataType.simpleString(), layout_of(f.name)) for f in schema.fields]
    return spark.createDataFrame(rows, "field string, type string, layout string")
