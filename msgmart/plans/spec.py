"""What a job is: which messages, which columns, which extra rows, which target."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import arrays, latest, meeting
from ..operators.payload import PARSED, Payload, parse, parsed_text
from ..sources.envelope import of_kind
from ..sources.schema import (
    declared_schema,
    distinct_names,
    infer_schema,
    pruned,
    respelled,
    seen_schema,
)
from .columns import Out


@dataclass(frozen=True)
class Child:
    """A child table: one row per element of the parent's ``array`` column, read from ``path``."""

    target: str
    array: str
    path: str
    ddl: str
    keep: tuple[str, ...]
    columns: tuple[Out, ...]
    keep_if: Callable[[], Column] | None = None


@dataclass(frozen=True)
class Match:
    """Columns from the matching elements of an array."""

    path: str
    element: str
    test: Callable[[Column], Column]
    fields: dict[str, Callable[[Column], Column]]


@dataclass(frozen=True)
class Attributes:
    """Columns from an array of name/value pairs."""

    path: str
    wanted: dict[str, str]
    convert: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    element: str = "struct<name:string,value:string>"


@dataclass(frozen=True)
class Latest:
    """Keep one version per key."""

    key: str
    newest_first: tuple[str, ...]


@dataclass(frozen=True)
class JobSpec:
    process: str
    source: str
    types: tuple[str, ...]
    versions: tuple[str, ...]
    target: str
    columns: tuple[Out, ...]
    extra_paths: tuple[tuple[str, str], ...] = ()
    children: tuple[Child, ...] = ()
    spread: Match | Attributes | None = None
    order: tuple[str, ...] = ()
    latest: Latest | None = None

    @property
    def full_recompute(self) -> bool:
        return self.latest is not None

    def messages(self, lake: DataFrame) -> DataFrame:
        return of_kind(lake, self.types, self.versions)

    def paths(self) -> dict[str, str]:
        """All payload paths the job reads, with the types declared for them."""
        out = {path: ddl for column in self.columns for path, ddl in column.needs}
        out.update(self.extra_paths)
        if self.spread is not None:
            out[self.spread.path] = f"array<{self.spread.element}>"
        return out

    def declared(self, seen: StructType | None = None) -> StructType:
        """The declared schema, in the spellings that ``seen``, a schema of the data, has."""
        return respelled(declared_schema(self.paths()), seen)

    def seen(self, messages: DataFrame) -> StructType:
        """Schema of the messages, to take spellings from: field names match without case."""
        return seen_schema(messages)

    def inferred(self, messages: DataFrame) -> StructType:
        """Schema of the messages, reduced to what the job reads; names and types follow the data."""
        return self.reduced(infer_schema(messages))

    def reduced(self, schema: StructType) -> StructType:
        opens = [path for column in self.columns for path in column.opens]
        return pruned(schema, list(self.paths()) + opens)

    # -- plans -----------------------------------------------------------------------------

    def outputs(
        self,
        messages: DataFrame,
        schema: StructType | None = None,
        how: str = "array",
        seen: StructType | None = None,
    ) -> dict[str, DataFrame]:
        """``{table: frame}``: the main target first, then the children, as lazy plans.

        ``schema=None`` takes the declared one, in the spellings of ``seen``; ``how`` is the form
        of the array operators.
        """
        main = self.main(messages, schema, how, seen)
        return {self.target: main, **self.children_of(main, schema, seen)}

    def main(
        self,
        messages: DataFrame,
        schema: StructType | None = None,
        how: str = "array",
        seen: StructType | None = None,
    ) -> DataFrame:
        """The frame of the main target only."""
        known = schema if schema is not None else self.declared(seen)
        frame, payload = parse(messages, known, inferred=schema is not None, seen=seen)
        return self._main(frame, payload, how)

    def main_split(
        self,
        messages: DataFrame,
        repeated: DataFrame,
        schema: StructType | None = None,
        seen: StructType | None = None,
        most: int | None = None,
    ) -> DataFrame:
        """The main frame where the ids in ``repeated`` (``repeated_id``) occur more than once.

        Only their messages meet each other; all others are worked on inside the row, those
        without an id outside both joins, which would deal them all to one task. ``most``, how
        often the most frequent id occurs, spares a look for ids of very many messages.
        """
        how = "few" if most is not None and most <= meeting.BLOCK else "join"
        same = F.col("acl_id") == F.col("repeated_id")
        named = messages.filter(F.col("acl_id").isNotNull())
        nameless = messages.filter(F.col("acl_id").isNull())
        once = named.join(repeated, same, "left_anti")
        several = named.join(repeated, same, "left_semi")
        return (
            self.main(once, schema, "array", seen)
            .unionByName(self.main(several, schema, how, seen))
            .unionByName(self.main(nameless, schema, "none", seen))
        )

    def children_of(
        self, main: DataFrame, schema: StructType | None = None, seen: StructType | None = None
    ) -> dict[str, DataFrame]:
        """The child frames from an already computed main frame."""
        known = distinct_names(schema if schema is not None else self.declared(seen))
        payload = Payload(known, F.col(PARSED), F.col("jsonstruct"), schema is not None, seen)
        return {child.target: self._child(main, child, payload) for child in self.children}

    def _main(self, frame: DataFrame, payload: Payload, how: str) -> DataFrame:
        # Constants come last: they need not travel through a shuffle.
        early = [out.column(payload) for out in self.columns if not out.constant]
        late = [out.column(payload) for out in self.columns if out.constant]
        if self.spread is not None:
            pairs = _readable_array(payload, self.spread).alias("spread_array")
            main = self._spread(frame.select(*early, pairs), how)
        else:
            main = frame.select(*early)
        if self.latest is not None:
            main = latest.latest_by_max(main, self.latest.key, self.latest.newest_first)
        order = self.order or tuple(out.name for out in self.columns)
        return main.select("*", *late).select(*order)

    def _spread(self, main: DataFrame, how: str) -> DataFrame:
        key = self.columns[0].name
        if isinstance(self.spread, Match):
            return arrays.matching_child(
                main, key, "spread_array", self.spread.test, self.spread.fields, how
            )
        return arrays.attributes(
            main, key, "spread_array", self.spread.wanted, self.spread.convert, how
        )

    def _child(self, main: DataFrame, child: Child, payload: Payload) -> DataFrame:
        inner = payload.element(F.col(arrays.ELEMENT), child.path, child.ddl)
        fields = [out.column(inner) for out in child.columns]
        elements = F.col(child.array)
        if payload.holds_texts(child.path):
            # below the explode: the optimizer would repeat a parse above it for `keep_if`
            shape = payload.element_type(child.path, child.ddl)
            elements = F.transform(elements, lambda text: parsed_text(text, shape))
        rows = arrays.exploded(main, elements, child.keep).select(*child.keep, *fields)
        return rows.filter(child.keep_if()) if child.keep_if else rows


def _readable_array(payload: Payload, spread: Match | Attributes) -> Column:
    """The array in the element type the operators expect, whatever the data looks like.

    An element may lack fields, carry others or spell them in another way; reading it by name gives
    typed nulls. Of several spellings of the array the first that holds something counts.
    """
    ddl = f"array<{spread.element}>"
    found = [_as_declared(column, kind, ddl) for column, kind in payload.find(spread.path)]
    if not found:
        return F.lit(None).cast(ddl)
    return found[0] if len(found) == 1 else F.coalesce(*found)


def _as_declared(column: Column, kind, ddl: str) -> Column:
    if kind.simpleString() == ddl:
        return column
    if not kind.simpleString().startswith("array<struct"):
        return F.lit(None).cast(ddl)
    shape = declared_schema({"x": ddl})["x"].dataType.elementType
    return F.transform(column, lambda e: _reshape(e, kind.elementType, shape))


def _reshape(column: Column, have, want) -> Column:
    """A struct read by name into another struct type."""
    fields = []
    source = Payload(have, column, column, True)
    for f in want.fields:
        found = source.find(f.name)
        if not found:
            fields.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, StructType):
            fields.append(_reshape(found[0][0], found[0][1], f.dataType).alias(f.name))
        else:
            several = [c.cast(f.dataType) for c, _ in found]
            value = several[0] if len(several) == 1 else F.coalesce(*several)
            fields.append(value.alias(f.name))
    return F.when(column.isNotNull(), F.struct(*fields))
