"""Building blocks of a job specification: one target column each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions import timeparse
from ..functions.jsontext import fragment
from ..operators.payload import Payload
from ..sources.envelope import AUDIT


@dataclass(frozen=True)
class Out:
    """A target column: its name, how to compute it, and the payload paths it needs.

    ``needs`` are read with a declared type; ``opens`` are parts of unknown shape, kept whole
    where the schema is inferred.
    """

    name: str
    build: Callable[[Payload], Column]
    needs: tuple[tuple[str, str], ...] = ()
    opens: tuple[str, ...] = ()
    constant: bool = False

    def column(self, payload: Payload) -> Column:
        return self.build(payload).alias(self.name)


def _texts(paths: tuple[str, ...]) -> tuple[tuple[str, str], ...]:
    return tuple((path, "string") for path in paths)


def envelope(source: str, name: str | None = None) -> Out:
    return Out(name or source, lambda _: F.col(source))


def load_time(name: str = "acl_dop_ISO") -> Out:
    return Out(name, lambda _: timeparse.stamp14(F.col("acl_dop")))


def audit() -> tuple[Out, ...]:
    """The audit columns passed through."""
    return tuple(envelope(name) for name in AUDIT)


def no_audit() -> tuple[Out, ...]:
    """The audit columns left empty."""
    return tuple(empty(name) for name in AUDIT)


def value(name: str, *paths: str, ddl: str = "string") -> Out:
    """First non-null of several paths; the column's own name if none is given."""
    paths = paths or (name,)
    needs = tuple((path, ddl) for path in paths)
    return Out(name, lambda p: p.value(*paths, ddl=ddl), needs)


def values(prefix: str, *names: str) -> tuple[Out, ...]:
    """Fields below ``prefix`` that keep their names."""
    return tuple(value(name, f"{prefix}.{name}" if prefix else name) for name in names)


def zulu(name: str, *paths: str, zone: str | None = timeparse.BERLIN) -> Out:
    """First readable ISO millisecond text of several paths."""
    paths = paths or (name,)

    def build(p: Payload) -> Column:
        parsed = [timeparse.iso_millis(p.value(path), zone) for path in paths]
        return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)

    return Out(name, build, _texts(paths))


def iso19(name: str, path: str, zone: str | None = timeparse.BERLIN) -> Out:
    return Out(name, lambda p: timeparse.iso_seconds(p.value(path), zone), _texts((path,)))


def epoch(name: str, path: str) -> Out:
    return Out(name, lambda p: timeparse.epoch_millis_text(p.value(path)), _texts((path,)))


def present(name: str, path: str) -> Out:
    """Whether the path holds anything. Its fields must be needed by other columns."""
    return Out(name, lambda p: p.value(path).isNotNull())


def empty(name: str, ddl: str = "string") -> Out:
    return Out(name, lambda _: F.lit(None).cast(ddl), constant=True)


def array_and_text(array: str, text: str, path: str) -> tuple[Out, ...]:
    """An array as a column, and the same part of the payload as JSON text.

    With a declared schema the payload is read once, for the text, and the array is that of its
    elements, each as JSON text with all its fields, so that the column's type does not depend on
    the data and nothing is left out. With an inferred one it is the array of the payload.
    """

    def build_array(p: Payload) -> Column:
        found = p.find(path)
        if found and isinstance(found[0][1], ArrayType):
            return p.value(path)
        return F.from_json(p.value(path).cast("string"), "array<string>", {"mode": "PERMISSIVE"})

    def build_text(p: Payload) -> Column:
        return fragment(p.text, f"$.{path}") if p.inferred else p.value(path)

    return Out(array, build_array, _texts((path,)), (path,)), Out(text, build_text, _texts((path,)))


def node(name: str, path: str) -> Out:
    """A part of unknown shape: as inferred, or its JSON text where the schema is declared."""
    return Out(name, lambda p: p.value(path), _texts((path,)), (path,))


def node_text(name: str, path: str) -> Out:
    """A part of unknown shape, always as text."""

    def build(p: Payload) -> Column:
        found = p.find(path)
        nested = bool(found) and "<" in found[0][1].simpleString()
        return F.to_json(p.value(path)) if nested else p.value(path).cast("string")

    return Out(name, build, _texts((path,)), (path,))


def inside(name: str, path: str, field: str) -> Out:
    """A field of a part of unknown shape that is itself a target column."""

    def build(p: Payload) -> Column:
        whole = p.find(path)
        if whole and whole[0][1].simpleString() == "string":
            return fragment(p.value(path), f"$.{field}")
        return p.value(f"{path}.{field}")

    return Out(name, build, _texts((path,)), (path,))
