"""JSON kept as text: fragments, bracket stripping, first elements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fragment(text: Column, json_path: str) -> Column:
    """The part of a JSON text below ``json_path``, as text."""
    return F.get_json_object(text, json_path)


def strip_brackets(text: Column) -> Column:
    """Remove one ``[`` at the start and one ``]`` at the end."""
    return F.regexp_replace(text, r"^\[|\]$", "")


def first_object(text: Column, element: str) -> Column:
    """First element of a JSON array text, parsed as the DDL type ``element``."""
    return F.get(F.from_json(text, f"array<{element}>", {"mode": "PERMISSIVE"}), F.lit(0))


def first_object_stripped(text: Column, element: str) -> Column:
    """The same by stripping the brackets: the parser stops behind the first object."""
    return F.from_json(strip_brackets(text), element, {"mode": "PERMISSIVE"})
