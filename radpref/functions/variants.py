"""Typed access to semi-structured (VARIANT) values.

Types are tested before values are read, since reading converts silently: the number 5 at a path is not
the text "5".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from radpref.functions.text import strip


def parse(text: Column) -> Column:
    """A JSON text as a variant. Blank or bad: null. A text that holds JSON in a JSON string is opened twice."""
    bare = strip(text)
    return F.when(bare.startswith('"'), F.try_parse_json(F.try_variant_get(F.try_parse_json(bare), "$", "string"))).when(bare != "", F.try_parse_json(bare))


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, f"$.{path}" if path else "$", kind)


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def at(v: Column, path: str) -> Column:
    """What stands at a path, itself a variant; null where nothing does. A copy: to read a scalar, name its whole path."""
    return _get(v, path, "variant")


def text_at(v: Column, path: str) -> Column:
    """The string at a path; null for anything that is not one. Of JSON's values only strings can be read as bytes."""
    return _get(v, path, "binary").cast("string")


def number_at(v: Column, path: str) -> Column:
    """The number at a path; true and false count as 1 and 0, a text does not count."""
    return F.when(_get(v, path, "binary").isNull(), _get(v, path, "double"))


def number(v: Column) -> Column:
    """A numeric value; true and false count as 1 and 0."""
    return number_at(v, "")


def is_object(v: Column, path: str = "") -> Column:
    """A non-empty object. Its values are not copied: nothing of them is read but the bytes of texts, which, unlike numbers or truth values, any text can be read as without an exception."""
    return F.coalesce(F.size(_get(v, path, "map<string, binary>")) > 0, F.lit(False))


def is_array(v: Column, path: str = "") -> Column:
    return _get(v, path, "array<binary>").isNotNull()


def length(v: Column, path: str = "") -> Column:
    """The number of elements of an array; null for anything else."""
    some = _get(v, path, "array<binary>")
    return F.when(some.isNotNull(), F.size(some))


def elements(v: Column, path: str = "") -> Column:
    """The elements of an array, each a variant; null for anything else."""
    return _get(v, path, "array<variant>")


def truthy(v: Column, path: str = "") -> Column:
    """True numbers but 0, texts but the empty one, non-empty arrays and objects."""
    return F.coalesce(text_at(v, path) != "", _get(v, path, "double") != 0, F.size(_get(v, path, "map<string, binary>")) > 0, F.size(_get(v, path, "array<binary>")) > 0, F.lit(False))


def shown(v: Column, path: str = "") -> Column:
    """A value as text: strings bare, the rest as JSON; null for a JSON null."""
    return _get(v, path, "string")
