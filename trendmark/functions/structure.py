"""Expressions that depend on how an input happens to be shaped."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_JOINERS = (".", "__", "_")


def _nested_type(schema: T.StructType, parts: list[str]) -> T.DataType | None:
    current: T.DataType = schema
    for part in parts:
        if not isinstance(current, T.StructType) or part not in current.fieldNames():
            return None
        current = current[part].dataType
    return current


def _located(df: DataFrame, path: str) -> tuple[Column, T.DataType] | None:
    """Find ``a.b`` as a nested field, else as a flat column spelt ``a.b``, ``a__b`` or ``a_b``."""
    parts = path.split(".")
    nested = _nested_type(df.schema, parts)
    if nested is not None:
        return F.col(".".join(f"`{part}`" for part in parts)), nested
    for joiner in _JOINERS:
        name = joiner.join(parts)
        if name in df.columns:
            return F.col(f"`{name}`"), df.schema[name].dataType
    return None


def has_field(df: DataFrame, path: str) -> bool:
    return _located(df, path) is not None


def field_or(df: DataFrame, path: str, dtype: str, default: object = None) -> Column:
    """The field at ``path`` as ``dtype``, or the default where the input has no such field.

    Text lists become one text joined with ``|`` when a string is wanted.
    """
    located = _located(df, path)
    if located is None:
        return F.lit(default).cast(dtype)
    column, found = located
    if dtype == "string" and isinstance(found, T.ArrayType):
        return F.array_join(column, "|")
    return column.try_cast(dtype)


def _leaves(schema: T.StructType, prefix: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for child in schema.fields:
        path = (*prefix, child.name)
        if isinstance(child.dataType, T.StructType):
            yield from _leaves(child.dataType, path)
        else:
            yield path


def flatten_struct(df: DataFrame, separator: str = ".") -> DataFrame:
    """Every nested struct field as a top-level column named after its path."""
    return df.select(
        [F.col(".".join(f"`{part}`" for part in path)).alias(separator.join(path)) for path in _leaves(df.schema)]
    )
