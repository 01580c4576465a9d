"""JSON conversions as Column expressions (path access, encode, decode, arrays, maps)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(c: str | Column, path: str) -> Column:
    """Field by JSON path, e.g. '$.data.city' (NULL when absent or malformed)."""
    return F.get_json_object(F.col(c) if isinstance(c, str) else c, path)


def encode(*cols: Column, pretty: bool = False) -> Column:
    """Record -> JSON object text."""
    opts = {"pretty": "true"} if pretty else None
    return F.to_json(F.struct(*cols), opts) if opts else F.to_json(F.struct(*cols))


def encode_array(records: Column) -> Column:
    """array<struct> -> JSON array text."""
    return F.to_json(records)


def decode(c: str | Column, schema: str) -> Column:
    """JSON object text -> typed struct (e.g. 'name string, age int')."""
    return F.from_json(F.col(c) if isinstance(c, str) else c, schema)


def decode_array(c: str | Column, element_schema: str) -> Column:
    """JSON array text -> array<struct>."""
    return F.from_json(F.col(c) if isinstance(c, str) else c, f"array<struct<{element_schema}>>")


def decode_map(c: str | Column) -> Column:
    """JSON object text -> map<string,string>."""
    return F.from_json(F.col(c) if isinstance(c, str) else c, "map<string,string>")
