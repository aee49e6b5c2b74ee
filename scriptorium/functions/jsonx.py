"""JSON columns that hold arrays of strings, and whole-row JSON."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_strings(json_text: Column) -> Column:
    return F.from_json(json_text, "array<string>")


def each_string(json_text: Column) -> Column:
    """One row per element; null, broken and empty arrays give no row."""
    return F.explode(parse_strings(json_text))


def row_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def is_broken(json_text: Column) -> Column:
    """Present but not JSON."""
    return json_text.isNotNull() & F.try_parse_json(json_text).isNull()
