"""Metadata helpers: keep only scalar values of a JSON object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scalar_metadata(json_col) -> Column:
    """JSON object -> ``map<string,string>`` of its scalar members (strings,
    numbers, booleans); nested objects and arrays are dropped by their type,
    as is null. A string stays whatever it begins with."""
    c = F.col(json_col) if isinstance(json_col, str) else json_col
    m = F.from_json(c, "map<string,variant>")
    scalar = F.map_filter(m, lambda k, v: ~F.schema_of_variant(v).rlike("^(OBJECT|ARRAY|VOID)"))
    return F.transform_values(scalar, lambda k, v: v.cast("string"))
