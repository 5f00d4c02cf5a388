"""Flattening of JSON text and nested columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def paths(text: str, fields: Mapping[str, str]) -> list[Column]:
    """``name -> JSON path`` as text columns; JSON text is parsed once per path in the JVM."""
    return [F.get_json_object(text, p).alias(n) for n, p in fields.items()]


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs as ``parent_child`` columns; arrays and maps stay whole."""

    def walk(schema: T.StructType, prefix: tuple[str, ...]):
        for f in schema.fields:
            path = (*prefix, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, path)
            else:
                yield F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path))

    return df.select(*walk(df.schema, ()))


def complex_to_json(df: DataFrame) -> DataFrame:
    """Structs, arrays and maps as JSON text; scalars unchanged."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *[(F.to_json(f.name) if isinstance(f.dataType, nested) else F.col(f.name)).alias(f.name) for f in df.schema.fields]
    )


def matched(df: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """First capture group as a column; rows without a match vanish."""
    return df.where(F.col(text).rlike(pattern)).withColumn(name, F.regexp_extract(text, pattern, 1))
