"""Schema-driven typing of text columns: bad values become NULL."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions.dates import parsed_timestamp

MISSING_TOKENS = ("nan", "None", "")
TRUE_TOKENS = ("true", "1")


def checked_name(name: str) -> str:
    """Identifiers of a schema may hold word characters only."""
    if not re.fullmatch(r"\w+", name):
        raise ValueError(f"invalid column name: {name!r}")
    return name


def coerced(c: Column, target: str) -> Column:
    """Text as the target type, NULL where it does not fit. ``decimal`` defaults to (18,2)."""
    kind = target.lower()
    text = F.when(~c.cast("string").isin(list(MISSING_TOKENS)), c.cast("string"))
    if kind == "boolean":
        return F.when(text.isNotNull(), F.lower(text).isin(list(TRUE_TOKENS)))
    if kind in ("timestamp", "timestamp_ntz"):
        return parsed_timestamp(text).cast(kind)
    if kind == "date":
        return parsed_timestamp(text).cast("date")
    if kind == "decimal":
        kind = "decimal(18,2)"
    if kind.startswith(("decimal", "double", "float")):
        number = F.when(~F.lower(F.trim(text)).isin("nan", "+nan", "-nan"), text)
        return number.try_cast(kind)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        # By decimal for "12.0", "3.7" and "1e3"; never by double, which 64 bits do not fit.
        return F.coalesce(text.try_cast(kind), text.try_cast("decimal(38,10)").try_cast(kind))
    return text.cast(kind)


def typed(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Declared columns that are present, coerced; the others are dropped."""
    present = [checked_name(c) for c in schema if c in df.columns]
    if not present:
        raise ValueError("no declared column is present")
    types = dict(df.dtypes)

    def one(c: str) -> Column:
        return coerced(F.col(c), schema[c]) if types[c] == "string" else F.col(c).cast(schema[c])

    return df.select(*[one(c).alias(c) for c in present])
