"""Landed list items: text columns, technical ones dropped, declared ones completed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions.dates import DateFields, resolve_dates
from millwright.functions.typing import typed
from millwright.operators.nested import complex_to_json

TECHNICAL = ("parentReference", "__etag")


def landed_items(items: DataFrame, fields: Sequence[str]) -> DataFrame:
    """All columns as text (nested values as JSON), plus NULL columns the source left out."""
    flat = complex_to_json(items.drop(*TECHNICAL))
    text = flat.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in flat.columns])
    missing = {c: F.lit(None).cast("string") for c in fields if c not in text.columns}
    return text.withColumns(missing) if missing else text


def read_list(spark: SparkSession, path: str, schema: Mapping[str, str], dates: DateFields | None = None) -> DataFrame:
    """A landed JSON dump of list items, dates repaired first, then typed by the schema."""
    items = landed_items(spark.read.json(path), list(schema))
    return typed(resolve_dates(items, dates) if dates else items, schema)
