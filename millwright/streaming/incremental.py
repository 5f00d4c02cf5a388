"""Watermark gates and extract windows of the incremental loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.functions import clock
from millwright.functions.clock import AsOf


def latest_by_key(df: DataFrame, keys: Sequence[str], ts: str, name: str = "ultima_data_hora") -> DataFrame:
    """Newest timestamp per key (partial maxima are combined before the shuffle)."""
    return df.groupBy(*keys).agg(F.max(ts).alias(name))


def keys_with_news(source: DataFrame, target: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Keys whose newest source row is newer than the target's, or that the target lacks."""
    newest = latest_by_key(source, keys, ts, "_source").where(F.col("_source").isNotNull())
    loaded = latest_by_key(target, keys, ts, "_target")
    return (
        newest.join(loaded, list(keys), "left")
        .where(F.col("_target").isNull() | (F.col("_source") > F.col("_target")))
        .select(*keys)
    )


def newer_than_target(source: DataFrame, target: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Source rows of the keys with news; unchanged keys are skipped whole."""
    return source.join(keys_with_news(source, target, keys, ts), list(keys), "left_semi")


def window_days(text: str | int) -> int:
    """A look-back setting: a non-negative whole number of days, possibly as text."""
    if not str(text).strip().isdigit():
        raise ValueError(f"look-back must be a non-negative integer, got {text!r}")
    return int(text)


def lookback(df: DataFrame, ts: str, as_of: AsOf, days: str | int) -> DataFrame:
    """Rows in ``[as_of - days, as_of)``."""
    end = clock.ntz(as_of)
    start = F.timestamp_add("DAY", F.lit(-window_days(days)), end)
    return df.where((F.col(ts) >= start) & (F.col(ts) < end))


def modified_since(df: DataFrame, as_of: AsOf, days: str | int, modified: str = "Modified") -> DataFrame:
    """List items modified in the last days (paging is left to the reader)."""
    start = F.timestamp_add("DAY", F.lit(-window_days(days)), clock.ntz(as_of))
    return df.where(F.col(modified) >= start)


def last_ids(df: DataFrame, count: int, key: str = "ID") -> DataFrame:
    """Rows with ``key >= max(key) - count``; the maximum is a scalar subquery."""
    newest = df.agg(F.max(key)).scalar()
    return df.where(F.col(key) >= newest - F.lit(count))


