"""Keep-one-per-key and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.functions import clock


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Columns not named in keys or order break remaining ties, so the survivor never depends
    on input order. Spark applies the ``rank = 1`` limit before the shuffle as well: a key
    holding a large share of the rows sends one row per input task, not all of them.
    """
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return first_per_key(df, keys, [F.col(ts).desc_nulls_last()])


def without_repeated_open_runs(
    runs: DataFrame, keys: Sequence[str], start: str, end: str
) -> DataFrame:
    """Drop open runs (NULL end) whose key and start second occur more than once.

    Only narrow keys are grouped and only groups that hold an open run are kept, so the
    anti-joined side stays small next to the runs.
    """
    second = clock.round_to_second(F.col(start))
    repeated = (
        runs.groupBy(*keys, second.alias("_second"))
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col(end).isNull()).alias("open"))
        .where("n > 1 AND open")
        .select(*keys, "_second", F.lit(True).alias("_open"))
    )
    return (
        runs.withColumn("_second", second)
        .withColumn("_open", F.col(end).isNull())
        .join(repeated, [*keys, "_second", "_open"], "left_anti")
        .drop("_second", "_open")
    )
