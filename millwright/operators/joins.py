"""Fact-to-dimension joins that hold up when one key owns a large share of the fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT_KEY = "spark.millwright.broadcastLimitBytes"
DEFAULT_LIMIT = 32 * 1024 * 1024
SALTS = 32


def estimated_bytes(df: DataFrame) -> int:
    """Spark's size estimate of a plan; for a scan it follows from the file sizes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def may_broadcast(df: DataFrame) -> bool:
    limit = int(df.sparkSession.conf.get(LIMIT_KEY, str(DEFAULT_LIMIT)))
    return estimated_bytes(df) <= limit


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    bounded_by: DataFrame | None = None,
) -> DataFrame:
    """Join a fact with a dimension that is unique per ``keys``.

    A dimension whose checked size is small is broadcast: the fact is not shuffled at all.
    A larger one is joined on the key plus a salt, with the dimension repeated per salt,
    so that the rows of a hot key are spread over many tasks. ``bounded_by`` names the table
    whose size bounds the dimension when it was built by joining others (join estimates
    multiply and say nothing).
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    if may_broadcast(dim if bounded_by is None else bounded_by):
        return fact.join(F.broadcast(dim), list(keys), how)
    # Hash of the whole row: the same row gets the same salt when a task is run again.
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.lit(SALTS)).cast("int")
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return fact.withColumn("_salt", salt).join(repeated, [*keys, "_salt"], how).drop("_salt")


def join_sparse(fact: DataFrame, other: DataFrame, keys: Sequence[str], optional: str, spread_by: str | None = None) -> DataFrame:
    """Left join on keys of which ``optional`` is often NULL.

    Rows without the key match nothing; they are spread by another column, or by all of them, instead of
    meeting in the partition of the NULL key. The other side's constant is written as an expression of the key:
    a plain literal is folded into the condition, and the join then deals by the keys alone.
    """
    by = [spread_by] if spread_by else [F.col(f"`{c}`") for c in fact.columns]
    spread = F.when(F.col(optional).isNull(), F.pmod(F.xxhash64(*by), F.lit(1024))).otherwise(F.lit(-1))
    always = F.pmod(F.xxhash64(F.col(f"`{optional}`")), F.lit(1)) - F.lit(1)
    return (
        fact.withColumn("_spread", spread.cast("bigint"))
        .join(other.withColumn("_spread", always.cast("bigint")), [*keys, "_spread"], "left")
        .drop("_spread")
    )
