"""Interval algebra that stays linear when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.functions import clock
from millwright.functions.clock import AsOf


def in_window(start: Column, end: Column, as_of: AsOf, days: int) -> Column:
    """Rolling window on an interval: it starts or ends inside the last ``days`` days."""
    limit = clock.days_before(as_of, days)
    return (start >= limit) | (end >= limit)


def point_in_window(ts: Column, as_of: AsOf, days: int) -> Column:
    return ts >= clock.days_before(as_of, days)


def overlaps_period(start: Column, end: Column, period_start: AsOf, period_end: AsOf) -> Column:
    """Inclusive overlap with the analysis period; an open (NULL) end does not pass."""
    return (start <= clock.ntz(period_end)) & (end >= clock.ntz(period_start))


def touches_range(start: Column, end: Column, low: AsOf, high: AsOf) -> Column:
    """Backfill rule: starts inside, ends inside, or spans the whole range."""
    lo, hi = clock.ntz(low), clock.ntz(high)
    return start.between(lo, hi) | end.between(lo, hi) | ((start < lo) & (end > hi))


def clip(start: Column, end: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Both ends moved into ``[low, high]``; a NULL end stays NULL."""
    return (
        F.when(start < low, low).otherwise(start),
        F.when(end > high, high).otherwise(end),
    )


# Each tile of the time hierarchy holds eight of the level below; four levels above a day reach eleven years.
RADIX_BITS, TOP_LEVEL = 3, 4


def tiles(first: Column, last: Column) -> Column:
    """The tiles of an interval of base tiles ``first`` to ``last``, as a list of ``(level, index, own)``.

    Own tiles cover the interval without overlap, the largest that fit: their number grows with the logarithm of
    its length. The others are the tiles it fills in part, at most two a level; they hold own tiles.
    """
    nothing = F.array().cast("array<bigint>")

    def numbered(level: int, a: Column, b: Column) -> Column:
        """Own tiles ``a`` to before ``b`` of a level."""
        found = F.when(a < b, F.sequence(a, b - 1)).otherwise(nothing)
        return F.transform(found, lambda i: F.struct(F.lit(level).alias("level"), i.alias("index"), F.lit(True).alias("own")))

    def whole(level: int) -> tuple[Column, Column]:
        """First whole tile of a level, and the one after the last."""
        bits = RADIX_BITS * level
        return F.shiftright(first + ((1 << bits) - 1), bits), F.shiftright(last + 1, bits)

    def held(level: int) -> Column:
        """Tiles of a level that are filled in part."""
        bits, (low, high) = RADIX_BITS * level, whole(level)
        edges = F.array_distinct(F.array(F.shiftright(first, bits), F.shiftright(last, bits)))
        partly = F.filter(edges, lambda i: (i < low) | (i >= high))
        return F.transform(partly, lambda i: F.struct(F.lit(level).alias("level"), i.alias("index"), F.lit(False).alias("own")))

    parts = [numbered(TOP_LEVEL, *whole(TOP_LEVEL))] + [held(level) for level in range(1, TOP_LEVEL + 1)]
    for level in range(TOP_LEVEL):
        (low, high), (up_low, up_high) = whole(level), whole(level + 1)
        above = up_low < up_high  # the middle is covered by larger tiles
        step = 1 << RADIX_BITS
        parts += [numbered(level, low, F.when(above, up_low * step).otherwise(high)), numbered(level, F.when(above, up_high * step).otherwise(high), high)]
    return F.concat(*parts)


def intersect(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    bucket_seconds: int = clock.DAY,
    names: tuple[str, str] = ("ini_parada", "fim_parada"),
    how: str = "inner",
    period: tuple[AsOf, AsOf] | None = None,
) -> DataFrame:
    """Row-level intersections (inclusive ends) of two interval sets sharing ``on``.

    Both sides are cut into :func:`tiles` of a time hierarchy above ``bucket_seconds`` and equi-joined on ``on``
    and tile, so a busy key is spread over time and a run of years makes tens of rows, not one a day. The own
    tiles of both sides that hold their first common moment lie in one another: the pair meets in the larger
    one, once, which makes the result exact without a distinct. The intersection is clipped to the left interval.

    With a ``period`` both sides are clipped to it first; rows outside are dropped, open ends last to its end.

    With ``how="left"`` a left row that meets nothing stays, with NULL bounds; rows of one key
    and span meet the same, so key and span tell which are left.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")

    limits = [clock.ntz(p) for p in period] if period else None

    def span_of(span: tuple[str, str]) -> tuple[Column, Column]:
        start, end = F.col(span[0]), F.col(span[1])
        if limits is None:
            return start, end
        low, high = limits
        return F.greatest(start, low), F.least(F.coalesce(end, high), high)

    def spanned(df: DataFrame, span: tuple[str, str], tag: str) -> DataFrame:
        start, end = span_of(span)
        df = df.where(F.col(span[0]).isNotNull()).withColumns({f"_{tag}0": start, f"_{tag}1": end}).where(f"_{tag}0 <= _{tag}1")
        return df.withColumns({f"_{tag}a": F.floor(clock.epoch_seconds(F.col(f"_{tag}0")) / bucket_seconds), f"_{tag}b": F.floor(clock.epoch_seconds(F.col(f"_{tag}1")) / bucket_seconds)})

    def tiled(df: DataFrame, tag: str, other: DataFrame, other_tag: str) -> DataFrame:
        if limits is not None:
            reach = F.floor((clock.epoch_seconds(limits[1]) - clock.epoch_seconds(limits[0])) / bucket_seconds) + 2
        else:
            reach = other.agg(F.max(F.col(f"_{other_tag}b") - F.col(f"_{other_tag}a") + 1)).scalar()
        cut = F.inline(tiles(F.col(f"_{tag}a"), F.col(f"_{tag}b")))
        cut = df.select("*", cut).withColumnsRenamed({"level": "_level", "index": "_tile", "own": f"_{tag}own"})
        # A tile filled in part meets own tiles of the other side, which are no longer than its longest interval.
        size = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_level") * RADIX_BITS)
        return cut.where(F.col(f"_{tag}own") | (size <= reach))

    keep = [c for c in right.columns if c not in on]
    renamed = right.select(*on, *[F.col(c).alias(f"_r_{c}") for c in keep])
    extra = [c for c in keep if c not in right_span and c not in left.columns]
    ls = spanned(left, left_span, "l")
    rs = spanned(renamed, (f"_r_{right_span[0]}", f"_r_{right_span[1]}"), "r")
    ini, fim = clip(F.col("_r0"), F.col("_r1"), F.col("_l0"), F.col("_l1"))
    shared = F.greatest("_la", "_ra")
    holds = F.call_function("shiftright", shared, F.col("_level") * RADIX_BITS) == F.col("_tile")
    met = (
        tiled(ls, "l", rs, "r")
        .join(tiled(rs, "r", ls, "l"), [*on, "_level", "_tile"])
        .where((F.col("_lown") | F.col("_rown")) & holds & (F.col("_r0") <= F.col("_l1")) & (F.col("_r1") >= F.col("_l0")))
        .select(
            *left.columns,
            *[F.col(f"_r_{c}").alias(c) for c in extra],
            ini.alias(names[0]),
            fim.alias(names[1]),
        )
    )
    if how == "inner":
        return met
    known = [*on, *left_span]
    if period:
        left = ls.select(*left.columns)
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in known]
    found = met.select(*[F.col(c).alias(f"_k_{c}") for c in known]).distinct()
    alone = left.join(found, reduce(and_, same), "left_anti").select(*left.columns)
    return met.unionByName(alone, allowMissingColumns=True)


def covered_seconds(
    runs: DataFrame,
    cover: DataFrame,
    on: Sequence[str],
    group_by: Sequence[str],
    span: tuple[str, str] = ("ini_corte", "fim_corte"),
) -> DataFrame:
    """Per group: total run seconds and the seconds covered by ``cover``, counted per pair.

    ``runs`` and ``cover`` hold whole-second intervals that start and end inside the same
    ``on`` bucket (e.g. machine + day + shift). The covered time of run ``[a, b)`` summed over
    all cover intervals is ``S(b) - S(a)`` with ``S`` the running integral of how many cover
    intervals are open, so no pair is ever formed. Ends are pre-aggregated per second, which
    bounds a bucket by its length however many rows fall into it.

    Returns ``group_by`` + ``total`` + ``covered``.
    """
    a, b = span
    ends = F.array(
        F.struct(F.col(b).alias("t"), F.lit(1).alias("w")),
        F.struct(F.col(a).alias("t"), F.lit(-1).alias("w")),
    )
    labels = [g for g in group_by if g not in on]
    points = (
        runs.select(*on, *labels, F.explode(ends).alias("e"))
        .groupBy(*on, *labels, F.col("e.t").alias("t"))
        .agg(F.sum("e.w").alias("w"))
        .withColumn("opened", F.lit(0).cast("bigint"))
        .withColumn("is_run", F.lit(True))
    )
    deltas = (
        cover.select(*on, F.explode(ends).alias("e"))
        .groupBy(*on, F.col("e.t").alias("t"))
        .agg((-F.sum("e.w")).alias("opened"))
        .where(F.col("opened") != 0)
        .withColumn("is_run", F.lit(False))
    )
    # A change at the very second of a point contributes nothing, so ties need no order.
    before = Window.partitionBy(*on).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    integral = F.col("t") * F.sum("opened").over(before) - F.sum(F.col("opened") * F.col("t")).over(before)
    return (
        points.unionByName(deltas, allowMissingColumns=True)
        .withColumn("area", integral)
        .where("is_run")
        .groupBy(*group_by)
        .agg(
            F.sum(F.col("w") * F.col("t")).alias("total"),
            F.sum(F.col("w") * F.col("area")).alias("covered"),
        )
    )
