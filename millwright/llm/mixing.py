"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target number of words and a schedule: its relative weight at the knots of
training time 0 to 1, linear in between and scaled so that its integral is the target. The words of a
source form a stream: its texts in the order of a hash of the id, repeated as often as the target
needs. A text's share of that stream is inverted through the integral of the schedule, which gives
the moment at which it is due. The words of all texts due before it are its position in the training
order, and texts are range-sorted by position.

The stream ends at the target, so the text at the end of the last round may be taken in part, and no
text is taken more than ``cap`` times. Prefix sums are taken over blocks of hash order first and
inside a block after that, so a source with a third of all words is spread over many tasks.

Positions come from sums over cells of training time first and inside a cell after that; a source's texts
are spread over time as its schedule says, so cells are even.

Rows: a null text has size 0 and is never taken; a null source is a source of its own and comes last;
repeated rows are texts of their own (the hash is taken of id and text, so rows of one id or of the null
id are spread like others; equal rows are interchangeable); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.shared import staged

WEIGHTS = (5, 2, 1)
# Weight of a source at training times 0, 1/2 and 1: rising, even and falling sources take turns.
SCHEDULES = ((0.5, 1.0, 1.5), (1.0, 1.0, 1.0), (1.5, 1.0, 0.5))


def n_words(text: Column) -> Column:
    """Number of runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.

    Counts the places where a word begins: a word character at the start or after a separator.
    """
    blank = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(blank, " "), lambda w: w != "")).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = 3) -> DataFrame:
    """``(source, rank, source_size, weight, target)`` from ``sizes(source, size)``.

    Shares the sum of all sizes by weight; what a source cannot take (``cap`` times its size) is shared
    among the others again. With the sources in the order of cap over weight, those below the final
    level are full: the level is found from running sums, without iteration.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on, so windows over all of them stay small.
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = totals.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("limit", (F.col("source_size") * cap).cast("double"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    level = (F.sum("source_size").over(everyone) - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))) / (
        F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    )
    levels = ranked.withColumn("level", level).withColumn("place", F.row_number().over(order))
    # The first source in that order that its level does not fill.
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("place", "level"))
    final = F.min(open_level).over(everyone)["level"]
    target = F.least(F.col("limit"), F.coalesce(final * F.col("weight"), F.col("limit")))
    return levels.withColumn("target", target).select("source", "rank", "source_size", "weight", "target")


def due_time(share: Column, rank: Column, schedules: Sequence[Sequence[float]] = SCHEDULES) -> Column:
    """Training time at which a source has taken ``share`` (0 to 1) of its target.

    Inverts the integral of the piecewise linear schedule: the segment is found from the integral at
    the knots, and inside it a quadratic is solved.
    """
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        width = 1.0 / (len(knots) - 1)
        areas = [(a + b) / 2 * width for a, b in zip(knots, knots[1:], strict=False)]
        total, reached, inner = sum(areas), 0.0, None
        for i, (a, b) in enumerate(zip(knots, knots[1:], strict=False)):
            rest = share * total - F.lit(reached)
            slope = (b - a) / width
            # a*x + slope*x*x/2 = rest, in the form that also holds for a slope of 0.
            x = 2 * rest / (F.lit(a) + F.sqrt(F.greatest(F.lit(0.0), F.lit(a * a) + 2 * slope * rest)))
            when = F.lit(i * width) + F.least(F.lit(width), F.greatest(F.lit(0.0), F.coalesce(x, F.lit(0.0))))
            last = i == len(areas) - 1
            reached += areas[i]
            bound = F.lit(reached)
            inner = [*(inner or []), (None if last else share * total < bound, when)]
        expr = inner[-1][1]
        for test, when in reversed(inner[:-1]):
            expr = F.when(test, when).otherwise(expr)
        out = F.when(rank % len(schedules) == k, expr).otherwise(out)
    return out


def stream_order() -> Column:
    """Hash of id and text: the place of a text in the stream of its source."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")))))


def _streams(docs: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """Per row of ``docs(source, size, _order)``: its source's figures, the words before it in the stream, and what is taken."""
    n = docs.agg(F.count(F.lit(1))).first()[0]
    # Blocks of about 10,000 texts; the prefix of the hash is uniform, so blocks are even.
    digits = max(1, min(7, len(f"{max(1, n // 10_000):x}")))
    rows = docs.withColumn("_block", F.substring("_order", 1, digits))
    sums = staged(rows.groupBy("source", "_block").agg(F.sum("size").alias("size")), "mix-blocks")
    targets = source_targets(sums, weights, cap)
    before = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_offset", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size")
    known = offsets.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    known = known.withColumnsRenamed({"source": "_s", "_block": "_b"})
    inside = Window.partitionBy("source", "_block").orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(known, rows["source"].eqNullSafe(known["_s"]) & (rows["_block"] == known["_b"])).drop("_s", "_b")
    quota = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(F.lit(0))
    rows = rows.withColumn("_before", F.col("_offset") + F.col("_inside")).withColumn("_quota", quota).withColumn("_rounds", whole)
    rest = F.col("_quota") - F.col("_rounds") * F.col("source_size") - F.col("_before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return rows.withColumn("_part", part).withColumn("taken", (F.col("_rounds") * F.col("size") + F.col("_part")).cast("long"))


def _dealt(rows: DataFrame, schedules: Sequence[Sequence[float]]) -> DataFrame:
    """Rows of :func:`_streams` once for each round that takes them.

    Adds ``round``, ``words_taken`` and ``train_time``. A row that no round takes stays once, with a null
    round and time and 0 words.
    """
    n_rounds = (F.col("_rounds") + F.when(F.col("_part") > 0, 1).otherwise(0)).cast("int")
    numbers = F.when(F.col("taken") > 0, F.sequence(F.lit(0), F.greatest(n_rounds - 1, F.lit(0))))
    rows = rows.withColumn("round", F.explode_outer(numbers))
    words = F.when(F.col("round") < F.col("_rounds"), F.col("size")).when(F.col("round").isNotNull(), F.col("_part")).otherwise(F.lit(0))
    rows = rows.withColumn("words_taken", words.cast("long"))
    middle = F.col("round") * F.col("source_size") + F.col("_before") + F.col("words_taken") / 2
    share = F.least(F.lit(1.0), middle / F.nullif(F.col("_quota"), F.lit(0)))
    return rows.withColumn("train_time", F.when(F.col("round").isNotNull(), due_time(share, F.col("rank"), schedules)))


def _placed(dealt: DataFrame, cell_rows: int = 10_000) -> DataFrame:
    """Staged rows of :func:`_dealt` with ``position``, the words of the mix that are due before; range-sorted by it.

    ``cell_rows`` is the mean number of rows in a cell of training time.
    """
    due = dealt.where("round is not null")
    cells = max(1, due.count() // cell_rows)
    cell = F.least(F.lit(cells - 1), F.floor(F.col("train_time") * cells)).cast("long")
    due = due.withColumn("_cell", cell)
    sums = due.groupBy("_cell").agg(F.sum("words_taken").alias("_words"))
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_cell", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_earlier"))
    # Ties in time: by hash, source and round; what is left are equal rows.
    order = ("train_time", "_order", F.col("source").asc_nulls_last(), "round", "_before")
    inside = Window.partitionBy("_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    due = due.withColumn("position", F.coalesce(F.sum("words_taken").over(inside), F.lit(0))).join(offsets, "_cell")
    due = due.withColumn("position", F.col("position") + F.col("_earlier")).drop("_cell", "_earlier")
    left = dealt.where("round is null").withColumn("position", F.lit(None).cast("long"))
    return due.unionByName(left).repartitionByRange("position", "_order").sortWithinPartitions("position", "_order")


def mixture(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    cap: int = 3,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, position)`` per row of ``docs(doc_id, text, source)``.

    The training order is dealt, range-sorted and written; ``taken`` is the sum of a text's rounds and
    ``position`` the words of the mix before its first one (null where nothing is taken).
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), n_words(F.col("text")).alias("size"), stream_order().alias("_order"))
    dealt = staged(_dealt(_streams(staged(rows, "mix-sizes"), weights, cap), schedules), "mix-dealt")
    placed = staged(_placed(dealt), "mix-order")
    known = ("doc_id", "size", "source_size", "target")
    # Words before it in its stream tell a text that is taken from all others of its source.
    taken = placed.where("round is not null").groupBy("source", "_before", *known)
    taken = taken.agg(F.sum("words_taken").alias("taken"), F.min("position").alias("position"))
    left = placed.where("round is null").select(*known, F.col("words_taken").alias("taken"), "position")
    return taken.select(*known, "taken", "position").unionAll(left)


def curriculum(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    cap: int = 3,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
) -> DataFrame:
    """One row per text and round that takes it, range-sorted by training time.

    All columns of ``docs(doc_id, text, source, ...)``, and ``round`` (0-based), ``words_taken`` and
    ``train_time``. Columns of ``docs`` with these names, in whatever case, are replaced.
    """
    added = ("round", "words_taken", "train_time")
    own = [f"`{c}`" for c in docs.columns if c.lower() not in added]
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        n_words(F.col("text")).alias("size"),
        stream_order().alias("_order"),
        F.struct(*own).alias("_row"),
    )
    rows = _dealt(_streams(rows, weights, cap).where("taken > 0"), schedules)
    order = ("train_time", "_order", "doc_id", "round")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_row.*", *added)
