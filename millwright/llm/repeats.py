"""Repeated passages by sorting the windows of ``min_words`` words around repeated minimisers.

A passage is a run of at least ``min_words`` words (at least ``K``) that stands in two texts, or at two places
of one text that do not overlap. Each such run is covered by windows of just ``min_words`` words, so what is
repeated is known from the windows alone. Most windows need not be looked at: the smallest k-gram hash in a
window (its minimiser) depends on content alone, so equal windows have equal minimisers. Hashes of minimisers
are counted first, and only windows whose minimiser stands at two places go on.

The windows left are range-sorted over all tasks by hash, id and row, so equal ones are neighbours, and a
window in many texts is spread over tasks; neighbours across the border of two tasks are joined by the border
rows. A group of m equal windows gives m rows, however large it is, and its first text is the one with the
smallest id. Windows that follow each other are joined to passages. Nothing is left to which neighbours a
text happens to have: the result is that of comparing all windows (by 64-bit hashes).

Rows: null and empty texts, and texts below ``min_words`` words, have no passages. A row is known by its id and
text: rows equal in both are one text. Null ids are kept as null; an empty table gives no rows; other
columns pass through :func:`without_repeats` and are ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.shared import marked, marks, staged, unused
from millwright.llm.words import BASE, SpanHasher, find_words, mix, text_slices, window_hashes, windows_in_texts

K = 20


def sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``size`` values, by doubling."""
    out, reach = values, 1
    while reach * 2 <= size:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    rest = size - reach
    return pick(out[:-rest], out[rest:]) if rest else out


def minimisers(hashes: np.ndarray, first: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows of ``min_words`` words, the smallest k-gram hash in each, and all k-gram hashes."""
    grams = window_hashes(hashes, K)
    starts = np.flatnonzero(windows_in_texts(first, min_words))
    if len(starts) == 0:
        return starts, np.zeros(0, np.uint64), grams
    return starts, sliding(grams, min_words - K + 1, np.minimum)[starts], grams


def row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _grams(min_words: int):
    """Hashes of the places that are minimiser of some window, a place once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(2)):
                found = find_words(data, offsets)
                starts, least, grams = minimisers(hasher(data, found.starts, found.ends), found.first, min_words)
                if len(starts) == 0:
                    continue
                size = min_words - K + 1
                of = np.zeros(len(grams) - size + 1, np.uint64)
                of[starts] = least
                # A place counts when it holds the smallest hash of one of the windows around it.
                edge = np.zeros(size - 1, np.uint64)
                chosen = sliding(np.concatenate([edge, of, edge]), size, np.maximum) == grams
                yield pa.RecordBatch.from_arrays([pa.array(grams[chosen].view(np.int64))], names=["gram"])

    return run


WINDOW = "hash long, doc_id long, row long, start int, more array<int>"


def _windows(min_words: int, wanted):
    """Windows with a wanted minimiser: one row for each text and content; ``more`` has its further places in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for i, _, data, offsets in text_slices(batch.column(2)):
                found = find_words(data, offsets)
                starts, least, grams = minimisers(hasher(data, found.starts, found.ends), found.first, min_words)
                starts = starts[marked(wanted.value, least.view(np.int64))] if len(starts) else starts
                if len(starts) == 0:
                    continue
                whole = np.zeros(len(starts), np.uint64)
                for at in [*range(0, min_words - K, K), min_words - K]:
                    whole = mix(whole * np.uint64(BASE) + grams[starts + at])
                owner = found.owner()[starts]
                order = np.lexsort((starts, whole, owner))
                starts, whole, owner = starts[order], whole[order], owner[order]
                new = np.concatenate([[True], (whole[1:] != whole[:-1]) | (owner[1:] != owner[:-1])])
                head, local = np.flatnonzero(new), (starts - found.first[owner]).astype(np.int32)
                further = np.concatenate([[0], np.cumsum(np.diff(np.append(head, len(starts))) - 1)]).astype(np.int32)
                rows = pa.array(i + owner[head])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(whole[head].view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(local[head]), pa.ListArray.from_arrays(pa.array(further), pa.array(local[~new]))],
                    names=[x.split()[0] for x in WINDOW.split(", ")],
                )

    return run


SEEN = f"kind int, task int, {WINDOW}, other_id long, earlier boolean"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that another text holds (kind 0); first and last row of the task (kinds 1 and 2).

    Each names the text before it in its group, and the first of a group the one after it.
    """
    from pyspark import TaskContext

    context = TaskContext.get()
    task = context.partitionId() if context is not None else 0
    names = [x.split()[0] for x in SEEN.split(", ")]

    def out(kind: int, rows: pa.RecordBatch, other: pa.Array, earlier: bool) -> pa.RecordBatch:
        n = rows.num_rows
        columns = [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, task, np.int32)), *rows.columns, other, pa.array(np.full(n, earlier))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    nobody = pa.array([None], pa.int64())
    last, heads = None, True
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if last is None:
            yield out(1, batch.slice(0, 1), nobody, False)
        else:
            batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
        whole, row = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("hash", "row"))
        # Rows equal in id and text are one.
        single = np.concatenate([[True], (whole[1:] != whole[:-1]) | (row[1:] != row[:-1])])
        if not single.all():
            batch, whole = batch.filter(pa.array(single)), whole[single]
        same = whole[1:] == whole[:-1]
        head = np.concatenate([[heads], ~same])
        ids = batch.column("doc_id")
        later, first = np.flatnonzero(same) + 1, np.flatnonzero(same & head[:-1])
        if len(later):
            yield out(0, batch.take(pa.array(later)), ids.take(pa.array(later - 1)), True)
        if len(first):
            yield out(0, batch.take(pa.array(first)), ids.take(pa.array(first + 1)), False)
        last, heads = batch.slice(batch.num_rows - 1, 1), bool(head[-1])
    if last is not None:
        yield out(2, last, nobody, False)


SPANS = "row long, doc_id long, start int, end int, other_id long, own boolean, earlier boolean"


def _joined(min_words: int):
    """Spans of windows that follow each other, of rows sorted by all but the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for name in ("row", "other_id", "own", "earlier"):
                values = batch.column(name).fill_null(False if name in ("own", "earlier") else -1).to_numpy(zero_copy_only=False)
                new[1:] |= values[1:] != values[:-1]
            gone = batch.column("other_id").is_null().to_numpy(zero_copy_only=False)
            start = batch.column("start").to_numpy(zero_copy_only=False)
            new[1:] |= (gone[1:] != gone[:-1]) | (start[1:] > start[:-1] + 1)
            head = np.flatnonzero(new)
            ends = start[np.append(head[1:], len(start)) - 1] + min_words
            kept = batch.take(pa.array(head))
            columns = {name: kept.column(name) for name in kept.schema.names} | {"end": pa.array(ends.astype(np.int32))}
            names = [x.split()[0] for x in SPANS.split(", ")]
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return run


def repeated_spans(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """Passages of at least ``min_words`` words: row, doc_id, start, end (words), other_id, own (same text), earlier.

    ``other_id`` is a text that holds the passage too; ``earlier`` tells that it comes before in the order of
    ids (rows of one id in the order of their hash), which holds in all but one of the texts with the passage.
    """
    if min_words < K:
        raise ValueError(f"min_words must be at least {K}")
    rows = docs.select(F.col("doc_id").cast("long"), row_key().alias("row"), F.col("text").cast("string")).where("text is not null")
    grams = rows.mapInArrow(_grams(min_words), "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    wanted = docs.sparkSession.sparkContext.broadcast(marks(staged(grams.select("gram"), "grams"), "gram"))
    windows = staged(rows.mapInArrow(_windows(min_words, wanted), WINDOW), "windows")
    order = ("hash", "doc_id", "row")
    seen = staged(windows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, SEEN), "neighbours")
    # Two rows for each task: the last of one and the first of the next that has rows.
    w = Window.orderBy("task", "kind")
    fields = ("hash", "doc_id", "row", "start", "more")
    here = F.struct(*fields)
    ends = seen.where("kind > 0").select("kind", here.alias("b"), F.lag(here).over(w).alias("a"))
    ends = ends.where("kind = 1 and a.hash = b.hash and a.row <> b.row")

    def side(one: str, other: str, earlier: bool) -> DataFrame:
        return ends.select(*[f"{one}.{c}" for c in fields[1:]], F.col(f"{other}.doc_id").alias("other_id"), F.lit(earlier).alias("earlier"))

    found = seen.where("kind = 0").select(*fields[1:], "other_id", "earlier").unionAll(side("b", "a", True)).unionAll(side("a", "b", False))
    places = F.concat(F.array("start"), "more")
    found = found.withColumn("own", F.lit(False)).withColumn("start", F.explode(places)).drop("more")
    # Places in one text at least a window apart from another.
    alone = windows.where("size(more) > 0").withColumn("_last", F.element_at("more", -1)).withColumn("_first", F.col("start"))
    alone = alone.withColumn("start", F.explode(places)).where(F.greatest(F.col("_last") - F.col("start"), F.col("start") - F.col("_first")) >= min_words)
    alone = alone.select("doc_id", "row", "start", F.col("doc_id").alias("other_id"), F.lit(False).alias("earlier"), F.lit(True).alias("own"))
    every = found.unionByName(alone)
    return every.repartition("row").sortWithinPartitions("row", "own", "other_id", "earlier", "start").mapInArrow(_joined(min_words), SPANS)


def merged(spans: Column) -> Column:
    """Union of an array of (start, end) spans, sorted."""
    span = "struct<start:int,end:int>"
    empty = F.array().cast(f"array<{span}>")

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        touches = (F.size(done) > 0) & (s["start"] <= F.coalesce(last["end"], F.lit(-1)))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), empty, add)


def repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """One row per text that holds repeated passages.

    doc_id, n_repeated_words, spans (merged word spans), other_ids (texts it shares a passage with: for each
    window the one before it in the order of ids, or after it).
    """
    found = repeated_spans(docs, min_words).groupBy("row", "doc_id").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"), F.sort_array(F.collect_set("other_id")).alias("other_ids")
    )
    found = found.withColumn("spans", merged(F.col("spans")))
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", total.alias("n_repeated_words"), "spans", "other_ids")


def without_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``docs`` with each passage cut that a text of a smaller id holds; all columns.

    The words of the passage and the separators inside it go. The text with the smallest id keeps it
    (of texts with that id, one does). Null ids neither cut nor are cut. Columns may have any names.
    """
    key, row, cuts_of = unused(docs, "_key", "_row", "_cuts")
    later = repeated_spans(docs, min_words).where("earlier and other_id <= doc_id")
    cuts = later.groupBy("row").agg(merged(F.collect_set(F.struct("start", "end"))).alias(cuts_of)).withColumnRenamed("row", row)
    keyed = docs.withColumn(key, row_key())
    joined = keyed.join(cuts, keyed[key] == cuts[row], "left").drop(key, row)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column(cuts_of).to_pylist(), strict=True):
                if text is not None and spans:
                    raw = text.encode()
                    found = find_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                    for s in reversed(spans):
                        raw = raw[: found.starts[s["start"]]] + raw[found.ends[s["end"] - 1] :]
                    text = raw.decode()
                out.append(text)
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, "text", pa.array(out, batch.schema.field("text").type))
            yield batch.drop_columns([cuts_of])

    return joined.mapInArrow(cut, docs.schema)
